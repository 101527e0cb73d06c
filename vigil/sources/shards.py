"""Protected-shard and legacy JSONL scans (SRC-04/05/07, FLT-11, SET-02)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.protect import PROTECTED_COLUMNS, PROTECTED_SCHEMA

# One dialect for the CSV writer and reader: quotes inside a field are doubled.
CSV_DIALECT = {"header": "true", "escape": '"'}

# Fixed value: legacy shard files end in ``.jsonl`` or ``.jsonl.gz``.
JSONL_GLOB = "*.{jsonl,jsonl.gz}"


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_protected(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Protected records from one or more shard roots (``p2`` from the
    directory names, typed by the explicit schema)."""
    reader = spark.read.schema(PROTECTED_SCHEMA)
    if fmt == "json":
        found = reader.json(_paths(paths))
    elif fmt == "csv":
        found = reader.options(**CSV_DIALECT).csv(_paths(paths))
    else:
        found = reader.parquet(*_paths(paths))
    return found.select(*PROTECTED_COLUMNS)


def read_legacy_jsonl(spark: SparkSession, roots: str | Sequence[str]) -> DataFrame:
    """Raw legacy JSONL lines (plain or gzip by extension) from several roots;
    ``root_file`` keeps which file each line came from."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", JSONL_GLOB)
        .text(_paths(roots))
        .select("value", F.col("_metadata.file_path").alias("root_file"))
    )
