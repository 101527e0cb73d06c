"""Files in, shards out, shards back in (SRC-01..04, SNK-01/05, FLT-10).

Synthetic lines are written as text files grouped by name, discovered
recursively with a case-insensitive ``.txt`` filter, parsed at the first
``:``, protected, written as gzip JSON shards partitioned by ``p2`` and
read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.paths import partition_value
from vigil.operators.protect import Keys
from vigil.plans.parse_protect import protected_first_colon
from vigil.session import scratch_path
from vigil.sinks.shards import write_protected
from vigil.sources.shards import read_protected
from vigil.sources.text_files import read_lines


def write_named_text(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``source``'s lines as text files under ``path/name=<stem>/``."""
    named = lines.select(
        F.regexp_extract("source", r"([^/]+)\.[tT][xX][tT]$", 1).alias("name"), "line"
    )
    named.write.mode(mode).partitionBy("name").text(path)


def file_roundtrip(spark: SparkSession, lines: DataFrame, keys: Keys) -> DataFrame:
    root = scratch_path(spark, "roundtrip")
    write_named_text(lines, f"{root}/input")
    recs = protected_first_colon(read_lines(spark, f"{root}/input"), keys)
    write_protected(recs, f"{root}/shards", fmt="json", mode="errorifexists")
    back = read_protected(spark, f"{root}/shards", fmt="json")
    return back.groupBy(partition_value(F.col("source"), "name").alias("name")).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_distinct("id_digest").alias("n_ids"),
    )


def csv_roundtrip(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Records whose source holds quotes, commas and backslashes, to CSV and back."""
    root = scratch_path(spark, "csv")
    odd = F.concat(F.lit('/d/a "q", b\\\'s/'), F.substring_index("source", "/", -1))
    write_protected(records.withColumn("source", odd), root, fmt="csv", mode="errorifexists")
    return read_protected(spark, root, fmt="csv").groupBy("source", "is_hash", "hash_type").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.substring("id_digest", 1, 4) == F.col("p4")).alias("n_whole"),
    )


def stored(spark: SparkSession, records: DataFrame) -> DataFrame:
    """``records`` written as Parquet shards and read back."""
    root = scratch_path(spark, "shards")
    write_protected(records, root, mode="errorifexists")
    return read_protected(spark, root)
