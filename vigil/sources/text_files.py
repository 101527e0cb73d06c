"""Text-file discovery and line scan (SRC-01..03, FLT-10, SET-02, PRJ-08).

Lines come back as ``(source, block, seq, line)``: ``source`` is the full
file path in URI form (``_metadata.file_path``: scheme prefix, percent-encoded), ``block`` the byte offset of the split the line was read from
and ``seq`` a per-task increasing id, so ``(block, seq)`` orders the lines
of a file.  Text files split at ``spark.sql.files.maxPartitionBytes``, so a
large file is read by many tasks; gzip files do not split.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Discovery suffix patterns.
TXT_ANY_CASE = "*.[tT][xX][tT]"
TXT_LOWER = "*.txt"


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str = TXT_ANY_CASE,
    recursive: bool = True,
) -> DataFrame:
    """Scan every matching file under ``paths``.  The text source splits
    lines at ``\\n``, ``\\r\\n`` and ``\\r``."""
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.text(_paths(paths)).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )


def list_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str = TXT_ANY_CASE,
    recursive: bool = True,
) -> DataFrame:
    """``(source, path, length, modified)`` of matching files with content; contents are not read
    (the binary-file source prunes the ``content`` column).  ``source`` is
    ``_metadata.file_path``, the same URI form :func:`read_lines` yields, so
    listings and loaded sources compare equal (the plain ``path`` column
    is not percent-encoded)."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(_paths(paths)).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("path"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
    )


def empty_files(
    spark: SparkSession, paths: str | Sequence[str], glob: str = TXT_ANY_CASE, recursive: bool = True
) -> DataFrame:
    """``(source)`` of matching files of zero bytes, which no scan hands out.

    The names come from Spark's own file index, which the driver holds anyway.
    """
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    # the index writes file:///a where scans write file:/a
    files = [re.sub("^file:///", "file:/", f) for f in reader.text(_paths(paths)).inputFiles()]
    names = spark.createDataFrame([(f,) for f in files], "source string")
    return names.join(list_files(spark, paths, glob, recursive).select("source"), "source", "left_anti")


def literal_path(path: str) -> str:
    """``path`` with glob characters escaped, for a reader that expands globs."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", path)
