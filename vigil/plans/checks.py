"""Exposure checks against stored shards (EXP-01/02, JON-05 re-aimed).

Callers pass their own identifier digests (never addresses); results are
counts and scheme names only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.operators import exposure
from vigil.sources.shards import read_protected


def exposure_report(spark: SparkSession, records_path: str, watchlist: DataFrame, fmt: str = "parquet") -> DataFrame:
    return exposure.exposure_check(read_protected(spark, records_path, fmt), watchlist)


def range_lookup(
    spark: SparkSession, records_path: str, prefixes: DataFrame, k: int = 2, fmt: str = "parquet"
) -> DataFrame:
    return exposure.prefix_range(read_protected(spark, records_path, fmt), prefixes, k=k)
