"""Union of shard roots (SET-01) and merge with dedupe (MNT-02)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.dedupe import one_per_key


def union_roots(roots: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL aligned by column name; columns missing in a root are null."""
    if len(roots) < 2:
        raise ValueError("merge needs at least two roots")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), roots)


def merge_roots(roots: Sequence[DataFrame]) -> DataFrame:
    """Each key once, with ``copies`` = number of rows across all roots."""
    return one_per_key(union_roots(roots), F.count(F.lit(1)).alias("copies"))
