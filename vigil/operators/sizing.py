"""Sizes of join sides.

A side is broadcast only after it has been measured; each operator says what
it does above the bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import checkpoint_root

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = 8


def estimate_bytes(df: DataFrame) -> tuple[int, int]:
    """(rows, approximate in-memory bytes) of ``df`` in one aggregate job."""
    var_cols = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.sum(F.coalesce(F.octet_length(F.col(c)), F.lit(0))).alias(f"_v{i}")
        for i, c in enumerate(var_cols)
    ]
    row = df.agg(*aggs).head()
    rows = int(row["_rows"])
    var = sum(int(row[f"_v{i}"] or 0) for i in range(len(var_cols)))
    return rows, rows * _FIXED_WIDTH * (len(df.columns) + 1) + var


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (cuts lineage)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
