"""Protected-record sinks (SNK-01/02/05/06, SCL-09/10).

Records are written partitioned by ``p2`` (256 directories) and sorted by
``p4, id_digest`` inside each file, so a lookup that filters ``p2`` and
``p4`` prunes directories and row groups.  ``REBALANCE(p2)`` lets AQE cut
each directory's rows into advisory-sized tasks: every task writes into
one or two directories, and no directory is funnelled through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.protect import PROTECTED_COLUMNS
from vigil.sources.shards import CSV_DIALECT

FORMATS = ("parquet", "json", "csv")


def write_run(records: DataFrame, path: str) -> None:
    """Write one run's records under ``path/p2=xx/``, in place of what an earlier try has left there."""
    layout_for_write(records).write.mode("overwrite").option("compression", "zstd").partitionBy("p2").parquet(path)


def replace_shards(records: DataFrame, path: str) -> None:
    """Write the shard directories that ``records`` has rows for, each in place of its earlier content."""
    (
        layout_for_write(records)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("p2")
        .parquet(path)
    )


def layout_for_write(records: DataFrame) -> DataFrame:
    return (
        records.select(*PROTECTED_COLUMNS)
        .hint("rebalance", "p2")
        .sortWithinPartitions("p2", "p4", "id_digest")
    )


def write_protected(
    records: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "append",
    compression: str | None = None,
) -> None:
    """Append (or write) protected records under ``path/p2=xx/``.

    ``fmt='json'`` writes JSON lines, gzip by default (SNK-05); ``csv``
    quotes every field and doubles embedded quotes (SCL-09).
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    w = layout_for_write(records).write.mode(mode).partitionBy("p2")
    if fmt == "parquet":
        w.option("compression", compression or "zstd").parquet(path)
    elif fmt == "json":
        w.option("compression", compression or "gzip").json(path)
    else:
        (
            w.option("compression", compression or "none")
            .options(**CSV_DIALECT)
            .option("quoteAll", "true")
            .csv(path)
        )


def write_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Idempotent table write: with ``partition`` (e.g. ``batch_id``) only the
    partitions present in ``df`` are replaced, so a replayed batch rewrites
    its own rows instead of appending them twice."""
    w = df.write.mode("overwrite")
    if partition:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(partition)
    w.parquet(path)
