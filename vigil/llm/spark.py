"""Small shared helpers: checkpoints in the session's shared folder, safe column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.session import checkpoint_root, scratch_path


def frozen(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in ``spark.checkpoint.dir``; lineage ends there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back.

    For wide or reusable intermediates: the files are compressed and columnar,
    and reading them again needs no earlier stage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores put before it until no column of ``df`` has that name.

    Spark compares names without case unless told otherwise, so this does too.
    """
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


__all__ = ["free_name", "frozen", "stored", "table", "scratch_path"]
