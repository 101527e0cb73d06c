"""Profiles kept beside merged runs, so that a profile does not rescan the dataset (AGG-01, AGG-10, EXP-03).

Maintenance writes one partial profile per merged run: records and distinct identifiers by source
and scheme, a row per file and scheme.  Runs never change, so a partial stays right
until its run is replaced.  On read:

- Records add up over runs, replays and compactions included.
- Identifiers add up for a group (source, scheme) that one run holds alone, which is the rule: a
  file belongs to one batch, and a batch to one run.
- A group that several runs hold is counted anew from the identifiers of those runs.  They are the
  exact key state: sorted by shard directory, read without the other columns.

Single batches have no partial; they are few between two maintenances, and are scanned.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.exposure import scheme_profile
from vigil.operators.protect import PROTECTED_SCHEMA
from vigil.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES, estimate_bytes, materialise
from vigil.plans.runs import Outputs, current_runs, path_exists, read_runs

GROUP = ("source", "hash_type", "is_hash")
_PARTIAL = "source string, hash_type string, is_hash boolean, n_records bigint, n_ids bigint"


def profile_run(spark: SparkSession, out: Outputs, run: str) -> None:
    """The partial profile of one merged run, in place of what an earlier try has left."""
    scheme_profile(read_runs(spark, out, [run]), GROUP).write.mode("overwrite").parquet(f"{out.profiles}/{run}")


def _same_group(a: str, b: str) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in GROUP])


def _named_runs(df: DataFrame) -> DataFrame:
    return df.withColumn("run", F.concat(F.lit("run="), F.col("run").cast("string")))


def partial_profiles(spark: SparkSession, out: Outputs, runs: Sequence[str]) -> DataFrame:
    """``run``, group, ``n_records``, ``n_ids``: stored where a run has a partial, else from its records."""
    stored = [r for r in runs if path_exists(spark, f"{out.profiles}/{r}")]
    scanned = [r for r in runs if r not in set(stored)]
    parts = []
    if stored:
        paths = [f"{out.profiles}/{r}" for r in stored]
        parts.append(_named_runs(spark.read.schema(_PARTIAL).option("basePath", out.profiles).parquet(*paths)))
    if scanned:
        found = spark.read.schema(PROTECTED_SCHEMA).option("basePath", out.records).parquet(*[out.path(r) for r in scanned])
        parts.append(_named_runs(scheme_profile(found, ("run", *GROUP))))
    columns = ["run", *GROUP, "n_records", "n_ids"]
    if not parts:
        return spark.createDataFrame([], f"run string, {_PARTIAL}")
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def stored_profile(spark: SparkSession, out: Outputs, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``scheme_profile`` of the current records, merged from partial profiles.

    An empty dataset gives no rows.  The driver holds the names of the runs that share a group.
    """
    partials = partial_profiles(spark, out, current_runs(spark, out))
    groups = materialise(
        partials.groupBy(*GROUP).agg(
            F.sum("n_records").alias("n_records"), F.sum("n_ids").alias("n_ids"), F.collect_set("run").alias("runs")
        )
    )
    shared = groups.where(F.size("runs") > 1)
    opened = sorted(r["run"] for r in shared.select(F.explode("runs").alias("run")).distinct().collect())
    if not opened:
        return groups.drop("runs")
    wanted = shared.select(*GROUP)
    small = estimate_bytes(wanted)[1] <= max_broadcast_bytes
    ids = read_runs(spark, out, opened).select(*GROUP, "id_digest")
    if small:
        met = ids.alias("i").join(F.broadcast(wanted.alias("w")), _same_group("i", "w"), "left_semi")
    else:  # each identifier once per group before it moves
        met = ids.distinct().alias("i").join(wanted.alias("w"), _same_group("i", "w"), "left_semi")
    exact = met.groupBy(*GROUP).agg(F.count_distinct("id_digest").alias("n_exact"))
    side = F.broadcast(exact.alias("e")) if small else exact.alias("e")
    return groups.alias("g").join(side, _same_group("g", "e"), "left").select(
        *[F.col(f"g.{c}") for c in GROUP], "g.n_records", F.coalesce("e.n_exact", "g.n_ids").alias("n_ids")
    )
