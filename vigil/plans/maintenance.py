"""Shard maintenance jobs (MNT-01..04, SET-01, SNK-05/06, STR-06).

Every job writes a new output location and never overwrites a path it is
reading.  ``maintain`` works on a dataset and switches its readers (see
``vigil.plans.runs``); after the other jobs that is the caller's step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.legacy import protect_legacy
from vigil.operators.dedupe import one_per_key
from vigil.operators.merge import union_roots
from vigil.operators.protect import PROTECTED_COLUMNS, Keys
from vigil.plans.index import absent_from_runs, index_run
from vigil.plans.profiles import profile_run
from vigil.plans.runs import (
    Outputs,
    Run,
    append_version,
    current_version,
    delete_path,
    loose_batches,
    loose_runs,
    path_exists,
    ranges,
    read_manifest,
    read_runs,
    read_versions,
)
from vigil.sinks.shards import replace_shards, write_protected, write_run
from vigil.sources.shards import read_legacy_jsonl, read_protected


def _distinct_paths(src: Sequence[str], dst: str) -> None:
    if dst.rstrip("/") in {s.rstrip("/") for s in src}:
        raise ValueError("output must differ from every input (no in-place rewrite)")


def dedupe_shards(spark: SparkSession, src: str, dst: str, fmt: str = "parquet") -> None:
    """Global dedupe on the record key (MNT-01).  The shuffle is keyed by the
    digest, so it spreads evenly; partial aggregation collapses repeats of
    a hot key before the exchange."""
    _distinct_paths([src], dst)
    recs = read_protected(spark, src, fmt)
    write_protected(one_per_key(recs), dst, fmt=fmt, mode="errorifexists")


def merge_shard_roots(spark: SparkSession, roots: Sequence[str], dst: str, fmt: str = "parquet", dedupe: bool = True) -> None:
    """Union of several shard roots (SET-01), deduplicated by key (MNT-02)."""
    _distinct_paths(roots, dst)
    u = union_roots([read_protected(spark, r, fmt) for r in roots])
    write_protected(one_per_key(u) if dedupe else u, dst, fmt=fmt, mode="errorifexists")


_WORK = "p2 string, state string, at timestamp"
CLAIMED, MERGED = "claimed", "done"


def _mark(spark: SparkSession, work: str, slices: Sequence[str], state: str) -> None:
    rows = spark.createDataFrame([(p, state) for p in slices], "p2 string, state string")
    rows.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(work)


def shards_left(spark: SparkSession, roots: Sequence[str], work: str) -> list[str]:
    """Shard directories (256 at most) of ``roots`` that the work list does not call done."""
    found = union_roots([read_protected(spark, r) for r in roots]).select("p2").distinct()
    if path_exists(spark, work):
        done = spark.read.schema(_WORK).parquet(work).where(F.col("state") == MERGED).select("p2").distinct()
        found = found.join(done, "p2", "left_anti")
    return sorted(r["p2"] for r in found.collect())


def resumable_merge(
    spark: SparkSession,
    roots: Sequence[str],
    dst: str,
    work: str,
    dedupe: bool = True,
    slice_size: int = 32,
    most_slices: int | None = None,
) -> list[str]:
    """Merge (or, of one root, deduplicate) shard roots in slices of shard directories (MNT-01, MNT-02).

    ``work`` is a list of directories and their states.  A slice is claimed, written (in place of
    what an earlier try has left of it) and marked done, so a merge that was killed goes on
    with the directories that are left.  A record's key decides its directory, so slices
    share no duplicates.  Returns the directories that are left, if ``most_slices`` ended it.
    """
    _distinct_paths(roots, dst)
    left = shards_left(spark, roots, work)
    whole = union_roots([read_protected(spark, r) for r in roots])
    for k in range(0, len(left), slice_size):
        if most_slices is not None and k >= most_slices * slice_size:
            return left[k:]
        part = left[k : k + slice_size]
        _mark(spark, work, part, CLAIMED)
        rows = whole.where(F.col("p2").isin(part))
        replace_shards(one_per_key(rows) if dedupe else rows, dst)
        _mark(spark, work, part, MERGED)
    return []


def compact(spark: SparkSession, src: str, dst: str, src_fmt: str = "parquet", fmt: str = "parquet", compression: str | None = None) -> None:
    """Rewrite small files into rebalanced, sorted files (MNT-04, SNK-05):
    e.g. JSON shards to gzip JSON or zstd Parquet."""
    _distinct_paths([src], dst)
    write_protected(read_protected(spark, src, src_fmt), dst, fmt=fmt, mode="errorifexists", compression=compression)


def protect_legacy_shards(spark: SparkSession, roots: Sequence[str], dst: str, keys: Keys) -> DataFrame:
    """Legacy clear-text JSONL shards -> protected shards (MNT-03, PRJ-11).
    Returns the malformed-line counts ``(source, scope, reason, n)`` by file."""
    _distinct_paths(roots, dst)
    records, malformed = protect_legacy(read_legacy_jsonl(spark, roots), keys)
    write_protected(records.select(*PROTECTED_COLUMNS), dst, mode="errorifexists")
    return malformed


# Maintenance thresholds (records, files, minutes since the last run).
MAINTENANCE_RECORDS = 1_000_000
MAINTENANCE_FILES = 20
MAINTENANCE_MINUTES = 60


@dataclass(frozen=True)
class Thresholds:
    records: int = MAINTENANCE_RECORDS
    files: int = MAINTENANCE_FILES
    minutes: int = MAINTENANCE_MINUTES


def maintenance_due(
    manifest: DataFrame, since_batch: int, limits: Thresholds = Thresholds(), since_time: object = None
) -> DataFrame:
    """One row: counters since ``since_batch`` and whether compaction is due
    (AGG-04, STR-06).  A file that was loaded twice counts once; minutes run
    from ``since_time``, or from the first load if there was no maintenance."""
    recent = manifest.where(F.col("batch_id") > since_batch)
    latest = recent.groupBy("source").agg(F.max_by("loaded", "batch_id").alias("loaded"), F.min("committed_at").alias("committed_at"))
    start = F.lit(since_time) if since_time is not None else F.min("committed_at")
    t = latest.agg(
        F.coalesce(F.sum("loaded"), F.lit(0)).cast("bigint").alias("records"),
        F.count(F.lit(1)).alias("files"),
        F.when(
            F.count(F.lit(1)) > 0, (F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(start)) / 60.0
        ).otherwise(F.lit(0.0)).alias("minutes"),
    )
    due = (
        (F.col("records") >= limits.records)
        | (F.col("files") >= limits.files)
        | (F.col("minutes") >= limits.minutes)
    )
    return t.withColumn("due", due & (F.col("files") > 0))


#: Runs of one level that are merged into one of the next.
FANOUT = 4


def merge_plan(runs: Sequence[Run], fanout: int = FANOUT) -> tuple[int, list[Run]]:
    """The level of the run that new batches are merged into, and the runs that join them.

    New batches make a run of level 1.  Where that would be the ``fanout``-th of its level, the
    level's runs are merged with it into one of the next level, and so on in one
    write.  So a record is rewritten once per level, and levels grow with the
    logarithm of the merges.
    """
    level, joined = 1, []
    while len(same := [r for r in runs if r.level == level]) + 1 >= fanout:
        joined += same
        level += 1
    return level, joined


def maintain(spark: SparkSession, out: Outputs, limits: Thresholds = Thresholds(), fanout: int = FANOUT) -> bool:
    """Merge the committed batches since the last time, if that is due (STR-06, MNT-04, SNK-06).

    The batches become one run, without the records that another run already holds, so the
    merged runs together hold each record once; levels that are full are merged
    with it (``merge_plan``).  Stored keys are looked up through the runs' membership
    filters; merged runs are rewritten as they are, without a join or an aggregate.

    The new run is written to a folder of its own; only then a row in ``versions``
    makes readers and loads follow it.  A maintenance that dies before that leaves everything
    as it was, and its leftovers are replaced by the next try.  Run it between loads.
    Replaced runs stay until ``remove_replaced``.
    """
    version = current_version(spark, out)
    loose = loose_batches(spark, out, version)
    if not loose:
        return False
    recent = read_manifest(spark, out).where(F.col("batch_id").isin(loose))
    if not maintenance_due(recent, -1, limits, version.maintained_at).head()["due"]:
        return False
    number = version.version + 1
    level, joined = merge_plan(version.runs, fanout)
    name = out.merged_run(number)
    new = one_per_key(read_runs(spark, out, loose_runs(spark, out, version)))
    fresh = absent_from_runs(spark, out, new, version.runs)
    write_run(fresh.unionByName(read_runs(spark, out, [r.run for r in joined])), out.path(name))
    index_run(spark, out, name)
    profile_run(spark, out, name)
    n = read_runs(spark, out, [name]).count()
    held = [*((b, b) for b in loose), *(r for j in joined for r in j.batches)]
    kept = [r for r in version.runs if r not in joined]
    replaced = [*(out.batch_run(b) for b in loose), *(r.run for r in joined)]
    append_version(spark, out, number, n, [*kept, Run(name, level, n, ranges(held))], replaced)
    return True


#: Minutes that a replaced run stays for the readers that have begun on it.
GRACE_MINUTES = 24 * 60


def remove_replaced(spark: SparkSession, out: Outputs, grace_minutes: float = GRACE_MINUTES) -> list[str]:
    """Delete runs that maintenance replaced at least ``grace_minutes`` ago, with their filters,
    zones and profiles; returns their folders.  Readers that began before that must have ended."""
    age = (F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("maintained_at")) / 60.0
    old = read_versions(spark, out).where(age >= grace_minutes).select(F.explode("replaced").alias("run")).distinct()
    used = {r.run for r in current_version(spark, out).runs}
    gone = []
    for row in old.collect():  # a name per run
        run = row["run"]
        if run not in used and path_exists(spark, out.path(run)):
            delete_path(spark, out.path(run))
            for index in (out.filters, out.zones, out.profiles):
                delete_path(spark, f"{index}/{run}")
            gone.append(run)
    return sorted(gone)
