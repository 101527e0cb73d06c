"""Batch ingestion job: text files -> protected shards + rejects + manifest
+ run metric (STR-01 batch form, SNK-02/03/07/08, AGG-02/03, AUD-03).

Passes over the input: layout inference (detected mode only) and parse.
The parse result is turned into digest-only rows at once and checkpointed
in the shared checkpoint folder, so records, reject counts and the
manifest are all derived from one parse and clear text never reaches a
shuffle, cache or sink.
"""

from __future__ import annotations

import itertools
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators import audit
from vigil.plans.index import new_records
from vigil.operators.layout import UNDETECTABLE
from vigil.operators.numbering import surrogate_ids
from vigil.operators.parse import BLANK, NO_LAYOUT, SCOPE_FILE, counted_reject, parse_detected, parse_first_colon
from vigil.operators.protect import Keys, protect_outcomes, records_of
from vigil.operators.sizing import materialise
from vigil.plans.parse_protect import detected
from vigil.plans.runs import (
    DONE,
    IN_PROGRESS,
    NEW,
    PROCESSED,
    REJECTED,
    Outputs,
    batch_states,
    current_records,
    is_committed,
    latest_version,
    path_exists,
    read_manifest,
)
from vigil.sinks.shards import write_run, write_table
from vigil.sources.text_files import TXT_ANY_CASE, empty_files, list_files, literal_path, read_lines

MODES = ("detected", "first_colon")

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("scope", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def read_rejects(spark: SparkSession, out: Outputs) -> DataFrame:
    return spark.read.schema(REJECT_SCHEMA).parquet(out.rejects)


LAYOUT_READERS = ("scan", "heads")

#: Files of one batch of a batch load, whose names the driver holds while it is read.
FILES_PER_BATCH = 10_000


def parse_lines(
    lines: DataFrame, mode: str, skip_header: bool = False, layout: DataFrame | None = None
) -> DataFrame:
    """Parse keeping blank lines as silent ``blank`` rows, so every file with
    at least one line reaches the manifest.  ``layout`` (detected mode) may
    come from :func:`vigil.sources.heads.infer_layout_from_heads`; by default
    it is inferred from ``lines``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "first_colon":
        return parse_first_colon(lines, keep_blank=True)
    if layout is None:
        return detected(lines, skip_header=skip_header, keep_blank=True)
    return parse_detected(lines, layout, skip_header=skip_header, keep_blank=True)


def claim(spark: SparkSession, out: Outputs, files: DataFrame, batch_id: int) -> None:
    """Mark ``files`` (source) as in progress under ``batch_id``, until ``commit``.

    A batch id names one set of files for ever: the same set may be tried again,
    another one is refused, since its rows would replace the first set's.
    """
    if path_exists(spark, f"{out.manifest}/batch_id={batch_id}"):
        known = read_manifest(spark, out).where(F.col("batch_id") == batch_id).select("source")
        other = known.exceptAll(files).unionAll(files.exceptAll(known))
        if other.limit(1).count():
            raise ValueError(f"batch id {batch_id} already belongs to other files")
        return
    _write_manifest(files.select("source", F.lit(IN_PROGRESS).alias("status"), F.lit(0).alias("loaded"), F.lit(0).alias("rejected")), out, batch_id)


def _write_manifest(rows: DataFrame, out: Outputs, batch_id: int) -> None:
    typed = rows.select(
        "source", "status", F.col("loaded").cast("bigint").alias("loaded"), F.col("rejected").cast("bigint").alias("rejected"),
        F.current_timestamp().alias("committed_at"), F.lit(batch_id).cast("bigint").alias("batch_id"),
    )
    write_table(typed, out.manifest, partition="batch_id")


def _totals(outcomes: DataFrame) -> DataFrame:
    """``source, scope, reason, n``: the lines of each outcome, from which all counts of a batch follow."""
    return outcomes.groupBy("source", "scope", "reason").agg(F.count(F.lit(1)).alias("n"))


def _rejected() -> F.Column:
    return counted_reject(F.col("reason")) & (F.col("reason") != NO_LAYOUT)


def _per_file(totals: DataFrame) -> DataFrame:
    """``source, loaded, rejected, failed`` (the reason why a file as a whole was not loaded)."""
    whole = F.when(F.col("scope") == SCOPE_FILE, F.coalesce(F.nullif("reason", F.lit(BLANK)), F.lit(UNDETECTABLE)))
    none = F.lit(0).cast("bigint")
    return totals.groupBy("source").agg(
        F.sum(F.when(F.col("reason").isNull(), F.col("n")).otherwise(none)).alias("loaded"),
        F.sum(F.when(_rejected(), F.col("n")).otherwise(none)).alias("rejected"),
        F.max(whole).alias("failed"),
    )


def load_outcomes(
    spark: SparkSession,
    lines: DataFrame,
    out: Outputs,
    keys: Keys,
    batch_id: int,
    mode: str = "detected",
    dedupe: bool = True,
    compat: bool = False,
    skip_header: bool = False,
    layout: DataFrame | None = None,
    without_lines: DataFrame | None = None,
) -> DataFrame:
    """Parse, protect and load one batch of lines; returns the manifest rows.

    ``compat=True`` protects with the compatibility normaliser and classifier.
    ``without_lines`` (``source``, and ``failed``: why, null if that is no fault)
    names files of the batch that have no line.

    Exactly once per ``batch_id``, with and without ``dedupe``, also when it is tried
    again after a crash or after maintenance: a committed batch is not loaded
    again; until then its files are marked in progress, readers do not see what it has
    written, and a retry replaces it.  The manifest says ``done`` (or
    ``rejected``, for a file that could not be read as a whole) last.  A file that
    came too late to have a layout stays ``new``, for a later batch.

    The run metric counts rows on the way (an observation of the parse job), so streams
    and batch loads write one alike, without a job of its own.
    """
    t0 = time.monotonic()
    if is_committed(spark, out, batch_id):
        return read_manifest(spark, out).where(F.col("batch_id") == batch_id)
    seen = Observation(f"load-{batch_id}-{uuid.uuid4().hex[:8]}")
    outcomes = protect_outcomes(parse_lines(lines, mode, skip_header, layout), keys, compat=compat)
    outcomes = materialise(
        outcomes.observe(
            seen,
            F.count_if(F.col("reason").isNull()).alias("loaded"),
            F.count_if(_rejected()).alias("rejected"),
        )
    )
    totals = materialise(_totals(outcomes))
    per_file = _per_file(totals)
    if without_lines is not None:
        none = F.lit(0).cast("bigint")
        per_file = per_file.unionByName(without_lines.select("source", none.alias("loaded"), none.alias("rejected"), "failed"))
    per_file = materialise(per_file)
    claim(spark, out, per_file.select("source"), batch_id)

    records = records_of(outcomes)
    if dedupe:
        records = new_records(spark, out, records)
    write_run(records, out.path(out.batch_run(batch_id)))
    commit(spark, out, batch_id, totals, per_file)
    write_metric(spark, out, batch_id, seen.get, time.monotonic() - t0)
    return read_manifest(spark, out).where(F.col("batch_id") == batch_id)


def commit(spark: SparkSession, out: Outputs, batch_id: int, totals: DataFrame, per_file: DataFrame) -> None:
    """Reject counts, then the manifest rows that make the batch visible."""
    counted = totals.where(_rejected()).select("source", "scope", "reason", "n")
    # a file that failed as a whole without a line to count still gets its row
    silent = per_file.where((F.col("rejected") == 0) & F.col("failed").isNotNull() & (F.col("failed") != NO_LAYOUT)).select(
        "source", F.lit(SCOPE_FILE).alias("scope"), F.col("failed").alias("reason"), F.lit(0).cast("bigint").alias("n")
    )
    rejects = counted.unionByName(silent).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    write_table(rejects, out.rejects, partition="batch_id")
    failed = F.col("failed")
    status = F.when(failed == NO_LAYOUT, F.lit(NEW)).when(failed.isNotNull(), F.lit(REJECTED)).otherwise(F.lit(DONE))
    _write_manifest(per_file.select("source", status.alias("status"), "loaded", "rejected"), out, batch_id)


def write_metric(spark: SparkSession, out: Outputs, batch_id: int, counts: dict, seconds: float) -> None:
    """One graded row of rows loaded, rows rejected and elapsed time."""
    row = [(batch_id, int(counts["loaded"]), int(counts["rejected"]), int(seconds * 1000))]
    totals = spark.createDataFrame(row, "batch_id bigint, loaded bigint, rejected bigint, elapsed_ms bigint")
    write_table(audit.run_grades(totals), out.metrics, partition="batch_id")


# A claimed file that is gone when its batch is tried again.
MISSING = "missing"


def _listing(spark: SparkSession, inputs: str | Sequence[str], glob: str) -> DataFrame:
    """``source, path`` of all matching files; of those of zero bytes ``path`` is null."""
    listed = list_files(spark, inputs, glob=glob).select("source", "path")
    empty = empty_files(spark, inputs, glob).select("source", F.lit(None).cast("string").alias("path"))
    return materialise(listed.unionByName(empty))


def in_slices(files: DataFrame, most: int) -> DataFrame:
    """``files`` with ``slice`` (0, 1, ...), each of ``most`` files but the last; dealt by the hash of ``source``."""
    numbered = surrogate_ids(files.withColumn("_hash", F.xxhash64("source")), "_hash", out="_n", start=0)
    return numbered.withColumn("slice", F.floor(F.col("_n") / most).cast("int")).drop("_hash", "_n")


def ingest_files(
    spark: SparkSession,
    inputs: str | Sequence[str],
    out: Outputs,
    keys: Keys,
    batch_id: int,
    mode: str = "detected",
    dedupe: bool = True,
    glob: str = TXT_ANY_CASE,
    compat: bool = False,
    skip_header: bool = False,
    layout_reader: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Load the matching files under ``inputs`` that no batch has processed, as batch
    ``batch_id``, and record a run metric (rows, elapsed time, grade).  Returns
    the batch's manifest rows; none if nothing is new.

    More than ``files_per_batch`` files are cut into batches of that many, under ``batch_id`` and the
    free ids that follow it, each committed before the next is read: the driver holds the
    names of one batch, and a load that crashes has lost one batch's work at most.

    Batches that an earlier run has claimed and not committed are loaded first, each
    under its own id and with its own files, so a load that crashed goes on
    whatever has arrived since.  The files are listed and claimed before anything is read,
    and exactly those are read: a file that arrives meanwhile is the next batch's.  Run one
    load of a dataset at a time.

    ``layout_reader="heads"`` (the default, but for ``skip_header``) infers
    layouts from the head of each file; ``"scan"`` with a full extra pass over
    the input (see ``vigil.sources.heads``)."""
    layout_reader = layout_reader or ("scan" if skip_header else "heads")
    if layout_reader not in LAYOUT_READERS:
        raise ValueError(f"layout_reader must be one of {LAYOUT_READERS}")
    if layout_reader == "heads" and mode == "detected" and skip_header:
        raise ValueError("skip_header needs the scan-based layout reader")
    if files_per_batch < 1:
        raise ValueError("files_per_batch must be at least 1")
    files = _listing(spark, inputs, glob)

    def load(chosen: DataFrame, as_batch: int) -> None:
        # the names of one batch, as Spark's own file index holds for the read that follows
        paths = [literal_path(r["path"]) for r in chosen.where(F.col("path").isNotNull()).select("path").toLocalIterator()]
        why = F.when(F.col("gone"), F.lit(MISSING))
        empty = chosen.where(F.col("path").isNull()).select("source", (why.otherwise(F.lit(UNDETECTABLE)) if mode == "detected" else why).alias("failed"))
        lines = read_lines(spark, paths, glob=glob) if paths else spark.createDataFrame([], "source string, block bigint, seq bigint, line string")
        layout = None
        if layout_reader == "heads" and mode == "detected" and paths:
            from vigil.sources.heads import layouts_of

            layout = layouts_of(chosen.where(F.col("path").isNotNull()).select("source"))
        load_outcomes(spark, lines, out, keys, as_batch, mode, dedupe, compat, skip_header, layout, without_lines=empty)

    states = batch_states(spark, out)
    for unfinished in sorted(b for b, ok in states.items() if not ok):
        claimed = read_manifest(spark, out).where(F.col("batch_id") == unfinished).select("source")
        here = files.withColumn("gone", F.lit(False))
        load(materialise(claimed.join(here, "source", "left").fillna(True, ["gone"])), unfinished)
    seen = read_manifest(spark, out).where(F.col("status").isin(*PROCESSED)).select("source")
    rest = files.join(seen, "source", "left_anti") if states else files
    rest = materialise(rest.withColumn("gone", F.lit(False)))
    n_files, loaded = rest.count(), [batch_id]
    if n_files and batch_id not in states:
        n_slices = -(-n_files // files_per_batch)
        free = (b for b in itertools.count(batch_id) if b not in states)
        loaded = list(itertools.islice(free, n_slices))
        cut = materialise(in_slices(rest, files_per_batch)) if n_slices > 1 else rest.withColumn("slice", F.lit(0))
        for k, as_batch in enumerate(loaded):
            chosen = cut.where(F.col("slice") == k).drop("slice")
            claim(spark, out, chosen.select("source"), as_batch)
            load(chosen, as_batch)
    elif n_files and states[batch_id]:
        raise ValueError(f"batch id {batch_id} already belongs to other files")
    return read_manifest(spark, out).where(F.col("batch_id").isin(loaded))


def prior_status(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``files`` (source, ...) with ``prior_status``: the manifest's latest word on each, or ``new``."""
    latest = manifest.groupBy("source").agg(F.max_by("status", "batch_id").alias("_status"))
    return files.join(latest, "source", "left").select(
        *files.columns, F.coalesce(F.col("_status"), F.lit(NEW)).alias("prior_status")
    )


def pending(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that are not processed yet, with their prior status (JON-01, SET-03)."""
    return prior_status(files, manifest).where(~F.col("prior_status").isin(*PROCESSED))


def progress(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row of counts of ``files`` by status (AGG-05)."""
    status = F.col("prior_status")
    return prior_status(files, manifest).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(status.isin(*PROCESSED)).alias("n_done"),
        F.count_if(status == IN_PROGRESS).alias("n_in_progress"),
        F.count_if(~status.isin(*PROCESSED)).alias("n_pending"),
    )


def pending_files(spark: SparkSession, inputs: str | Sequence[str], out: Outputs, glob: str = TXT_ANY_CASE) -> DataFrame:
    """Candidate files, also those of zero bytes, that no batch has processed."""
    listed = list_files(spark, inputs, glob=glob).select("source", "length", "modified")
    empty = empty_files(spark, inputs, glob).select(
        "source", F.lit(0).cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modified")
    )
    files = listed.unionByName(empty)
    if not path_exists(spark, out.manifest):
        return files
    return pending(files, read_manifest(spark, out)).drop("prior_status")
