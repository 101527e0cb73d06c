"""Resumable, exactly-once incremental ingestion (STR-01..05, JON-01, SNK-04/08).

The file stream source remembers which files it has handed out in its
checkpoint, so each new file is read once; ``availableNow`` processes
everything present and stops, and a stopped query resumes from the last
committed batch.  Each micro-batch runs the batch loader
(:func:`vigil.plans.ingest.load_outcomes`), which is idempotent per
``batch_id``: a batch replayed after a failure inserts no record twice and
rewrites its own reject and manifest partitions.  Keyed dedupe uses the
loaded table as its state, so no streaming state grows without bound.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil.operators.protect import Keys
from vigil.functions.paths import partition_value
from vigil.operators.layout import UNDETECTABLE
from vigil.operators.sizing import materialise
from vigil.plans.ingest import LAYOUT_READERS, Outputs, current_records, latest_version, load_outcomes
from vigil.plans.maintenance import Thresholds, maintain
from vigil.plans.roundtrip import write_named_text
from vigil.plans.runs import is_committed, read_manifest
from vigil.session import scratch_path
from vigil.sources.heads import layouts_of
from vigil.sources.text_files import TXT_ANY_CASE, empty_files


#: Files per micro-batch where neither bound is given.
FILES_PER_TRIGGER = 10_000

#: Seconds between two listings for files of zero bytes, while batches have lines.
LISTING_SECONDS = 600


def files_without_lines(spark: SparkSession, input_root: str, out: Outputs, batch_id: int, sources: DataFrame, listed: bool) -> DataFrame:
    """``source`` of the zero-byte files of a batch, for the manifest; the stream has no line of them.

    A batch that is tried again has those that it has claimed.  Otherwise, where ``listed``,
    they are the empty files under the root that no batch has.
    """
    known = read_manifest(spark, out)
    claimed = known.where(F.col("batch_id") == batch_id).select("source")
    if not claimed.isEmpty():
        return claimed.join(sources, "source", "left_anti")
    if not listed:
        return claimed
    return empty_files(spark, input_root).join(known.select("source").distinct(), "source", "left_anti")


def start_ingest(
    spark: SparkSession,
    input_root: str,
    out: Outputs,
    checkpoint: str,
    keys: Keys,
    mode: str = "detected",
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    dedupe: bool = True,
    compat: bool = False,
    skip_header: bool = False,
    max_bytes_per_trigger: str | None = None,
    limits: Thresholds | None = None,
    layout_reader: str | None = None,
) -> StreamingQuery:
    """Start the ingestion stream.  Without ``processing_time`` it runs as
    ``availableNow`` (drain what is there, then stop).

    ``dedupe=True`` probes the loaded table for every batch (insert if
    absent).  That probe reads the target's key columns once per batch; on
    a very large target, ``dedupe=False`` defers deduplication to the
    maintenance, which amortises one pass over many batches.  With
    ``limits``, maintenance runs after any batch that crosses them.

    A batch is bounded by ``max_bytes_per_trigger`` (such as ``"200g"``) or by a
    number of files, also on the first load of a full folder.

    ``layout_reader="heads"`` (the default, but for ``skip_header``) opens the batch's
    files only up to their second line; ``"scan"`` infers layouts from the batch's lines, with
    a sort of line flags.

    Files of zero bytes, which the stream hands out without a line, are listed in the first
    batch of a run, in a batch without lines, and every ``LISTING_SECONDS``; they get the same manifest
    and reject rows as in a batch load."""
    layout_reader = layout_reader or ("scan" if skip_header else "heads")
    if layout_reader not in LAYOUT_READERS or (layout_reader == "heads" and skip_header):
        raise ValueError(f"layout_reader must be one of {LAYOUT_READERS}, and scan with skip_header")
    reader = (
        spark.readStream.format("text")
        .option("pathGlobFilter", TXT_ANY_CASE)
        .option("recursiveFileLookup", "true")
    )
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    else:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger or FILES_PER_TRIGGER))
    stream = reader.load(input_root).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )

    listed_at: list[float] = []

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        if is_committed(batch.sparkSession, out, batch_id):  # it died after that, before Spark knew
            return
        lines = batch.withColumn("seq", F.monotonically_increasing_id())
        sources = materialise(batch.select("source").distinct())
        layout = None
        if layout_reader == "heads" and mode == "detected":
            layout = layouts_of(sources)
        due = not listed_at or time.monotonic() - listed_at[-1] >= LISTING_SECONDS or sources.isEmpty()
        if due:
            listed_at[:] = [time.monotonic()]
        empty = materialise(files_without_lines(batch.sparkSession, input_root, out, batch_id, sources, due))
        why = F.lit(UNDETECTABLE if mode == "detected" else None).cast("string")
        load_outcomes(
            batch.sparkSession, lines, out, keys, batch_id,
            mode=mode, dedupe=dedupe, compat=compat, skip_header=skip_header, layout=layout,
            without_lines=empty.withColumn("failed", why),
        )
        if limits is not None:
            maintain(batch.sparkSession, out, limits)

    writer = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def run_until_stopped(
    spark: SparkSession, query: StreamingQuery, stop_file: str, poll_seconds: float = 1.0, timeout_s: float | None = None
) -> bool:
    """Graceful stop (STR-03): poll for ``stop_file`` on shared storage and
    stop the query when it appears.  Stopping is safe at any point: a batch
    that has not committed is replayed on restart and, being idempotent,
    loads nothing twice.  Returns True when stopped by the file."""
    import time

    from vigil.plans.ingest import path_exists

    waited = 0.0
    while query.isActive:
        if path_exists(spark, stop_file):
            query.stop()
            return True
        query.awaitTermination(poll_seconds)
        waited += poll_seconds
        if timeout_s is not None and waited >= timeout_s:
            query.stop()
            return False
        time.sleep(0)
    return False


def run_available(spark: SparkSession, input_root: str, out: Outputs, checkpoint: str, keys: Keys, **kw) -> None:
    q = start_ingest(spark, input_root, out, checkpoint, keys, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _named(records: DataFrame) -> DataFrame:
    """Records by the name of their file, since a run's own folder is not part of a result."""
    name = partition_value(F.col("source"), "name")
    return records.groupBy(name.alias("name"), "hash_type").agg(
        F.count(F.lit(1)).alias("n_records"), F.count_distinct("id_digest").alias("n_ids")
    )


def stream_resume_demo(spark: SparkSession, lines: DataFrame, keys: Keys) -> DataFrame:
    """Two arrivals of files and three ``availableNow`` runs against one
    checkpoint; the loaded records (each file loaded once)."""
    root = scratch_path(spark, "stream")
    inbox, out, ckpt = f"{root}/input", Outputs(f"{root}/tables"), f"{root}/checkpoint"
    first = F.col("source").isin("/syn/view.txt", "/syn/click.txt", "/syn/error.txt")
    write_named_text(lines.where(first), inbox)
    run_available(spark, inbox, out, ckpt, keys)
    write_named_text(lines.where(~first), inbox, mode="append")
    run_available(spark, inbox, out, ckpt, keys)
    run_available(spark, inbox, out, ckpt, keys)
    return _named(current_records(spark, out))


def replay_demo(spark: SparkSession, lines: DataFrame, keys: Keys) -> DataFrame:
    """One batch loaded twice without deduplication: its rows are there once."""
    out = Outputs(scratch_path(spark, "replay"))
    for _ in range(2):
        load_outcomes(spark, lines, out, keys, batch_id=7, dedupe=False)
    return current_records(spark, out).groupBy("source", "hash_type").agg(F.count(F.lit(1)).alias("n_records"))


def maintained_demo(spark: SparkSession, lines: DataFrame, keys: Keys) -> DataFrame:
    """Two batches without deduplication, each followed by maintenance that
    only the second makes due; readers then see the compacted version."""
    out = Outputs(scratch_path(spark, "maintained"))
    some = F.col("source").isin("/syn/view.txt", "/syn/click.txt")
    limits = Thresholds(records=1 << 40, files=3, minutes=1 << 20)
    for batch_id, part in enumerate((lines.where(some), lines.where(~some))):
        load_outcomes(spark, part, out, keys, batch_id, dedupe=False)
        maintain(spark, out, limits)
    version = F.lit(latest_version(spark, out)[0]).cast("bigint")
    return current_records(spark, out).groupBy("source", version.alias("version")).agg(F.count(F.lit(1)).alias("n_records"))


def stopped_demo(spark: SparkSession, lines: DataFrame, keys: Keys) -> DataFrame:
    """A stream of two files a batch that finds its stop file, then a run to the end: what is loaded, with the
    files of the largest batch."""
    root = scratch_path(spark, "stopped")
    inbox, out, ckpt = f"{root}/input", Outputs(f"{root}/tables"), f"{root}/checkpoint"
    write_named_text(lines, inbox)
    spark.range(1).select(F.lit("stop").alias("value")).write.text(f"{root}/stop")
    query = start_ingest(spark, inbox, out, ckpt, keys, max_files_per_trigger=2, processing_time="0 seconds")
    stopped = run_until_stopped(spark, query, f"{root}/stop")
    run_available(spark, inbox, out, ckpt, keys, max_files_per_trigger=2)
    most = read_manifest(spark, out).groupBy("batch_id").count().agg(F.max("count")).first()[0]
    return _named(current_records(spark, out)).select(
        "*", F.lit(stopped).alias("stopped"), F.lit(most).cast("bigint").alias("most_files")
    )
