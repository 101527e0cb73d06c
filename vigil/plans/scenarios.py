"""Whole runs of the stored dataset, for the registered queries: crash and replay, tiered
maintenance, loads and lookups against merged runs, an interrupted merge, observed metrics.

Each works on a fresh folder under the shared checkpoint root and returns what a user would read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.paths import dir_name, merge_destination, partition_value, plain_path, relative
from vigil.operators import buckets
from vigil.operators.audit import storage_profile
from vigil.operators.protect import Keys
from vigil.operators.sizing import materialise
from vigil.plans.index import new_records, records_to_check
from vigil.plans.ingest import claim, ingest_files, load_outcomes, pending_files
from vigil.plans.maintenance import Thresholds, maintain, resumable_merge
from vigil.plans.parse_protect import protected_first_colon
from vigil.plans.profiles import stored_profile
from vigil.plans.roundtrip import write_named_text
from vigil.plans.runs import Outputs, current_records, read_manifest, read_versions
from vigil.session import scratch_path
from vigil.sinks.shards import write_protected, write_run
from vigil.sources.heads import infer_layout_from_heads
from vigil.sources.shards import read_protected
from vigil.sources.text_files import list_files, read_lines

#: Due after every batch.
ALWAYS = Thresholds(records=1 << 40, files=1, minutes=1 << 20)


def crash_and_replay(spark: SparkSession, lines: DataFrame, keys: Keys) -> DataFrame:
    """A batch dies after its records, further files arrive, the load goes on; then
    maintenance, then both batches come once more.  Records by file, with their batch."""
    root = scratch_path(spark, "crash")
    inbox, out = f"{root}/input", Outputs(f"{root}/tables")
    first = F.col("source").isin("/syn/view.txt", "/syn/click.txt")
    write_named_text(lines.where(first), inbox)
    claim(spark, out, list_files(spark, inbox).select("source"), 1)
    write_run(protected_first_colon(read_lines(spark, inbox), keys), out.path(out.batch_run(1)))  # and no commit
    unseen = current_records(spark, out).count()
    write_named_text(lines.where(~first), inbox, mode="append")
    ingest_files(spark, inbox, out, keys, batch_id=2, dedupe=False)
    maintain(spark, out, ALWAYS)
    for batch_id in (1, 2):
        load_outcomes(spark, read_lines(spark, inbox), out, keys, batch_id, dedupe=False)
    batches = read_manifest(spark, out).select("source", "batch_id")
    return (
        current_records(spark, out)
        .join(F.broadcast(batches), "source")  # a row per file of the test
        .groupBy(partition_value(F.col("source"), "name").alias("name"), "batch_id", "hash_type")
        .agg(F.count(F.lit(1)).alias("n_records"), F.lit(unseen).cast("bigint").alias("n_seen_before_commit"))
    )


def tiered_maintenance(spark: SparkSession, lines: DataFrame, keys: Keys) -> DataFrame:
    """Four batches, each followed by maintenance with two runs a level: what each maintenance wrote."""
    out = Outputs(scratch_path(spark, "tiers"))
    for batch_id in range(4):
        part = lines.where(F.col("seq") % 4 == batch_id)
        load_outcomes(spark, part, out, keys, batch_id, mode="first_colon", dedupe=False)
        maintain(spark, out, ALWAYS, fanout=2)
    stored = current_records(spark, out).count()
    runs = F.col("runs")
    return read_versions(spark, out).select(
        "version",
        F.element_at(runs, -1).getField("level").alias("level"),
        F.size(runs).alias("n_runs"),
        "rewritten",
        F.aggregate(runs, F.lit(0).cast("bigint"), lambda n, r: n + r.getField("records")).alias("n_merged"),
        F.lit(stored).cast("bigint").alias("n_stored_at_last"),
    )


def _half_merged(spark: SparkSession, lines: DataFrame, keys: Keys) -> Outputs:
    """A dataset whose every second line is in a merged run, with its filters and zones."""
    out = Outputs(scratch_path(spark, "merged"))
    load_outcomes(spark, lines.where(F.col("seq") % 2 == 0), out, keys, 0, mode="first_colon", dedupe=False)
    maintain(spark, out, ALWAYS)
    return out


def stored_insert(spark: SparkSession, lines: DataFrame, keys: Keys) -> DataFrame:
    """All lines against a dataset that holds every second one: what a load would add."""
    out = _half_merged(spark, lines, keys)
    return new_records(spark, out, materialise(protected_first_colon(lines, keys))).select("id_digest", "secret_digest", "source", "hash_type")


def stored_check(spark: SparkSession, lines: DataFrame, keys: Keys, watchlist: DataFrame) -> DataFrame:
    """Exposure of a watchlist in a merged run and in the batch after it."""
    from vigil.operators.exposure import exposure_check

    out = _half_merged(spark, lines, keys)
    load_outcomes(spark, lines.where(F.col("seq") % 2 == 1), out, keys, 1, mode="first_colon")
    return exposure_check(records_to_check(spark, out, watchlist), watchlist)


def resumed_merge(spark: SparkSession, roots: list[DataFrame]) -> DataFrame:
    """Two shard roots merged in slices, stopped after the second slice and taken up again."""
    root = scratch_path(spark, "resumed")
    paths = [f"{root}/root{k}" for k in range(len(roots))]
    for path, records in zip(paths, roots):
        write_protected(records, path, mode="errorifexists")
    resumable_merge(spark, paths, f"{root}/merged", f"{root}/work", slice_size=64, most_slices=2)
    resumable_merge(spark, paths, f"{root}/merged", f"{root}/work", slice_size=64)
    return read_protected(spark, f"{root}/merged").select("id_digest", "secret_digest", "source", "hash_type")


def observed_metrics(spark: SparkSession, lines: DataFrame, keys: Keys) -> DataFrame:
    """Run metrics of one batch load and of a stream over the same lines."""
    from vigil.streaming.ingest import run_available

    root = scratch_path(spark, "metrics")
    batch, stream = Outputs(f"{root}/batch"), Outputs(f"{root}/stream")
    write_named_text(lines, f"{root}/input")
    ingest_files(spark, f"{root}/input", batch, keys, batch_id=0)
    run_available(spark, f"{root}/input", stream, f"{root}/checkpoint", keys, max_files_per_trigger=3)
    both = [spark.read.parquet(o.metrics).withColumn("load", F.lit(n)) for n, o in (("batch", batch), ("stream", stream))]
    return both[0].unionByName(both[1]).groupBy("load").agg(F.sum("loaded").alias("loaded"), F.sum("rejected").alias("rejected"))


def incremental_profile(spark: SparkSession, lines: DataFrame, keys: Keys) -> DataFrame:
    """Three batches that share files, maintenance after each of the first two (two runs stay), a replay,
    and a batch after that: the profile from what is stored beside the runs."""
    out = Outputs(scratch_path(spark, "profiles"))
    parts = [lines.where(F.col("seq") % 4 == k) for k in range(4)]
    for batch_id in range(3):
        load_outcomes(spark, parts[batch_id], out, keys, batch_id, mode="first_colon", dedupe=False)
        if batch_id < 2:
            maintain(spark, out, ALWAYS)
    load_outcomes(spark, parts[1], out, keys, 1, mode="first_colon", dedupe=False)
    load_outcomes(spark, parts[3], out, keys, 3, mode="first_colon")
    return stored_profile(spark, out)


def bucketed_insert(spark: SparkSession, records: DataFrame) -> DataFrame:
    """A bucketed table of every second line takes all lines, twice, as a bulk load, then the other
    lines unchecked: its records with their copies."""
    root = scratch_path(spark, "buckets")
    name = f"vigil_bucketed_{root.rsplit('-', 1)[1]}"
    own = records.drop("seq")
    buckets.create_bucketed(records.where(F.col("seq") % 2 == 0).drop("seq"), name, f"{root}/table", 8)
    for _ in range(2):
        buckets.insert_bulk(own, name)
    buckets.append_records(records.where(F.col("seq") % 2 == 1).drop("seq"), name)
    found = materialise(buckets.distinct_records(spark, name).select("id_digest", "secret_digest", "source", "hash_type", "copies"))
    spark.sql(f"DROP TABLE {name}")  # the session's catalog is left as it was; the files stay
    return found


def sliced_load(spark: SparkSession, lines: DataFrame, keys: Keys) -> DataFrame:
    """A folder loaded in batches of two files, and once more: records by file name, with the files of
    the largest batch and of those that are not processed."""
    root = scratch_path(spark, "sliced")
    inbox, out = f"{root}/input", Outputs(f"{root}/tables")
    write_named_text(lines, inbox)
    for batch_id in (0, 1 << 20):
        ingest_files(spark, inbox, out, keys, batch_id=batch_id, files_per_batch=2)
    most = read_manifest(spark, out).groupBy("batch_id").count().agg(F.max("count")).first()[0]
    left = pending_files(spark, inbox, out).count()
    name = partition_value(F.col("source"), "name").alias("name")
    return current_records(spark, out).groupBy(name, "hash_type").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_distinct("id_digest").alias("n_ids"),
        F.lit(most).cast("bigint").alias("most_files"),
        F.lit(left).cast("bigint").alias("n_left"),
    )


def head_layouts(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Layouts of text files by their heads, which are read up to the second non-blank line."""
    inbox = f"{scratch_path(spark, 'heads')}/input"
    write_named_text(lines, inbox)
    found = infer_layout_from_heads(spark, inbox)
    return found.select(partition_value(F.col("source"), "name").alias("name"), "delim", "email_first", "status").distinct()


def stored_sizes(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Two folders of text files in one listing: size by folder and file name, and the folder that
    a merge of the two would write."""
    root = scratch_path(spark, "sizes")
    paths = [f"{root}/{name}" for name in ("a", "b")]
    for k, path in enumerate(paths):
        write_named_text(lines.where(F.col("seq") % 3 != k), path)
    path, top = plain_path(F.col("source")), plain_path(F.lit(root))
    owner = F.split_part(relative(path, top), F.lit("/"), F.lit(1))
    files = list_files(spark, paths).select(
        "length",
        owner.alias("root"),
        partition_value(path, "name").alias("name"),
        merge_destination(dir_name(path), F.concat(top, F.lit("/"), owner), "/merged/").alias("destination"),
    )
    return storage_profile(files, ["root", "name", "destination"]).drop("n_files")
