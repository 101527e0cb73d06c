"""Registered queries: one per operator group of the blueprint.

Each takes ``(spark, sf_dir)``, derives synthetic credential lines from the
``events`` table of that scale factor (see ``vigil.sources.fixtures``) and
returns a DataFrame whose columns match the DuckDB oracle in
``vigil.oracle``.  Results hold digests and counts only.

Every query reads every line derived from the whole ``events`` table.  The
modulo rules in the fixtures only shape the synthetic input: which lines
are perturbed, which lines a target already holds (``seq % 2``), how two
shard roots overlap (``seq % 3``) and which users a caller watches
(``user_id % 10``).  None of them thins the data a query scans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.digest import with_hmacs
from vigil.functions.text import lower_trim, normalise_compat, normalise_identifier
from vigil.operators import audit, catalog, exposure
from vigil.operators.dedupe import first_occurrence, insert_if_absent
from vigil.operators.layout import infer_layout
from vigil.operators.legacy import legacy_outcomes
from vigil.operators.merge import merge_roots, union_roots
from vigil.operators.numbering import surrogate_ids
from vigil.operators.parse import accepted, counted_reject, outcome_counts, parse_first_colon
from vigil.operators.protect import TEST_KEYS
from vigil.operators.sizing import materialise
from vigil.plans import ingest, parse_protect, scenarios
from vigil.session import scratch_path
from vigil.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]
KEYS = TEST_KEYS


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.raw_lines(spark, d)


def _stored_lines(spark: SparkSession, d: str) -> DataFrame:
    """For queries that read the lines in several jobs, as a detected parse does."""
    return fixtures.stored_lines(spark, d)


def _protected(spark: SparkSession, d: str, keep=("seq",)) -> DataFrame:
    return parse_protect.protected_detected(_stored_lines(spark, d), KEYS, keep=list(keep))


def layout_inference(spark: SparkSession, d: str) -> DataFrame:
    return infer_layout(_lines(spark, d)).select("source", "delim", "email_first", "status")


def parse_detected_rejects(spark: SparkSession, d: str) -> DataFrame:
    return outcome_counts(parse_protect.detected(_lines(spark, d)))


def parse_first_colon_counts(spark: SparkSession, d: str) -> DataFrame:
    return outcome_counts(parse_first_colon(_lines(spark, d)))


def normalise_compare(spark: SparkSession, d: str) -> DataFrame:
    rows = accepted(parse_protect.detected(_lines(spark, d)))
    a = normalise_identifier(F.col("ident"))
    b = normalise_compat(F.col("ident"))
    normed = rows.select("source", (a != b).alias("_differ"), a.alias("_na"), b.alias("_nb"))
    digested = with_hmacs(normed, [("_da", "_na", KEYS.identifier), ("_db", "_nb", KEYS.identifier)])
    # by digest pair first: the two distinct counts then see each pair once, not each line
    pairs = digested.groupBy("source", "_da", "_db").agg(F.count(F.lit(1)).alias("_n"), F.count_if("_differ").alias("_d"))
    return pairs.groupBy("source").agg(
        F.sum("_n").cast("bigint").alias("n_rows"),
        F.sum("_d").cast("bigint").alias("n_differ"),
        F.count_distinct("_da").alias("n_ids_a"),
        F.count_distinct("_db").alias("n_ids_b"),
    )


def id_digest(spark: SparkSession, d: str) -> DataFrame:
    return _protected(spark, d, keep=()).groupBy("id_digest").agg(F.count(F.lit(1)).alias("n_lines"))


def scheme_profile(spark: SparkSession, d: str) -> DataFrame:
    return exposure.scheme_profile(_protected(spark, d, keep=()))


def scheme_profile_compat(spark: SparkSession, d: str) -> DataFrame:
    recs = parse_protect.protected_detected(_lines(spark, d), KEYS, compat=True)
    return exposure.scheme_profile(recs, by=("source", "hash_type"))


def shard_histogram(spark: SparkSession, d: str) -> DataFrame:
    return exposure.shard_histogram(_protected(spark, d, keep=()))


def dedupe_distinct(spark: SparkSession, d: str) -> DataFrame:
    first = first_occurrence(_protected(spark, d), order=["seq"])
    return first.select(
        "id_digest", "secret_digest", "source", F.col("seq").alias("first_line"), "hash_type", "copies"
    )


def insert_if_absent_query(spark: SparkSession, d: str) -> DataFrame:
    # digest-only records feed both the batch and the target: checkpoint once
    recs = materialise(_protected(spark, d))
    target = recs.where(F.col("seq") % 2 == 0).drop("seq")
    new = insert_if_absent(recs.drop("seq"), target)
    return new.select("id_digest", "secret_digest", "source", "hash_type", "is_hash")


def _roots(spark: SparkSession, d: str) -> list[DataFrame]:
    recs = materialise(_protected(spark, d))
    return [
        recs.where(F.col("seq") % 3 != 0).drop("seq"),
        recs.where(F.col("seq") % 3 != 1).drop("seq"),
    ]


def merge_roots_query(spark: SparkSession, d: str) -> DataFrame:
    merged = merge_roots(_roots(spark, d))
    return merged.select("id_digest", "secret_digest", "source", "hash_type", "copies")


def _files(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n_lines"))


def _manifest(spark: SparkSession) -> DataFrame:
    """Synthetic load manifest: two files done, one rejected, one first done
    and in progress again, one in progress."""
    rows = [("view", "done", 1), ("click", "done", 1), ("solo", "rejected", 1), ("error", "done", 1),
            ("error", "in-progress", 2), ("signup", "in-progress", 2)]
    return spark.createDataFrame(
        [(f"/syn/{n}.txt", s, b) for n, s, b in rows], "source string, status string, batch_id bigint"
    )


def pending_files(spark: SparkSession, d: str) -> DataFrame:
    return ingest.pending(_files(spark, d), _manifest(spark)).select("source", "prior_status", "n_lines")


def progress_summary(spark: SparkSession, d: str) -> DataFrame:
    return ingest.progress(_files(spark, d), _manifest(spark))


def _watchlist(spark: SparkSession, d: str) -> DataFrame:
    unseen = spark.createDataFrame([(a,) for a in fixtures.UNSEEN_ADDRESSES], "address string")
    addresses = fixtures.watch_users(spark, d).unionByName(unseen)
    normed = addresses.select(normalise_identifier(F.col("address")).alias("_n"))
    return with_hmacs(normed, [("id_digest", "_n", KEYS.identifier)]).select("id_digest")


def exposure_check(spark: SparkSession, d: str) -> DataFrame:
    return exposure.exposure_check(_protected(spark, d, keep=()), _watchlist(spark, d))


def prefix_range(spark: SparkSession, d: str) -> DataFrame:
    prefixes = _watchlist(spark, d).select(F.substring("id_digest", 1, 4).alias("prefix"))
    return exposure.prefix_range(_protected(spark, d, keep=()), prefixes, k=2)


def constraint_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit.constraint_audit(union_roots(_roots(spark, d)))


def schema_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit.schema_audit(_protected(spark, d))


def _run_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Rows loaded and rejected per source, in one pass, with synthetic elapsed times."""
    per = parse_protect.detected(_lines(spark, d), keep_blank=True).groupBy("source").agg(
        F.count_if(F.col("reason").isNull()).alias("loaded"),
        F.count_if(counted_reject(F.col("reason"))).alias("rejected"),
    )
    k10 = F.lit(10)
    for name, k in zip(sorted(fixtures.SHAPES), fixtures.RUN_K_TENTHS):
        k10 = F.when(F.col("source") == f"/syn/{name}.txt", F.lit(k)).otherwise(k10)
    return per.select("source", "loaded", "rejected", F.floor(F.col("loaded") * k10 / F.lit(10.0)).cast("bigint").alias("elapsed_ms"))


def run_grades(spark: SparkSession, d: str) -> DataFrame:
    return audit.run_grades(_run_metrics(spark, d))


def _legacy_lines(spark: SparkSession, d: str) -> DataFrame:
    """Legacy clear-text JSONL records built from the first-colon parse, with
    malformed lines, odd values in unused fields, and records without a source."""
    rows = accepted(parse_first_colon(_lines(spark, d)))
    k = F.col("seq") % 97
    rec = F.to_json(
        F.struct(
            F.lit("legacy").alias("email_hash"),
            F.col("secret").alias("password"),
            F.when(k == 7, F.lit("yes")).otherwise(F.lit("false")).alias("is_hash"),
            F.lit(1).alias("hash_type"),
            lower_trim(F.col("ident")).alias("email"),
            F.when(k != 8, F.col("source")).alias("source"),
        )
    )
    value = F.when(k == 5, F.lit('{"email": "broken')).when(k == 6, F.lit("5")).otherwise(rec)
    file = F.concat(F.lit("/legacy/"), F.substring_index("source", "/", -1), F.lit(".jsonl.gz"))
    return rows.select(value.alias("value"), file.alias("root_file"))


def legacy_protect(spark: SparkSession, d: str) -> DataFrame:
    outcomes = legacy_outcomes(_legacy_lines(spark, d), KEYS)
    outcome = F.coalesce(F.col("reason"), F.lit("protected"))
    g = outcomes.groupBy(outcome.alias("outcome"), "root_file", "source", "hash_type", "id_digest").agg(
        F.count(F.lit(1)).alias("_n")
    )
    return g.groupBy("outcome", "root_file", "source", "hash_type").agg(
        F.sum("_n").cast("bigint").alias("n_records"),
        F.count_if(F.col("id_digest").isNotNull()).alias("n_ids"),
    )


def file_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    from vigil.plans.roundtrip import file_roundtrip as run

    return run(spark, _lines(spark, d), KEYS)


def stream_resume(spark: SparkSession, d: str) -> DataFrame:
    from vigil.streaming.ingest import stream_resume_demo

    return stream_resume_demo(spark, _lines(spark, d), KEYS)


def replay_direct_load(spark: SparkSession, d: str) -> DataFrame:
    from vigil.streaming.ingest import replay_demo

    return replay_demo(spark, _lines(spark, d), KEYS)


def maintained_load(spark: SparkSession, d: str) -> DataFrame:
    from vigil.streaming.ingest import maintained_demo

    return maintained_demo(spark, _lines(spark, d), KEYS)


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    from vigil.plans.roundtrip import csv_roundtrip as run

    return run(spark, _protected(spark, d, keep=()))


def stored_prefix_range(spark: SparkSession, d: str) -> DataFrame:
    from vigil.plans.roundtrip import stored

    prefixes = _watchlist(spark, d).select(F.substring("id_digest", 1, 4).alias("prefix"))
    return exposure.prefix_range(stored(spark, _protected(spark, d, keep=())), prefixes, k=2)


def scheme_rollup(spark: SparkSession, d: str) -> DataFrame:
    return exposure.scheme_rollup(_protected(spark, d, keep=()))


def crash_and_replay(spark: SparkSession, d: str) -> DataFrame:
    return scenarios.crash_and_replay(spark, _lines(spark, d), KEYS)


def tiered_maintenance(spark: SparkSession, d: str) -> DataFrame:
    return scenarios.tiered_maintenance(spark, _stored_lines(spark, d), KEYS)


def stored_insert(spark: SparkSession, d: str) -> DataFrame:
    return scenarios.stored_insert(spark, _lines(spark, d), KEYS)


def stored_check(spark: SparkSession, d: str) -> DataFrame:
    return scenarios.stored_check(spark, _lines(spark, d), KEYS, _watchlist(spark, d))


def resumed_merge(spark: SparkSession, d: str) -> DataFrame:
    return scenarios.resumed_merge(spark, _roots(spark, d))


def observed_metrics(spark: SparkSession, d: str) -> DataFrame:
    return scenarios.observed_metrics(spark, _lines(spark, d), KEYS)


def incremental_profile(spark: SparkSession, d: str) -> DataFrame:
    return scenarios.incremental_profile(spark, _stored_lines(spark, d), KEYS)


def bucketed_insert(spark: SparkSession, d: str) -> DataFrame:
    return scenarios.bucketed_insert(spark, materialise(_protected(spark, d)))


def catalog_audit(spark: SparkSession, d: str) -> DataFrame:
    """A right table, one with a wrong, a missing and a foreign column and no key, and one that is not there."""
    root = scratch_path(spark, "catalog")
    recs = materialise(_protected(spark, d))
    unique = root.rsplit("-", 1)[1]
    right, wrong, absent = (f"vigil_{n}_{unique}" for n in ("right", "wrong", "absent"))
    catalog.register(recs.drop("seq"), right, f"{root}/right")
    odd = recs.withColumn("is_hash", F.col("is_hash").cast("string")).drop("p4")
    catalog.register(odd, wrong, f"{root}/wrong", {catalog.NOT_NULL: "1"})
    found = catalog.catalog_audit(spark, [right, wrong, absent])
    for name in (right, wrong):  # the session's catalog is left as it was; the files stay
        spark.sql(f"DROP TABLE {name}")
    return found.withColumn("table_name", F.split_part("table_name", F.lit("_"), F.lit(2)))


def numbered_ids(spark: SparkSession, d: str) -> DataFrame:
    """Gap-free numbers of the identifier digests, in their order."""
    ids = _protected(spark, d, keep=()).groupBy("id_digest").agg(F.count(F.lit(1)).alias("n_lines"))
    place = F.conv(F.substring("id_digest", 1, 15), 16, 10).cast("bigint")
    return surrogate_ids(materialise(ids.withColumn("_place", place)), "_place").select("id", "id_digest", "n_lines")


def sliced_load(spark: SparkSession, d: str) -> DataFrame:
    return scenarios.sliced_load(spark, _lines(spark, d), KEYS)


def head_layouts(spark: SparkSession, d: str) -> DataFrame:
    return scenarios.head_layouts(spark, _lines(spark, d))


def stored_sizes(spark: SparkSession, d: str) -> DataFrame:
    return scenarios.stored_sizes(spark, _lines(spark, d))


def stopped_stream(spark: SparkSession, d: str) -> DataFrame:
    from vigil.streaming.ingest import stopped_demo

    return stopped_demo(spark, _lines(spark, d), KEYS)


QUERIES: dict[str, Query] = {
    "layout_inference": layout_inference,
    "parse_detected_rejects": parse_detected_rejects,
    "parse_first_colon_counts": parse_first_colon_counts,
    "normalise_compare": normalise_compare,
    "id_digest": id_digest,
    "scheme_profile": scheme_profile,
    "scheme_profile_compat": scheme_profile_compat,
    "shard_histogram": shard_histogram,
    "dedupe_distinct": dedupe_distinct,
    "insert_if_absent": insert_if_absent_query,
    "merge_roots": merge_roots_query,
    "pending_files": pending_files,
    "progress_summary": progress_summary,
    "exposure_check": exposure_check,
    "prefix_range": prefix_range,
    "constraint_audit": constraint_audit,
    "schema_audit": schema_audit,
    "run_grades": run_grades,
    "legacy_protect": legacy_protect,
    "file_roundtrip": file_roundtrip,
    "stream_resume": stream_resume,
    "replay_direct_load": replay_direct_load,
    "maintained_load": maintained_load,
    "csv_roundtrip": csv_roundtrip,
    "stored_prefix_range": stored_prefix_range,
    "scheme_rollup": scheme_rollup,
    "crash_and_replay": crash_and_replay,
    "tiered_maintenance": tiered_maintenance,
    "stored_insert": stored_insert,
    "stored_check": stored_check,
    "resumed_merge": resumed_merge,
    "observed_metrics": observed_metrics,
    "catalog_audit": catalog_audit,
    "incremental_profile": incremental_profile,
    "bucketed_insert": bucketed_insert,
    "numbered_ids": numbered_ids,
    "sliced_load": sliced_load,
    "head_layouts": head_layouts,
    "stored_sizes": stored_sizes,
    "stopped_stream": stopped_stream,
}

FLAGSHIP = "scheme_profile"
