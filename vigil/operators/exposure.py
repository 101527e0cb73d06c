"""Exposure checks and profiles over protected records (EXP-01..03, AGG-10,
PRJ-09).  Inputs and outputs hold digests and counts only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES, materialise


def scheme_profile(records: DataFrame, by: tuple[str, ...] = ("source", "hash_type", "is_hash")) -> DataFrame:
    """Records and distinct identifiers per source and scheme (EXP-03)."""
    return records.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_distinct("id_digest").alias("n_ids"),
    )


def scheme_rollup(records: DataFrame) -> DataFrame:
    """Totals by source and scheme, by source, by scheme and over all, with the share
    of secrets that were not hashed (EXP-03).

    ``level`` is the grouping id: 0 source and scheme, 1 source, 2 scheme, 3 all.  Rows collapse to
    one per identifier, source and scheme before they are expanded into the four sets.
    """
    per_id = records.groupBy("id_digest", "source", "hash_type", "is_hash").agg(F.count(F.lit(1)).alias("_n"))
    rows = per_id.groupingSets(
        [["source", "hash_type"], ["source"], ["hash_type"], []], "source", "hash_type"
    ).agg(
        F.grouping_id("source", "hash_type").cast("bigint").alias("level"),
        F.sum("_n").cast("bigint").alias("n_records"),
        F.count_distinct("id_digest").alias("n_ids"),
        F.coalesce(F.sum(F.when(~F.col("is_hash"), F.col("_n"))), F.lit(0)).cast("bigint").alias("n_not_hashed"),
    )
    share = F.when(F.col("n_records") > 0, F.round(F.col("n_not_hashed") / F.col("n_records"), 6)).otherwise(F.lit(0.0))
    return rows.withColumn("share_not_hashed", share)


def shard_histogram(records: DataFrame) -> DataFrame:
    """Per shard directory: records, distinct 4-hex shard keys, identifiers.

    A ``p2`` directory holds at most 256 distinct ``p4`` keys, so their count
    is an exact bounded set; only ``id_digest`` needs a distinct aggregate,
    which avoids duplicating every row for two distinct groups.
    """
    return records.groupBy("p2").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.size(F.collect_set("p4")).cast("bigint").alias("n_prefixes"),
        F.count_distinct("id_digest").alias("n_ids"),
    )


P2_DIRS = 256
# Requested digests or shard keys up to this number go into the scan's filter as a list.
PUSHED_VALUES = 1000


def measured_digests(df: DataFrame, max_bytes: int) -> tuple[DataFrame, bool, list[str] | None]:
    """Materialise a small digest table and, in one aggregate job, measure
    it and collect its ``p2`` directories (a set of at most 256 values).
    Returns (table, fits the broadcast bound, directories or None if all)."""
    m = materialise(df)
    var = [c for c in m.columns if c != "p2"]
    row = m.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.sum(F.octet_length(c)), F.lit(0)).alias(f"_b{i}") for i, c in enumerate(var)],
        F.array_sort(F.collect_set("p2")).alias("dirs"),
    ).head()
    size = int(row["n"]) * 8 * (len(m.columns) + 1) + sum(int(row[f"_b{i}"]) for i in range(len(var)))
    dirs = [d for d in row["dirs"] if d is not None]
    return m, size <= max_bytes, (None if len(dirs) >= P2_DIRS else dirs)


def _scoped(records: DataFrame, wanted: DataFrame, column: str, dirs: list[str] | None) -> DataFrame:
    """``records`` with static filters for the scan: the shard directories of
    what is ``wanted`` and, if it has few values of ``column``, these too (files
    are sorted by shard key and digest, so row groups are skipped)."""
    if dirs is not None:
        records = records.where(F.col("p2").isin(dirs))
    few = [r[0] for r in wanted.select(column).limit(PUSHED_VALUES + 1).collect()]
    if len(few) <= PUSHED_VALUES:
        records = records.where(F.col(column).isin(few))
        if column == "id_digest":
            records = records.where(F.col("p4").isin(sorted({v[:4] for v in few})))
    return records


def exposure_check(
    records: DataFrame,
    watchlist: DataFrame,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """For each watched ``id_digest``: records, sources, schemes, exposed flag.

    A watchlist within the broadcast bound filters the records first with a
    broadcast semi join; its shard directories and, if they are few, the digests
    themselves are static filters of the scan.  A larger watchlist takes the shuffle path, with the records
    pre-aggregated per (digest, source, scheme) first so that an identifier
    in a third of all rows reaches the exchange as a handful of rows.
    """
    wl, small, touched = measured_digests(
        watchlist.select("id_digest").distinct().withColumn("p2", F.substring("id_digest", 1, 2)),
        max_broadcast_bytes,
    )
    if small:
        watched = _scoped(records, wl, "id_digest", touched).join(F.broadcast(wl), ["p2", "id_digest"], "left_semi")
        per = watched.groupBy("id_digest", "source", "hash_type").agg(F.count(F.lit(1)).alias("_n"))
    else:
        per = records.groupBy("id_digest", "source", "hash_type").agg(F.count(F.lit(1)).alias("_n"))
        per = per.join(wl.select("id_digest"), "id_digest", "left_semi")
    hits = per.groupBy("id_digest").agg(
        F.sum("_n").alias("n_records"),
        F.count_distinct("source").alias("n_sources"),
        F.array_join(F.array_sort(F.collect_set("hash_type")), ",").alias("schemes"),
    )
    return wl.select("id_digest").join(hits, "id_digest", "left").select(
        "id_digest",
        F.coalesce(F.col("n_records"), F.lit(0)).cast("bigint").alias("n_records"),
        F.coalesce(F.col("n_sources"), F.lit(0)).cast("bigint").alias("n_sources"),
        "schemes",
        F.col("n_records").isNotNull().alias("exposed"),
    )


def prefix_range(
    records: DataFrame,
    prefixes: DataFrame,
    k: int = 2,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """k-anonymous range lookup (EXP-02).

    For each requested 4-hex ``prefix``: one row per identifier digest in
    that bucket (``suffix`` = digest without the prefix, ``n_records``) when
    the bucket holds at least ``k`` distinct identifiers; otherwise a single
    row with ``suppressed = true`` and no suffix or count.
    """
    if k < 2:
        raise ValueError("k must be 2 or more: smaller values would switch suppression off")
    req, small, touched = measured_digests(
        prefixes.select(F.lower(F.col("prefix")).alias("p4")).distinct().withColumn("p2", F.substring("p4", 1, 2)),
        max_broadcast_bytes,
    )
    scoped = _scoped(records, req, "p4", touched)
    side = F.broadcast(req) if small else req
    hits = materialise(
        scoped.join(side, ["p2", "p4"], "left_semi")
        .groupBy("p4", "id_digest")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    # One count per requested prefix: joined back, not a window over a bucket
    # (the 65,536 buckets grow with the data).
    counts = hits.groupBy("p4").agg(F.count(F.lit(1)).alias("_ids"))
    counts = req.select("p4").join(counts, "p4", "left").select("p4", F.coalesce("_ids", F.lit(0)).alias("_ids"))
    counts = F.broadcast(counts) if small else counts
    shown_rows = hits.join(counts.where(F.col("_ids") >= k), "p4")
    hidden = counts.where(F.col("_ids") < k).select(
        "p4", F.lit(None).cast("string").alias("id_digest"), F.lit(None).cast("bigint").alias("n_records"), "_ids"
    )
    sized = shown_rows.unionByName(hidden)
    shown = F.col("_ids") >= k
    return sized.select(
        F.col("p4").alias("prefix"),
        F.when(shown, F.substring("id_digest", 5, 60)).alias("suffix"),
        F.when(shown, F.col("n_records")).alias("n_records"),
        (~shown).alias("suppressed"),
    )
