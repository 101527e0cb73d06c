"""Distinct records and keyed insert-if-absent (AGG-06, WIN-02, JON-03, SNK-03).

The record key is ``(id_digest, secret_digest, source)``.  The other protected
columns follow from the key and the scheme name, so one row per key needs only
fixed-width aggregates: the scheme travels as a small number and the shard
keys are cut from the digest again.  That keeps both steps of the aggregate on
hash tables (no sort), and a hot key collapses before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.classify import COMPAT_NAMES, PLAINTEXT, SCHEMES
from vigil.operators.protect import RECORD_KEY
from vigil.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES, estimate_bytes, materialise

# Scheme names by number; 0 stands for a name that is not listed.
_NAMES = [*SCHEMES, *(n for n in COMPAT_NAMES if n not in SCHEMES)]


def one_per_key(records: DataFrame, *aggregates: Column, within: Sequence[str] = ()) -> DataFrame:
    """One protected record per key, plus ``aggregates`` over its rows.  ``within`` names columns
    that follow from the key and are grouped by and kept too (a stored table's bucket columns).

    Where a key came with several schemes (roots protected in different
    modes), the one listed first wins.  Names outside the known schemes stay
    apart, so that an audit still sees them.
    """
    code = F.array_position(F.array(*[F.lit(n) for n in _NAMES]), F.col("hash_type")).cast("int")
    coded = records.withColumn("_code", code).withColumn("_other", F.when(F.coalesce(F.col("_code"), F.lit(0)) == 0, F.col("hash_type")))
    g = coded.groupBy(*RECORD_KEY, *within, "_other").agg(F.min(F.when(F.col("_code") > 0, F.col("_code"))).alias("_code"), *aggregates)
    known = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), F.col("_code"))
    named = g.withColumn("hash_type", F.when(F.col("_code").isNotNull(), known).otherwise(F.col("_other")))
    extra = [c for c in g.columns if c not in (*RECORD_KEY, "_other", "_code")]
    return named.select(
        "id_digest",
        "secret_digest",
        (F.col("hash_type") != F.lit(PLAINTEXT)).alias("is_hash"),
        "hash_type",
        "source",
        F.substring("id_digest", 1, 2).alias("p2"),
        F.substring("id_digest", 1, 4).alias("p4"),
        *extra,
    )


def dedupe(records: DataFrame) -> DataFrame:
    """Each key once."""
    return one_per_key(records)


def _position(order: Sequence[str]) -> tuple[Column, list[Column]]:
    """One number that sorts like ``order`` (one or two non-negative longs), and the way back."""
    if len(order) == 1:
        return F.col(order[0]).cast("long"), [F.col("_at").alias(order[0])]
    if len(order) != 2:
        raise ValueError("order by one or two columns")
    base = F.lit("18446744073709551616").cast("decimal(20,0)")
    packed = (F.col(order[0]).cast("decimal(17,0)") * base + F.col(order[1]).cast("decimal(20,0)")).cast("decimal(38,0)")
    high = F.floor(F.col("_at") / base).cast("long")
    low = F.pmod(F.col("_at"), base).cast("long")
    return packed, [high.alias(order[0]), low.alias(order[1])]


def first_occurrence(records: DataFrame, order: Sequence[str] = ("block", "seq")) -> DataFrame:
    """Each key once, with the position of its first row by ``order`` and
    ``copies`` (how many rows carried the key)."""
    packed, back = _position(list(order))
    g = one_per_key(records, F.min(packed).alias("_at"), F.count(F.lit(1)).alias("copies"))
    return g.select(*[c for c in g.columns if c not in ("_at", "copies")], *back, "copies")


def _same(a: DataFrame, b: DataFrame, key: Sequence[str]) -> Column:
    """Null-safe equality on ``key`` and, where both have it, the shard directory."""
    names = [*key, *(["p2"] if "p2" in a.columns and "p2" in b.columns and "p2" not in key else [])]
    on = F.lit(True)
    for c in names:
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return on


def insert_if_absent(
    batch: DataFrame,
    target: DataFrame | None,
    key: Sequence[str] = RECORD_KEY,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Rows of ``batch`` to append so that ``target`` holds each key once.

    Duplicates inside the batch collapse first.  A batch whose keys fit the
    broadcast bound probes the target with a broadcast semi join: the target's
    key columns are scanned once and never shuffled.  What is found is made
    distinct, so it is at most as large as the batch, whatever repeats the target
    holds.  A bulk batch falls back to a shuffle anti join.

    A batch of evenly spread digests touches every shard directory, so a large
    target is better loaded with ``dedupe=False`` and deduplicated by the
    maintenance job.
    """
    fresh = one_per_key(batch)
    if target is None:
        return fresh
    key = list(key)
    # The raw batch's key size bounds the deduplicated probe: measure it
    # before deciding, so a bulk batch is never written out an extra time.
    _, upper = estimate_bytes(batch.select(*key))
    if upper <= max_broadcast_bytes:
        fresh = materialise(fresh)
        keys = [*key, "p2"] if "p2" in target.columns else key
        probe = fresh.select(*keys)
        stored = target.select(*keys)
        present = stored.alias("a").join(F.broadcast(probe.alias("b")), _same(stored, probe, key), "left_semi").distinct()
        return fresh.alias("a").join(F.broadcast(present.alias("b")), _same(fresh, present, key), "left_anti")
    stored = target.select(*key)
    return fresh.alias("a").join(stored.alias("b"), _same(fresh, stored, key), "left_anti")
