"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is mapped to the bit counts of its 2-bit segments.  The Manhattan
distance of two such maps never exceeds the number of differing bits, so it is
a lower bound that needs no bitwise comparison.  Candidates come from a grid
join on these counts:

* of two fingerprints at most ``2r + 1`` bits apart, one half (32 bits) is at
  most ``r`` apart, so its 16 counts are at Manhattan distance ``r`` or less;
* two integer points at distance ``r <= 2`` have a grid point within distance 1
  of both, so each half is written to its own cell and its direct
  neighbours, and pairs meet in a shared cell (an equality join).

Pairs that meet pass the bound over all 32 segments and are then verified by
``bit_count(a XOR b)``.  The search is exact: no link within the distance is lost.

Dense groups: equal fingerprints are one row.  Fingerprints at distance 2 or
less are first joined by hubs (each bit flipped once is a key; all holders of a
key are linked to its smallest, which is at most 2 bits away), a number of
links that is linear in the rows.  The grid join then only has to find links
between different hub groups.

Defined cases: a null or empty text has no words and fingerprint zero; null ids
are kept as rows and take part with id null ordered last; repeated rows give
repeated results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.components import component_ids
from vigil.llm.spark import frozen, table

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Hashes whose bits are unpacked at a time.
_BLOCK = 1 << 15


def shingle_hashes(raw: bytes, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``words`` words (A-Z in lower case, joined by spaces); of all words if fewer."""
    w = raw.lower().split()  # for bytes: ASCII letters and ASCII white space
    if not w:
        return np.zeros(0, np.uint64)
    text = b" ".join(w)
    n = len(w)
    if n <= words:
        return np.array([xxhash.xxh64_intdigest(text, seed)], np.uint64)
    sizes = np.fromiter(map(len, w), np.int64, n) + 1
    starts = np.zeros(n + 1, np.int64)
    np.cumsum(sizes, out=starts[1:])
    lo, hi = starts[: n - words + 1].tolist(), (starts[words:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[a:b], seed) for a, b in zip(lo, hi)), np.uint64, len(lo))


def majority_bits(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        block = hashes[i : i + _BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, tag, fp``: the 64-bit fingerprint of every whole text, as a signed
    long; ``tag`` is a hash of the text, which tells rows with equal ids apart."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).cast(pa.large_binary())
            found = [majority_bits(shingle_hashes(t.as_py() or b"", words)) for t in raw]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), fps], ["doc_id", "tag", "fp"])

    text = F.col(f"`{text_col}`").cast("string")
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tag"))
    return given.mapInArrow(make, "doc_id long, tag long, fp long")


def _long(bits: int):
    """A literal of these 64 bits."""
    return F.lit(bits - (bits >> 63 << 64)).cast("long")


def _counts(fp, first: int = 0, last: int = 32):
    """Bit counts (0 to 2) of the 2-bit segments ``first`` to ``last - 1``, two bits each, in place."""
    mask = _long(sum(1 << (2 * s) for s in range(first, last)))
    one, other = fp.bitwiseAND(mask), F.shiftrightunsigned(fp, 1).bitwiseAND(mask)
    return one.bitwiseXOR(other).bitwiseOR(F.shiftleft(one.bitwiseAND(other), 1))


def _manhattan(a, b):
    """Manhattan distance of two maps of counts."""
    # per segment a XOR b is 0, 1 or 2 for that distance, and 3 for 1 against 2
    d = a.bitwiseXOR(b)
    odd = _long(0x5555555555555555)
    low, high = d.bitwiseAND(odd), F.shiftrightunsigned(d, 1).bitwiseAND(odd)
    return F.bit_count(low) + 2 * F.bit_count(high) - 2 * F.bit_count(low.bitwiseAND(high))


def _cells(counts, first: int, last: int):
    """A half's own cell and the cells one step away, as packed counts.

    The halves' cells differ in which 32 bits they use; only the cell of all
    zeros is shared, where the verification tells them apart.
    """
    near = [counts]
    for s in range(first, last):
        value = F.shiftrightunsigned(counts, 2 * s).bitwiseAND(_long(3))
        near += [
            F.when(value != 2, counts.bitwiseXOR(_long(1 << (2 * s)))),  # 0 to 1 and back
            F.when(value != 0, counts.bitwiseXOR(_long(3 << (2 * s)))),  # 1 to 2 and back
        ]
    return F.array_compact(F.array(*near))


def hub_links(fps: DataFrame) -> DataFrame:
    """Links (``src`` > ``dst``) that join any two fingerprints ``id`` at most 2 bits apart.

    A key has at most 65 holders (itself and its one-bit neighbours), which
    are at most 2 bits apart from each other; each is linked to the least.
    """
    ones = [F.col("id").bitwiseXOR(_long(1 << k)) for k in range(64)]
    keys = fps.select("id", F.explode(F.array("id", *ones)).alias("key"))
    least = keys.select("id", F.min("id").over(Window.partitionBy("key")).alias("dst"))
    return least.where("id > dst").select(F.col("id").alias("src"), "dst").distinct()


def grid_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Verified pairs (``src`` > ``dst``) of fingerprints ``id`` of different ``grp``, found by the grid join."""
    if not 0 <= max_bits <= 5:
        raise ValueError("the grid join covers distances up to 5")
    halves = [_cells(_counts(F.col("id"), *half), *half) for half in ((0, 16), (16, 32))]
    cells = fps.select("id", "grp", F.explode(F.array_union(*halves)).alias("cell"))
    a, b = cells.alias("a"), cells.alias("b")
    met = a.join(
        b,
        (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.id") > F.col("b.id"))
        & (F.col("a.grp") != F.col("b.grp"))
        & (_manhattan(_counts(F.col("a.id")), _counts(F.col("b.id"))) <= max_bits)
        & (F.bit_count(F.col("a.id").bitwiseXOR(F.col("b.id"))) <= max_bits),
    )
    return met.select(F.col("a.grp").alias("s"), F.col("b.grp").alias("d")).distinct()


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, tag, fp, group, component_id`` per row: ``component_id`` is the smallest
    doc_id reachable over links of at most ``max_bits`` bits, ``group`` the group's own name."""
    rows = frozen(fingerprints(docs, words, id_col, text_col))
    # one node per fingerprint; doc_ids come back only at the end
    nodes = frozen(rows.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumnRenamed("fp", "id"))
    if max_bits >= 2:
        hubs = component_ids(hub_links(nodes))
        nodes = frozen(nodes.join(hubs, "id", "left").select("id", "least", F.coalesce("component", "id").alias("grp")))
    else:
        nodes = nodes.withColumn("grp", F.col("id"))
    between = grid_links(nodes, max_bits).select(F.greatest("s", "d").alias("src"), F.least("s", "d").alias("dst"))
    merged = component_ids(between.distinct()).withColumnRenamed("id", "grp")
    labelled = nodes.join(merged, "grp", "left").select("id", "least", F.coalesce("component", "grp").alias("_c"))
    least = labelled.groupBy("_c").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "_c").select(F.col("id").alias("fp"), F.col("_c").alias("group"), "component_id")
    return rows.join(named, "fp").select("doc_id", "tag", "fp", "group", "component_id")


def one_per_group(
    docs: DataFrame, words: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that with the smallest id
    (of rows without an id, that with the smallest text hash)."""
    found = near_duplicates(docs, words, max_bits, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("first")
    chosen = found.groupBy("group").agg(first).select("first.*")
    keys = ["_key", "_none", "_tag"]  # never null, so that texts are shuffled once for the join and the window

    def keyed(row_id: Column, tag: Column) -> list[Column]:
        return [F.coalesce(row_id, F.lit(0)).alias("_key"), row_id.isNull().alias("_none"), tag.alias("_tag")]

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        *keyed(F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.col(f"`{text_col}`").cast("string"))),
    )
    met = rows.join(chosen.select(*keyed(F.col("doc_id"), F.col("tag"))), keys, "left_semi")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("row")))  # repeated rows
    return met.withColumn("_n", nth).where("_n = 1").select("row.*")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
