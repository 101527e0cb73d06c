"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ``k`` smallest distinct 64-bit hashes of a text's shingles
(five words, A-Z in lower case), ascending; as a string, base64 of their
big-endian bytes.  The sketch of a union is the ``k`` smallest of the sketches'
union, so sketches of parts merge exactly, in any order.  From two sketches
come estimates of resemblance, containment and distinct shingle counts; they
are exact while the union has at most ``k`` shingles.

``next_in_order`` walks documents by descending id with each one's successor
at hand.  Ids are cut into ranges by quantiles; each range's first row is also
sent to the range before it, so every text is shuffled once and each task
streams through its range.  An id that many rows share, and rows without an id,
are cut further by the hash of the text; only rows alike in both stay together.

Defined cases: a null text is empty; a text without words has the empty
sketch, and two empty sketches are alike (1.0); one with fewer than five words
has one shingle; null ids come last; rows with equal ids follow each other by
the hash of their text; a single document is its own successor; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.simhash import shingle_hashes
from vigil.llm.spark import table
from vigil.operators.numbering import range_of

K = 128
WORDS = 5


def sketch(raw: bytes, k: int = K, words: int = WORDS) -> np.ndarray:
    return np.unique(shingle_hashes(raw, words))[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the union's shingles that both texts have."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    return float((np.isin(union, a, assume_unique=True) & np.isin(union, b, assume_unique=True)).mean())


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**64 / (float(a[-1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first text's shingles that the second has."""
    if not len(a):
        return 1.0
    r = resemblance(a, b, k)
    both = r / (1 + r) * (distinct_count(a, k) + distinct_count(b, k))
    return min(1.0, both / distinct_count(a, k))


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def sketch_hashes(parts: DataFrame, key: str, text_col: str = "text", k: int = K) -> DataFrame:
    """``key, hash`` (unsigned, as decimal(20)): the sketch of all texts of a key together.

    Each batch merges its own texts by key; batches' sketches merge in two
    ranked steps, the first by key and hash prefix, so that a key with a third
    of the texts is not one group.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged: dict = {}
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                merged[name] = merge(merged.get(name, np.zeros(0, np.uint64)), sketch((text.as_py() or "").encode(), k), k)
            names = [n for n, a in merged.items() for _ in a]
            values = np.concatenate([*merged.values(), np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(names, batch.column(0).type), pa.array(values.view(np.int64))], [key, "h"])

    kind = parts.schema[key].dataType.simpleString()
    rows = parts.select(key, F.col(text_col).cast("string")).mapInArrow(run, f"`{key}` {kind}, h long").distinct()
    # flipping the sign bit makes the order of longs that of unsigned values
    flipped = F.col("h").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    rows = rows.withColumn("o", flipped).withColumn("s", F.pmod(F.xxhash64("h"), F.lit(64)))
    for group in ([key, "s"], [key]):
        rows = rows.withColumn("r", F.row_number().over(Window.partitionBy(*group).orderBy("o"))).where(F.col("r") <= k)
    unsigned = F.col("h").cast("decimal(20,0)") + F.when(F.col("h") < 0, F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(F.lit(0))
    return rows.select(key, unsigned.cast("decimal(20,0)").alias("hash"))


class _Ranges:
    """Ranges of the order by id (null lowest) and, within a hot id, by the hash of the text."""

    def __init__(self, ids: DataFrame, ranges: int):
        at = [i / ranges for i in range(1, ranges)]
        cuts = F.percentile_approx("doc_id", at, 20 * ranges) if at else F.lit(None)
        found, rows, none = ids.agg(cuts, F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull())).first()
        self.bounds = sorted(set(found or []))
        # an id that fills several quantiles gets that many ranges of its own, as do rows without an id
        filled = Counter(found or [])
        slots = [-(-none * ranges // max(rows, 1)), *[filled[b] for b in self.bounds]]
        self.slots = [n if n > 1 else 0 for n in slots]
        self.any_hot = any(self.slots)
        self.first = [sum(self.slots[:k]) + k for k in range(len(self.slots))]
        self.n = sum(self.slots) + len(self.slots)

    def deal(self, rows: DataFrame) -> DataFrame:
        """``rows`` (``doc_id``, ``tie``) with ``own``, the range: those of a hot id come before the other ids of its cut."""
        cut = rows.withColumn("_cut", range_of(F.col("doc_id"), self.bounds).cast("int"))  # computed once

        def at_cut(values: list) -> Column:
            return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("_cut") + 1)

        if not self.any_hot:
            return cut.withColumnRenamed("_cut", "own")
        # even parts of the hashes, in their order
        part = F.shiftright((F.shiftright("tie", 32) + (1 << 31)) * F.col("_slots"), 32)
        is_hot = F.col("doc_id").eqNullSafe(at_cut([None, *self.bounds])) & (F.col("_slots") > 0)
        own = at_cut(self.first) + F.when(is_hot, part).otherwise(F.col("_slots"))
        return cut.withColumn("_slots", at_cut(self.slots)).withColumn("own", own.cast("int")).drop("_cut", "_slots")


def next_in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """``doc_id, text, target, extra``, partitioned by ``target`` and sorted so that
    each row's successor is the row after it; ``extra`` rows only follow others.

    ``ranges`` (default: the session's shuffle partitions) bounds what is
    collected: one quantile and one first row's id and hash per range.
    """
    spark = docs.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = _Ranges(rows.select("doc_id"), n)
    # texts are read for the cuts only where an id is hot
    rows = rows.withColumn("tie", F.xxhash64("text") if cut.any_hot else F.lit(0).cast("long"))
    rows = cut.deal(rows)
    head = F.max(F.struct("doc_id", "tie"))  # null is lowest
    heads = {r["own"]: r["head"] for r in rows.groupBy("own").agg(head.alias("head")).collect()}
    there = sorted(heads)
    # a range's first document also goes to the range that comes before; the very first goes to the last
    before = {t: there[(k + 1) % len(there)] for k, t in enumerate(there)}

    def of_own(value) -> Column:
        return F.element_at(F.array(*[F.lit(value(t) if t in heads else None).cast("long") for t in range(cut.n)]), F.col("own") + 1)

    is_head = F.col("doc_id").eqNullSafe(of_own(lambda t: heads[t]["doc_id"])) & (F.col("tie") == of_own(lambda t: heads[t]["tie"]))
    own = F.struct(F.col("own").alias("target"), F.lit(0).alias("extra"))
    further = F.struct(of_own(before.get).cast("int").alias("target"), F.lit(1).alias("extra"))
    dealt = rows.withColumn("_to", F.explode(F.when(is_head, F.array(own, further)).otherwise(F.array(own))))
    dealt = dealt.select("doc_id", "text", "_to.target", "_to.extra")
    return dealt.repartitionById(cut.n, F.col("target")).sortWithinPartitions(
        "target", "extra", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edit, whose last third comes from the next document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row = None  # target, id, text, sketch: waits for its successor

        def closed(row, text: str, a: np.ndarray) -> tuple:
            _, doc, own, mine = row
            third = len(own) // 3
            edited = (own[: len(own) - third] + text[:third]).encode()
            b = sketch(edited, k)
            return (
                doc, len(own), hashlib.sha256(edited).hexdigest(), encode(mine), encode(b),
                resemblance(mine, b, k), resemblance(mine, a, k),
            )

        names = RESULT.replace(",", "").split()[::2]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in batches:
            out = []
            doc, text, target, extra = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                t, own = target[i].as_py(), text[i].as_py() or ""
                if extra[i].as_py() and open_row is None:
                    continue  # a further copy of a first document
                mine = sketch(own.encode(), k)
                if open_row is not None and open_row[0] == t:
                    out.append(closed(open_row, own, mine))
                open_row = None if extra[i].as_py() else (t, doc[i].as_py(), own, mine)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return next_in_order(docs, id_col, text_col, ranges).mapInArrow(run, RESULT)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
