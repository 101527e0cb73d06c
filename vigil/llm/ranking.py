"""Ranked lexical search: item bundles pass through term owners.

Index.  One pass over the texts cuts each task's documents into slices of at most
``SLICE`` documents, sorted by id, and writes a posting row per (slice, term): the
documents' places in the slice, the term's counts there and the documents' lengths.
Only terms that may occur in an item are written: a bitmap of ``SLOTS`` hash slots,
of fixed size, drops the others; what passes it by chance finds no item later.
Document counts, lengths and document frequencies are sums over these rows, that is
over all documents.

Search.  Items form bundles of about ``ITEMS``.  Terms are dealt to ``OWNERS`` owners
by hash.  A bundle of a slice carries, per item, a sparse accumulator of 64-bit scores; at
each owner's stage a cogroup on (bundle, slice) meets the owner's postings of the
bundle's terms and adds their integer contributions.  After the last owner the ten
best of each item and slice go on, and one ranking per item is left.

How it is spread.  A frequent term is one row per slice, never one group; a group of
the cogroup holds one slice of one bundle: at most items x slice scores.  Query terms are
broadcast to the postings only if they are measured to be small; else both are shuffled
by term, and adaptive execution splits a frequent one.

Defined cases: null or termless texts have no part in the counts and the ranking; a
null or termless item has no results; items equal in id and text are asked once; items of
one id and different texts are each ranked, under that id; documents without an id
are ranked, after all ids on equal scores; repeated rows are documents of their own; empty
tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.spark import frozen, stored, table
from vigil.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES, estimate_bytes

K = 10
OWNERS = 4
ITEMS = 256
SLICE = 2048
#: Bytes of text after which a slice is closed early.
SLICE_BYTES = 64 << 20
SLOTS = 1 << 20
#: Bytes of a lower-cased text that make up terms; all bytes of characters beyond ASCII do.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(text: str | bytes | None) -> list[bytes]:
    """The terms of a text, in order; ``bytes.lower`` lowers A-Z alone."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return _TERM.findall(raw.lower())


def _slot(term: bytes) -> int:
    return zlib.crc32(term) & (SLOTS - 1)


def bundled(items: DataFrame, per_bundle: int = ITEMS, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``bundle, pos, item_id, term, times, slot``: a row per item and term; stored."""
    given = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).distinct()
    n = max(1, -(-given.count() // per_bundle))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for pos, (i, text) in enumerate(zip(group["item_id"], group["text"])):
            for term, times in Counter(terms(text)).items():
                out.append((group["bundle"].iat[0], pos, i, term, times, _slot(term)))
        return pd.DataFrame(out, columns=["bundle", "pos", "item_id", "term", "times", "slot"])

    # ids travel as text: pandas has no plain column of longs with nulls
    dealt = given.select(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).alias("bundle"), F.col("item_id").cast("string").alias("item_id"), "text")
    found = dealt.groupBy("bundle").applyInPandas(run, "bundle long, pos int, item_id string, term binary, times long, slot int")
    return stored(found.withColumn("item_id", F.col("item_id").cast("long")), "ranking-items")


_POSTING = "slice long, term binary, at binary, tf binary, n binary, ids array<long>, docs long, total long"
_POSTING_TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
_POSTING_NAMES = ["slice", "term", "at", "tf", "n", "ids", "docs", "total"]


def _slice_rows(number: int, docs: list[tuple]) -> list[tuple]:
    """The posting rows of one slice, after its own row (ids; documents and terms counted)."""
    docs.sort(key=lambda d: (d[0] is None, d[0] or 0))
    lengths = np.array([d[2] for d in docs], np.uint32)
    found: dict[bytes, tuple[list, list]] = {}
    for at, (_, counts, _) in enumerate(docs):
        for term, tf in counts:
            places = found.get(term)
            if places is None:
                places = found[term] = ([], [])
            places[0].append(at)
            places[1].append(tf)
    rows = [(number, None, None, None, None, [d[0] for d in docs], len(docs), int(lengths.sum(dtype=np.int64)))]
    for term, (at, tf) in found.items():
        at = np.array(at, np.uint32)
        rows.append((number, term, at.tobytes(), np.array(tf, np.uint32).tobytes(), lengths[at].tobytes(), None, None, None))
    return rows


def _index(wanted: bytes, per_slice: int, slice_bytes: int):
    def emitted(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(rows), 4096):
            columns = zip(*rows[k : k + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _POSTING_TYPES)], names=_POSTING_NAMES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.unpackbits(np.frombuffer(wanted, np.uint8)).tobytes()
        number = TaskContext.get().partitionId() << 32
        docs, size = [], 0
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for i, text in zip(batch.column(0).to_pylist(), texts):
                raw = text.as_py()
                found = terms(raw)
                if not found:
                    continue
                counts = [(t, c) for t, c in Counter(found).items() if slots[zlib.crc32(t) & (SLOTS - 1)]]
                docs.append((i, counts, len(found)))
                size += len(raw)
                if len(docs) >= per_slice or size >= slice_bytes:
                    yield from emitted(_slice_rows(number, docs))
                    number, docs, size = number + 1, [], 0
        if docs:
            yield from emitted(_slice_rows(number, docs))

    return run


def _addition(n_docs: int, n_terms: int, last: bool, k: int):
    """Adds an owner's postings of one (bundle, slice) to its accumulators; the last owner's stage leaves the k best."""

    def run(key: tuple, carried: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        bundle, number = key
        sums: dict[int, np.ndarray] = {}
        width = 1 + max(
            [int(np.frombuffer(x, np.uint32).max()) for x in carried["at"]] + [int(np.frombuffer(x, np.uint32)[-1]) for x in postings["at"]], default=0
        )
        for pos, at, score in zip(carried["pos"], carried["at"], carried["score"]):
            sums[pos] = np.zeros(width, np.int64)
            sums[pos][np.frombuffer(at, np.uint32)] = np.frombuffer(score, np.int64)
        for at, tf, n, w, users in zip(postings["at"], postings["tf"], postings["n"], postings["w"], postings["users"]):
            place = np.frombuffer(at, np.uint32)
            count = np.frombuffer(tf, np.uint32).astype(np.int64)
            m = 100 - 75 + (75 * np.frombuffer(n, np.uint32).astype(np.int64) * n_docs) // n_terms
            gain = w * ((1_000_000_000 * count) // (1000 * count + 8 * m))
            for user in users:
                if user["pos"] not in sums:
                    sums[user["pos"]] = np.zeros(width, np.int64)
                sums[user["pos"]][place] += user["times"] * gain  # a document is once in a posting
        out = []
        for pos, total in sums.items():
            at = np.flatnonzero(total)
            if last and len(at) > k:  # places follow ids, so equal scores do too
                at = np.sort(at[np.argsort(-total[at], kind="stable")[:k]])
            if len(at):
                out.append((bundle, number, pos, at.astype(np.uint32).tobytes(), total[at].tobytes()))
        return pd.DataFrame(out, columns=["bundle", "slice", "pos", "at", "score"])

    return run


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["bundle", "slice", "pos", "at", "score"]
    for batch in batches:
        sizes = [len(x) // 4 for x in batch.column("at").to_pylist()]
        left = [np.repeat(batch.column(c).to_numpy(), sizes) for c in names[:3]]
        at = np.frombuffer(b"".join(batch.column("at").to_pylist()), np.uint32).astype(np.int32)
        score = np.frombuffer(b"".join(batch.column("score").to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*left, at, score)], names=names)


def rank_documents(
    items: DataFrame,
    docs: DataFrame,
    k: int = K,
    owners: int = OWNERS,
    per_bundle: int = ITEMS,
    per_slice: int = SLICE,
    slice_bytes: int = SLICE_BYTES,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    asked = bundled(items, per_bundle)
    bits = np.zeros(SLOTS, np.uint8)
    bits[[r["slot"] for r in asked.select("slot").distinct().collect()]] = 1  # SLOTS numbers at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = stored(texts.mapInArrow(_index(np.packbits(bits).tobytes(), per_slice, slice_bytes), _POSTING), "ranking-index")
    slices, postings = index.where(F.col("term").isNull()), index.where(F.col("term").isNotNull())
    counts = slices.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("total"), F.lit(0)).alias("l")).head()
    n_docs, n_terms = int(counts["n"]), max(1, int(counts["l"]))

    df = postings.groupBy("term").agg(F.sum(F.octet_length("at") / 4).cast("long").alias("df"))
    users = asked.groupBy("term", "bundle").agg(F.collect_list(F.struct("pos", "times")).alias("users"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("long")
    owner = F.pmod(F.xxhash64("term"), F.lit(owners)).cast("int")
    wanted = frozen(users.join(df, "term").select("term", "bundle", "users", weight.alias("w"), owner.alias("owner")))
    _, size = estimate_bytes(wanted.select("term", "bundle", "w"))
    size += 16 * (asked.count() + 1)  # the users' places and counts
    wanted = F.broadcast(wanted) if size <= max_broadcast_bytes else wanted
    met = postings.select("slice", "term", "at", "tf", "n").join(wanted, "term")
    # each owner reads its own terms: Spark pushes the filter below the join

    acc = spark.createDataFrame([], "bundle long, slice long, pos int, at binary, score binary")
    for stage in range(owners):
        own = met.where(F.col("owner") == stage).select("bundle", "slice", "at", "tf", "n", "w", "users")
        acc = (
            acc.groupBy("bundle", "slice")
            .cogroup(own.groupBy("bundle", "slice"))
            .applyInPandas(_addition(n_docs, n_terms, stage == owners - 1, k), "bundle long, slice long, pos int, at binary, score binary")
        )
    best = acc.mapInArrow(_unpacked, "bundle long, slice long, pos int, at int, score long")
    named = best.join(slices.select("slice", "ids"), "slice").select("bundle", "pos", "score", F.get("ids", F.col("at")).alias("doc_id"))
    order = Window.partitionBy("bundle", "pos").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(asked.select("bundle", "pos", "item_id").distinct(), ["bundle", "pos"]).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def _found(name: str, source: str, key: str) -> str:
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return (
        f"{name} AS (SELECT k, {key}, unnest(regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term "
        f"FROM (SELECT row_number() OVER () AS k, * FROM {source}))"
    )


SQL = f"""
WITH {_found("d", "documents", "doc_id")},
{_found("i", "(SELECT DISTINCT item_id, text FROM benchmark)", "item_id")},
size AS (SELECT k, doc_id, count(*) AS n FROM d GROUP BY k, doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
tf AS (SELECT k, term, count(*) AS tf FROM d GROUP BY k, term),
df AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, docs),
asked AS (SELECT k AS item, item_id, term, count(*) AS times FROM i GROUP BY ALL),
scores AS (
  SELECT item, item_id, size.k, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN df USING (term) JOIN tf USING (term) JOIN size ON size.k = tf.k, whole GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
