"""Best-fit packing planned on a histogram of lengths.

1. ``token_pieces`` encodes each document once and keeps only lengths.
2. ``plan_slots`` packs *counts*: at most ``capacity`` lengths, so its input and
   its plan are bounded by the capacity, whatever the number of documents.
3. ``pack`` numbers the pieces within each length and joins the plan's row for
   (length, rank) to get a sequence and a place in it.

Ranks are taken inside salted (length, bucket) groups plus a prefix sum over
the bucket counts, so a length that a third of all pieces share is spread.

Defined cases: a null or empty text is one piece holding only the separator;
null ids are packed like others; repeated rows are packed once each; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.encoding import encoder, vocabulary_path
from vigil.llm.spark import frozen, table

CAPACITY = 2048
#: Salts per length, or the session's shuffle partitions if those are more.
#: Each (length, salt) group is numbered by itself.
SALTS = 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SLOTS = "length long, first_rank long, n long, per_sequence long, first_sequence long, first_offset long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all full but the first."""
    pieces = max(1, -(-n // capacity))
    first = n - capacity * (pieces - 1)
    return [(0, first)] + [(first + capacity * k, capacity) for k in range(pieces - 1)]


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", separator: int = 0
) -> DataFrame:
    """One row per piece of each document's ids plus ``separator``, in ``PIECES``."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(enc.encode(text.as_py()), separator).astype("<u4")
                for k, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    rows.append((doc, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            cols = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(cut, PIECES)


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit-decreasing over counts.

    Open sequences are kept as runs that share one remaining space.  The
    longest pieces go first; each fills the run with the least space that
    still holds it, as often as it fits, since after one piece that same run
    is again the best fit.  A run's space at least halves whenever it is
    used, and a length opens or splits at most two runs, so the plan has at most
    ``3 * capacity * (log2(capacity) + 1)`` rows.
    """
    spaces: list[int] = []  # remaining spaces that some open run has, ascending
    runs: dict[int, deque[tuple[int, int]]] = {}  # space -> (first sequence, count)
    plan, opened = [], 0

    def put(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in runs:
                runs[space] = deque()
                insort(spaces, space)
            runs[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of length {length} does not fit into {capacity}")
        left, rank = histogram[length], 0
        while left > 0:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, count = runs[space].popleft()
                if not runs[space]:
                    del runs[space], spaces[at]
            else:
                space, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            each = space // length
            n = min(left, count * each)
            plan.append((length, rank, n, each, first, capacity - space))
            full, rest = divmod(n, each)
            put(space - each * length, first, full)
            if rest:
                put(space - rest * length, first + full, 1)
                full += 1
            put(space, first + full, count - full)
            left, rank = left - n, rank + n
    return plan


def ranked(pieces: DataFrame, key: str, order: list[str], salts: int | None = None, rank: str = "rank") -> DataFrame:
    """Adds a dense 0-based ``rank`` within ``key``, without one group per key.

    ``pieces`` must be frozen: it is read twice.  Rows that tie on all of
    ``order`` are told apart arbitrarily, so ``order`` should hold every column
    that matters.
    """
    salts = salts or max(SALTS, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int")
    salted = pieces.withColumn("_salt", salt)
    before = Window.partitionBy(key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        salted.groupBy(key, "_salt")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    inside = F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order)) - 1
    numbered = salted.withColumn("_inside", inside)
    return numbered.join(base, [key, "_salt"]).withColumn(rank, F.col("_base") + F.col("_inside")).drop(
        "_salt", "_inside", "_base"
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, salts: int | None = None) -> DataFrame:
    """``PIECES`` plus ``sequence_id`` and ``offset``: pieces of one sequence
    follow each other without gaps from offset 0 and fill at most ``capacity``."""
    spark = pieces.sparkSession
    # at most `capacity` rows: a length is between 1 and capacity
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(plan_slots(histogram, capacity), SLOTS)
    ranks = ranked(pieces, "length", ["doc_id", "piece", "start", "ids_crc32"], salts)
    # a rank falls into one row of its length: equality on length, then the range
    rows = ranks.join(
        F.broadcast(plan.withColumnRenamed("length", "_length")),  # bounded: see plan_slots
        (F.col("length") == F.col("_length"))
        & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("first_rank") + F.col("n")),
    )
    nth = F.col("rank") - F.col("first_rank")
    return rows.select(
        *pieces.columns,
        (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + nth % F.col("per_sequence") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(frozen(token_pieces(docs, path, capacity)), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))
