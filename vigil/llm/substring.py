"""Substring deduplication by level-wise doubling.

A window of ``window`` words is removed from a document if the same words also
start in a document with a smaller id.  Counting every window would shuffle a
row per word, so candidates are found at a quarter of the length and doubled:

1. In each run of windows of a quarter length that one full window can hold,
   the one with the least hash is sampled.  Equal full windows sample the same
   one, so a full window can only repeat if its sample does.
2. Samples whose words occur in two documents or more are extended to twice the
   length, to the left and to the right (a full window holds one of the two),
   and compared again.  Those that do not repeat are gone.
3. Full windows that hold a survivor are written by hash; a window is removed
   where its hash has a smaller document.  If no candidates survive a level,
   the later ones have no rows.

Hashes are 64-bit polynomials of 64-bit word hashes, so the levels never miss a
repeat; a wrong one needs a collision among candidate windows.

Skew: what a task sees of one hash is settled there.  At the first two levels,
windows that two documents of a task share are survivors already; only one row
of the smallest and one of the largest document go to the hash's group, as
witnesses for other tasks.  At the last, only the smallest document's rows
go; the others are marked at once, as ranges.  So a passage that a third of all
documents hold costs its group a row or two per task, not one per document.

Defined cases: a null text has no words; a document shorter than the window
loses nothing; rows without an id neither lose nor take words; rows with the
same id do not take words from each other; an empty table gives an empty
result; other columns are kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.spark import table

WINDOW = 50
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(1 << 14, n), base, np.uint64)
        steps[0] = 1
        grown = np.multiply.accumulate(steps)
        if n > 1 << 20:  # for a very long text: not kept
            return grown
        have = _powers[base] = grown
    return have[:n]


class Rolling:
    """Hashes of the word windows of one text."""

    def __init__(self, raw: bytes):
        words = raw.split()  # for bytes: ASCII white space
        self.n = n = len(words)
        x = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(x * _power(_BASE, n), out=self._sums[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        s = self._sums
        return (s[starts + length] - s[starts]) * _power(_INVERSE, self.n + 1)[starts]

    def every(self, length: int) -> np.ndarray:
        s = self._sums
        return (s[length:] - s[:-length]) * _power(_INVERSE, self.n + 1)[: self.n - length + 1]

    def samples(self, length: int, window: int) -> np.ndarray:
        """Starts of the sampled windows of ``length``: each window of ``window`` words holds one."""
        mixed = self.every(length)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        run = window - length + 1
        least = np.lib.stride_tricks.sliding_window_view(mixed, run).argmin(axis=1)
        return np.unique(least + np.arange(len(least)))


def levels(window: int) -> tuple[int, int]:
    """Lengths of the first two levels; a full window is at least three of the first."""
    first = max(1, -(-window // 4)) if window >= 8 else 1
    if window < 3 * first:
        raise ValueError("windows of fewer than three words are not supported")
    return first, min(2 * first, window)


#: place: the text's tag and the window's start.  n: 0 for a window still to be
#: judged, else the number of starts from this one on that are settled.
_ROWS = "hash long, id long, place long, n long"
#: Windows that a task holds and settles together.
_HELD = 1_000_000


def _place(tag: int, starts: np.ndarray) -> np.ndarray:
    return np.int64(tag << 31) + starts.astype(np.int64)


def _spread(places: np.ndarray) -> np.ndarray:
    """Any even value: settled rows need no group."""
    return places.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)


def _batch(hashes, ids, places, n) -> pa.RecordBatch:
    cols = [pa.array(hashes.view(np.int64)), pa.array(ids), pa.array(places), pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(cols, ["hash", "id", "place", "n"])


def _grouped(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by hash and id, and each ordered row's first and last place in its group."""
    order = np.lexsort((ids, hashes))
    h = hashes[order]
    heads = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    size = np.diff(np.r_[heads, len(h)])
    return order, np.repeat(heads, size), np.repeat(heads + size - 1, size)


def _shared(hashes: np.ndarray, ids: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    """Windows of two documents or more are settled; of these, two rows stay as witnesses."""
    order, first, last = _grouped(hashes, ids)
    at, i = np.arange(len(order)), ids[order]
    settled = i[first] < i[last]
    free = settled & (at != first) & (at != last)
    h = hashes[order]
    h[free] = _spread(places[order][free])
    return _batch(h, i, places[order], settled)


def _smallest(hashes: np.ndarray, ids: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    """Windows that also start in a smaller document are settled, as ranges."""
    order, first, _ = _grouped(hashes, ids)
    gone = np.empty(len(order), bool)
    gone[order] = ids[order] > ids[order][first]
    i, p = ids[gone], places[gone]
    heads = np.flatnonzero(np.r_[True, (p[1:] != p[:-1] + 1) | (i[1:] != i[:-1])][: len(p)])
    runs = np.diff(np.r_[heads, len(p)])
    left = ~gone
    return _batch(
        np.r_[hashes[left], _spread(p[heads])],
        np.r_[ids[left], i[heads]],
        np.r_[places[left], p[heads]],
        np.r_[np.zeros(int(left.sum()), np.int64), runs],
    )


def _windows(starts_of: Callable, length: int, settle: Callable) -> Callable:
    """A map over texts that emits ``_ROWS`` for the windows of ``length`` words at
    ``starts_of(rolling, candidates)``, settling what a task holds."""

    def flush(held: list[tuple[np.ndarray, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if held:
            ids = np.repeat(np.array([i for _, i, _ in held], np.int64), [len(h) for h, _, _ in held])
            yield settle(np.concatenate([h for h, _, _ in held]), ids, np.concatenate([p for _, _, p in held]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            given = column.get("_starts")
            for k in range(batch.num_rows):
                doc, text = column["_id"][k].as_py(), column["_text"][k].as_py()
                if doc is None or not text:
                    continue
                rolling = Rolling(text.encode())
                candidates = None if given is None else given[k].values.to_numpy(zero_copy_only=False)
                starts = starts_of(rolling, candidates)
                if len(starts):
                    held.append((rolling.at(starts, length), doc, _place(column["_tag"][k].as_py(), starts)))
                    size += len(starts)
                if size > _HELD:
                    yield from flush(held)
                    held, size = [], 0
        yield from flush(held)

    return run


def _start():
    return F.col("place").bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int")


def _by_text(rows: DataFrame, gathered: Column) -> DataFrame:
    # as many entries as the text has words, at most
    text = [F.coalesce("id", F.lit(0)).alias("_key"), F.shiftrightunsigned("place", 31).alias("_tag")]
    return rows.select(*text, "place", "n").groupBy("_key", "_tag").agg(gathered)


def _with(texts: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``texts`` with the array that ``found`` has for each.

    The keys are never null on the side of the texts, so no join adds a filter
    there: all of them plan the same exchange of the texts and Spark runs it
    once.  What is found is grouped by the same keys and moves no second time.
    """
    array = found.columns[-1]
    return texts.join(found, ["_key", "_tag"], how).select(*texts.columns, array)


def _survivors(rows: DataFrame) -> DataFrame:
    """``_key, _tag, _starts`` of windows that occur with two ids or more."""
    same = Window.partitionBy("hash")  # at most two rows of a task, or one document's
    seen = rows.select("*", F.min("id").over(same).alias("a"), F.max("id").over(same).alias("b"))
    return _by_text(seen.where("n > 0 OR a < b"), F.collect_list(_start()).alias("_starts"))


def removed_starts(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``_key, _tag, _gone``: ranges (``at``, ``n``) of starts of removed windows, per text.

    ``texts`` has ``_key`` (the id, 0 for none), ``_id, _tag, _text`` (and what else
    shares its shuffle)."""
    first, second = levels(window)
    reach = window - second

    def sampled(r: Rolling, _) -> np.ndarray:
        return r.samples(first, window) if r.n >= window else np.zeros(0, np.int64)

    def doubled(r: Rolling, starts: np.ndarray) -> np.ndarray:
        both = np.union1d(starts, starts - first)  # to the right, to the left
        return both[(both >= 0) & (both + second <= r.n)]

    def full(r: Rolling, starts: np.ndarray) -> np.ndarray:
        """Starts of the full windows that hold a surviving window."""
        delta = np.zeros(r.n + 2, np.int64)
        np.add.at(delta, np.maximum(starts - reach, 0), 1)
        np.add.at(delta, starts + 1, -1)
        return np.flatnonzero(np.cumsum(delta)[: max(0, r.n - window + 1)])

    def level(starts_of: Callable, length: int, settle: Callable, candidates: DataFrame | None) -> DataFrame:
        given = texts if candidates is None else _with(texts, candidates, "inner")
        return given.mapInArrow(_windows(starts_of, length, settle), _ROWS)

    one = _survivors(level(sampled, first, _shared, None))
    two = _survivors(level(doubled, second, _shared, one))
    last = level(full, window, _smallest, two)
    least = F.min(F.when(F.col("n") == 0, F.col("id"))).over(Window.partitionBy("hash"))
    gone = last.withColumn("_least", least).where((F.col("n") > 0) | (F.col("id") > F.col("_least")))
    ranges = F.collect_list(F.struct(_start().alias("at"), F.greatest("n", F.lit(1)).cast("int").alias("n")))
    return _by_text(gone, ranges.alias("_gone"))


def _kept(raw: bytes, gone, window: int) -> tuple[int, int, str | None]:
    words = raw.split()
    if gone is None or not len(gone):
        return len(words), 0, None
    at = gone.field("at").to_numpy(zero_copy_only=False)
    n = gone.field("n").to_numpy(zero_copy_only=False)
    delta = np.zeros(len(words) + 1, np.int64)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + n - 1 + window, -1)
    covered = np.cumsum(delta)[:-1] > 0
    left = [w for w, c in zip(words, covered.tolist()) if not c]
    return len(words), int(covered.sum()), b" ".join(left).decode()


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (a struct of all columns of ``docs``) plus ``n_words``, ``n_removed``
    and ``kept_text``: the words that stay, joined by one space; null if none went."""
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    text = F.col(f"`{text_col}`").cast("string")
    texts = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)).alias("_key"),
        F.col(f"`{id_col}`").cast("long").alias("_id"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("_tag"),
        text.alias("_text"),
        *[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(rest)],
    )
    names = texts.columns
    fields = [*texts.schema.fields, *T._parse_datatype_string("n_words long, n_removed long, kept_text string").fields]

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, raw, gone = (batch.column(k) for k in (names.index("_id"), names.index("_text"), len(names)))
            found = [
                _kept((t.as_py() or "").encode(), g.values if g.is_valid and i.is_valid else None, window)
                for i, t, g in zip(own, raw, gone)
            ]
            words, removed, kept = zip(*found) if found else ((), (), ())
            new = [pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], *new], [*names, "n_words", "n_removed", "kept_text"]
            )

    joined = _with(texts, removed_starts(texts, window), "left")
    done = joined.mapInArrow(keep, T.StructType(fields))
    back = {id_col: "_id", text_col: "_text"} | {c: f"_c{k}" for k, c in enumerate(rest)}
    row = F.struct(*[F.col(back[c]).alias(c) for c in docs.columns])
    return done.select(row.alias("row"), "n_words", "n_removed", "kept_text")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.regexp_replace(F.coalesce("row.text", F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    whole = F.trim(words)  # the text's words joined by one space
    return remove_repeats(docs).select(
        "row.doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept_text", whole), 256).alias("kept_sha256")
    )


SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
windows AS (
  SELECT doc_id, i, word,
    CASE WHEN count(*) OVER w = 50 THEN string_agg(word, ' ') OVER w END AS text50
  FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
judged AS (
  SELECT doc_id, i, word, text50 IS NOT NULL AND min(doc_id) OVER (PARTITION BY text50) < doc_id AS gone FROM windows),
covered AS (
  SELECT doc_id, i, word,
    max(CAST(gone AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 1 AS gone
  FROM judged),
kept AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
  FROM covered GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
