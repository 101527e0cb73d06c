"""Language identification with hyperdimensional profiles.

Every letter has a random vector of -1 and 1, drawn from its code point.  A
trigram is the product of its letters' vectors, each rotated by its place
(binding); a text is the sum of its trigrams' vectors (bundling); a language's
prototype is the sum of its documents' vectors, each scaled to length one.  A
document's language is that of the prototype with the largest cosine.

Texts are lower-cased; runs of other characters than letters become one blank,
also before and after the text.  A trigram of a batch is bound once, and the
batch's documents are bundled from their trigram counts.

Training: each task returns one partial sum per language (``DIMENSIONS``
numbers), Spark adds them by language and dimension, and only the prototypes -
languages x dimensions numbers, whatever the number of documents - reach the
driver.

Defined cases: a text that is null or has no letter is ``und`` with score 0; a
null language is not learned; with nothing learned every text is ``und``; null
ids are held out or not by the text ``null``'s absence, that is, held out is
false; repeated rows count each; an empty table gives an empty result; extra
columns are kept by ``predict``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.spark import free_name, table

DIMENSIONS = 1024
SEED = 20240501
UNKNOWN = "und"
#: Characters whose trigrams are counted together.
_CHARS = 600_000
#: Entries of a table of counts (texts x trigrams), and trigrams whose vectors are held at a time.
_COUNTS, _TRIGRAMS = 1 << 23, 1 << 14
_BLANK = 0x20


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1)
def _in_word() -> np.ndarray:
    """Letters, and the marks that belong to them (many scripts write vowels as marks)."""
    return _is_letter() | np.fromiter((unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=200_000)
def _letter(code: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng((SEED, code)).integers(0, 2, dimensions, np.int8) * np.int8(2) - np.int8(1)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-case letters, with one blank for each run of others; empty if there is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if not _is_letter()[codes].any():
        return np.zeros(0, np.uint32)
    codes = np.r_[_BLANK, np.where(_in_word()[codes], codes, _BLANK), _BLANK].astype(np.uint32)
    blank = codes == _BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # of a run of blanks, the first stays
    keep[0] = True
    return codes[keep & ~np.r_[False, blank[1:] & blank[:-1]]]


def trigram_counts(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray | None]:
    """Distinct trigrams (n x 3 code points) of some letter sequences, and the counts (sequences x n),
    or None if these would be more than ``_COUNTS`` for several sequences."""
    alphabet, coded = np.unique(np.concatenate(parts), return_inverse=True)
    k = len(alphabet)
    ends = np.cumsum([len(p) for p in parts])
    a, b, c = (coded[i : len(coded) - 2 + i].astype(np.int64) for i in range(3))
    codes = (a * k + b) * k + c
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    inside = doc[:-2] == doc[2:]
    codes, doc = codes[inside], doc[:-2][inside]
    if k**3 <= 4_000_000:  # number the trigrams by a table of all there could be
        there = np.zeros(k**3, bool)
        there[codes] = True
        known = np.flatnonzero(there)
        number = np.zeros(k**3, np.int64)
        number[known] = np.arange(len(known))
        at = number[codes]
    else:
        known, at = np.unique(codes, return_inverse=True)
    triples = np.stack([known // (k * k), known // k % k, known % k], axis=1)
    if len(parts) > 1 and len(parts) * len(known) > _COUNTS:
        return alphabet[triples], None
    counts = np.bincount(doc * len(known) + at, minlength=len(parts) * len(known)).reshape(len(parts), -1)
    return alphabet[triples], counts.astype(np.float32)


def bound(triples: np.ndarray, dimensions: int) -> np.ndarray:
    """One vector per trigram: its letters' vectors, rotated by 2, 1 and 0 places, multiplied."""
    alphabet, at = np.unique(triples, return_inverse=True)
    base = np.stack([_letter(int(c), dimensions) for c in alphabet])
    at = at.reshape(triples.shape)
    out = np.roll(base, 2, axis=1)[at[:, 0]]
    out *= np.roll(base, 1, axis=1)[at[:, 1]]
    out *= base[at[:, 2]]
    return out.astype(np.float32)


def bundles(texts: list[str | None], dimensions: int) -> Iterator[tuple[list[int], np.ndarray]]:
    """Positions of the texts that have letters and their vectors, some at a time.

    A text longer than a group is cut into parts that overlap by two letters, so
    that no trigram is lost, and its parts' vectors are added.
    """
    group: list[tuple[int, np.ndarray]] = []
    size = 0

    def vectors(group):
        triples, counts = trigram_counts([p for _, p in group])
        if counts is None:  # texts with few trigrams in common: a table of their counts would be mostly empty
            half = len(group) // 2
            return np.concatenate([vectors(group[:half]), vectors(group[half:])])
        out = np.zeros((len(group), dimensions), np.float32)
        for k in range(0, len(triples), _TRIGRAMS):  # sums of whole numbers: exact in any order
            out += counts[:, k : k + _TRIGRAMS] @ bound(triples[k : k + _TRIGRAMS], dimensions)
        return out

    for k, text in enumerate(texts):
        seq = letters(text) if text else np.zeros(0, np.uint32)
        if not len(seq):
            continue
        if len(seq) > _CHARS:
            whole = np.zeros(dimensions, np.float64)
            for i in range(0, len(seq) - 2, _CHARS):
                whole += vectors([(k, seq[i : i + _CHARS + 2])])[0]
            yield [k], whole[None]
            continue
        if group and size + len(seq) > _CHARS:
            yield [i for i, _ in group], vectors(group)
            group, size = [], 0
        group.append((k, seq))
        size += len(seq)
    if group:
        yield [i for i, _ in group], vectors(group)


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=-1, keepdims=True)
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


def prototypes(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """A unit vector per language of ``labelled``."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for at, vectors in bundles(batch.column(0).to_pylist(), dimensions):
                for k, v in zip(at, _unit(vectors)):
                    sums.setdefault(langs[k], np.zeros(dimensions))[:] += v
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions)), pa.array(total)], ["lang", "d", "v"]
            )

    rows = (
        labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(text_col).cast("string"), F.col(lang_col).cast("string"))
        .mapInArrow(partial, "lang string, d long, v double")
        .groupBy("lang", "d")
        .agg(F.sum("v").alias("v"))
        .collect()  # languages x dimensions
    )
    found: dict[str, np.ndarray] = {}
    for r in rows:
        found.setdefault(r["lang"], np.zeros(dimensions))[r["d"]] = r["v"]
    return {lang: _unit(v) for lang, v in sorted(found.items())}


def predict(docs: DataFrame, learned: dict[str, np.ndarray], text_col: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score`` (the cosine, 0 at least)."""
    names = list(learned)
    matrix = np.stack([learned[n] for n in names]).T if names else np.zeros((dimensions, 0))
    given = docs.columns
    at = given.index(text_col)
    out = [free_name(docs, "lang_pred"), free_name(docs, "score")]
    schema = T.StructType([*docs.schema.fields, T.StructField(out[0], T.StringType()), T.StructField(out[1], T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if names:
                for where, vectors in bundles(batch.column(at).to_pylist(), dimensions):
                    cosines = _unit(vectors.astype(np.float64)) @ matrix
                    best = cosines.argmax(axis=1)
                    for k, b, c in zip(where, best, cosines.max(axis=1)):
                        lang[k], score[k] = names[b], min(1.0, max(0.0, c))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang), pa.array(score)], [*given, *out])

    return docs.mapInArrow(run, schema)


def recognised(lang: Column, score: Column, text: Column, dimensions: int = DIMENSIONS) -> Column:
    """False for texts without a language: ``und``, or a cosine that even with its own spread
    stays below what unrelated vectors reach.

    Unrelated vectors reach three spreads of 1/sqrt(dimensions).  The cosine of a text of n
    letters varies by up to 1/sqrt(n), so the bound falls smoothly as texts get shorter, at
    every length by the same rule.
    """
    n = F.greatest(F.lit(1), F.char_length(F.regexp_replace(text, F.lit(r"[^\p{L}]+"), F.lit(""))))
    return (lang != UNKNOWN) & (score + F.lit(1.0) / F.sqrt(n) >= F.lit(3 / dimensions**0.5))


def held_out(id_col):
    """True for documents that are not learned from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = prototypes(docs.where(~held_out(F.col("doc_id"))))
    found = predict(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
