"""Exact token counts at every prefix, for a BPE vocabulary with word ends.

``PrefixCounter`` holds, for each word it has met, the count of tokens of every
prefix of that word, found by dynamic programming over token ends:

    count(i) = count(i - |t|) + 1

where ``t`` is the only token ending at ``i`` that merging by rank allows after
the last token of the prefix before it.  (A row of tokens is what merging
gives exactly when each two neighbours, merged alone, stay as they are.)  Two
tables are kept: prefixes that a word goes on after, and prefixes at which it
ends, whose last token carries the word end.  Truncation and budget questions
read the tables; no text is encoded again for them.

White space is dropped by this kind of vocabulary, so a text's count is the sum
over its pieces between ASCII white space.  Whole pieces with characters outside
Latin, or with ``<|``, are counted by ``tokenizers`` itself; the prefixes of the former come from
the same tables of bytes, held against that count.

Defined cases: a null or empty text has 0 bytes and 0 tokens; null ids stay;
repeated rows are counted once each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.encoding import _byte_of_char, vocabulary_path
from vigil.llm.spark import table

LIMIT = 2048
_LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
#: Pieces whose lower case, letters and digits need no Unicode tables.
_SIMPLE = re.compile(f"[\x21-\x7e{_LETTER}]+")
#: The vocabulary's pre-tokenizer over such pieces (fixed value).
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\\s0-9{_LETTER}]+")
#: The same over all pieces (fixed value).
_ANY_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_END = "</w>"
#: Longer words (characters) and pieces (bytes) are not kept: they hardly come again.
_WORD_KEPT, _PIECE_KEPT = 64, 256


class PrefixCounter:
    """Counts for one vocabulary file.  Tables of at most ``max_words`` words
    of bounded length are kept; a dropped one is made again."""

    def __init__(self, path: str, max_words: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if model["end_of_word_suffix"] != _END:
            raise ValueError(f"{path} has no word ends")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self._rank = {p: k for k, p in enumerate(pairs)}
        self._of_byte = {b: c for c, b in _byte_of_char().items()}
        tokens = set(self._of_byte.values()) | {"".join(p) for p in pairs if not p[1].endswith(_END)}
        ends = set(self._of_byte.values()) | {"".join(p).removesuffix(_END) for p in pairs if p[1].endswith(_END)}
        # only tokens that merging their own characters gives can occur
        self._mid = {t for t in tokens if len(self._merge([*t])[0]) == 1}
        self._end = {t: t + _END for t in ends if len(self._merge([*t[:-1], t[-1] + _END])[0]) == 1}
        self._longest = max(map(len, [*self._mid, *self._end]))
        self._edges: tuple[dict, dict] = ({}, {})
        self._max = max_words
        self._pairs: dict[tuple[str, str], bool] = {}
        self._words: dict[str, bytes | array] = {}
        self._pieces: dict[bytes, int] = {}

    def _merge(self, parts: list[str]) -> tuple[list[str], tuple[str, str] | None]:
        """Merge neighbours by rank until none can be merged; also the last pair merged."""
        rank, last = self._rank, None
        while len(parts) > 1:
            best, at = min((rank.get(p, len(rank)), i) for i, p in enumerate(zip(parts, parts[1:])))
            if best == len(rank):
                break
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """What stands at one end of ``token`` while it is merged from its
        characters (side 0: left, 1: right), each with the rank that absorbs it."""
        if (known := self._edges[side].get(token)) is not None:
            return known
        plain = token.removesuffix(_END)
        symbols = [*plain] if plain is token else [*plain[:-1], plain[-1] + _END]
        last = self._merge(symbols)[1]
        edge = [(token, len(self._rank))]
        if last is not None:
            inner = self._edge(last[side], side)
            edge += [(inner[0][0], self._rank[last])] + inner[1:]
        self._edges[side][token] = edge
        return edge

    def _stay(self, a: str, b: str) -> bool:
        """Whether tokens ``a`` and ``b`` remain two when merged together.

        Ranks only rise while a text is merged, so they do unless, at some
        rank, what stands left and right of the border merges before either is
        absorbed on its own side (of equal ranks the left one comes first).
        """
        key = (a, b)
        if (known := self._pairs.get(key)) is None:
            if len(self._pairs) > self._max:
                self._pairs.clear()
            rank, known = self._rank, True
            right = self._edge(b, 0)
            for left, gone in self._edge(a, 1):
                for other, taken in right:
                    if (q := rank.get((left, other))) is not None and q < gone and q <= taken:
                        known = False
            self._pairs[key] = known
        return known

    def word(self, word: str) -> bytes | array:
        """Token counts of the prefixes of 0, 1, ... characters of a lower-case word, each as a word of its own."""
        if (known := self._words.get(word)) is not None:
            return known
        if len(self._words) > self._max:
            self._words.clear()
        symbols = word.encode()
        s = "".join(map(self._of_byte.__getitem__, symbols))
        counts, lasts, stops = [0], [""], [0]
        mid, end, stay, longest = self._mid, self._end, self._stay, self._longest
        for i in range(1, len(s) + 1):
            count = stop = 0
            for j in range(i - longest if i > longest else 0, i):
                token = s[j:i]
                if not stop and token in end and (j == 0 or stay(lasts[j], end[token])):
                    stop = counts[j] + 1
                    if count:
                        break
                if not count and token in mid and (j == 0 or stay(lasts[j], token)):
                    count, last = counts[j] + 1, token
                    if stop:
                        break
            counts.append(count)
            lasts.append(last)
            stops.append(stop)
        if len(symbols) > len(word):  # a character ends before each byte that begins one
            stops = [stops[i] for i, b in enumerate(symbols) if b & 0xC0 != 0x80] + stops[-1:]
        found = bytes(stops) if stops[-1] < 200 and max(stops) < 256 else array("I", stops)
        if len(word) <= _WORD_KEPT:
            self._words[word] = found
        return found

    def piece(self, piece: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, ... characters of a text without white space."""
        simple = _SIMPLE.fullmatch(piece) is not None
        lower = piece.lower() if simple else "".join(c.lower() for c in piece)  # letter by letter, as the vocabulary's rule
        if "<|" not in piece and (simple or (len(lower) == len(piece) and unicodedata.is_normalized("NFC", piece))):
            found = self._by_words(lower, _WORDS if simple else _ANY_WORDS)
            # a letter that another version of Unicode classes differently shows here
            if simple or found[-1] == self._library(piece):
                return found
        return np.array([self._library(piece[:k]) for k in range(len(piece) + 1)], np.int64)

    def _by_words(self, lower: str, words) -> np.ndarray:
        """``piece`` of a normalised, lower-case text, from the tables of its words; what is in no word has no tokens."""
        out, so_far = np.zeros(len(lower) + 1, np.int64), 0
        at = 0
        for m in words.finditer(lower):
            word = m[0]
            own = np.array(list(self.word(word)), np.int64)
            if word in ("'re", "'ve", "'ll"):  # cut inside a contraction: its quote and letter part
                own[2] = self.word("'")[1] + self.word(word[1])[1]
            out[at + 1 : m.start() + 1] = so_far
            out[m.start() + 1 : m.end() + 1] = so_far + own[1:]
            so_far, at = so_far + int(own[-1]), m.end()
        out[at + 1 :] = so_far
        return out

    def _library(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids) if text else 0

    def _whole(self, piece: bytes) -> int:
        text = piece.decode()
        if not _SIMPLE.fullmatch(text) or "<|" in text:
            return self._library(text)
        return sum(self.word(w)[-1] for w in _WORDS.findall(text.lower()))

    def ends(self, raw: bytes) -> tuple[list[bytes], np.ndarray]:
        """Pieces of a text (UTF-8) and the token count up to each one's end."""
        pieces = raw.split()  # ASCII white space
        got = list(map(self._pieces.get, pieces))
        if None in got:
            if len(self._pieces) > self._max:
                self._pieces.clear()
            for k, c in enumerate(got):
                if c is None:
                    if (c := self._pieces.get(pieces[k])) is None:
                        c = self._whole(pieces[k])
                        if len(pieces[k]) <= _PIECE_KEPT:
                            self._pieces[pieces[k]] = c
                    got[k] = c
        return pieces, np.cumsum(np.array(got, np.int64))

    def count(self, raw: bytes) -> int:
        ends = self.ends(raw)[1]
        return int(ends[-1]) if len(ends) else 0

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, ... characters of a text."""
        out, so_far = np.zeros(len(text) + 1, np.int64), 0
        at = 0
        for m in re.finditer(r"[^\x20\x09-\x0d]+", text):
            own = self.piece(m[0])
            out[at + 1 : m.start() + 1] = so_far
            out[m.start() + 1 : m.end() + 1] = so_far + own[1:]
            so_far, at = so_far + int(own[-1]), m.end()
        out[at + 1 :] = so_far
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every whole text."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            raw = batch.column(1).cast(pa.large_binary())
            sizes, tokens = [], []
            for text in raw:
                data = text.as_py() or b""
                sizes.append(len(data))
                tokens.append(c.count(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long"
    )


def prefix_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, prefix_tokens``: the token counts of all prefixes of each text, by characters."""

    def tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            for k in range(batch.num_rows):  # a table is as long as its text: one row at a time
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), pa.array([c.prefixes(batch.column(1)[k].as_py() or "")], pa.list_(pa.int64()))],
                    ["doc_id", "prefix_tokens"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        tables, "doc_id long, prefix_tokens array<bigint>"
    )


def longest_prefix(prefix_tokens, budget: int):
    """Characters of the longest prefix with at most ``budget`` tokens, from a stored table."""
    within = F.transform(prefix_tokens, lambda c, k: F.when(c <= budget, k))
    return F.array_max(within)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
