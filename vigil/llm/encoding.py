"""Byte-level BPE ids of whole texts.

Where a vocabulary's ids rise in the order of its merges (checked when it is
loaded), merging by rank gives the ids that ``tokenizers`` gives.  Texts of
Latin characters without ``<|`` are then merged by ``tiktoken`` from the same
vocabulary file, about four times as fast; all others go to ``tokenizers``.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

#: Characters whose classes all Unicode versions agree on.
_LATIN = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ]*")
#: The byte-level pre-tokenizer's pattern (fixed value of this kind of vocabulary).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """The byte that each printable stand-in of a byte-level vocabulary means."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _by_rank(path: str):
    """A rank-merging twin of the vocabulary, or None where ranks do not decide its merges."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, merges = model["vocab"], model["merges"]
    pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
    ranks = [vocab.get("".join(p), -1) for p in pairs]
    if any(b <= a for a, b in zip(ranks, ranks[1:])) or model.get("end_of_word_suffix"):
        return None
    byte = _byte_of_char()
    merged = set(ranks)
    known = {bytes(byte[c] for c in t): i for t, i in vocab.items() if len(t) == 1 or i in merged}
    return tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=known, special_tokens={})


class TextEncoder:
    """``encode(text)`` gives the ids that ``tokenizers`` gives, without special tokens added."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._twin = _by_rank(path)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if self._twin is not None and "<|" not in text and _LATIN.fullmatch(text):
            return self._twin.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=4)
def encoder(path: str) -> TextEncoder:
    """The worker's encoder for this vocabulary; tasks of one worker share it."""
    return TextEncoder(path)


@lru_cache(maxsize=4)
def byte_table(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary (none for special tokens)."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte = _byte_of_char()
    found = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        if all(c in byte for c in token):
            found[i] = bytes(byte[c] for c in token)
    return found


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
