"""Plain re-statements of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def simhash(text, n=4):
    w = WORD.findall(lower(text))
    shingles = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, links):
    """The smallest node reachable from each."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_bits(fps, most=4):
    """(i, j) of fingerprints at most ``most`` bits apart."""
    a = np.array(fps, np.uint64)
    return [(i, j) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a[:i] ^ a[i]) <= most).tolist()]


def substring(docs, window=50):
    """doc_id -> (n_words, n_removed, kept text) for distinct ids."""
    words = {i: WORD.findall(t or "") for i, t in docs}
    first = {}
    for i in sorted(k for k in words if k is not None):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def vectors(rows, threshold=0.98):
    """vec_id -> (n_links, component_id, kept) for distinct ids of (id, vector, label)."""
    good = {}
    for i, v, label in rows:
        if label is None or v is None or any(x is None for x in v):
            continue
        a = np.array(v, float)
        if np.isfinite(a).all() and (a != 0).any():
            good[i] = (label, a / np.linalg.norm(a))
    ids = sorted(good)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[:k]
        if good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= threshold
    ]
    n = {i: 0 for i, _, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    root = components(n, links)
    return {i: (n[i], root[i], root[i] == i) for i in n}


def edits(docs):
    """doc_id -> (n_chars, edited text, text, next text), in the order of descending ids."""
    rows = sorted(docs, key=lambda d: -d[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        text, other = t or "", rows[(k + 1) % len(rows)][1] or ""
        third = len(text) // 3
        out[i] = (len(text), text[: len(text) - third] + other[:third], text, other)
    return out


def turns(rows):
    """conv_id -> (n_turns, turns_sha256, loss_chars, loss_sha256) of (conv, turn, role, text)."""
    convs = {}
    for r in sorted(rows, key=lambda r: r[:2]):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for c, said in convs.items():
        learned = "".join(t for role, t in said if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in said)
        out[c] = (len(said), sha(whole), len(learned), sha(learned))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
