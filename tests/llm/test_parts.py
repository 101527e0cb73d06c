"""Parts of the operators that need no Spark, as properties."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm import chat, embeddings, packing, shards, sketches, substring
from vigil.llm.encoding import byte_table, encoder, vocabulary_path
from vigil.llm.token_counts import counter

BYTES, WORDS = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("word_bpe_49k.json")
TEXT = st.text(st.sampled_from("ab cdé'ß\n\t.,!12<|>_ABÉ日 \xa0́\x00\x1c"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_ids_are_the_librarys(text):
    enc = encoder(BYTES)
    ids = enc.encode(text)
    assert ids.tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert b"".join(byte_table(BYTES)[i] for i in ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(TEXT, st.sampled_from(["", "don't we'll", "the heater's <|endoftext|> x", "thinthandouhe", "Straße café"]))
def test_prefix_counts_are_the_librarys(text, more):
    c, text = counter(WORDS), text + more
    want = [len(c.tokenizer.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
    assert c.prefixes(text).tolist() == want
    assert c.count(text.encode()) == want[-1]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_places_every_piece(histogram):
    plan = packing.plan_slots(histogram, 64)
    filled = {}
    for length in histogram:
        own = sorted(p for p in plan if p[0] == length)
        assert [p[1] for p in own] == np.cumsum([0, *(p[2] for p in own)])[:-1].tolist()
        assert sum(p[2] for p in own) == histogram[length]
    for length, _, n, each, first, offset in plan:
        for r in range(n):
            filled.setdefault(first + r // each, []).append((offset + r % each * length, length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(k * n for k, n in histogram.items())
    assert len(filled) <= 2 * -(-total // 64)  # no two sequences could be half empty


def test_plan_is_bounded():
    rng = np.random.default_rng(1)
    plan = packing.plan_slots({k: int(n) for k, n in enumerate(rng.integers(1, 10**9, 2048), 1)})
    assert len(plan) <= 3 * 2048 * 12


@pytest.mark.parametrize("domain", [1, 2, 3, 5, 17, 1000, 4097])
def test_permutation(domain):
    there = shards.permute(np.arange(domain), domain)
    assert sorted(there.tolist()) == list(range(domain))
    assert (shards.unpermute(there, domain) == np.arange(domain)).all()
    assert domain < 1000 or (shards.permute(np.arange(domain), domain, 1) != there).any()


@given(st.text(st.sampled_from("<|\\>n\nab"), max_size=20))
def test_escapes(text):
    for there, back in ((chat.escape, chat.unescape), (chat.escape_role, chat.unescape_role)):
        assert back(there(text)) == text
        assert "<|" not in there(text)
    assert "\n" not in chat.escape_role(text)


@given(st.lists(st.text(st.sampled_from("ab "), max_size=30), min_size=1, max_size=5))
def test_sketches_merge(texts):
    parts = [sketches.sketch(t.encode(), 8, 2) for t in texts]
    merged = parts[0]
    for p in parts[1:]:
        merged = sketches.merge(merged, p, 8)
    whole = np.unique(np.concatenate([sketches.sketch(t.encode(), 10**6, 2) for t in texts]))
    assert merged.tolist() == whole[:8].tolist()
    assert sketches.decode(sketches.encode(merged)).tolist() == merged.tolist()


def test_sketch_estimates():
    words = [f"w{i}" for i in range(6000)]
    a, b = (sketches.sketch(" ".join(w).encode(), 256) for w in (words[:4000], words[2000:]))
    assert abs(sketches.resemblance(a, b, 256) - 1 / 3) < 0.1
    assert abs(sketches.containment(a, b, 256) - 1 / 2) < 0.15
    assert abs(sketches.distinct_count(a, 256) / 3996 - 1) < 0.2
    empty = sketches.sketch(b"")
    assert sketches.resemblance(empty, empty) == 1.0 and sketches.resemblance(a, empty, 256) == 0.0


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=10, max_size=40))
def test_rolling_hashes(words):
    r = substring.Rolling(b" ".join(words))
    hashes = r.every(4)
    for i in range(len(hashes)):
        for j in range(i):
            assert (hashes[i] == hashes[j]) == (words[i : i + 4] == words[j : j + 4])
    samples = r.samples(3, 8)
    assert all(((samples >= s) & (samples <= s + 5)).any() for s in range(len(words) - 7))


def test_collisions_are_window_counts():
    rng = np.random.default_rng(3)
    a, b = rng.standard_normal((30, 5)), rng.standard_normal((40, 5))
    want = (np.abs(a[:, None] - b[None]) <= 0.4).sum(axis=2)
    assert (embeddings.collisions(a, b, 0.4) == want).all()


def test_calibrated_recall():
    half, least, width = embeddings.calibrate()
    rng = np.random.default_rng(5)
    u = rng.standard_normal((4000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.standard_normal((4000, 64))
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    v = 0.98 * u + np.sqrt(1 - 0.98**2) * w  # every pair exactly at the threshold
    gap = np.abs((u - v) @ embeddings.directions(64))
    found = ((gap <= half).sum(axis=1) >= least) & (gap[:, 0] <= width)
    assert found.mean() > 0.99
    far = np.abs((u[:-1] - u[1:]) @ embeddings.directions(64)) <= half
    assert (far.sum(axis=1) >= least).mean() < 0.01
