"""Top-k search, prefix trie and lexical search against brute force, with small groups and odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from scripts.oracle_check import digest
from tests.conftest import SF_SMALL
from vigil.llm import pivots, queries, ranking, trie

NEW = ("op11_topk_search", "op12_prefix_trie", "op13_lexical_search")


@pytest.mark.parametrize("name", NEW)
def test_queries_match_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("embeddings", "conversations", "benchmark", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    found = queries.QUERIES[name](spark, SF_SMALL)
    cur = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    expected = cur.fetchall()
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(expected) > 0
    assert digest(found.columns, rows) == digest(names, expected)


# top-k ------------------------------------------------------------------------------


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_top(rows, k, every):
    rows = {(i, tuple(min(max(math.floor(64 * x), -(1 << 63)), (1 << 63) - 1) for x in v)) for i, v in rows if whole(v)}
    out = []
    for i, q in rows:
        if i is None or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for j, v in rows if j is None or j != i)
        out += [(i, r + 1, None if nil else j, -s) for r, (s, nil, j) in enumerate(scored[:k])]
    return sorted(out, key=str)


def top(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 9, 9, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, rank int, bundle string")
    return sorted([tuple(r) for r in pivots.top_products(df.repartition(3), **options).collect()], key=str)


def test_top_products_equal_brute_force_with_copies_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 4)) * rng.choice([0.1, 1, 5], size=(60, 1))
    rows = [(i, base[i % 60].tolist()) for i in range(90)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(100, 140)]  # one vector, many ids
    rows += [(7, base[7].tolist()), (8, base[9].tolist()), (None, base[1].tolist()), (None, [0.5] * 4)]
    rows += [(200, None), (204, [1.0, None, 0.0, 0.0]), (208, [float("nan")] * 4), (212, [float("inf")] * 4), (216, []), (220, [1.0]), (224, [0.0] * 4)]
    for options in ({"annulus": 4, "bundle": 3, "pivots": 5}, {"annulus": 64, "bundle": 64, "pivots": 1}):
        assert top(spark, rows, k=5, every=4, **options) == brute_top(rows, 5, 4)


def test_top_products_with_few_rows_and_none(spark):
    assert top(spark, [], k=3) == []
    assert top(spark, [(0, None)], k=3) == []
    assert top(spark, [(0, [1.0])], k=3) == []
    assert top(spark, [(0, [1.0]), (1, [-2.0])], k=3) == [(0, 1, 1, -128 * 64)]


def test_scores_beyond_doubles_are_exact():
    q = np.array([[(1 << 31) + 1, 3]], np.int64)
    x = np.array([[(1 << 31) + 7, -5], [-(1 << 62), 1 << 62]], np.int64)
    assert pivots._products(q, x).tolist()[0][0] == ((1 << 31) + 1) * ((1 << 31) + 7) - 15
    assert pivots._products(q, x).tolist()[0][1] == -((1 << 63) - 1)  # held at the limit


def test_annuli_far_from_every_query_are_not_met(spark):
    """Two far clusters, with queries in one: the other cluster's annuli are left out."""
    rng = np.random.default_rng(5)
    near = rng.normal(size=(400, 3)) * 0.05 + [4, 0, 0]
    far = rng.normal(size=(400, 3)) * 0.05 + [-4, 0, 0]
    rows = [(2 * i, v.tolist()) for i, v in enumerate(near)] + [(2 * i + 1, v.tolist()) for i, v in enumerate(far)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    search = pivots.Search(df, k=5, every=20, annulus=16, pivots=4)
    assert search.top().count() == 5 * 40
    met = search.met.join(search.annuli, "annulus").select("annulus").distinct().count()
    assert met <= 0.6 * search.annuli.count()


# trie -------------------------------------------------------------------------------

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), tie, (role, text)))
    own = {c: [t for *_, t in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for p, cs in nodes.items():
        under = [q for q in nodes if q[: len(p)] == p]
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in under) for q in under)
        saved = sum((len(nodes[q]) - 1) * (len(WORDS.findall(q[-1][1])) if q else 0) for q in under)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(seqs[c]) == len(p)))
        out.append((
            min(cs), len(p), min(nodes[p[:-1]]) if p else None, len(cs),
            sum(len(q) == len(p) + 1 for q in under), leaves, saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found_trie(spark, given, **options):
    df = spark.createDataFrame([(*r, 1, "y") for r in given], "conv_id long, turn long, role string, text string, depth int, keys string")
    found = trie.trie_nodes(df.repartition(3), **options)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted([tuple(r) for r in found.collect()], key=str)


@pytest.mark.parametrize("rows,turns", [(1, 100), (3, 4), (8192, 1 << 18)])
def test_trie_equals_brute_force_at_any_block_size(spark, rows, turns):
    rng = np.random.default_rng(11)
    table = []
    for c in range(0, 90):
        if c in (20, 41):
            continue  # one base is absent
        for turn in range(int(rng.integers(1, 6))):
            table.append((c, turn, "user" if turn % 2 == 0 else "assistant", f"{turn} w{rng.integers(0, 2)}  x"))
    table += [(c, t, "user", "same") for c in range(100, 125) for t in range(3)]  # copies
    table += [(130, None, None, None), (130, None, None, None), (130, 1, "a", "b\tc"), (130, 1, "a", "b\tc"), (130, 1, "a", "d")]
    table += [(None, 0, "user", "lost"), (-7, 0, "user", "negative"), (-140, 0, "user", "base"), (-140, 1, "user", "base")]
    table += [(160, 0, "user", "word " * 5000)]
    assert found_trie(spark, table, rows=rows, turns=turns, max_broadcast_bytes=0 if rows == 3 else 1 << 20) == brute_trie(table)


def test_trie_of_turnless_conversations_and_of_nothing(spark):
    assert found_trie(spark, []) == []
    assert found_trie(spark, [(None, 0, "a", "b")]) == []
    odd = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][:3]
    table = [(c, 0, "user", "gone") for c in odd]  # their base is absent, their own turns are cut off
    assert found_trie(spark, table) == brute_trie(table)
    assert found_trie(spark, table)[0][1:7] == (0, None, 3, 0, 1, 0)


def test_extents_by_binary_search():
    lcp = np.array([-1, 2, 0, 3, 3, 1, 0])
    levels = trie.sparse_minima(lcp)
    row, depth = np.array([0, 3, 4, 5, 6, 2]), np.array([2, 3, 1, 2, 0, 9])
    left, right = trie.extents(levels, row, depth)
    assert left.tolist() == [0, 2, 2, 5, 0, 2] and right.tolist() == [1, 4, 5, 5, 6, 2]


# lexical ----------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_ranking(items, docs, k):
    counted = [(i, Counter(TERM.findall(lowered(t)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in counted:
            n, score = sum(c.values()), 0
            m = 25 + (75 * n * n_docs) // n_terms
            for t in TERM.findall(lowered(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if nil else i, -s) for r, (s, nil, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def ranked(spark, items, docs, **options):
    a = spark.createDataFrame([(*r, "z") for r in items], "item_id long, text string, term string")
    b = spark.createDataFrame([(*r, 1, "z") for r in docs], "doc_id long, text string, score int, slice string")
    return sorted([tuple(r) for r in ranking.rank_documents(a, b.repartition(3), **options).collect()], key=str)


def test_ranking_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    words = ["the", "The", "É", "é", "naïve", "x1", "Ünder", "a_b", "中文", "z" * 300, "q", "r", "s"]
    texts = [" ".join(rng.choice(words, int(rng.integers(1, 30)))) for _ in range(80)]
    docs = list(enumerate(texts)) + [(200 + i, "the the q") for i in range(20)]  # equal scores
    docs += [(300, None), (301, ""), (302, " .,-"), (None, "q r s"), (None, "q r s"), (5, "repeated id q"), (5, "repeated id q"), (400, "q " * 20000)]
    items = [(0, "the q"), (1, "É naïve É naïve THE"), (2, None), (3, ""), (4, "absent"), (5, "s"), (5, "r"), (5, "r"), (None, "中文"), (6, "z" * 300)]
    expected = brute_ranking(items, docs, 4)
    assert {r[0] for r in expected} == {0, 1, 5, None, 6}
    for options in ({"owners": 3, "per_bundle": 2, "per_slice": 7, "max_broadcast_bytes": 0}, {"owners": 1, "slice_bytes": 50}, {}):
        assert ranked(spark, items, docs, k=4, **options) == expected


def test_ranking_of_nothing(spark):
    assert ranked(spark, [], [(1, "a")]) == []
    assert ranked(spark, [(1, "a")], []) == []
    assert ranked(spark, [(1, "a")], [(1, None), (2, "..")]) == []
