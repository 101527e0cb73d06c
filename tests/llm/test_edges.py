"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from vigil.llm import chat, embeddings, langid, mixing, packing, shards, simhash, sketches, substring, token_counts
from vigil.llm.encoding import vocabulary_path

BYTES, WORDS = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = (
    "row", "tag", "fp", "group", "id", "key", "grp", "cell", "least", "score", "lang_pred", "tokens", "probability", "topic",
    "_id", "_tag", "_text", "_c0", "_gone", "kept_text", "n_words", "n_removed", "place", "shard", "rank", "length", "h", "_n",
)

LONG = " ".join(f"word{i % 997} thing{i % 89}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(70))
PLAIN = "The quick brown fox jumps over the lazy dog and then it sleeps all day long in the sun."


def rows():
    texts = {
        0: f"start here {PASSAGE} and the end of it",
        1: f"another opening {PASSAGE} goes on",
        2: None,
        3: "",
        4: " \t\n ",
        5: PLAIN,
        6: PLAIN,
        7: PLAIN + " Yes.",
        8: LONG,
        9: "x",
        10: PASSAGE,
        11: "El perro duerme en la casa y el gato come en la cocina todos los días.",
        12: "12345 67890 !!! ???",
    }
    lang = {5: "en", 6: "en", 7: "en", 8: "en", 11: "es", 0: "en", 1: None}
    out = [(i, t, lang.get(i), f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in texts.items()]
    out += [out[5], out[5]]  # repeated rows
    out.append((None, PLAIN, "en", "s1", len(PLAIN)))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def clashing(docs):
    for k, name in enumerate(CLASHES):
        docs = docs.selectExpr("*", f"{k} AS `{name}`")
    return docs


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def operators(df):
    return {
        1: lambda: packing.pack_documents(df, BYTES),
        2: lambda: simhash.near_duplicates(df),
        4: lambda: sketches.fingerprint_edits(df),
        6: lambda: mixing.mix_documents(df),
        7: lambda: langid.predict(df, langid.prototypes(df)),
        9: lambda: substring.remove_repeats(df),
        10: lambda: token_counts.token_counts(df, WORDS),
    }


@pytest.mark.parametrize("n", [1, 2, 4, 6, 7, 9, 10])
def test_empty_tables(empty, n):
    assert operators(empty)[n]().collect() == []


@pytest.mark.parametrize("n", [1, 2, 4, 7, 9, 10])
def test_every_row_has_a_result(docs, clashing, n):
    plain = operators(docs)[n]().collect()
    assert n == 1 or len(plain) == len(rows())
    assert len(operators(clashing)[n]().collect()) == len(plain)


def test_packing_of_null_and_long(docs):
    found = packing.pack_documents(docs, BYTES, capacity=256).collect()
    assert sorted(r.length for r in found if r.doc_id in (2, 3)) == [1, 1]
    assert [r.doc_id for r in found if r.piece > 3 and r.length < 256] == []
    assert sum(1 for r in found if r.doc_id == 5) == 3
    places = [(r.sequence_id, r.offset) for r in found]
    assert len(places) == len(set(places))


def test_simhash_groups(docs):
    found = simhash.near_duplicates(docs).collect()
    by = {r.doc_id: r.component_id for r in found}
    assert by[2] == by[3] == by[4] == 2 and by[5] == by[6] == by[None] == 5
    one = simhash.one_per_group(docs).collect()
    assert len(one) == len({r.group for r in found})
    assert sorted(r.doc_id for r in one) == sorted({r.component_id for r in found})


def test_simhash_keeps_one_of_rows_without_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e", None, None, 9)] * 3, SCHEMA)
    assert simhash.one_per_group(df).count() == 1


def test_dense_near_copies(spark):
    """Random fingerprints up to 4 bits apart, through hubs and grid, against all pairs."""
    import numpy as np

    rng = np.random.default_rng(11)
    base = rng.integers(0, 2**63, 40, np.uint64)
    fps = {int(b) for b in base}
    for b in base:
        for bits in rng.integers(0, 7, 12):
            x = int(b)
            for k in rng.choice(64, bits, replace=False):
                x ^= 1 << int(k)
            fps.add(x)
    fps |= {0, 1, 3, 2**64 - 1, 2**63, 2**63 + 2**62}
    fps = sorted(fps)
    signed = [(f - (f >> 63 << 64),) for f in fps]
    df = spark.createDataFrame([(f, f) for (f,) in signed], "id long, grp long")
    found = {tuple(sorted((r.s, r.d))) for r in simhash.grid_links(df).collect()}
    pairs = [(signed[a][0], signed[b][0]) for a, b in brute.near_bits(fps)]
    assert found == {tuple(sorted(p)) for p in pairs}
    near = {tuple(sorted((signed[a][0], signed[b][0]))) for a, b in brute.near_bits(fps, 2)}
    hubs = {tuple(sorted((r.src, r.dst))) for r in simhash.hub_links(df).collect()}
    ids = [f for (f,) in signed]
    assert hubs <= near and brute.components(ids, hubs) == brute.components(ids, near)


def test_components_of_a_path(spark):
    from vigil.llm.components import component_ids

    links = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(305, 300), (304, 300), (305, 301)], "src long, dst long")
    found = {r.id: r.component for r in component_ids(links).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {301: 300, 304: 300, 305: 300}


def test_vectors(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    base = rng.standard_normal((4, 16))
    table = [(i, (base[i % 4] + 0.02 * rng.standard_normal(16)).tolist(), i % 2) for i in range(60)]
    table += [(60 + i, table[0][1], 0) for i in range(5)]  # copies
    nan, inf = float("nan"), float("inf")
    table += [(70, None, 0), (71, [0.0] * 16, 0), (72, [nan] * 16, 0), (73, [inf] + [0.0] * 15, 0), (74, table[0][1], None)]
    table += [(75, [None] + [1.0] * 15, 0), (76, table[0][1][:8], 0), (77, [], 0)]
    df = spark.createDataFrame([(*r, 1, 2) for r in table], "vec_id long, embedding array<float>, label int, node int, links int")
    stored = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in table]
    for tile in (1024, 8):  # one tile, and many that meet
        found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df, tile=tile).collect()}
        assert found == brute.vectors(stored)
    assert embeddings.near_vectors(df.limit(0)).count() == 0
    twice = embeddings.near_vectors(spark.createDataFrame([(1, [1.0, 0.0], 3)] * 2 + [(None, [1.0, 0.0], 3)], "vec_id long, embedding array<float>, label int"))
    assert sorted(map(str, twice.collect())) == sorted(
        ["Row(vec_id=1, n_links=2, component_id=1, kept=True)"] * 2 + ["Row(vec_id=None, n_links=2, component_id=1, kept=False)"]
    )


def test_successors(spark):
    df = spark.createDataFrame([(i, f"text number {i} has words") for i in range(50)] + [(None, "no id"), (None, "none")], "doc_id long, text string")
    for ranges in (1, 3, 64):
        found = sketches.fingerprint_edits(df, ranges=ranges).collect()
        assert len(found) == 52
        by = {r.doc_id: r.edited_sha256 for r in found if r.doc_id is not None}
        want = brute.edits([(i, f"text number {i} has words") for i in range(50)])
        assert all(by[i] == brute.sha(want[i][1]) for i in range(1, 50))
    alone = sketches.fingerprint_edits(df.where("doc_id = 7")).collect()[0]
    assert alone.edited_sha256 == brute.sha("text number 7 hatext nu") and alone.near_next == 1.0
    assert sketches.fingerprint_edits(df.where("doc_id IS NULL")).count() == 2


def test_successors_of_hot_ids(spark):
    """A third of the rows without an id, a third with one id: both are cut, and no successor is lost."""
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"w{k * k} text of row {k}") for k in range(600)]
    rows += [(7, "alike"), (7, "alike"), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ordered = [tuple(r) for r in df.withColumn("h", F.xxhash64("text")).collect()]
    ordered.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]), reverse=True)
    texts = [r[1] or "" for r in ordered]
    want = []
    for (i, _, _), own, after in zip(ordered, texts, [*texts[1:], texts[0]]):
        third = len(own) // 3
        want.append((str(i), len(own), brute.sha(own[: len(own) - third] + after[:third])))
    for ranges in (1, 2, 8, 64):
        found = sketches.fingerprint_edits(df, ranges=ranges).collect()
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in found) == sorted(want)
    dealt = sketches.next_in_order(df, ranges=12).groupBy("target").agg(F.count_if(F.col("extra") == 0).alias("n"), F.sum("extra").alias("x")).collect()
    assert max(r.n for r in dealt) < 2 * len(rows) / 12 + 40 and max(r.x for r in dealt) <= 2
    one = sketches.next_in_order(df.where("doc_id IS NULL AND text <> ''"), ranges=8).where("extra = 0").groupBy("target").count()
    assert one.count() == 8


def test_sketches_of_groups(docs):
    import numpy as np

    found = {}
    for r in sketches.sketch_hashes(docs.where("doc_id < 11"), "source", k=16).collect():
        found.setdefault(r.source, []).append(int(r.hash))
    for source in ("s0", "s1", "s2", None):
        parts = [sketches.sketch((t or "").encode(), 10**6) for i, t, _, s, _ in rows() if s == source and i is not None and i < 11]
        assert sorted(found.get(source, [])) == np.unique(np.concatenate(parts))[:16].tolist()


def test_turns(spark):
    table = [
        (1, 0, "user", "a <|im_end|> b"), (1, 1, "assistant", None), (1, 2, None, "x"), (1, 2000, "assistant", "late \\ <\\|im_start|>"),
        (2, 0, "assistant", "<|endoftext|>"), (2, 1, "odd\nrole\\n", "y\n\n"), (3, 0, "assistant", "w " * 5000), (-7, 5, "user", ""),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in table], "conv_id long, turn long, role string, text string, ids int, start int")
    found = chat.read_back(chat.format_conversations(df, BYTES, block=2), BYTES).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == brute.turns(table)
    assert chat.read_back(chat.format_conversations(df.limit(0), BYTES), BYTES).count() == 0
    ties = spark.createDataFrame([(None, None, "user", "b"), (None, 0, "user", "c"), (None, 0, "user", "c")], "conv_id long, turn long, role string, text string")
    r = chat.read_back(chat.format_conversations(ties, BYTES), BYTES).collect()
    assert [(x.conv_id, x.n_turns, x.turns_sha256) for x in r] == [(None, 3, brute.sha("user\nb\nuser\nc\nuser\nc\n"))]


def test_mixing(docs, clashing):
    found = mixing.mix_documents(docs, keep=1.0).collect()
    assert len(found) == len(rows()) and all(r.probability == 1 for r in found)
    assert mixing.mix_documents(clashing, keep=0.6).select("row.*").columns == clashing.columns


def test_mixing_meets_targets(spark):
    from pyspark.sql import functions as F

    table = [(i, "w " * (1 + i % 7), "ab"[i % 3 == 0], "xyz"[i % 5 % 3]) for i in range(30_000)]
    df = spark.createDataFrame(table, "doc_id long, text string, source string, lang string")
    aim = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.2, "y": 0.3, "z": 0.5}}
    targets = {d: spark.createDataFrame(list(v.items()), f"{d} string, target double") for d, v in aim.items()}
    kept = mixing.mix(
        df, {"source": F.col("source"), "lang": F.col("lang"), "topic": F.lit("all")}, mixing.words(F.col("text")), F.col("doc_id"), F.col("text"),
        targets, keep=0.2,
    ).collect()
    total = sum(r.tokens for r in kept)
    for d, shares in aim.items():
        for value, share in shares.items():
            assert abs(sum(r.tokens for r in kept if r[d] == value) / total - share) < 0.02
    assert abs(total / sum(1 + i % 7 for i in range(30_000)) - 0.2) < 0.02


def test_mixing_meets_targets_where_cells_run_out(spark):
    from pyspark.sql import functions as F

    # a third of all words in one cell; scarce cells; a value with target zero, and one without any target
    table = [(i, "w " * (1 + i % 5), "a" if i % 3 else "b", "xyz"[min(2, i % 40)], "t" if i % 50 else "u") for i in range(4000)]
    table += [(5000 + i, "w", "zero", "z", "t") for i in range(50)] + [(6000 + i, "w", "none", "z", "t") for i in range(50)]
    df = spark.createDataFrame(table, "doc_id long, text string, source string, lang string, topic string")
    aim = {"source": {"a": 0.4, "b": 0.6, "zero": 0.0}, "lang": {"x": 0.05, "y": 0.05, "z": 0.9}, "topic": {"t": 0.9, "u": 0.1}}
    targets = {d: spark.createDataFrame(list(v.items()), f"{d} string, target double") for d, v in aim.items()}
    rows_ = df.select("source", "lang", "topic", mixing.words(F.col("text")).alias("tokens"))
    total = rows_.agg(F.sum("tokens")).head()[0]
    have = {d: {r[0]: r[1] for r in rows_.groupBy(d).agg(F.sum("tokens")).collect()} for d in aim}
    for cells in (mixing.CELLS, 0):  # both plans
        keep, mixing.CELLS = mixing.CELLS, cells
        try:
            raked, _ = mixing.raked_cells(rows_, list(aim), targets, keep=0.4, tolerance=1e-6)
            found = {(r.dimension, r.value): (r.aim, r.expected) for r in mixing.marginals(raked, list(aim)).collect()}
            chances = [r[0] for r in raked.select(mixing.probability(list(aim))).collect()]
        finally:
            mixing.CELLS = keep
        assert all(0 <= p <= 1 for p in chances) and any(p == 1 for p in chances)
        for (d, value), (aimed, expected) in found.items():
            assert abs(expected - aimed) / (0.4 * total) < 0.001
            assert aimed <= have[d][value] + 1e-6
        assert found["source", "zero"] == found["source", "none"] == (0.0, 0.0)
        assert abs(sum(a for (d, _), (a, _) in found.items() if d == "topic") - 0.4 * total) < 1e-6 * total
        assert found["topic", "u"][0] == have["topic"]["u"]  # it has less than its part and gives all


def test_language_vectors_by_definition():
    import unicodedata
    from collections import Counter

    import numpy as np

    def vector(text, size):
        marks = "".join(c if c.isalpha() or unicodedata.category(c)[0] == "M" else " " for c in text.lower())
        seq = " " + " ".join(marks.split()) + " "
        out = np.zeros(size)
        for (a, b, c), n in Counter(zip(seq, seq[1:], seq[2:])).items():
            la, lb, lc = (langid._letter(ord(x), size).astype(int) for x in (a, b, c))
            out += n * np.roll(la, 2) * np.roll(lb, 1) * lc
        return out

    rng = np.random.default_rng(4)
    texts = ["The cat, the hat!", "कि हिन्दी में", "a", "สวัสดี ครับ", "x" * 50] + ["".join(map(chr, rng.integers(0x4E00, 0x9FA5, 60))) for _ in range(40)]
    counts, trigrams = langid._COUNTS, langid._TRIGRAMS
    for langid._COUNTS, langid._TRIGRAMS in ((counts, trigrams), (500, 7)):
        found = {k: v for at, vectors in langid.bundles(texts, 32) for k, v in zip(at, vectors)}
        assert all(np.array_equal(found[k], vector(t, 32)) for k, t in enumerate(texts))
    langid._COUNTS, langid._TRIGRAMS = counts, trigrams


def test_many_short_texts_in_a_large_alphabet_stay_small():
    import resource

    import numpy as np

    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9FA5, 60))) for _ in range(4000)]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert sum(len(at) for at, _ in langid.bundles(texts, 256)) == 4000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20  # 1 GB


def test_recognised_follows_one_rule_at_every_length(spark):
    from pyspark.sql import functions as F

    table = [("en", 0.0, "a" * n) for n in (1, 100, 150, 200, 10_000)] + [("en", 0.09, "a" * 10_000), ("und", 1.0, "a"), ("en", 0.2, "a" * 10_000)]
    df = spark.createDataFrame(table, "lang string, score double, text string")
    found = [r[0] for r in df.select(langid.recognised(F.col("lang"), F.col("score"), F.col("text"))).collect()]
    assert found == [True, True, False, False, False, True, False, True]


def test_languages(docs):
    found = {r.doc_id: r for r in langid.predict(docs, langid.prototypes(docs)).collect()}
    assert [found[i].lang_pred for i in (2, 3, 4, 12)] == ["und"] * 4 and found[2].score == 0
    assert found[11].lang_pred == "es" and found[6].lang_pred == "en"
    assert {r.lang_pred for r in langid.predict(docs, {}).collect()} == {"und"}


def test_long_texts_are_bundled_whole():
    import numpy as np

    (_, once), = langid.bundles([LONG], 64)
    keep, langid._CHARS = langid._CHARS, 10_000
    try:
        (_, parts), = langid.bundles([LONG], 64)
    finally:
        langid._CHARS = keep
    assert np.allclose(once, parts)


def test_shards(spark, docs, clashing, empty, tmp_dir):
    import numpy as np

    layout = shards.layout_for(docs, BYTES, seq_len=64, shard_bytes=8000)
    assert layout.shards > 3
    for k, df in enumerate((docs, clashing)):
        shards.write_shards(df, BYTES, f"{tmp_dir}/{k}", layout)
    found = sorted(shards.read_shards(spark, f"{tmp_dir}/0", layout).collect(), key=lambda r: r.slot)
    assert [r.slot for r in found] == list(range(len(found)))
    assert sorted({r.doc_id for r in found}, key=str) == sorted({r[0] for r in rows()}, key=str)
    own = [layout.lowest if r.doc_id is None else r.doc_id for r in found]
    address = [(o - layout.lowest) * layout.pieces + r.piece for o, r in zip(own, found)]
    place = shards.permute(np.array(address), layout.domain, layout.key)
    assert (np.diff(place) >= 0).all() and [r.shard for r in found] == layout.shard_of(place).tolist()
    later = shards.read_shards(spark, f"{tmp_dir}/1", layout, from_slot=100).collect()
    assert sorted((r.slot, r.doc_id, r.piece, r.ids) for r in later if r.doc_id) == [(r.slot, r.doc_id, r.piece, r.ids) for r in found[100:] if r.doc_id]
    none = shards.layout_for(empty, BYTES)
    shards.write_shards(empty, BYTES, f"{tmp_dir}/none", none)


def test_shards_of_ids_from_all_64_bits(spark, tmp_dir):
    table = [(-(1 << 63), "least"), ((1 << 63) - 1, "most " * 200), (0, None), (None, "no id " * 100), (None, ""), (12345678901234567, "x"), (-5, "y")]
    df = spark.createDataFrame(table, "doc_id long, text string")
    layout = shards.layout_for(df, BYTES, seq_len=64, shard_bytes=200)
    assert layout.domain == 0 and layout.shards > 1
    shards.write_shards(df.repartition(3), BYTES, f"{tmp_dir}/wide", layout)
    found = sorted(shards.read_shards(spark, f"{tmp_dir}/wide", layout).collect(), key=lambda r: r.slot)
    assert [r.slot for r in found] == list(range(len(found))) and [r.shard for r in found] == sorted(r.shard for r in found)
    assert {r.doc_id for r in found} == {r[0] for r in table}
    pieces = sorted((r.piece for r in found if r.doc_id == (1 << 63) - 1))
    assert pieces == list(range(len(pieces))) and len(pieces) > 1
    assert sum(r.n_tokens for r in found if r.doc_id is None) > 2


def test_substring(docs):
    unique = {r[0]: r[1] for r in rows()}
    want = brute.substring(list(unique.items()))
    found = {}
    for r in substring.remove_repeats(docs).collect():
        kept = " ".join(brute.WORD.findall(r.row.text or "")) if r.kept_text is None else r.kept_text
        found[r.row.doc_id] = (r.n_words, r.n_removed, kept)
    assert found == want and found[10][1] == 70


@pytest.mark.parametrize("window", [8, 13, 30, 50])
def test_substring_windows(spark, window):
    import numpy as np

    rng = np.random.default_rng(window)
    passages = [[f"p{k}w{i}" for i in range(int(rng.integers(5, 90)))] for k in range(6)]
    table = []
    for i in range(80):
        words = []
        for _ in range(4):
            p = passages[int(rng.integers(6))]
            a = int(rng.integers(len(p)))
            words += p[a:] + [f"r{rng.integers(40)}" for _ in range(int(rng.integers(8)))]
        table.append((i, " ".join(words)))
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    found = {r.row.doc_id: (r.n_words, r.n_removed) for r in substring.remove_repeats(df, window).collect()}
    assert found == {i: v[:2] for i, v in brute.substring(table, window).items()}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stages(spark, docs, clashing, empty, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    last = name == corpus_pipeline.STAGES[-1][0]
    out = stage(spark, docs, "")
    rows_ = out.collect()
    assert rows_ and (last or out.dtypes == docs.dtypes)
    if name != "substring_dedup":  # its own columns take part in no other way
        assert last or stage(spark, clashing, "").columns == clashing.columns
    assert stage(spark, empty, "").collect() == []


def test_pipeline_decisions(spark, docs):
    """Every stage holds against brute force on what the stage before kept."""
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, "").collect()
    assert {r.doc_id for r in kept} == {0, 1, 5, 6, 7, 8, 9, 10, 11, None}
    one = stages["simhash_dedup"](spark, spark.createDataFrame(kept, SCHEMA), "").collect()
    ids = sorted({r.doc_id for r in kept if r.doc_id is not None})
    text = {r.doc_id: r.text for r in kept}
    fps = [brute.simhash(text[i]) for i in ids]
    root = brute.components(ids, [(ids[a], ids[b]) for a, b in brute.near_bits(fps)])
    assert sorted(r.doc_id for r in one) == sorted(set(root.values()))
    clean = stages["substring_dedup"](spark, spark.createDataFrame(one, SCHEMA), "").collect()
    want = brute.substring([(r.doc_id, r.text) for r in one])
    assert {r.doc_id for r in clean} == {i for i, (n, g, _) in want.items() if g < n}
    for r in clean:
        if want[r.doc_id][1]:
            assert (r.text, r.n_chars) == (want[r.doc_id][2], len(want[r.doc_id][2]))
        else:
            assert r.text == text[r.doc_id]
