"""Each registered operator query against brute force on the smallest tables."""

import math

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from scripts.oracle_check import digest
from tests.conftest import SF_SMALL
from tests.llm import brute
from vigil.llm import queries
from vigil.llm.encoding import vocabulary_path


def rows_of(spark, name):
    return queries.QUERIES[name](spark, SF_SMALL).collect()


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


def test_op1_packs_every_piece_once(spark, docs):
    tok = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    found = rows_of(spark, "op1_best_fit_packing")
    pieces = {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
    assert len(pieces) == len(docs)
    for i, text, _ in docs:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert sum(r.length for r in own) == len(ids)
        assert all(r.length == 2048 for r in own[1:]) and (len(own) == 1) == (len(ids) <= 2048)
        for r in own:
            assert r.ids_crc32 == brute.crc(ids[r.start : r.start + r.length])
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in found)
    assert len(sequences) <= math.ceil(total / 2048) * 1.02 + 1


def test_op2_components(spark, docs):
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in rows_of(spark, "op2_simhash")}
    ids = sorted(i for i, _, _ in docs)
    text = {i: t for i, t, _ in docs}
    fps = [brute.simhash(text[i]) for i in ids]
    root = brute.components(ids, [(ids[a], ids[b]) for a, b in brute.near_bits(fps)])
    assert found == {i: (f"{fp:016x}", root[i]) for i, fp in zip(ids, fps)}


def test_op3_links(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows_of(spark, "op3_embedding_dedup")}
    assert found == brute.vectors(rows)


def test_op4_fingerprints(spark, docs):
    from vigil.llm.sketches import encode, sketch

    found = {r.doc_id: r for r in rows_of(spark, "op4_fingerprints")}
    want = brute.edits([(i, t) for i, t, _ in docs])
    assert found.keys() == want.keys()
    errors = []
    for i, (n, edited, text, other) in want.items():
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (n, brute.sha(edited))
        assert (r.fingerprint, r.edited_fingerprint) == (encode(sketch(text.encode())), encode(sketch(edited.encode())))
        sets = []
        for t in (text, edited, other):
            w = brute.WORD.findall(brute.lower(t))
            sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
        errors.append(abs(r.near_edited - len(sets[0] & sets[1]) / len(sets[0] | sets[1])))
        assert abs(r.near_next - len(sets[0] & sets[2]) / len(sets[0] | sets[2])) < 0.2
    assert np.mean(errors) < 0.04 and max(errors) < 0.25


def test_op5_reads_back(spark):
    says = "<|im_end|><|im_start|>assistant ok"
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    want = brute.turns([*rows, (-1, 0, "user", says), (-1, 1, "assistant", says)])
    found = {r.conv_id: r for r in rows_of(spark, "op5_chat")}
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in found.items()} == want
    # both texts of the probe hold two control strings, each escaped by one character
    assert found[-1].formatted_chars == 2 * (len("<|im_start|>\n<|im_end|>\n") + len(says) + 2) + len("userassistant")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    cur = con.execute(queries.ORACLE_SQL[name])
    df = queries.QUERIES[name](spark, SF_SMALL)
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(names, cur.fetchall())


def test_op7_held_out_accuracy(spark, docs):
    import zlib

    found = {r.doc_id: r for r in rows_of(spark, "op7_language_id")}
    assert len(found) == len(docs)
    held = [i for i, _, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(i for i, r in found.items() if r.held_out) == sorted(held)
    lang = {i: x for i, _, x in docs}
    assert np.mean([found[i].lang_pred == lang[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())


def test_op8_records(spark, docs):
    tok = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    want = {}
    for i, text, _ in docs:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 512)):
            want[(i, k)] = (len(ids[at : at + 512]), brute.crc(ids[at : at + 512]))
    found = rows_of(spark, "op8_token_shards")
    assert {(r.doc_id, r.piece): (r.n_tokens, r.ids_crc32) for r in found} == want
    assert sorted(r.slot for r in found) == list(range(len(want)))


def test_op9_kept_words(spark, docs):
    want = {i: (n, g, brute.sha(t)) for i, (n, g, t) in brute.substring([(i, t) for i, t, _ in docs]).items()}
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows_of(spark, "op9_substring_dedup")}
    assert found == want


def test_op10_counts(spark, docs):
    tok = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    want = {i: (len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in docs}
    found = rows_of(spark, "op10_token_counts")
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in found} == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in found)
