"""Token counts at every prefix, in all scripts, held against the library."""

import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.llm import token_counts
from vigil.llm.encoding import vocabulary_path

PATH = vocabulary_path("word_bpe_49k.json")
SCRIPTS = [
    "", " ", "plain words, and it's they've 12x", "日本語のテキスト漢字かな交じり", "Привет, мир! Ещё раз", "ελληνικά ΣΑΣ τέλος ς",
    "हिन्दी में लिखा है", "한국어 문장입니다", "مرحبا بالعالم ١٢٣", "é decomposed", "İstanbul ǅ ﬁ", "😀😀 emoji👍🏽!!",
    "a　b c 中　文", "<|endoftext|>中 <|x", "naïve’s “quotes” it’s", "½²③ Ⅷ x", "​﻿ z",
]


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(PATH)


def library(counter, text):
    return [len(counter.tokenizer.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]


@pytest.mark.parametrize("text", SCRIPTS)
def test_prefixes_of_all_scripts(counter, text):
    assert counter.prefixes(text).tolist() == library(counter, text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab'sre19 中文字日кЖéß½!?.。、ーंहि한글 　"), max_size=25))
def test_prefixes_of_mixed_scripts(text):
    c = token_counts.counter(PATH)
    assert c.prefixes(text).tolist() == library(c, text)


def test_long_text_without_blanks_is_not_encoded_again_for_each_prefix(counter, monkeypatch):
    text = "".join(chr(0x4E00 + (k * k * 7919) % 20000) for k in range(20_000))
    encoded, real = [], counter._library
    monkeypatch.setattr(counter, "_library", lambda t: encoded.append(len(t)) or real(t))
    t0 = time.process_time()
    found = counter.prefixes(text)
    assert time.process_time() - t0 < 60 and encoded == [len(text)]
    assert (np.diff(found) >= 0).sum() and found[-1] == real(text) and found[777] == real(text[:777])
    assert not [w for w in counter._words if len(w) > 64]  # long words and pieces are not kept
    counter.count(text.encode())
    assert not [p for p in counter._pieces if len(p) > 256]


def test_stored_prefixes_answer_budgets(spark):
    texts = ["one two three", "日本語のテキスト", "", None, "word " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stored = token_counts.prefix_table(df, PATH)
    c = token_counts.counter(PATH)
    rows = stored.select("doc_id", "prefix_tokens", token_counts.longest_prefix(F.col("prefix_tokens"), 5).alias("cut")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        want = library(c, text)
        assert r["prefix_tokens"] == want
        assert r["cut"] == max(k for k, n in enumerate(want) if n <= 5)
    assert token_counts.prefix_table(df.limit(0), PATH).count() == 0
