"""Edge tables for normalisation, classification, trimming and HMAC."""

import hashlib
import hmac
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.functions import classify
from vigil.functions.digest import TEST_ID_KEY, TEST_SECRET_KEY, HmacKey, with_hmacs
from vigil.functions.text import JS_WHITESPACE, js_trim, normalise_compat, normalise_identifier, strip_controls

NORMALISE_CASES = [
    ("Bob+x@Ex.test", "bob@ex.test", "bob"),
    ("  bob@ex.test ", "bob@ex.test", "  bob@ex.test "),
    ("--bob@ex.test", "bob@ex.test", "--bob@ex.test"),
    ("a@b+c.test", "a@b+c.test", "a@b"),
    ("a@b@c.test", "a@b@c.test", "a@b@c.test"),
    ("+tag@ex.test", "tag@ex.test", ""),
    ("nobody", "nobody", "nobody"),
    ("a+b+c@d.test", "a@d.test", "a"),
    ("", "", ""),
]


def _one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).head()["r"]


def test_normalise_edge_table(spark):
    rows = spark.createDataFrame([(i, a) for i, (a, _, _) in enumerate(NORMALISE_CASES)], "i int, v string")
    got = {r["i"]: (r["a"], r["b"]) for r in rows.select(
        "i", normalise_identifier(F.col("v")).alias("a"), normalise_compat(F.col("v")).alias("b")).collect()}
    for i, (_, a, b) in enumerate(NORMALISE_CASES):
        assert got[i] == (a, b), NORMALISE_CASES[i]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZ9+@-. _\" x", max_size=12), min_size=1, max_size=25))
def test_normalised_identifiers_have_the_canonical_form(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    once = df.withColumn("n", normalise_identifier(F.col("v")))
    for r in once.withColumn("again", normalise_identifier(F.col("n"))).collect():
        v, n = r["v"].lower(), r["n"]
        assert r["again"].rstrip() == n.rstrip(), r  # a second time changes nothing
        assert n == "" or re.match("[a-z0-9]", n), r
        # nothing is added: what is left is a subsequence of the input
        rest = iter(v)
        assert all(c in rest for c in n), r
        local, at, domain = n.partition("@")
        kept = v[len(v) - len(v.lstrip("@+-. _\"")):]
        if "@" in kept and at:
            assert "+" not in local and kept.partition("@")[2].rstrip() == domain.rstrip(), r
            assert kept.startswith(local), r
        else:
            assert n == kept.rstrip(), r


CLASSIFY_CASES = [
    ("$2b$10$" + "a" * 53, "bcrypt", "bcrypt"),
    ("$2b$zz", "plaintext", "bcrypt"),
    ("$argon2id$v=19$m=1$c2$aa", "argon2", "plaintext"),
    ("$1$salt$abc", "md5-crypt", "plaintext"),
    ("$5$salt$abc", "sha256-crypt", "plaintext"),
    ("$5$rounds=5000$salt$abc", "plaintext", "plaintext"),
    ("$6$s$abc", "sha512-crypt", "plaintext"),
    ("{SSHA}ab==", "ssha", "plaintext"),
    ("{SHA}ab==", "sha1-base64", "plaintext"),
    ("a" * 32, "md5-hex", "md5"),
    ("A" * 40, "sha1-hex", "sha1"),
    ("0" * 64, "sha256-hex", "plaintext"),
    ("f" * 128, "sha512-hex", "plaintext"),
    ("a" * 33, "plaintext", "plaintext"),
    ("hello", "plaintext", "plaintext"),
    ("  " + "b" * 32 + " ", "md5-hex", "plaintext"),
    ("abc\n", "plaintext", "plaintext"),
]


def test_classifier_edge_table(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(CLASSIFY_CASES)], "i int, v string")
    got = {r["i"]: (r["fs"], r["pg"]) for r in df.select(
        "i", classify.hash_scheme(F.col("v")).alias("fs"), classify.hash_scheme_compat(F.col("v")).alias("pg")).collect()}
    for i, (v, fs, pg) in enumerate(CLASSIFY_CASES):
        assert got[i] == (fs, pg), v


def test_js_trim_and_controls(spark):
    s = "﻿  \tab c　 "
    assert _one(spark, s, js_trim) == "ab c"
    assert _one(spark, "a\x00b\x07c\x1fd\x7fe\tf", strip_controls) == "abcdef"
    assert _one(spark, "\u0085x\u0085", js_trim) == "\u0085x\u0085"  # not JS whitespace


def test_hmac_matches_python(spark):
    key = HmacKey(bytes(range(7, 39)))
    values = ["bob@ex.test", "é@ü.test", "", "x" * 300, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = dict(with_hmacs(df, [("h", "v", key)]).select("i", "h").collect())
    for i, v in enumerate(values):
        want = None if v is None else hmac.new(key.material, v.encode(), hashlib.sha256).hexdigest()
        assert got[i] == want


def test_two_keys_in_one_join(spark):
    df = spark.createDataFrame([("a@b.test",)], "v string")
    r = with_hmacs(df, [("x", "v", TEST_ID_KEY), ("y", "v", TEST_SECRET_KEY)]).head()
    assert r["x"] == hmac.new(TEST_ID_KEY.material, b"a@b.test", hashlib.sha256).hexdigest()
    assert r["y"] == hmac.new(TEST_SECRET_KEY.material, b"a@b.test", hashlib.sha256).hexdigest()
    plan = with_hmacs(df, [("x", "v", TEST_ID_KEY)])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_key_validation_and_repr():
    import pytest

    with pytest.raises(ValueError):
        HmacKey(b"short")
    with pytest.raises(ValueError):
        HmacKey.from_hex("zz" * 32)
    assert TEST_ID_KEY.material.hex() not in repr(TEST_ID_KEY)


_EVENT_LOG_PROBE = r"""
import glob, sys
sys.path.insert(0, sys.argv[2])
from vigil.session import build_session
from vigil.functions.digest import TEST_ID_KEY, with_hmacs
d = sys.argv[1]
spark = build_session("local[2]", **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": d,
                                     "spark.eventLog.compress": "false"})
spark.sparkContext.setLogLevel("ERROR")
df = spark.createDataFrame([("a@b.test",)], "v string")
out = with_hmacs(df, [("h", "v", TEST_ID_KEY)])
out.collect()
plan = out._jdf.queryExecution().explainString(
    spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))
spark.stop()
logs = glob.glob(d + "/*/events*")
text = plan.lower() + "".join(open(f).read().lower() for f in logs)
ipad, opad = TEST_ID_KEY.pads()
leaks = [n for n, s in (("ipad", ipad.hex()), ("opad", opad.hex()), ("key", TEST_ID_KEY.material.hex())) if s in text]
print("LOGS", len(logs), "SQLSTART", text.count("sqlexecutionstart"), "LEAKS", leaks)
"""


def test_key_absent_from_plan_and_event_log(tmp_dir):
    """Plan strings reach explain output, the event log and the UI unredacted,
    so the key (and its pads) must never be a literal in them.  Runs in its
    own process so the event log belongs to a fresh session."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    res = subprocess.run([sys.executable, "-c", _EVENT_LOG_PROBE, tmp_dir, root],
                         capture_output=True, text=True, timeout=300)
    line = [ln for ln in res.stdout.splitlines() if ln.startswith("LOGS")]
    assert line, res.stderr[-2000:]
    parts = line[0].split()
    assert int(parts[1]) >= 1 and int(parts[3]) >= 1
    assert line[0].endswith("LEAKS []"), line[0]


# What each scheme's strings look like, first match first.
_SHAPES = [
    (r"\$2[aby]\$[0-9]{2}\$[A-Za-z0-9./]{53}", "bcrypt"),
    (r"\$argon2(i|d|id)\$v=[0-9]+\$.*\$.*\$.*", "argon2"),
    (r"\$1\$[^$]+\$[A-Za-z0-9./]+", "md5-crypt"),
    (r"\$5\$[^$]+\$[A-Za-z0-9./]+", "sha256-crypt"),
    (r"\$6\$[^$]+\$[A-Za-z0-9./]+", "sha512-crypt"),
    (r"\{SSHA\}[A-Za-z0-9+/=]+", "ssha"),
    (r"\{SHA\}[A-Za-z0-9+/=]+", "sha1-base64"),
    *((f"[A-Fa-f0-9]{{{n}}}", f"{name}-hex") for n, name in ((32, "md5"), (40, "sha1"), (64, "sha256"), (128, "sha512"))),
    (r"[\s\S]*", "plaintext"),
]


def _scheme(value: str) -> str:
    return next(name for shape, name in _SHAPES if re.fullmatch(shape, value.strip(JS_WHITESPACE)))


_HASH_CHARS = "aAfF09./$=+{}SHAbxyz"
_shapes = st.one_of(
    st.text(alphabet=_HASH_CHARS + " ", max_size=20),
    st.builds(lambda v, d, body: f"$2{v}${d}${body}", st.sampled_from("abyc"),
              st.text(alphabet="0123456789a", min_size=1, max_size=3),
              st.text(alphabet="abAB09./$", min_size=51, max_size=55)),
    st.builds(lambda k, salt, body: f"${k}${salt}${body}", st.sampled_from("1562"),
              st.text(alphabet="ab$=", min_size=0, max_size=4), st.text(alphabet="aZ9./!", min_size=0, max_size=6)),
    st.builds(lambda tag, body: f"{{{tag}}}{body}", st.sampled_from(["SHA", "SSHA", "sha", "MD5"]),
              st.text(alphabet="aZ9+/=!", min_size=0, max_size=8)),
    st.builds(lambda n, c, pad: pad + c * n + pad, st.sampled_from([31, 32, 33, 40, 64, 128]),
              st.sampled_from(["a", "F", "0", "g"]), st.sampled_from(["", " ", "\t"])),
    st.builds(lambda v, rest: f"$argon2{v}$v={rest}", st.sampled_from(["i", "d", "id", "x"]),
              st.text(alphabet="19$m=,a", max_size=12)),
)


@settings(max_examples=80, deadline=None)
@given(st.lists(_shapes, min_size=1, max_size=30))
def test_classifier_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = dict(df.select("i", classify.hash_scheme(F.col("v")).alias("s")).collect())
    for i, v in enumerate(values):
        assert got[i] == _scheme(v), repr(v)


def test_path_helpers(spark):
    from vigil.functions.paths import base_name, dir_name, partition_value, strip_gz

    df = spark.createDataFrame([("file:/data/root/p2=ab/ab/abcd.jsonl.gz",)], "p string")
    r = df.select(base_name(F.col("p")).alias("b"), dir_name(F.col("p")).alias("d"),
                  strip_gz(F.col("p")).alias("s"), partition_value(F.col("p"), "p2").alias("v")).head()
    assert r["b"] == "abcd.jsonl.gz"
    assert r["d"] == "file:/data/root/p2=ab/ab"
    assert r["s"] == "file:/data/root/p2=ab/ab/abcd.jsonl"
    assert r["v"] == "ab"
