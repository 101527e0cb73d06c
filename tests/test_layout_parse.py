"""Layout inference, both parse modes, reject reasons and conservation."""

from pyspark.sql import functions as F

from vigil.operators.layout import infer_layout
from vigil.operators.parse import parse_detected, parse_first_colon
from vigil.plans.parse_protect import detected
from vigil.sources import fixtures
from vigil.functions.text import js_trim

from tests.conftest import SF_MID, SF_SMALL


def _lines(spark, files):
    rows = [(src, 0, i, line) for src, lines in files.items() for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "source string, block bigint, seq bigint, line string")


def _layout(spark, files):
    return {r["source"]: (r["delim"], r["email_first"], r["status"]) for r in infer_layout(_lines(spark, files)).collect()}


def test_layout_cases(spark):
    got = _layout(spark, {
        "hdr": ["h;h", "pw1;u@x.test", "pw2;v@x.test"],
        "blanks": ["", "  ", "a@x.test:p", "", "b@x.test:q"],
        "wide": ["a@x.test:p", "u@x.test:p:q"],
        "tab": ["a@x.test\tp", "b@x.test\tq"],
        "one": ["a@x.test:p", "", "   "],
        "none": ["", ""],
        "space": ["x y", "u@x.test pw"],
    })
    assert got["hdr"] == (";", False, "ok")
    assert got["blanks"] == (":", True, "ok")
    assert got["wide"] == (":", None, "record2_fields")
    assert got["tab"] == (" ", True, "ok")
    assert got["one"] == (None, None, "undetectable")
    assert got["none"] == (None, None, "undetectable")
    assert got["space"] == (" ", True, "ok")


def test_layout_later_blocks(spark):
    # second non-blank line sits in a later block of the file
    rows = [("f", 0, 1, "a@x.test;p"), ("f", 0, 2, ""), ("f", 128, 3, "q;b@x.test"), ("f", 128, 4, "r;c@x.test")]
    df = spark.createDataFrame(rows, "source string, block bigint, seq bigint, line string")
    r = infer_layout(df).head()
    assert (r["delim"], r["email_first"], r["status"]) == (";", False, "ok")


def test_detected_reasons(spark):
    files = {"f": ["a@x.test:p1", "b@x.test:p2", "c@x.test:p:q", ":", "d@x.test:" + "z" * 4000,
                   "\x07e@x.test:p3", "", "  f@x.test : p4  "]}
    lines = _lines(spark, files)
    got = sorted((r["seq"], r["reason"]) for r in parse_detected(lines, infer_layout(lines)).collect())
    assert got == [(0, None), (1, None), (2, "field_count"), (3, "empty_field"), (4, "oversize"),
                   (5, None), (7, None)]
    parsed = {r["seq"]: (r["ident"], r["secret"]) for r in parse_detected(lines, infer_layout(lines)).collect()}
    assert parsed[5] == ("e@x.test", "p3") and parsed[7] == ("f@x.test", "p4")


def test_first_colon_cases(spark):
    lines = _lines(spark, {"f": ["a@x.test:p:q", "a@x.test:", ":p", "no separator", "user:p", ""]})
    got = sorted((r["seq"], r["secret"], r["reason"]) for r in parse_first_colon(lines).collect())
    assert got == [(0, "p:q", None), (1, "", None), (2, None, "no_separator"), (3, None, "no_separator"),
                   (4, "p", "no_at")]


def test_fixture_counts_sf001(spark):
    """Per-source outcome counts of the sf0.01 fixture (FIXTURES.md 2.4)."""
    parsed = detected(fixtures.raw_lines(spark, SF_MID))
    got = {(r["source"], r["reason"]): r["n"] for r in parsed.groupBy(
        "source", F.coalesce("reason", F.lit("accepted")).alias("reason")).count().withColumnRenamed("count", "n").collect()}
    expect = {
        "/syn/click.txt": (1940, 23, 0, 23), "/syn/error.txt": (1938, 21, 17, 13),
        "/syn/signup.txt": (1949, 24, 0, 25), "/syn/view.txt": (1910, 12, 18, 21),
    }
    for src, (acc, fc, ef, ov) in expect.items():
        assert got.get((src, "accepted"), 0) == acc
        assert got.get((src, "field_count"), 0) == fc
        assert got.get((src, "empty_field"), 0) == ef
        assert got.get((src, "oversize"), 0) == ov
    assert got[("/syn/purchase.txt", "record2_fields")] > 0
    assert got[("/syn/solo.txt", "undetectable")] == 1


def test_every_nonblank_line_counted_once(spark):
    lines = fixtures.raw_lines(spark, SF_SMALL)
    nonblank = lines.where(js_trim(F.col("line")) != "").count()
    parsed = detected(lines)
    assert parsed.count() + 0 <= nonblank
    # lines of accepted layouts that are blank after control stripping are the only silent ones
    silent = nonblank - parsed.count()
    ctrl_only = lines.where((js_trim(F.col("line")) != "") & (F.regexp_replace("line", r"[\x00-\x1f\x7f\s]", "") == "")).count()
    assert silent == ctrl_only
    assert parsed.select("source", "seq").distinct().count() == parsed.count()


def test_skip_header(spark):
    lines = _lines(spark, {"f": ["", "email;password", "a@x.test;p1", "b@x.test;p2"], "g": ["only"]})
    keep = sorted(r["seq"] for r in parse_detected(lines, infer_layout(lines)).where("reason is null").collect())
    skip = sorted(r["seq"] for r in parse_detected(lines, infer_layout(lines), skip_header=True)
                  .where("reason is null").collect())
    assert keep == [1, 2, 3] and skip == [2, 3]


def test_layout_join_variants_agree(spark):
    """Hashed key vs path key, broadcast vs shuffle join: same parse."""
    lines = fixtures.raw_lines(spark, SF_SMALL)
    layout = infer_layout(lines)
    cols = ["source", "seq", "reason"]

    def rows(**kw):
        return sorted(tuple(r) for r in parse_detected(lines, layout, **kw).select(*cols).collect())

    base = rows()
    assert rows(hash_key=False) == base
    assert rows(max_broadcast_bytes=0) == base
    assert rows(hash_key=False, max_broadcast_bytes=0) == base


import re as _re

from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.functions.text import JS_WHITESPACE


def _model_detected(lines, source):
    """Python model of the layout-driven parse for one file: a list of
    (index, reason or None, ident, secret) for every line that is counted."""
    trimmed = [ln.strip(JS_WHITESPACE) for ln in lines]
    nonblank = [t for t in trimmed if t]
    out = []
    if len(nonblank) < 2:
        return [(i, "undetectable", None, None) for i, t in enumerate(trimmed) if t]
    second = nonblank[1]
    delim = ":" if ":" in second else ";" if ";" in second else " "
    if len(second.split(delim)) > 2:
        return [(i, "record2_fields", None, None) for i, t in enumerate(trimmed) if t]
    first = second.split(delim)[0].strip(JS_WHITESPACE)
    email_first = _re.search(r"\S+@\S+\.\S+", first) is not None
    for i, line in enumerate(lines):
        clean = _re.sub(r"[\x00-\x1f\x7f]", "", line).strip(JS_WHITESPACE)
        if not clean:
            continue
        fields = clean.split(delim)
        if len(fields) != 2:
            out.append((i, "field_count", None, None))
            continue
        r1, r2 = (f.strip(JS_WHITESPACE) for f in fields)
        ident, secret = (r1, r2) if email_first else (r2, r1)
        if not ident or not secret:
            out.append((i, "empty_field", ident, secret))
        elif len(ident) + len(secret) + len(source) > 4000:
            out.append((i, "oversize", ident, secret))
        else:
            out.append((i, None, ident, secret))
    return out


_line = st.one_of(
    st.text(alphabet="ab@.:; \t\x07x", max_size=14),
    st.builds(lambda u, d, p: f"{u}@ex.test{d}{p}", st.sampled_from(["a", "B", " c"]),
              st.sampled_from([":", ";", " ", "::", "\t"]), st.text(alphabet="pw1:; ", max_size=6)),
    st.builds(lambda p, d: f"{p}{d}u@ex.test", st.text(alphabet="pw1", min_size=1, max_size=4),
              st.sampled_from([":", ";", " "])),
    st.just(""),
    st.just("x" * 3990 + "@e.t:p" + "q" * 20),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(_line, min_size=0, max_size=8), min_size=1, max_size=4))
def test_detected_parse_matches_model(spark, files):
    rows = [(f"f{k}", 0, i, ln) for k, lines in enumerate(files) for i, ln in enumerate(lines)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "source string, block bigint, seq bigint, line string")
    parsed = parse_detected(df, infer_layout(df))
    got = sorted(
        (r["source"], r["seq"], r["reason"], r["ident"] if r["reason"] is None else None,
         r["secret"] if r["reason"] is None else None)
        for r in parsed.collect()
    )
    want = sorted(
        (f"f{k}", i, reason, ident if reason is None else None, secret if reason is None else None)
        for k, lines in enumerate(files)
        for i, reason, ident, secret in _model_detected(lines, f"f{k}")
    )
    assert got == want


def test_lines_without_text_are_dropped_before_and_after_the_parse(spark):
    rows = [("/f", 0, k, v) for k, v in enumerate(["a@x.test:p", "", None, " \t", "b@x.test:q"])]
    lines = spark.createDataFrame(rows, "source string, block long, seq long, line string")
    assert sorted(r["seq"] for r in detected(lines).collect()) == [0, 4]
    assert sorted((r["seq"], r["reason"]) for r in detected(lines, keep_blank=True).where("reason = 'blank'").collect()) == [(1, "blank"), (3, "blank")]
