"""Head-only layout inference agrees with the scan-based layout pass."""

import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.operators.layout import infer_layout, line_flags
from vigil.sources.heads import infer_layout_from_heads, layout_of_line
from vigil.sources.text_files import read_lines


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


FILES = {
    "a.txt": b"h;h\r\npw1;u@x.test\r\npw2;v@x.test",
    "b.TXT": b"\n\n  \na@x.test:p\n\n\tb@x.test:q\n",
    "c.txt": b"a@x.test:p\nu@x.test:p:q\n",
    "d.txt": b"only one line\n",
    "e.txt": b"\r\r\n  \n",
    "f b%.txt": b"x y\nu@x.test pw\n",
    "g.txt": b"a@x.test:p\r",
    "h.txt": b"\xef\xbb\xbfa@x.test:p\r\n\xff\xfeb@x.test:q\r\n",
}


def test_heads_match_scan(spark, tmp_dir):
    for name, data in FILES.items():
        _write(f"{tmp_dir}/in/{name}", data)
    big = b"".join(b"u%d@x.test;p%d\n" % (i, i) for i in range(30000))
    _write(f"{tmp_dir}/in/sub/big.txt", b"\n" * 70000 + big)
    heads = {r["source"]: tuple(r[1:]) for r in infer_layout_from_heads(spark, f"{tmp_dir}/in").collect()}
    scan = {r["source"]: (r["delim"], r["email_first"], r["status"])
            for r in infer_layout(read_lines(spark, f"{tmp_dir}/in")).collect()}
    assert heads == scan
    assert len(heads) == len(FILES) + 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab@.:; \t\x07x", max_size=14), min_size=1, max_size=20))
def test_python_flags_match_columns(spark, lines):
    df = spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "i int, line string")
    got = {r["i"]: r for r in df.select("i", *line_flags(F.col("line"))).collect()}
    for i, ln in enumerate(lines):
        if got[i]["_blank"]:
            continue
        delim, first, status = layout_of_line(ln)
        assert got[i]["_delim"] == delim
        assert got[i]["_wide"] == (status == "record2_fields")
        if status == "ok":
            assert got[i]["_id_first"] == first


def test_ingest_with_head_layouts(spark, tmp_dir):
    from vigil.operators.protect import TEST_KEYS
    from vigil.plans.ingest import Outputs, ingest_files
    from vigil.sources.shards import read_protected

    for name, data in FILES.items():
        _write(f"{tmp_dir}/in/{name}", data)
    a = Outputs(f"{tmp_dir}/scan")
    b = Outputs(f"{tmp_dir}/heads")
    ma = sorted(tuple(r) for r in ingest_files(spark, f"{tmp_dir}/in", a, TEST_KEYS, 0)
                .select("source", "loaded", "rejected").collect())
    mb = sorted(tuple(r) for r in ingest_files(spark, f"{tmp_dir}/in", b, TEST_KEYS, 0, layout_reader="heads")
                .select("source", "loaded", "rejected").collect())
    assert ma == mb and ma
    cols = ["id_digest", "secret_digest", "source"]
    ra = sorted(tuple(r) for r in read_protected(spark, a.records).select(*cols).collect())
    rb = sorted(tuple(r) for r in read_protected(spark, b.records).select(*cols).collect())
    assert ra == rb and ra


def test_long_lines_are_searched_once():
    import io

    from vigil.sources.heads import _second_nonblank

    long = b"x" * 300_000
    cases = {
        long: None, long + b"\n": None, long + b"\r\ny:z": "y:z", b"\n \n" + long + b"\n\n b;c \n": " b;c ",
        b"a\n" + long: long.decode(), (" " * 200_000).encode() + b"\n\xe3\x80\x80\nq\nr\n": "r", b"": None, b"\r\n\r\n": None,
        "\u3000".encode() * 50_000 + b"\na\nb": "b", b"a\r" * 2: "a",
    }
    for raw, want in cases.items():
        assert _second_nonblank(io.BytesIO(raw)) == want
