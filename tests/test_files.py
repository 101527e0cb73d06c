"""File discovery, sinks, legacy shards and streaming resume in temp dirs."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from vigil.operators.protect import TEST_KEYS
from vigil.plans import maintenance
from vigil.plans.ingest import Outputs, ingest_files, load_outcomes, pending_files
from vigil.sinks.shards import write_protected
from vigil.sources.shards import read_protected
from vigil.sources.text_files import TXT_LOWER, read_lines
from vigil.streaming.ingest import run_available


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _tree(root):
    _write(f"{root}/a.txt", b"a1@x.test:p1\r\nb1@x.test:p2\r\nc1@x.test:p3")
    _write(f"{root}/sub/b.TXT", b"h:h\nu2@x.test:5f4dcc3b5aa765d61d8327deb882cf99\n\nv2@x.test:pw\n")
    _write(f"{root}/c.csv", b"z@x.test:p\n")
    _write(f"{root}/empty.txt", b"")


def test_discovery_and_line_endings(spark, tmp_dir):
    _tree(tmp_dir)
    lines = read_lines(spark, tmp_dir)
    srcs = {os.path.basename(r["source"]) for r in lines.select("source").distinct().collect()}
    assert srcs == {"a.txt", "b.TXT"}
    assert {os.path.basename(r["source"]) for r in read_lines(spark, tmp_dir, glob=TXT_LOWER)
            .select("source").distinct().collect()} == {"a.txt"}
    a = [r["line"] for r in lines.where(F.col("source").endswith("a.txt")).orderBy("block", "seq").collect()]
    assert a == ["a1@x.test:p1", "b1@x.test:p2", "c1@x.test:p3"]


def test_multi_block_file_order(spark, tmp_dir):
    rows = [f"u{i}@x.test:p{i}" for i in range(3000)]
    _write(f"{tmp_dir}/big.txt", ("\n".join(rows) + "\n").encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_lines(spark, tmp_dir)
        assert lines.select("block").distinct().count() > 1
        got = [r["line"] for r in lines.orderBy("block", "seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == rows


def test_batch_ingest_and_sinks(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _tree(src)
    out = Outputs(f"{tmp_dir}/out")
    manifest = {os.path.basename(r["source"]): (r["loaded"], r["rejected"])
                for r in ingest_files(spark, src, out, TEST_KEYS, batch_id=0).collect()}
    # b.TXT: header line is loaded as a record (compat with the reference)
    assert manifest == {"a.txt": (3, 0), "b.TXT": (3, 0), "empty.txt": (0, 0)}
    recs = read_protected(spark, out.records)
    assert recs.count() == 6
    # replay of the same batch adds nothing
    ingest_files(spark, src, out, TEST_KEYS, batch_id=0)
    assert read_protected(spark, out.records).count() == 6
    assert spark.read.parquet(out.manifest).count() == 3
    # another batch finds nothing new; a batch id belongs to its files for ever
    assert ingest_files(spark, src, out, TEST_KEYS, batch_id=1).count() == 0
    assert read_protected(spark, out.records).count() == 6
    assert spark.read.parquet(out.manifest).count() == 3
    assert pending_files(spark, src, out).count() == 0
    _write(f"{src}/new.txt", b"n@x.test:p\n")
    assert [os.path.basename(r["source"]) for r in pending_files(spark, src, out).collect()] == ["new.txt"]
    with pytest.raises(ValueError):
        ingest_files(spark, f"{src}/new.txt", out, TEST_KEYS, batch_id=0)
    assert read_protected(spark, out.records).count() == 6
    assert [r["loaded"] for r in ingest_files(spark, src, out, TEST_KEYS, batch_id=1, mode="first_colon").collect()] == [1]
    assert pending_files(spark, src, out).count() == 0
    grade = spark.read.parquet(out.metrics).where("batch_id = 0").head()
    assert grade["loaded"] == 6 and grade["grade"] in ("good", "acceptable", "poor")
    recs = read_protected(spark, out.records)  # the replay has replaced the files listed before
    # shard layout: p2 directories, gzip JSON and CSV exports
    assert all(d.startswith("p2=") for d in os.listdir(f"{out.records}/run=b0") if not d.startswith(("_", ".")))
    write_protected(recs, f"{tmp_dir}/json", fmt="json")
    assert any(f.endswith(".json.gz") for _, _, fs in os.walk(f"{tmp_dir}/json") for f in fs)
    assert read_protected(spark, f"{tmp_dir}/json", fmt="json").count() == 7
    write_protected(recs, f"{tmp_dir}/csv", fmt="csv")
    assert read_protected(spark, f"{tmp_dir}/csv", fmt="csv").count() == 7


def test_maintenance_jobs(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _tree(src)
    out = Outputs(f"{tmp_dir}/out")
    for batch_id in (0, 0, 1):  # the first one is tried again
        load_outcomes(spark, read_lines(spark, src), out, TEST_KEYS, batch_id, dedupe=False)
    assert read_protected(spark, out.records).count() == 12
    maintenance.dedupe_shards(spark, out.records, f"{tmp_dir}/v2")
    assert read_protected(spark, f"{tmp_dir}/v2").count() == 6
    maintenance.merge_shard_roots(spark, [out.records, f"{tmp_dir}/v2"], f"{tmp_dir}/merged")
    assert read_protected(spark, f"{tmp_dir}/merged").count() == 6
    maintenance.compact(spark, f"{tmp_dir}/v2", f"{tmp_dir}/v2json", fmt="json")
    assert read_protected(spark, f"{tmp_dir}/v2json", fmt="json").count() == 6
    due = maintenance.maintenance_due(spark.read.parquet(out.manifest), since_batch=-1,
                                      limits=maintenance.Thresholds(records=10, files=100, minutes=100)).head()
    # a file that was loaded twice counts once
    assert due["records"] == 6 and due["files"] == 2 and not due["due"]
    with pytest.raises(ValueError):
        maintenance.compact(spark, f"{tmp_dir}/v2", f"{tmp_dir}/v2")


def test_legacy_shards(spark, tmp_dir):
    recs = [{"email_hash": "x", "password": "5f4dcc3b5aa765d61d8327deb882cf99", "is_hash": True,
             "hash_type": "md5", "email": "bob+x@ex.test", "source": "/s/a.txt"},
            {"email_hash": "y", "password": "pw", "is_hash": False, "hash_type": "plaintext",
             "email": "bob@ex.test", "source": "/s/a.txt"}]
    _write(f"{tmp_dir}/r1/ab/abcd.jsonl", ("\n".join(json.dumps(r) for r in recs) + "\nnot json\n").encode())
    _write(f"{tmp_dir}/r1/ab/abcd.jsonl.tmp", (json.dumps(recs[0]) + "\n").encode())
    _write(f"{tmp_dir}/r2/ab/abce.jsonl.gz", gzip.compress((json.dumps(recs[0]) + "\n5\n").encode()))
    bad = maintenance.protect_legacy_shards(spark, [f"{tmp_dir}/r1", f"{tmp_dir}/r2"], f"{tmp_dir}/prot", TEST_KEYS)
    assert {os.path.basename(r["source"]): r["n"] for r in bad.collect()} == {"abcd.jsonl": 1, "abce.jsonl.gz": 1}
    out = read_protected(spark, f"{tmp_dir}/prot")
    assert out.count() == 3 and out.select("id_digest").distinct().count() == 1
    assert sorted(r["hash_type"] for r in out.collect()) == ["md5-hex", "md5-hex", "plaintext"]
    assert "email" not in out.columns and "password" not in out.columns


def test_stream_resume_loads_each_file_once(spark, tmp_dir):
    inbox, out, ckpt = f"{tmp_dir}/inbox", Outputs(f"{tmp_dir}/tables"), f"{tmp_dir}/ckpt"
    _write(f"{inbox}/a.txt", b"a1@x.test:p1\nb1@x.test:p2\nc1@x.test:p3\n")
    run_available(spark, inbox, out, ckpt, TEST_KEYS)
    assert read_protected(spark, out.records).count() == 3
    _write(f"{inbox}/d/b.txt", b"x@x.test;p\ny@x.test;q\n")
    run_available(spark, inbox, out, ckpt, TEST_KEYS)
    run_available(spark, inbox, out, ckpt, TEST_KEYS)
    assert read_protected(spark, out.records).count() == 5
    m = spark.read.parquet(out.manifest)
    assert m.count() == 2 and m.select("batch_id").distinct().count() == 2


def test_stored_lookup_prunes_partitions(spark, tmp_dir):
    from pyspark.sql import functions as F

    from vigil.plans.checks import exposure_report, range_lookup
    from vigil.plans.parse_protect import protected_detected
    from vigil.sources import fixtures
    from tests.conftest import SF_SMALL

    recs = protected_detected(fixtures.raw_lines(spark, SF_SMALL), TEST_KEYS)
    write_protected(recs, f"{tmp_dir}/shards")
    wl = recs.select("id_digest").distinct().limit(2)
    rep = exposure_report(spark, f"{tmp_dir}/shards", wl)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = rep._jdf.queryExecution().explainString(mode)
    parts = [ln for ln in plan.splitlines() if ln.startswith("PartitionFilters")]
    assert any(" IN (" in ln for ln in parts), parts
    assert rep.where("exposed").count() == 2
    rl = range_lookup(spark, f"{tmp_dir}/shards", wl.select(F.substring("id_digest", 1, 4).alias("prefix")), k=2)
    assert rl.count() >= 2


def test_compat_ingest_and_storage_profile(spark, tmp_dir):
    from vigil.operators.audit import storage_profile
    from vigil.sources.text_files import list_files

    src = f"{tmp_dir}/in"
    _tree(src)
    out = Outputs(f"{tmp_dir}/out")
    ingest_files(spark, src, out, TEST_KEYS, batch_id=0, compat=True, skip_header=True)
    recs = read_protected(spark, out.records)
    assert recs.count() == 4  # first line of each file skipped (a1 and the "h:h" header)
    assert sorted(r["hash_type"] for r in recs.collect()).count("md5") == 1
    prof = storage_profile(list_files(spark, out.records, glob="*.parquet")).head()
    assert prof["n_files"] > 0 and prof["bytes"] > 0 and prof["size"].endswith(("bytes", "kB"))


def test_stream_stops_on_stop_file(spark, tmp_dir):
    from vigil.streaming.ingest import run_until_stopped, start_ingest

    inbox, out, ckpt = f"{tmp_dir}/inbox", Outputs(f"{tmp_dir}/tables"), f"{tmp_dir}/ckpt"
    _write(f"{inbox}/a.txt", b"a1@x.test:p1\nb1@x.test:p2\n")
    q = start_ingest(spark, inbox, out, ckpt, TEST_KEYS, processing_time="1 second")
    q.processAllAvailable()
    _write(f"{tmp_dir}/STOP", b"")
    assert run_until_stopped(spark, q, f"{tmp_dir}/STOP", poll_seconds=0.5, timeout_s=60)
    assert not q.isActive
    assert read_protected(spark, out.records).count() == 2
    # restart from the same checkpoint: nothing new, nothing doubled
    run_available(spark, inbox, out, ckpt, TEST_KEYS)
    assert read_protected(spark, out.records).count() == 2


def test_pending_matches_encoded_paths(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _write(f"{src}/a b%c.txt", b"a@x.test:p\nb@x.test:q\n")
    out = Outputs(f"{tmp_dir}/out")
    ingest_files(spark, src, out, TEST_KEYS, batch_id=0)
    assert pending_files(spark, src, out).count() == 0
    prof = read_protected(spark, out.records).select("source").distinct().head()[0]
    assert prof.endswith("a%20b%25c.txt")


def test_files_without_records_leave_a_trace(spark, tmp_dir):
    from vigil.plans.ingest import read_manifest, read_rejects

    src = f"{tmp_dir}/in"
    _write(f"{src}/empty.txt", b"")
    _write(f"{src}/blank.txt", b"\n\n  \n")
    _write(f"{src}/one.txt", b"a@x.test:p\n")
    _write(f"{src}/wide.txt", b"a@x.test:p:q\nb@x.test:p:q\n")
    _write(f"{src}/good.txt", b"a@x.test:p\n\nb@x.test:p\nbad\n")
    for k, (reader, skip) in enumerate((("heads", False), ("scan", False))):
        out = Outputs(f"{tmp_dir}/out{k}")
        ingest_files(spark, src, out, TEST_KEYS, batch_id=0, layout_reader=reader, skip_header=skip)
        m = {os.path.basename(r["source"]): (r["status"], r["loaded"], r["rejected"]) for r in read_manifest(spark, out).collect()}
        assert m == {
            "empty.txt": ("rejected", 0, 0), "blank.txt": ("rejected", 0, 0), "one.txt": ("rejected", 0, 1),
            "wide.txt": ("rejected", 0, 2), "good.txt": ("done", 2, 1),
        }
        r = {os.path.basename(r["source"]): (r["scope"], r["reason"], r["n"]) for r in read_rejects(spark, out).collect()}
        assert r == {
            "empty.txt": ("file", "undetectable", 0), "blank.txt": ("file", "undetectable", 0), "one.txt": ("file", "undetectable", 1),
            "wide.txt": ("file", "record2_fields", 2), "good.txt": ("line", "field_count", 1),
        }
        assert pending_files(spark, src, out).count() == 0


def test_names_with_glob_characters(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", Outputs(f"{tmp_dir}/out")
    _write(f"{src}/a[1]*.txt", b"a@x.test:p\nb@x.test:q\n")
    ingest_files(spark, src, out, TEST_KEYS, batch_id=0)
    _write(f"{src}/b{{2}}, c+d?.txt", b"c@x.test:p\nd@x.test:q\n")
    assert ingest_files(spark, src, out, TEST_KEYS, batch_id=1).count() == 1
    assert read_protected(spark, out.records).count() == 4


def test_crash_between_records_and_manifest(spark, tmp_dir, monkeypatch):
    from vigil.plans import ingest

    src, out = f"{tmp_dir}/in", Outputs(f"{tmp_dir}/out")
    _write(f"{src}/a.txt", b"a@x.test:p\nb@x.test:q\n")
    whole = ingest.write_table

    def dies(df, path, **kw):
        if path == out.rejects:
            raise OSError("lost")
        whole(df, path, **kw)

    monkeypatch.setattr(ingest, "write_table", dies)
    with pytest.raises(OSError):
        ingest_files(spark, src, out, TEST_KEYS, batch_id=0, dedupe=False)
    monkeypatch.undo()
    # written, but not seen before the batch is committed
    assert read_protected(spark, out.records).count() == 2 and ingest.current_records(spark, out).count() == 0
    assert [r["status"] for r in ingest.read_manifest(spark, out).collect()] == ["in-progress"]
    assert pending_files(spark, src, out).count() == 1
    for dedupe in (False, True):
        ingest_files(spark, src, out, TEST_KEYS, batch_id=0, dedupe=dedupe)
        assert read_protected(spark, out.records).count() == 2
        assert [r["status"] for r in ingest.read_manifest(spark, out).collect()] == ["done"]


def test_maintenance_switches_versions(spark, tmp_dir):
    from vigil.plans.ingest import current_records, latest_version

    src, out = f"{tmp_dir}/in", Outputs(f"{tmp_dir}/out")
    limits = maintenance.Thresholds(records=100, files=2, minutes=100)
    _write(f"{src}/a.txt", b"a@x.test:p\na@x.test:p\nb@x.test:q\n")
    ingest_files(spark, src, out, TEST_KEYS, batch_id=0, dedupe=False)
    assert not maintenance.maintain(spark, out, limits) and current_records(spark, out).count() == 3
    _write(f"{src}/b.txt", b"c@x.test:p\nd@x.test:p\n")
    ingest_files(spark, src, out, TEST_KEYS, batch_id=1, dedupe=False)
    assert maintenance.maintain(spark, out, limits)
    assert latest_version(spark, out)[:2] == (1, 1) and current_records(spark, out).count() == 4
    assert not maintenance.maintain(spark, out, limits)
    _write(f"{src}/c.txt", b"e@x.test:p\na@x.test:p\n")
    ingest_files(spark, src, out, TEST_KEYS, batch_id=2)  # beside the merged run
    assert current_records(spark, out).count() == 6 and read_protected(spark, f"{out.records}/run=m1").count() == 4


def test_path_length_counts_the_path(spark):
    from vigil.functions.paths import merge_destination, plain_path, relative

    df = spark.createDataFrame([("file:/d/a%20b+%C3%BC.txt",), ("/plain/%41.txt",), ("s3a://b/x/y%25.txt",)], "p string")
    assert [r[0] for r in df.select(plain_path(F.col("p"))).collect()] == ["/d/a b+\u00fc.txt", "/plain/%41.txt", "/x/y%.txt"]
    df = spark.createDataFrame([("/r/ab/x.jsonl.gz",), ("/other/x.jsonl",)], "p string")
    assert [r[0] for r in df.select(merge_destination(F.col("p"), "/r/", "/t")).collect()] == ["/t/ab/x.jsonl", "/t//other/x.jsonl"]
    assert [r[0] for r in df.select(relative(F.col("p"), "/r")).collect()] == ["ab/x.jsonl.gz", "/other/x.jsonl"]


def test_csv_keeps_odd_sources(spark, tmp_dir):
    recs = spark.createDataFrame(
        [("ab" * 32, "cd" * 32, False, "plaintext", '/d/a "q", b\\x.txt', "ab", "abab")], "id_digest string, secret_digest string,"
        " is_hash boolean, hash_type string, source string, p2 string, p4 string",
    )
    write_protected(recs, f"{tmp_dir}/csv", fmt="csv")
    assert [tuple(r) for r in read_protected(spark, f"{tmp_dir}/csv", fmt="csv").collect()] == [tuple(r) for r in recs.collect()]
