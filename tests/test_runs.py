"""The stored dataset: visibility of batches, tiered maintenance, indexes of merged runs, resumable merges."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigil.operators.exposure import exposure_check
from vigil.operators.protect import RECORD_KEY, TEST_KEYS
from vigil.plans import index, ingest, maintenance, runs
from vigil.plans.ingest import claim, current_records, ingest_files, load_outcomes, read_manifest
from vigil.plans.maintenance import maintain, merge_plan, remove_replaced, resumable_merge, shards_left
from vigil.plans.parse_protect import protected_first_colon
from vigil.plans.runs import Outputs, Run, batch_states, current_version, ranges, read_versions
from vigil.plans.scenarios import ALWAYS
from vigil.sinks.shards import write_protected, write_run
from vigil.sources import fixtures
from vigil.sources.shards import read_protected
from vigil.sources.text_files import read_lines


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def lines_of(spark, rows):
    return spark.createDataFrame([(s, 0, k, v) for s, k, v in rows], "source string, block long, seq long, line string")


def batch(spark, out, batch_id, rows, **kw):
    lines = lines_of(spark, [(f"/b{batch_id}.txt", k, v) for k, v in enumerate(rows)])
    return load_outcomes(spark, lines, out, TEST_KEYS, batch_id, mode="first_colon", **kw)


def test_a_batch_replayed_after_maintenance_is_not_loaded_again(spark, tmp_dir):
    out = Outputs(f"{tmp_dir}/out")
    rows = [f"u{k}@x.test:p" for k in range(6)]
    for _ in range(2):
        batch(spark, out, 1, rows, dedupe=False)
        maintain(spark, out, ALWAYS)
    assert current_records(spark, out).count() == 6
    assert [r["version"] for r in read_versions(spark, out).collect()] == [1]


def test_a_crashed_batch_goes_on_when_files_have_arrived(spark, tmp_dir, monkeypatch):
    src, out = f"{tmp_dir}/in", Outputs(f"{tmp_dir}/out")
    write(f"{src}/a.txt", b"a@x.test:p\nb@x.test:q\nc@x.test:q\n")
    write(f"{src}/gone.txt", b"g@x.test:p\nh@x.test:q\n")

    def dies(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(ingest, "commit", dies)
    with pytest.raises(OSError):
        ingest_files(spark, src, out, TEST_KEYS, batch_id=1, dedupe=False)
    monkeypatch.undo()
    assert current_records(spark, out).count() == 0 and batch_states(spark, out) == {1: False}
    assert not maintain(spark, out, ALWAYS)  # nothing committed, nothing to merge
    os.remove(f"{src}/gone.txt")
    write(f"{src}/b.txt", b"d@x.test:p\ne@x.test:q\n")
    ingest_files(spark, src, out, TEST_KEYS, batch_id=2, dedupe=False)
    assert batch_states(spark, out) == {1: True, 2: True}
    found = {os.path.basename(r["source"]): (r["batch_id"], r["status"], r["loaded"]) for r in read_manifest(spark, out).collect()}
    assert found == {"a.txt": (1, "done", 3), "gone.txt": (1, "rejected", 0), "b.txt": (2, "done", 2)}
    reasons = {(os.path.basename(r["source"]), r["reason"]) for r in ingest.read_rejects(spark, out).collect()}
    assert reasons == {("gone.txt", "missing")}
    assert current_records(spark, out).count() == 5
    # the retry by its own id: its files are loaded, the new one is left to the next id
    with pytest.raises(ValueError):
        write(f"{src}/c.txt", b"f@x.test:p\ng@x.test:q\n")
        ingest_files(spark, src, out, TEST_KEYS, batch_id=1)


def test_a_retry_by_its_own_id_leaves_later_files(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", Outputs(f"{tmp_dir}/out")
    write(f"{src}/a.txt", b"a@x.test:p\nb@x.test:q\n")
    lines = read_lines(spark, src)
    claim(spark, out, lines.select("source").distinct(), 1)
    write_run(protected_first_colon(lines, TEST_KEYS), out.path(out.batch_run(1)))
    write(f"{src}/b.txt", b"c@x.test:p\nd@x.test:q\n")
    assert [os.path.basename(r["source"]) for r in ingest_files(spark, src, out, TEST_KEYS, batch_id=1).collect()] == ["a.txt"]
    assert current_records(spark, out).count() == 2
    ingest_files(spark, src, out, TEST_KEYS, batch_id=2)
    assert current_records(spark, out).count() == 4


def test_a_file_without_a_layout_waits_for_the_next_batch(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", Outputs(f"{tmp_dir}/out")
    write(f"{src}/a.txt", b"a@x.test:p\nb@x.test:q\n")
    write(f"{src}/late.txt", b"c@x.test:p\nd@x.test:q\n")
    lines = read_lines(spark, src)
    known = lines.where(F.col("source").endswith("/a.txt"))
    from vigil.operators.layout import infer_layout

    load_outcomes(spark, lines, out, TEST_KEYS, 1, layout=infer_layout(known))
    assert {os.path.basename(r["source"]): r["status"] for r in read_manifest(spark, out).collect()} == {"a.txt": "done", "late.txt": "new"}
    assert ingest.read_rejects(spark, out).count() == 0
    ingest_files(spark, src, out, TEST_KEYS, batch_id=2)
    assert current_records(spark, out).count() == 4


def test_merge_plan_and_ranges():
    def run(level, n):
        return Run(f"run=m{n}", level, 10, ((n, n),))

    assert merge_plan([], 4) == (1, [])
    three = [run(1, k) for k in range(3)]
    assert merge_plan(three, 4) == (2, three)
    assert merge_plan(three[:2], 4) == (1, [])
    both = [run(2, 9), run(1, 1)]
    assert merge_plan(both, 2) == (3, [both[1], both[0]])
    assert ranges([(4, 4), (0, 1), (2, 2), (7, 9)]) == ((0, 2), (4, 4), (7, 9))


def test_tiers_rewrite_each_record_once_a_level(spark, tmp_dir):
    out, n = Outputs(f"{tmp_dir}/out"), 8
    for b in range(n):
        batch(spark, out, b, [f"u{b}-{k}@x.test:p" for k in range(5)], dedupe=False)
        assert maintain(spark, out, ALWAYS, fanout=2)
    written = [r["rewritten"] for r in read_versions(spark, out).orderBy("version").collect()]
    # as a binary counter carries: n log2(n) / 2 + n rows of 5 for n batches, against n (n + 1) / 2 for whole rewrites
    assert [w // 5 for w in written] == [1, 2, 1, 4, 1, 2, 1, 8]
    assert current_records(spark, out).count() == 5 * n and len(current_version(spark, out).runs) == 1


def test_an_aborted_maintenance_changes_nothing(spark, tmp_dir, monkeypatch):
    out = Outputs(f"{tmp_dir}/out")
    batch(spark, out, 0, ["a@x.test:p", "a@x.test:p", "b@x.test:p"], dedupe=False)

    def dies(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(maintenance, "append_version", dies)
    with pytest.raises(OSError):
        maintain(spark, out, ALWAYS)
    monkeypatch.undo()
    assert current_records(spark, out).count() == 3 and current_version(spark, out).version == 0
    batch(spark, out, 1, ["c@x.test:p"])
    assert maintain(spark, out, ALWAYS) and current_records(spark, out).count() == 3


def test_replaced_runs_go_after_the_grace_period(spark, tmp_dir):
    out = Outputs(f"{tmp_dir}/out")
    for b in range(2):
        batch(spark, out, b, [f"u{b}@x.test:p", "same@x.test:p"])
        maintain(spark, out, ALWAYS, fanout=2)
    assert remove_replaced(spark, out) == []
    assert remove_replaced(spark, out, grace_minutes=0) == ["run=b0", "run=b1", "run=m1"]
    assert sorted(d for d in os.listdir(out.records) if d.startswith("run")) == ["run=m2"]
    assert os.listdir(out.filters) == os.listdir(out.zones) == ["run=m2"]
    assert current_records(spark, out).count() == 4


def test_filters_miss_no_key_and_pass_few_others():
    rng = np.random.default_rng(1)
    held, other = (rng.integers(-(1 << 63), (1 << 63) - 1, 20_000) for _ in range(2))
    packed = index.build_filter(held)
    assert index.may_hold(packed, held).all()
    assert index.may_hold(packed, other).mean() < 0.002
    assert not index.may_hold(index.build_filter(held[:0]), other).any()


def test_loads_open_only_directories_that_may_hold_their_keys(spark, tmp_dir):
    out = Outputs(f"{tmp_dir}/out")
    recs = spark.createDataFrame(protected_first_colon(fixtures.raw_lines(spark, SF_SMALL), TEST_KEYS).collect())
    load_outcomes(spark, fixtures.raw_lines(spark, SF_SMALL), out, TEST_KEYS, 0, mode="first_colon")
    maintain(spark, out, ALWAYS)
    whole = current_records(spark, out)
    version = current_version(spark, out)
    # new keys: same identifiers, another source
    absent = recs.withColumn("source", F.lit("/other.txt"))
    possible = index.possible_keys(spark, out, absent, version.runs)
    opened = index.opened_directories(possible)
    stored = [d for d in os.listdir(f"{out.records}/run=m1") if d.startswith("p2=")]
    assert len(opened) <= 0.1 * len(stored)
    fresh = index.new_records(spark, out, absent)
    assert fresh.count() == absent.select(*RECORD_KEY).distinct().count()
    # a mixed batch loses no key and adds none twice
    few = recs.limit(40).unionByName(absent.limit(40))
    got = index.new_records(spark, out, few).select(*RECORD_KEY).collect()
    assert sorted(got) == sorted(absent.limit(40).select(*RECORD_KEY).distinct().collect())
    for bound in (0, 1 << 26):
        assert index.absent_from_runs(spark, out, whole, version.runs, max_broadcast_bytes=bound).count() == 0


def test_lookups_open_the_files_that_hold_their_digests(spark, tmp_dir):
    out = Outputs(f"{tmp_dir}/out")
    lines = fixtures.raw_lines(spark, SF_SMALL)
    load_outcomes(spark, lines.where("seq % 2 = 0"), out, TEST_KEYS, 0, mode="first_colon")
    maintain(spark, out, ALWAYS)
    load_outcomes(spark, lines.where("seq % 2 = 1"), out, TEST_KEYS, 1, mode="first_colon")
    wanted = current_records(spark, out).select("id_digest").distinct().limit(2)
    wanted = spark.createDataFrame([*wanted.collect(), ("0" * 64,)], "id_digest string")
    files, whole = index.lookup_files(spark, out, wanted)
    assert 0 < len(files) <= 3 < whole
    expected = sorted(map(tuple, exposure_check(current_records(spark, out), wanted).collect()), key=str)
    for most in (100, 0):
        found = exposure_check(index.records_to_check(spark, out, wanted, most_files=most), wanted)
        assert sorted(map(tuple, found.collect()), key=str) == expected


def test_a_killed_merge_goes_on_with_what_is_left(spark, tmp_dir, monkeypatch):
    recs = protected_first_colon(fixtures.raw_lines(spark, SF_SMALL), TEST_KEYS)
    paths = [f"{tmp_dir}/r{k}" for k in range(2)]
    for p in paths:
        write_protected(recs, p, mode="errorifexists")
    dst, work = f"{tmp_dir}/merged", f"{tmp_dir}/work"
    whole = maintenance.replace_shards
    calls = []

    def dies(rows, path):
        whole(rows, path)
        calls.append(path)
        if len(calls) == 2:
            raise OSError("killed after the write, before it was marked done")

    every = shards_left(spark, paths, work)
    half = max(1, len(every) // 3)
    monkeypatch.setattr(maintenance, "replace_shards", dies)
    with pytest.raises(OSError):
        resumable_merge(spark, paths, dst, work, slice_size=half)
    monkeypatch.undo()
    left = shards_left(spark, paths, work)
    assert left == every[half:]
    assert resumable_merge(spark, paths, dst, work, slice_size=half) == [] == shards_left(spark, paths, work)
    expected = recs.select(*RECORD_KEY).distinct()
    found = read_protected(spark, dst).select(*RECORD_KEY)
    assert found.count() == expected.count() and found.exceptAll(expected).count() == 0


def test_streams_and_batches_write_the_same_metrics(spark, tmp_dir):
    from vigil.streaming.ingest import run_available

    write(f"{tmp_dir}/in/a.txt", b"a@x.test:p\nb@x.test:q\nbad\n")
    write(f"{tmp_dir}/in/b.txt", b"c@x.test;p\nd@x.test;q\n\n")
    a, b = Outputs(f"{tmp_dir}/a"), Outputs(f"{tmp_dir}/b")
    ingest_files(spark, f"{tmp_dir}/in", a, TEST_KEYS, batch_id=0)
    run_available(spark, f"{tmp_dir}/in", b, f"{tmp_dir}/ckpt", TEST_KEYS)
    for out in (a, b):
        assert [(r["loaded"], r["rejected"]) for r in spark.read.parquet(out.metrics).collect()] == [(4, 1)]
        assert runs.latest_version(spark, out) == (0, -1, None)
