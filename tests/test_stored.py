"""Profiles beside runs, bucketed storage, and files of zero bytes in streams."""

import os

import pytest
from pyspark.sql import functions as F

from tests.test_runs import batch, lines_of, write
from vigil.operators import buckets
from vigil.operators.exposure import scheme_profile
from vigil.operators.protect import PROTECTED_SCHEMA, TEST_KEYS
from vigil.plans import ingest, profiles
from vigil.plans.ingest import claim, current_records, ingest_files, load_outcomes, read_manifest, read_rejects
from vigil.plans.maintenance import maintain, remove_replaced
from vigil.plans.runs import Outputs, current_version
from vigil.plans.scenarios import ALWAYS
from vigil.streaming.ingest import files_without_lines, run_available


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def check_profile(spark, out):
    want = scheme_profile(current_records(spark, out))
    assert rows_of(profiles.stored_profile(spark, out).select(*want.columns)) == rows_of(want)
    assert rows_of(profiles.stored_profile(spark, out, max_broadcast_bytes=0).select(*want.columns)) == rows_of(want)


def test_a_stored_profile_equals_the_scan(spark, tmp_dir, monkeypatch):
    out = Outputs(f"{tmp_dir}/out")
    assert profiles.stored_profile(spark, out).count() == 0
    for k in range(3):
        batch(spark, out, k, [f"u{j}@x.test:p{j % 2}" for j in range(4 + k)] * 2, dedupe=False)
        check_profile(spark, out)
        maintain(spark, out, ALWAYS, fanout=2)
        check_profile(spark, out)
        batch(spark, out, k, ["other@x.test:p"], dedupe=False)  # a replay changes nothing
    remove_replaced(spark, out, grace_minutes=0)
    check_profile(spark, out)
    assert os.listdir(out.profiles) == [r.run for r in current_version(spark, out).runs]
    # no file is in two runs, so no record is read
    monkeypatch.setattr(profiles, "read_runs", lambda *_: pytest.fail("records were read"))
    assert profiles.stored_profile(spark, out).agg(F.sum("n_records")).head()[0] == 4 + 5 + 6


def test_a_file_in_several_runs_is_counted_from_them_alone(spark, tmp_dir, monkeypatch):
    out = Outputs(f"{tmp_dir}/out")

    def load(batch_id, source, n):
        lines = lines_of(spark, [(source, k, f"u{k}@x.test:p{batch_id}") for k in range(n)])
        load_outcomes(spark, lines, out, TEST_KEYS, batch_id, mode="first_colon")

    load(0, "/a.txt", 5)
    maintain(spark, out, ALWAYS)
    load(1, "/b.txt", 3)
    maintain(spark, out, ALWAYS)
    load(2, "/a.txt", 7)
    check_profile(spark, out)
    opened = []
    read = profiles.read_runs
    monkeypatch.setattr(profiles, "read_runs", lambda s, o, runs: opened.append(runs) or read(s, o, runs))
    found = {r["source"]: (r["n_records"], r["n_ids"]) for r in profiles.stored_profile(spark, out).collect()}
    assert found == {"/a.txt": (12, 7), "/b.txt": (3, 3)} and opened == [["run=b2", "run=m1"]]
    # a run from before partials were kept is scanned
    for f in os.listdir(f"{out.profiles}/run=m2"):
        os.remove(f"{out.profiles}/run=m2/{f}")
    os.rmdir(f"{out.profiles}/run=m2")
    monkeypatch.undo()
    check_profile(spark, out)


def protected(spark, rows):
    made = [(f"{i:064x}", f"{s:064x}", False, "plaintext", src, "00", "0000") for i, s, src in rows]
    schema = "id_digest string, secret_digest string, is_hash boolean, hash_type string, source string, p2 string, p4 string"
    return spark.createDataFrame(made, schema)


@pytest.fixture()
def table(spark, tmp_dir):
    name = "vigil_t_" + os.path.basename(tmp_dir).replace("-", "_").lower()
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucketed_storage_takes_each_key_once(spark, tmp_dir, table):
    start = protected(spark, [(1, 1, "/a"), (1, 1, "/a"), (1, 2, None), (2, 1, "")])
    buckets.create_bucketed(start, table, f"{tmp_dir}/t", 4)
    assert buckets.bucket_number(spark, table) == 4
    with pytest.raises(ValueError):
        buckets.create_bucketed(start, table, f"{tmp_dir}/t2", 4)
    load = protected(spark, [(1, 1, "/a"), (1, 1, "/b"), (1, 2, None), (2, 1, None), (2, 1, ""), (3, 1, "/a"), (3, 1, "/a")])
    for _ in range(2):  # the second time adds nothing
        buckets.insert_bulk(load, table)
        got = spark.table(table).select("id_digest", "secret_digest", "source")
        assert got.count() == got.distinct().count() == 6
    buckets.append_records(start, table)
    copies = {(int(r["id_digest"], 16), int(r["secret_digest"], 16), r["source"]): r["copies"] for r in buckets.distinct_records(spark, table).collect()}
    assert copies == {(1, 1, "/a"): 3, (1, 2, None): 2, (2, 1, ""): 2, (1, 1, "/b"): 1, (2, 1, None): 1, (3, 1, "/a"): 1}
    assert buckets.absent(spark.createDataFrame([], PROTECTED_SCHEMA), table).count() == 0


def test_bulk_loads_and_dedupe_do_not_move_the_stored_side(spark, tmp_dir, table):
    buckets.create_bucketed(protected(spark, [(k, k % 3, "/a") for k in range(50)]), table, f"{tmp_dir}/t", 4)
    buckets.append_records(protected(spark, [(k, k % 3, "/a") for k in range(60)]), table)
    plan = buckets.distinct_records(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    fresh = buckets.absent(protected(spark, [(k, k % 3, "/a") for k in range(70)]), table)
    text = fresh._jdf.queryExecution().executedPlan().toString()
    lines = text.split("\n")
    scan = next(k for k, l in enumerate(lines) if "Bucketed: true" in l)
    join = next(k for k, l in enumerate(lines) if "LeftAnti" in l)
    depth = lambda l: len(l) - len(l.lstrip(" :+-"))
    above, last = [], depth(lines[scan])
    for l in reversed(lines[join:scan]):
        if depth(l) < last:
            above.append(l)
            last = depth(l)
    assert not any("Exchange" in l for l in above), text
    assert fresh.count() == 10


def test_bucket_numbers_follow_the_records():
    assert [buckets.buckets_for(n) for n in (0, 1, buckets.BUCKET_RECORDS, buckets.BUCKET_RECORDS + 1, 10 * buckets.BUCKET_RECORDS)] == [1, 1, 1, 2, 16]


def manifest_of(spark, out):
    files = {(os.path.basename(r["source"]), r["status"], r["loaded"], r["rejected"]) for r in read_manifest(spark, out).collect()}
    rejects = {(os.path.basename(r["source"]), r["scope"], r["reason"], r["n"]) for r in read_rejects(spark, out).collect()}
    return files, rejects


@pytest.mark.parametrize("mode", ingest.MODES)
def test_stream_and_batch_load_say_the_same_of_every_file(spark, tmp_dir, mode):
    src, a, b = f"{tmp_dir}/in", Outputs(f"{tmp_dir}/batch"), Outputs(f"{tmp_dir}/stream")
    write(f"{src}/a.txt", b"a@x.test:p\nb@x.test:q\nnothing\n")
    write(f"{src}/blank.txt", b"\n\n")
    write(f"{src}/empty.txt", b"")
    write(f"{src}/sub/none at%all.txt", b"")
    ingest_files(spark, src, a, TEST_KEYS, batch_id=0, mode=mode)
    run_available(spark, src, b, f"{tmp_dir}/ck", TEST_KEYS, mode=mode, max_files_per_trigger=2)
    assert manifest_of(spark, a) == manifest_of(spark, b)
    assert len(manifest_of(spark, b)[0]) == 4
    # later ones, alone in their batch, and no file twice
    write(f"{src}/later.txt", b"")
    ingest_files(spark, src, a, TEST_KEYS, batch_id=1, mode=mode)
    run_available(spark, src, b, f"{tmp_dir}/ck", TEST_KEYS, mode=mode)
    assert manifest_of(spark, a) == manifest_of(spark, b)
    assert read_manifest(spark, b).count() == 5


def test_a_retried_stream_batch_keeps_its_empty_files(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", Outputs(f"{tmp_dir}/out")
    write(f"{src}/a.txt", b"a@x.test:p\n")
    write(f"{src}/empty.txt", b"")
    here = spark.createDataFrame([(f"file:{src}/a.txt",)], "source string")
    first = files_without_lines(spark, src, out, 0, here, True)
    claim(spark, out, here.unionByName(first), 0)
    write(f"{src}/late.txt", b"")
    again = [r[0] for r in files_without_lines(spark, src, out, 0, here, True).collect()]
    assert again == [f"file:{src}/empty.txt"]
    assert [r[0] for r in files_without_lines(spark, src, out, 1, here, True).collect()] == [f"file:{src}/late.txt"]
    assert files_without_lines(spark, src, out, 1, here, False).isEmpty()
