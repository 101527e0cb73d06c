"""Batch loads cut into bounded batches, sizes by part, heads, and a stream that finds its stop file."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vigil.operators.audit import storage_profile
from vigil.operators.protect import TEST_KEYS
from vigil.plans import ingest
from vigil.plans.ingest import current_records, in_slices, ingest_files, read_manifest
from vigil.plans.runs import Outputs, batch_states
from vigil.sources.text_files import list_files


def fill(folder, names):
    os.makedirs(folder, exist_ok=True)
    for name in names:
        with open(f"{folder}/{name}.txt", "w") as f:
            f.write(f"{name}@x.test:p\n{name}b@x.test:q\n")


def files_of(spark, out):
    return Counter(r["batch_id"] for r in read_manifest(spark, out).collect())


@pytest.mark.parametrize("n, most", [(0, 3), (1, 3), (7, 3), (9, 3), (40, 1)])
def test_slices_are_full_but_for_the_last(spark, n, most):
    files = spark.createDataFrame([(f"file:/in/{k % 20}/{k}.txt",) for k in range(n)], "source string")
    cut = in_slices(files, most)
    sizes = Counter(r["slice"] for r in cut.collect())
    assert sorted(sizes) == list(range(-(-n // most)))
    assert all(sizes[k] == most for k in range(n // most)) and sum(sizes.values()) == n
    assert cut.columns == ["source", "slice"]


def test_a_folder_is_loaded_in_batches_once(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", Outputs(f"{tmp_dir}/out")
    fill(src, "abcde")
    loaded = ingest_files(spark, src, out, TEST_KEYS, batch_id=4, files_per_batch=2)
    assert Counter(r["batch_id"] for r in loaded.collect()) == {4: 2, 5: 2, 6: 1} == files_of(spark, out)
    assert {r["status"] for r in loaded.collect()} == {"done"}
    assert current_records(spark, out).count() == 10
    # a later load takes ids that are free, and only what is new
    fill(src, "fgh")
    ingest_files(spark, src, out, TEST_KEYS, batch_id=3, files_per_batch=1)
    assert files_of(spark, out) == {3: 1, 4: 2, 5: 2, 6: 1, 7: 1, 8: 1}
    assert current_records(spark, out).count() == 16
    assert ingest_files(spark, src, out, TEST_KEYS, batch_id=20, files_per_batch=1).count() == 0
    with pytest.raises(ValueError):
        ingest_files(spark, src, out, TEST_KEYS, batch_id=21, files_per_batch=0)


def test_a_load_that_dies_between_batches_goes_on(spark, tmp_dir, monkeypatch):
    src, out = f"{tmp_dir}/in", Outputs(f"{tmp_dir}/out")
    fill(src, "abcde")
    commit, calls = ingest.commit, []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        commit(*args)

    monkeypatch.setattr(ingest, "commit", dies)
    with pytest.raises(OSError):
        ingest_files(spark, src, out, TEST_KEYS, batch_id=0, files_per_batch=2, dedupe=False)
    monkeypatch.undo()
    assert batch_states(spark, out) == {0: True, 1: False}
    assert current_records(spark, out).count() == 4
    fill(src, "f")  # the second batch keeps its own two files
    ingest_files(spark, src, out, TEST_KEYS, batch_id=2, files_per_batch=3, dedupe=False)
    assert files_of(spark, out) == {0: 2, 1: 2, 2: 2}
    assert current_records(spark, out).count() == 12


def test_sizes_by_part(spark, tmp_dir):
    fill(f"{tmp_dir}/one", "ab")
    os.makedirs(f"{tmp_dir}/two")
    with open(f"{tmp_dir}/two/c.TXT", "w") as f:
        f.write("c" * 1219)
    files = list_files(spark, [f"{tmp_dir}/one", f"{tmp_dir}/two"])
    part = F.regexp_extract("source", "/(one|two)/", 1).alias("part")
    found = {r["part"]: tuple(r)[1:] for r in storage_profile(files.select(part, "length"), ["part"]).collect()}
    assert found == {"one": (2, 46, "46 bytes"), "two": (1, 1219, "1.2 kB")}
    assert storage_profile(files).columns == ["n_files", "bytes", "size"]
    assert tuple(storage_profile(files.limit(0)).first()) == (0, 0, "0 bytes")
