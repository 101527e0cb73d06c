"""Indexes of merged runs: membership filters and digest zones (JON-03, JON-05, EXP-01).

Written by maintenance, once per merged run, in one pass over the run's keys:

- **Filters.**  Per shard directory and part of it, a Bloom filter over 64-bit hashes of the
  record key: ``BITS`` bits a key, so about one absent key in 2,000 passes.  A part
  has about ``PART`` keys, so a filter is at most a few megabytes however large the run.  A load
  probes the filters first; only keys that pass are joined with stored records, and only
  the shard directories that hold such keys are opened.  A filter never misses a
  key, and what passes it is compared in full, so the result is exact.
- **Zones.**  Per data file its least and greatest digest (files are sorted by digest).  A
  lookup opens the files whose zone holds a wanted digest.

Single batches have neither: they are few between two maintenances, and are scanned.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.dedupe import insert_if_absent
from vigil.operators.protect import RECORD_KEY
from vigil.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES, estimate_bytes, materialise
from vigil.plans.runs import Outputs, Run, current_version, loose_runs, read_runs

BITS = 16
HASHES = 11
PART = 1 << 20
#: Small filters are roomier, since their few places make chance hits more likely.
LEAST_BYTES = 512


def _key_hash() -> F.Column:
    return F.xxhash64(*RECORD_KEY)


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The ``HASHES`` bits of each key in a filter of ``size`` bits, from two halves of its hash."""
    h = hashes.astype(np.uint64)
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (a[:, None] + np.arange(HASHES, dtype=np.uint64) * b[:, None]) % np.uint64(size)


def build_filter(hashes: np.ndarray) -> bytes:
    bits = np.zeros(8 * max(LEAST_BYTES, len(hashes) * BITS // 8 + 1), np.uint8)
    bits[_places(hashes, len(bits)).ravel()] = 1
    return np.packbits(bits).tobytes()


def may_hold(packed: bytes, hashes: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8)
    at = _places(hashes, 8 * len(raw))
    return ((raw[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1).all(axis=1)


def _part(parts: F.Column) -> F.Column:
    return F.pmod(F.shiftright("h", 7), parts).cast("int")


def index_run(spark: SparkSession, out: Outputs, run: str) -> None:
    """Filters and zones of one merged run, written beside it."""
    records = read_runs(spark, out, [run])
    keys = records.select("p2", _key_hash().alias("h"))
    counts = materialise(keys.groupBy("p2").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")))  # 256 rows at most

    def build(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[0]
        return pd.DataFrame([(first["p2"], first["part"], first["parts"], build_filter(group["h"].to_numpy()))], columns=["p2", "part", "parts", "bits"])

    dealt = keys.join(F.broadcast(counts), "p2").withColumn("part", _part(F.col("parts")))
    filters = dealt.groupBy("p2", "part").applyInPandas(build, "p2 string, part int, parts int, bits binary")
    filters.write.mode("overwrite").parquet(f"{out.filters}/{run}")
    file = F.regexp_extract("_metadata.file_path", r"(run=[^/]+/p2=[^/]+/[^/]+)$", 1)
    zones = records.groupBy(file.alias("file"), "p2").agg(
        F.min("id_digest").alias("lo"), F.max("id_digest").alias("hi"), F.count(F.lit(1)).alias("records")
    )
    zones.write.mode("overwrite").parquet(f"{out.zones}/{run}")


def read_filters(spark: SparkSession, out: Outputs, runs: Sequence[Run]) -> DataFrame:
    """``run, p2, part, parts, bits`` of merged runs."""
    paths = [f"{out.filters}/{r.run}" for r in runs]
    found = spark.read.schema("p2 string, part int, parts int, bits binary").option("basePath", out.filters).parquet(*paths)
    return found.withColumn("run", F.concat(F.lit("run="), F.col("run").cast("string")))


def possible_keys(spark: SparkSession, out: Outputs, fresh: DataFrame, runs: Sequence[Run]) -> DataFrame:
    """``run`` and the key columns of rows of ``fresh`` that a run's filter does not rule out."""
    filters = read_filters(spark, out, runs)
    sizes = read_filters(spark, out, runs).select("run", "p2", "parts").distinct()  # 256 rows a run at most
    dealt = fresh.select(*RECORD_KEY, "p2", _key_hash().alias("h")).join(F.broadcast(sizes), "p2").withColumn("part", _part(F.col("parts")))

    def probe(keys: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(keys) or not len(found):
            return keys.iloc[:0][["run", "p2", *RECORD_KEY]]
        return keys[may_hold(found["bits"].iat[0], keys["h"].to_numpy())][["run", "p2", *RECORD_KEY]]

    cell = ["run", "p2", "part"]
    schema = "run string, p2 string, " + ", ".join(f"{c} string" for c in RECORD_KEY)
    return dealt.groupBy(*cell).cogroup(filters.select(*cell, "bits").groupBy(*cell)).applyInPandas(probe, schema)


def opened_directories(possible: DataFrame) -> list[str]:
    """The shard directories, 256 a run at most, that hold possible keys."""
    return sorted(f"{r['run']}/p2={r['p2']}" for r in possible.select("run", "p2").distinct().collect())


def absent_from_runs(
    spark: SparkSession, out: Outputs, fresh: DataFrame, runs: Sequence[Run], max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``fresh`` (each key once) whose key none of the merged runs holds."""
    if not runs:
        return fresh
    fresh = materialise(fresh)
    possible = materialise(possible_keys(spark, out, fresh, runs))
    folders = opened_directories(possible)
    if not folders:
        return fresh
    # the exact comparison concerns possible keys and opened directories alone
    doubtful = possible.select(*RECORD_KEY).distinct()
    small = estimate_bytes(doubtful)[1] <= max_broadcast_bytes
    stored = read_runs(spark, out, folders).select(*RECORD_KEY)
    found = stored.join(F.broadcast(doubtful) if small else doubtful, list(RECORD_KEY), "left_semi").distinct()
    return fresh.join(F.broadcast(found) if small else found, list(RECORD_KEY), "left_anti").select(*fresh.columns)


def new_records(spark: SparkSession, out: Outputs, batch: DataFrame) -> DataFrame:
    """Rows of ``batch`` that the dataset does not hold yet, each key once (SNK-03, JON-03)."""
    version = current_version(spark, out)
    loose = loose_runs(spark, out, version)
    fresh = insert_if_absent(batch, read_runs(spark, out, loose) if loose else None)
    return absent_from_runs(spark, out, fresh, version.runs)


def lookup_files(spark: SparkSession, out: Outputs, digests: DataFrame) -> tuple[list[str], int]:
    """(files of merged runs whose zone holds one of the digests, files in all)."""
    version = current_version(spark, out)
    if not version.runs:
        return [], 0
    zones = spark.read.parquet(*[f"{out.zones}/{r.run}" for r in version.runs])
    wanted = digests.select("id_digest", F.substring("id_digest", 1, 2).alias("p2")).distinct()
    met = zones.join(wanted, "p2").where("id_digest BETWEEN lo AND hi").select("file").distinct()
    return sorted(r["file"] for r in met.collect()), zones.count()


#: Beyond so many files a lookup reads the whole runs.
LOOKUP_FILES = 4096


def records_to_check(spark: SparkSession, out: Outputs, digests: DataFrame, most_files: int = LOOKUP_FILES) -> DataFrame:
    """Current records, read only from the files that may hold the digests.

    Beyond ``most_files`` files the whole runs are read: the shard directories and the
    digests that a check pushes into the scan then do the pruning.
    """
    version = current_version(spark, out)
    files, _ = lookup_files(spark, out, digests)
    merged = files if len(files) <= most_files else [r.run for r in version.runs]
    return read_runs(spark, out, [*merged, *loose_runs(spark, out, version)])
