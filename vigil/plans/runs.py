"""A dataset's stored runs, and which of them readers see (SNK-04, SNK-06, SRC-06).

A run is one folder of protected records, ``records/<run>/p2=xx/...``, written once and
never changed.  Each load batch is a run (``run=b<batch>``); maintenance
merges runs into larger ones (``run=m<version>``).  Two small tables say what counts:

- ``manifest``: a batch is *committed* when it has rows there and none of them is in
  progress.  What an unfinished batch has written is not seen by readers, loads or
  maintenance, and its retry replaces it.
- ``versions``: one row per maintenance, with the merged runs that are current after it,
  the batches each of them holds, and the runs it replaced.  The row is a single file, so
  a version is there as a whole or not at all.

Current records are the merged runs of the last version and the committed
batches that none of them holds.  The driver holds one entry per run and batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.protect import PROTECTED_COLUMNS, PROTECTED_SCHEMA

# A file's status.  A rejected file was read and could not be loaded as a whole; a new one
# has not been loaded, though a batch may have met it.
NEW, IN_PROGRESS, DONE, REJECTED = "new", "in-progress", "done", "rejected"
PROCESSED = (DONE, REJECTED)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("loaded", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

_RANGES = "array<struct<lo:bigint,hi:bigint>>"
_RUN = f"struct<run:string,level:int,records:bigint,batches:{_RANGES}>"
VERSION_SCHEMA = f"version bigint, maintained_at timestamp, rewritten bigint, runs array<{_RUN}>, replaced array<string>"


@dataclass(frozen=True)
class Outputs:
    """Locations of one dataset's tables under a shared root."""

    root: str

    @property
    def records(self) -> str:
        """All runs, current or not; see ``current_records`` for what readers see."""
        return f"{self.root}/records"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    @property
    def metrics(self) -> str:
        return f"{self.root}/run_metrics"

    @property
    def versions(self) -> str:
        return f"{self.root}/versions"

    @property
    def filters(self) -> str:
        return f"{self.root}/filters"

    @property
    def zones(self) -> str:
        return f"{self.root}/zones"

    @property
    def profiles(self) -> str:
        return f"{self.root}/profiles"

    def batch_run(self, batch_id: int) -> str:
        return f"run=b{batch_id}"

    def merged_run(self, version: int) -> str:
        return f"run=m{version}"

    def path(self, run: str) -> str:
        return f"{self.records}/{run}"


@dataclass(frozen=True)
class Run:
    """A merged run: its folder, its level, its records, and the batches it holds (inclusive ranges)."""

    run: str
    level: int
    records: int
    batches: tuple[tuple[int, int], ...]

    def holds(self, batch_id: int) -> bool:
        return any(lo <= batch_id <= hi for lo, hi in self.batches)


@dataclass(frozen=True)
class Version:
    version: int = 0
    maintained_at: object = None
    runs: tuple[Run, ...] = field(default_factory=tuple)

    def holds(self, batch_id: int) -> bool:
        return any(r.holds(batch_id) for r in self.runs)

    @property
    def through(self) -> int:
        """The largest batch that a merged run holds, -1 before any maintenance."""
        return max((hi for r in self.runs for _, hi in r.batches), default=-1)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


def ranges(held: Iterable[tuple[int, int]]) -> tuple[tuple[int, int], ...]:
    """Sorted, disjoint ranges (both ends included) of the batch ids that the given ranges hold."""
    out: list[list[int]] = []
    for lo, hi in sorted(held):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return tuple((lo, hi) for lo, hi in out)


def read_manifest(spark: SparkSession, out: Outputs) -> DataFrame:
    """Manifest rows (empty when nothing was claimed yet)."""
    if not path_exists(spark, out.manifest):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(out.manifest)


def read_versions(spark: SparkSession, out: Outputs) -> DataFrame:
    if not path_exists(spark, out.versions):
        return spark.createDataFrame([], VERSION_SCHEMA)
    return spark.read.schema(VERSION_SCHEMA).parquet(out.versions)


def current_version(spark: SparkSession, out: Outputs) -> Version:
    row = read_versions(spark, out).orderBy(F.col("version").desc()).head()
    if row is None:
        return Version()
    runs = tuple(Run(r["run"], r["level"], r["records"], tuple((b["lo"], b["hi"]) for b in r["batches"])) for r in row["runs"])
    return Version(row["version"], row["maintained_at"], runs)


def latest_version(spark: SparkSession, out: Outputs) -> tuple[int, int, object]:
    """(version, last batch that maintenance covered, when): (0, -1, None) before any maintenance."""
    v = current_version(spark, out)
    return v.version, v.through, v.maintained_at


def append_version(spark: SparkSession, out: Outputs, version: int, rewritten: int, runs: Iterable[Run], replaced: Iterable[str]) -> None:
    rows = [(r.run, r.level, r.records, [(lo, hi) for lo, hi in r.batches]) for r in runs]
    row = spark.createDataFrame([(version, None, rewritten, rows, list(replaced))], VERSION_SCHEMA)
    row.withColumn("maintained_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(out.versions)


def batch_states(spark: SparkSession, out: Outputs) -> dict[int, bool]:
    """Batch id -> whether it is committed, of every batch that has claimed files."""
    open_files = F.count_if(F.col("status") == IN_PROGRESS)
    return {r["batch_id"]: r["n"] == 0 for r in read_manifest(spark, out).groupBy("batch_id").agg(open_files.alias("n")).collect()}


def is_committed(spark: SparkSession, out: Outputs, batch_id: int) -> bool:
    if not path_exists(spark, f"{out.manifest}/batch_id={batch_id}"):
        return False
    rows = read_manifest(spark, out).where(F.col("batch_id") == batch_id)
    return rows.agg(F.count_if(F.col("status") == IN_PROGRESS)).head()[0] == 0


def loose_batches(spark: SparkSession, out: Outputs, version: Version) -> list[int]:
    """Committed batches that no merged run holds."""
    return sorted(b for b, ok in batch_states(spark, out).items() if ok and not version.holds(b))


def loose_runs(spark: SparkSession, out: Outputs, version: Version) -> list[str]:
    """Runs of committed batches that no merged run holds; a batch without any line has written none."""
    return [r for b in loose_batches(spark, out, version) if path_exists(spark, out.path(r := out.batch_run(b)))]


def current_runs(spark: SparkSession, out: Outputs) -> list[str]:
    version = current_version(spark, out)
    return [*(r.run for r in version.runs), *loose_runs(spark, out, version)]


def read_runs(spark: SparkSession, out: Outputs, parts: Sequence[str]) -> DataFrame:
    """Records of runs, or of single shard directories or files (``run=.../p2=...``) of them."""
    if not parts:
        return spark.createDataFrame([], PROTECTED_SCHEMA)
    found = spark.read.schema(PROTECTED_SCHEMA).option("basePath", out.records).parquet(*[out.path(p) for p in parts])
    return found.select(*PROTECTED_COLUMNS)


def current_records(spark: SparkSession, out: Outputs) -> DataFrame:
    """The records of all committed batches."""
    return read_runs(spark, out, current_runs(spark, out))
