"""Session construction and shared-storage locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from vigil.functions.digest import ensure_redaction

# Settings every vigil job relies on.  Partition type inference is off so the
# hex shard directories (``p2=00``) stay strings; AQE re-plans joins and
# splits skewed partitions at runtime.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parse, HMAC and regex work is CPU-bound per line: keep small
    # post-shuffle stages spread over the cores (large inputs reach the
    # advisory partition size anyway, so this only matters at small scale).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Broadcasts only from measured sizes: explicit hints after a size check,
    # or AQE's runtime conversion, which sees the materialised shuffle size.
    # Static planning from estimated statistics never broadcasts.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    # Each batch checkpoints its digest-only intermediates; let Spark delete
    # those files once the DataFrames are unreachable so a long-running
    # stream does not grow the checkpoint folder without bound.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "vigil", **conf: str) -> SparkSession:
    """Session for local runs and tests.  On a cluster, pass no master and let
    spark-submit decide; the settings above are applied only where unset."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SESSION_DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_redaction(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names (``spark.checkpoint.dir``).

    Only when a local session names none (tests) is a private temporary folder
    created; on a cluster that would put parts on each node's own disk, so
    there the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="vigil-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint root for job-owned files."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/vigil-{label}-{uuid.uuid4().hex[:12]}"


__all__ = ["build_session", "checkpoint_root", "scratch_path"]
