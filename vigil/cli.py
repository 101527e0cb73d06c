"""Command line for the vigil jobs (``python -m vigil <command> ...`` or
``spark-submit vigil/cli.py <command> ...``).

Keys are read from one-line hex files on shared storage.  Lookup results
are written to ``--output`` (never collected to the driver); audits print
their single summary row.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from vigil.functions.digest import HmacKey
from vigil.operators import audit, exposure
from vigil.operators.protect import Keys
from vigil.plans import ingest, maintenance, profiles
from vigil.plans.index import records_to_check
from vigil.plans.runs import current_runs
from vigil.session import build_session
from vigil.sources.shards import read_protected


def _keys(spark: SparkSession, a: argparse.Namespace) -> Keys:
    return Keys(HmacKey.from_file(spark, a.id_key), HmacKey.from_file(spark, a.secret_key))


def _write(df: DataFrame, path: str, fmt: str) -> None:
    w = df.write.mode("errorifexists")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.parquet(path)


def _read_digests(spark: SparkSession, path: str, column: str) -> DataFrame:
    if path.endswith(".csv"):
        return spark.read.option("header", "true").csv(path).select(column)
    return spark.read.parquet(path).select(column)


def _k(text: str) -> int:
    k = int(text)
    if k < 2:
        raise argparse.ArgumentTypeError("must be 2 or more")
    return k


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vigil")
    p.add_argument("--master", help="Spark master for local runs (omit under spark-submit)")
    sub = p.add_subparsers(dest="command", required=True)

    def keyed(sp: argparse.ArgumentParser) -> None:
        sp.add_argument("--id-key", required=True, help="file holding the identifier key (64 hex)")
        sp.add_argument("--secret-key", required=True, help="file holding the secret key (64 hex)")

    def stored(sp: argparse.ArgumentParser) -> None:
        where = sp.add_mutually_exclusive_group(required=True)
        where.add_argument("--out", help="dataset root: the records of its committed batches")
        where.add_argument("--records", help="a folder of shards")

    s = sub.add_parser("ingest", help="load text files once as one batch")
    s.add_argument("--input", required=True, nargs="+")
    s.add_argument("--out", required=True, help="dataset root (records, rejects, manifest, run_metrics)")
    s.add_argument("--batch-id", type=int, required=True)
    s.add_argument("--mode", choices=ingest.MODES, default="detected")
    s.add_argument("--no-dedupe", action="store_true")
    s.add_argument("--compat", action="store_true")
    s.add_argument("--skip-header", action="store_true")
    s.add_argument("--files-per-batch", type=int, default=ingest.FILES_PER_BATCH,
                   help="more files than that are loaded as several batches")
    s.add_argument("--layout-reader", choices=ingest.LAYOUT_READERS,
                   help="heads (default, but with --skip-header): read only each file's head for layout inference")
    keyed(s)

    s = sub.add_parser("stream", help="incremental, exactly-once ingestion of a folder")
    s.add_argument("--input", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--mode", choices=ingest.MODES, default="detected")
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--max-bytes-per-trigger", help='e.g. "200g"; instead of a number of files')
    s.add_argument("--maintain", action="store_true", help="compact and deduplicate after batches that make it due")
    s.add_argument("--processing-time", help='e.g. "2 seconds"; default: drain what is there and stop')
    s.add_argument("--stop-file", help="stop gracefully when this path appears")
    s.add_argument("--no-dedupe", action="store_true")
    s.add_argument("--compat", action="store_true")
    s.add_argument("--skip-header", action="store_true")
    keyed(s)

    s = sub.add_parser("pending", help="list files not yet loaded")
    s.add_argument("--input", required=True, nargs="+")
    s.add_argument("--out", required=True)
    s.add_argument("--output", required=True)

    s = sub.add_parser("dedupe", help="global dedupe of stored shards into a new location")
    s.add_argument("--src", required=True)
    s.add_argument("--dst", required=True)
    s.add_argument("--format", choices=("parquet", "json"), default="parquet")

    s = sub.add_parser("merge", help="merge shard roots (deduplicated) into a new location")
    s.add_argument("--roots", required=True, nargs="+")
    s.add_argument("--dst", required=True)
    s.add_argument("--format", choices=("parquet", "json"), default="parquet")
    s.add_argument("--keep-duplicates", action="store_true")

    s = sub.add_parser("compact", help="rewrite shards (e.g. to gzip JSON or zstd Parquet)")
    s.add_argument("--src", required=True)
    s.add_argument("--dst", required=True)
    s.add_argument("--src-format", choices=("parquet", "json"), default="parquet")
    s.add_argument("--format", choices=("parquet", "json", "csv"), default="parquet")
    s.add_argument("--compression")

    s = sub.add_parser("protect-legacy", help="legacy clear-text JSONL shards -> protected shards")
    s.add_argument("--roots", required=True, nargs="+")
    s.add_argument("--dst", required=True)
    keyed(s)

    s = sub.add_parser("check", help="exposure check for a table of id_digest values")
    stored(s)
    s.add_argument("--watchlist", required=True, help="parquet or .csv with an id_digest column")
    s.add_argument("--output", required=True)
    s.add_argument("--output-format", choices=("parquet", "csv"), default="csv")

    s = sub.add_parser("range", help="k-anonymous range lookup for 4-hex prefixes")
    stored(s)
    s.add_argument("--prefixes", required=True, help="parquet or .csv with a prefix column")
    s.add_argument("--k", type=_k, default=2, help="identifiers a bucket must hold, at least 2")
    s.add_argument("--output", required=True)
    s.add_argument("--output-format", choices=("parquet", "csv"), default="csv")

    s = sub.add_parser("profile", help="records and identifiers per source and scheme")
    stored(s)
    s.add_argument("--output", required=True)
    s.add_argument("--output-format", choices=("parquet", "csv"), default="csv")

    s = sub.add_parser("audit", help="constraint and schema audit of stored records")
    stored(s)

    s = sub.add_parser("storage", help="stored size of a table (files and bytes)")
    s.add_argument("--path", required=True)
    s.add_argument("--glob", default="*", help="file name pattern, e.g. *.parquet")

    s = sub.add_parser("maintenance-due", help="is compaction due since the last one (or a batch id)?")
    s.add_argument("--out", required=True)
    s.add_argument("--since-batch", type=int)

    s = sub.add_parser("maintain", help="compact and deduplicate into the next version, if that is due")
    s.add_argument("--out", required=True)
    for name in ("records", "files", "minutes"):
        s.add_argument(f"--{name}", type=int, default=getattr(maintenance.Thresholds(), name))

    s = sub.add_parser("remove-replaced", help="delete runs that maintenance has replaced")
    s.add_argument("--out", required=True)
    s.add_argument("--grace-minutes", type=float, default=maintenance.GRACE_MINUTES, help="keep what was replaced later than that")

    s = sub.add_parser("where", help="folders of a dataset's current records")
    s.add_argument("--out", required=True)
    return p


def _stored(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return read_protected(spark, a.records) if a.records else ingest.current_records(spark, ingest.Outputs(a.out))


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    c = a.command
    if c == "ingest":
        ingest.ingest_files(
            spark, a.input, ingest.Outputs(a.out), _keys(spark, a), a.batch_id,
            mode=a.mode, dedupe=not a.no_dedupe, compat=a.compat, skip_header=a.skip_header,
            layout_reader=a.layout_reader, files_per_batch=a.files_per_batch,
        )
    elif c == "stream":
        from vigil.streaming.ingest import run_until_stopped, start_ingest

        q = start_ingest(
            spark, a.input, ingest.Outputs(a.out), a.checkpoint, _keys(spark, a), mode=a.mode,
            max_files_per_trigger=a.max_files_per_trigger, processing_time=a.processing_time,
            dedupe=not a.no_dedupe, compat=a.compat, skip_header=a.skip_header,
            max_bytes_per_trigger=a.max_bytes_per_trigger,
            limits=maintenance.Thresholds() if a.maintain else None,
        )
        if a.stop_file:
            run_until_stopped(spark, q, a.stop_file)
            if q.exception() is not None:
                raise q.exception()
        else:
            q.awaitTermination()
    elif c == "pending":
        _write(ingest.pending_files(spark, a.input, ingest.Outputs(a.out)), a.output, "csv")
    elif c == "dedupe":
        maintenance.dedupe_shards(spark, a.src, a.dst, fmt=a.format)
    elif c == "merge":
        maintenance.merge_shard_roots(spark, a.roots, a.dst, fmt=a.format, dedupe=not a.keep_duplicates)
    elif c == "compact":
        maintenance.compact(spark, a.src, a.dst, src_fmt=a.src_format, fmt=a.format, compression=a.compression)
    elif c == "protect-legacy":
        bad = maintenance.protect_legacy_shards(spark, a.roots, a.dst, _keys(spark, a))
        bad.show(truncate=False)
    elif c == "check":
        wl = _read_digests(spark, a.watchlist, "id_digest")
        recs = _stored(spark, a) if a.records else records_to_check(spark, ingest.Outputs(a.out), wl)
        _write(exposure.exposure_check(recs, wl), a.output, a.output_format)
    elif c == "range":
        px = _read_digests(spark, a.prefixes, "prefix")
        _write(exposure.prefix_range(_stored(spark, a), px, k=a.k), a.output, a.output_format)
    elif c == "profile":
        if a.out:
            found = profiles.stored_profile(spark, ingest.Outputs(a.out))
        else:
            found = exposure.scheme_profile(_stored(spark, a))
        _write(found, a.output, a.output_format)
    elif c == "audit":
        recs = _stored(spark, a)
        audit.constraint_audit(recs).show(vertical=True, truncate=False)
        audit.schema_audit(recs).orderBy("column_name").show(truncate=False)
    elif c == "storage":
        from vigil.sources.text_files import list_files

        audit.storage_profile(list_files(spark, a.path, glob=a.glob)).show(truncate=False)
    elif c == "maintenance-due":
        out = ingest.Outputs(a.out)
        _, since, when = ingest.latest_version(spark, out)
        if a.since_batch is not None:
            since, when = a.since_batch, None
        maintenance.maintenance_due(ingest.read_manifest(spark, out), since, since_time=when).show(truncate=False)
    elif c == "maintain":
        limits = maintenance.Thresholds(a.records, a.files, a.minutes)
        print("maintained" if maintenance.maintain(spark, ingest.Outputs(a.out), limits) else "not due")
    elif c == "remove-replaced":
        print("\n".join(maintenance.remove_replaced(spark, ingest.Outputs(a.out), a.grace_minutes)))
    elif c == "where":
        out = ingest.Outputs(a.out)
        print("\n".join(out.path(r) for r in current_runs(spark, out)))
    return 0


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(argv)
    own = spark is None
    if own:
        spark = build_session(a.master, app=f"vigil-{a.command}")
        spark.sparkContext.setLogLevel("WARN")
    try:
        return run(spark, a)
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
