"""Audits of protected data (AUD-01..03, AGG-03/07/08, SCL-15/16).

Constraint checks run as one two-level aggregate (per key, then global),
so duplicate detection and per-column checks share a single scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.classify import COMPAT_NAMES, SCHEMES
from vigil.operators.protect import PROTECTED_SCHEMA, RECORD_KEY

DIGEST_RE = r"^[0-9a-f]{64}\z"
# Load-rate grades in minutes per million rows.
GOOD_MAX_MIN = 30.0
ACCEPTABLE_MAX_MIN = 40.0
ALERT_ABOVE_MIN = 45.0


def constraint_audit(records: DataFrame, key: Sequence[str] = RECORD_KEY) -> DataFrame:
    """One row of violation counts: duplicate keys, nulls, digest format,
    shard-prefix consistency, flag/scheme consistency, unknown schemes."""
    key = list(key)
    payload = [c for c in PROTECTED_SCHEMA.fieldNames() if c in records.columns]
    any_null = F.lit(False)
    for c in payload:
        any_null = any_null | F.col(c).isNull()
    idd, sd = F.col("id_digest"), F.col("secret_digest")
    checks = {
        "n_null_rows": any_null,
        "n_bad_id_digest": ~F.coalesce(idd.rlike(DIGEST_RE), F.lit(False)),
        "n_bad_secret_digest": ~F.coalesce(sd.rlike(DIGEST_RE), F.lit(False)),
        "n_bad_shard": ~F.coalesce(
            (F.col("p2") == F.substring(idd, 1, 2)) & (F.col("p4") == F.substring(idd, 1, 4)), F.lit(False)
        ),
        "n_bad_hash_flag": ~F.coalesce(F.col("is_hash") == (F.col("hash_type") != "plaintext"), F.lit(False)),
        "n_unknown_scheme": ~F.coalesce(F.col("hash_type").isin(*sorted(set(SCHEMES) | set(COMPAT_NAMES))), F.lit(False)),
    }
    per_key = records.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_c"), *[F.count_if(v).alias(n) for n, v in checks.items()]
    )
    return per_key.agg(
        F.sum("_c").cast("bigint").alias("n_rows"),
        F.count_if(F.col("_c") > 1).cast("bigint").alias("n_dup_keys"),
        F.sum(F.when(F.col("_c") > 1, F.col("_c") - 1).otherwise(0)).cast("bigint").alias("n_dup_rows"),
        *[F.sum(n).cast("bigint").alias(n) for n in checks],
    )


def schema_audit(df: DataFrame, expected: T.StructType = PROTECTED_SCHEMA) -> DataFrame:
    """Expected vs actual columns, types and nullability, with observed null counts.

    Files carry no NOT NULL, so nullability is judged on the data: ``status`` is
    ``ok``, ``missing``, ``unexpected``, ``type_mismatch``, or ``has_nulls`` for a
    column that must not be null and is.
    """
    spark = df.sparkSession
    exp = spark.createDataFrame(
        [(f.name, f.dataType.simpleString(), f.nullable) for f in expected.fields],
        "column_name string, type_name string, expected_nullable boolean",
    )
    act = spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column_name string, type_name string"
    )
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    null_counts = agg.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").cast("bigint").alias("n_nulls"))
                    for i, c in enumerate(df.columns)
                ]
            )
        ).alias("_s")
    ).select("_s.*")
    joined = exp.withColumnRenamed("type_name", "expected_type").join(
        act.withColumnRenamed("type_name", "actual_type"), "column_name", "full"
    )
    status = (
        F.when(F.col("actual_type").isNull(), F.lit("missing"))
        .when(F.col("expected_type").isNull(), F.lit("unexpected"))
        .when(F.col("expected_type") != F.col("actual_type"), F.lit("type_mismatch"))
        .when(~F.col("expected_nullable") & (F.col("n_nulls") > 0), F.lit("has_nulls"))
        .otherwise(F.lit("ok"))
    )
    return joined.join(null_counts, "column_name", "left").select(
        "column_name", "expected_type", "actual_type", "expected_nullable", status.alias("status"), "n_nulls"
    )


def minutes_per_million(loaded: F.Column, elapsed_ms: F.Column) -> F.Column:
    """Elapsed minutes per million rows; 0 when nothing loaded."""
    rate = (elapsed_ms / F.lit(60000.0)) / (loaded / F.lit(1e6))
    return F.when(loaded > 0, rate).otherwise(F.lit(0.0))


def grade(rate: F.Column) -> F.Column:
    return (
        F.when(rate <= GOOD_MAX_MIN, F.lit("good"))
        .when(rate <= ACCEPTABLE_MAX_MIN, F.lit("acceptable"))
        .otherwise(F.lit("poor"))
    )


def run_grades(metrics: DataFrame) -> DataFrame:
    """``run_metric`` rows -> rate, grade and alert flag (AUD-03, AGG-03).

    Grade and alert follow the exact rate; the shown rate has one decimal.
    """
    rate = minutes_per_million(F.col("loaded"), F.col("elapsed_ms"))
    return metrics.withColumn("_rate", rate).select(
        *metrics.columns,
        F.round("_rate", 1).alias("min_per_million"),
        grade(F.col("_rate")).alias("grade"),
        (F.col("_rate") > ALERT_ABOVE_MIN).alias("alert"),
    )


def pretty_bytes(n: F.Column) -> F.Column:
    """Human-readable byte size (SCL-16)."""
    units = [(1 << 40, "TB"), (1 << 30, "GB"), (1 << 20, "MB"), (1 << 10, "kB")]
    out = F.concat(n.cast("string"), F.lit(" bytes"))
    for size, name in reversed(units):
        out = F.when(n >= size, F.concat(F.format_number(n / F.lit(size), 1), F.lit(" " + name))).otherwise(out)
    return out


def storage_profile(files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored size of a table, or of its parts ``by`` columns, from its file listing (AGG-09):
    ``(*by, n_files, bytes, size)``; ``files`` is ``list_files`` output."""
    t = files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes"),
    )
    return t.withColumn("size", pretty_bytes(F.col("bytes")))
