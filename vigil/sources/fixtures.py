"""Synthetic credential-shaped lines derived from the ``events`` table.

Every value is synthetic: identifiers use ``example.com`` and secrets are
digests of user ids.  The same derivation is written as DuckDB SQL in
``vigil.oracle`` so each query can be checked against an independent
engine.  Line numbers are dense per event type and come from
:func:`vigil.operators.numbering.number_within` (no one-task-per-type sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.numbering import number_within
from vigil.session import scratch_path

SOLO_SOURCE = "/syn/solo.txt"
SOLO_LINE = "only line"
BLANK_SOURCE = "/syn/blank.txt"
BLANK_LINES = ("", "  ")
# Event type -> line shape (delimiter and column order).
SHAPES = {
    "view": ("ident", ":", "secret", ""),
    "signup": ("ident", ";", "secret", ""),
    "click": ("ident", " ", "secret", ""),
    "error": ("secret", ":", "ident", ""),
    "purchase": ("ident", ":", "secret", ":x"),
}
# Per-event-type k for the synthetic run metrics (alphabetical
# event type order), giving 16.7, 25, 35, 41.7, 46.7 minutes per million.
RUN_K_TENTHS = (10, 15, 21, 25, 28)


def _s(c) -> F.Column:
    return c.cast("string")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def canonical_address(u: F.Column) -> F.Column:
    """The address every identifier form of user ``u`` normalises to."""
    return F.concat(F.lit("user"), _s(u), F.lit("@mail"), _s(u % 9), F.lit(".example.com"))


def _ident(eid: F.Column, u: F.Column) -> F.Column:
    m9 = _s(u % 9)
    us = _s(u)
    k = eid % 4
    return (
        F.when(k == 0, canonical_address(u))
        .when(k == 1, F.concat(F.lit("User"), us, F.lit("+t"), _s(eid % 3), F.lit("@Mail"), m9, F.lit(".example.com")))
        .when(k == 2, F.concat(F.lit("--USER"), us, F.lit("@MAIL"), m9, F.lit(".EXAMPLE.COM")))
        .otherwise(F.concat(F.lit('"user'), us, F.lit("@mail"), m9, F.lit(".example.com")))
    )


def _digests(u: F.Column) -> list[F.Column]:
    return [F.md5(F.concat(F.lit(c), _s(u))).alias(f"_md5_{c}") for c in "abs"]


def _secret(eid: F.Column, u: F.Column) -> F.Column:
    us = _s(u)
    md5_a, md5_b, md5_s = [F.col(f"_md5_{c}") for c in "abs"]  # see _digests
    k = eid % 12
    return (
        F.when(k == 0, F.concat(F.lit("pw"), _s(eid % 50)))
        .when(k == 1, md5_s)
        .when(k == 2, F.upper(F.sha1(F.concat(F.lit("s"), us))))
        .when(k == 3, F.concat(F.lit("$2b$10$"), md5_a, F.substring(md5_b, 1, 21)))
        .when(k == 4, F.concat(md5_a, md5_b))
        .when(k == 5, F.concat(F.lit("{SHA}"), F.substring(md5_s, 1, 27), F.lit("=")))
        .when(k == 6, F.concat(F.lit("$argon2id$v=19$m=65536,t=2,p=1$"), F.substring(md5_a, 1, 16), F.lit("$"), md5_b))
        .when(k == 7, F.concat(F.lit("$1$"), F.substring(md5_a, 1, 8), F.lit("$"), F.substring(md5_b, 1, 22)))
        .when(k == 8, F.concat(F.lit("$5$"), F.substring(md5_a, 1, 16), F.lit("$"), md5_b))
        .when(k == 9, F.concat(F.lit("$6$"), F.substring(md5_a, 1, 16), F.lit("$"), md5_a, md5_b))
        .when(k == 10, F.concat(F.lit("{SSHA}"), F.substring(md5_s, 1, 30), F.lit("==")))
        .otherwise(F.concat(md5_a, md5_b, md5_s, md5_a))
    )


def _shaped(event_type: F.Column, ident: F.Column, secret: F.Column) -> F.Column:
    out = None
    for et, (first, delim, second, tail) in SHAPES.items():
        a = ident if first == "ident" else secret
        b = ident if second == "ident" else secret
        line = F.concat(a, F.lit(delim), b, F.lit(tail))
        out = F.when(event_type == et, line) if out is None else out.when(event_type == et, line)
    return out


def _perturbed(line: F.Column, line_no: F.Column, eid: F.Column) -> F.Column:
    k = eid % 97
    late = line_no > 2
    return (
        F.when(late & (k == 0), F.lit(""))
        .when(late & (k == 1), F.concat(line, F.lit(":extra:x")))
        .when(late & (k == 2), F.concat(F.lit("\u0007"), line))
        .when(late & (k == 3), F.lit(":"))
        .when(late & (k == 4), F.rpad(line, 5000, "x"))
        .otherwise(line)
    )


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("event_id", "user_id", "event_type")
    return number_within(ev, ["event_type"], "event_id", out="line_no")


_PLANS: dict[tuple, DataFrame] = {}


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, block, seq, line)``: one line per event, a one-line file and a file of blank lines.

    ``seq`` is the dense line number within the source; ``block`` is 0.
    The (lazy) plan object is reused per session and directory:
    building it costs hundreds of driver round trips; no data is cached.
    """
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _PLANS:
        _PLANS[key] = _raw_lines(spark, sf_dir)
    return _PLANS[key]


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_lines`` for a query that reads them several times: the events are numbered once.

    The numbered events (ids, types and numbers, no line) are written to a scratch folder of
    the caller; the lines are derived from them at each read.
    """
    path = scratch_path(spark, "numbered")
    numbered = numbered_events(spark, sf_dir)
    numbered.write.parquet(path)
    return _lines_of(spark, spark.read.schema(numbered.schema).parquet(path))


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_of(spark, numbered_events(spark, sf_dir))


def _lines_of(spark: SparkSession, ev: DataFrame) -> DataFrame:
    eid, u = F.col("event_id"), F.col("user_id")
    # Staged projections keep each generated expression to one copy, and the generated
    # method within the 8,000 bytes of bytecode that the JVM compiles.
    digested = ev.select("event_id", "user_id", "event_type", "line_no", *_digests(u))
    parts = digested.select(
        "event_id", "user_id", "event_type", "line_no",
        _ident(eid, u).alias("_ident"),
        _secret(eid, u).alias("_secret"),
    )
    shaped = parts.select(
        "event_id", "user_id", "event_type", "line_no",
        _shaped(F.col("event_type"), F.col("_ident"), F.col("_secret")).alias("_line"),
    )
    base = shaped.select(
        F.concat(F.lit("/syn/"), F.col("event_type"), F.lit(".txt")).alias("source"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("line_no").alias("seq"),
        _perturbed(F.col("_line"), F.col("line_no"), eid).alias("line"),
    )
    fixed = [(SOLO_SOURCE, 1, SOLO_LINE), *((BLANK_SOURCE, k, line) for k, line in enumerate(BLANK_LINES, 1))]
    rows = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(k).cast("bigint").alias("seq"), F.lit(v).alias("line")) for s, k, v in fixed])
    few = spark.range(1).select(F.explode(rows).alias("r")).select(
        "r.source", F.lit(0).cast("bigint").alias("block"), "r.seq", "r.line"
    )
    return base.unionByName(few)


def watch_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical addresses of the users a caller monitors (every tenth user)."""
    return (
        events(spark, sf_dir)
        .where(F.col("user_id") % 10 == 0)
        .select(canonical_address(F.col("user_id")).alias("address"))
        .distinct()
    )


# Addresses in the watchlist that match no record.
UNSEEN_ADDRESSES = ("nobody1@example.test", "nobody2@example.test", "nobody3@example.test")
