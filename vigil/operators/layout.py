"""Per-file layout inference (WIN-01, PRJ-02, SCL-08, FLT-04/05/09, LIM-01).

The layout of a file is read from its second non-blank line: the delimiter
is ``:`` if the line has one, else ``;`` if it has one, else a space; the
file is rejected when that line splits into more than two fields; the
identifier comes first when the first field looks like ``x@y.z``.  Files
with fewer than two non-blank lines are undetectable.

Only derived flags leave the scan, never line text.  The
``row_number() <= 2`` filter lets Catalyst insert a partial
``WindowGroupLimit`` before the exchange, so each map task ships at most two
rows per file: a file holding a third of all lines costs no more shuffle
than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.text import js_trim

LAYOUT_OK = "ok"
RECORD2_FIELDS = "record2_fields"
UNDETECTABLE = "undetectable"
# Fixed value: the unanchored "looks like an address" test on the first field.
EMAIL_SHAPE_RE = r"\S+@\S+\.\S+"

LINE_ORDER = ("block", "seq")


def delimiter_of(line: F.Column) -> F.Column:
    """``:`` if present, else ``;`` if present, else a single space (SCL-08)."""
    return (
        F.when(line.contains(":"), F.lit(":"))
        .when(line.contains(";"), F.lit(";"))
        .otherwise(F.lit(" "))
    )


def line_flags(line: F.Column) -> list[F.Column]:
    """Layout flags of one trimmed line: blank, delimiter, >2 fields, id first."""
    trimmed = js_trim(line)
    delim = delimiter_of(trimmed)
    return _flags(trimmed, delim, F.split(trimmed, delim, -1))


def _flags(trimmed: F.Column, delim: F.Column, parts: F.Column) -> list[F.Column]:
    first = F.get(parts, 0)
    return [
        F.coalesce(trimmed == F.lit(""), F.lit(True)).alias("_blank"),
        delim.alias("_delim"),
        (F.size(parts) > 2).alias("_wide"),
        # the contains() guards skip the regex for fields that cannot match
        F.when(
            first.contains("@") & first.contains("."),
            js_trim(first).rlike(EMAIL_SHAPE_RE),
        ).otherwise(F.lit(False)).alias("_id_first"),
    ]


def infer_layout(lines: DataFrame, order: Sequence[str] = LINE_ORDER) -> DataFrame:
    """``lines(source, <order...>, line)`` ->
    ``(source, delim, email_first, status, header_at)``.

    One row per source present in ``lines``; ``header_at`` is the position
    (the ``order`` columns) of the first non-blank line, used by
    ``parse_detected(skip_header=True)``.
    """
    order = list(order)
    # Staged projections: a line is trimmed and split once, not for each of its flags.
    trimmed = lines.select("source", *order, js_trim(F.col("line")).alias("_trimmed"))
    delimited = trimmed.withColumn("_delim", delimiter_of(F.col("_trimmed")))
    split = delimited.withColumn("_parts", F.split(F.col("_trimmed"), F.col("_delim"), -1))
    flagged = split.select("source", *order, *_flags(F.col("_trimmed"), F.col("_delim"), F.col("_parts")))
    # Non-blank lines sort first, so row 2 is the second non-blank line when
    # the file has at least two of them.
    w = Window.partitionBy("source").orderBy("_blank", *order)
    top2 = flagged.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 2)
    picked = top2.groupBy("source").agg(
        F.max("_rn").alias("_n"),
        F.max_by(F.struct("_blank", "_delim", "_wide", "_id_first"), "_rn").alias("_r2"),
        F.min_by(F.struct(*[F.col(c) for c in order], F.col("_blank")), "_rn").alias("_r1"),
    )
    found = (F.col("_n") == 2) & ~F.col("_r2._blank")
    status = (
        F.when(~found, F.lit(UNDETECTABLE))
        .when(F.col("_r2._wide"), F.lit(RECORD2_FIELDS))
        .otherwise(F.lit(LAYOUT_OK))
    )
    header = F.when(~F.col("_r1._blank"), F.struct(*[F.col(f"_r1.{c}").alias(c) for c in order]))
    return picked.select(
        "source",
        F.when(found, F.col("_r2._delim")).alias("delim"),
        F.when(status == LAYOUT_OK, F.col("_r2._id_first")).alias("email_first"),
        status.alias("status"),
        header.alias("header_at"),
    )
