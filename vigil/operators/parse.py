"""Line parsing into transient ``(ident, secret)`` plus a reject reason.

Two modes:

* :func:`parse_detected` - per-file layout (delimiter and column order)
  applied through a size-checked broadcast join; control characters are
  stripped, fields split and trimmed, and each line is accepted or counted
  under ``field_count`` / ``empty_field`` / ``oversize``.  Lines of rejected
  or undetectable files are counted under the file's status, lines of files
  without any layout under ``no_layout``.
* :func:`parse_first_colon` - split at the first ``:``; the secret keeps its
  raw text; lines without a separator or without ``@`` are counted.

Blank lines are skipped silently, as in both reference modes.  ``ident`` and
``secret`` are clear text and must be protected (see ``protect``) before
any shuffle, cache or sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.paths import plain_path
from vigil.functions.text import js_trim, lower_trim, strip_controls, utf16_length
from vigil.operators.layout import LAYOUT_OK, RECORD2_FIELDS, UNDETECTABLE
from vigil.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES, materialise

FIELD_COUNT = "field_count"
EMPTY_FIELD = "empty_field"
OVERSIZE = "oversize"
NO_SEPARATOR = "no_separator"
NO_AT = "no_at"
BLANK = "blank"  # silent: never counted as a reject
SCOPE_LINE = "line"
SCOPE_FILE = "file"
# Fixed value: combined length limit of identifier, secret and source path.
MAX_RECORD_CHARS = 4000

PARSED_COLUMNS = ["source", "block", "seq", "ident", "secret", "scope", "reason"]


def _oversize(ident: F.Column, secret: F.Column, source: F.Column, limit: int) -> F.Column:
    # UTF-16 units (what the limit counts) never exceed UTF-8 bytes, and a path
    # is never longer than its encoded URI, so the exact count is only computed
    # for the few rows above the byte bound.
    octets = F.octet_length(ident) + F.octet_length(secret) + F.octet_length(source)
    units = utf16_length(ident) + utf16_length(secret) + utf16_length(plain_path(source))
    return F.when(octets <= limit, F.lit(False)).otherwise(units > limit)


# The status of lines whose file has no layout row (it came after the layout pass).
NO_LAYOUT = "no_layout"
# Packed layout code = status index * 8 + delimiter index * 2 + id-first bit.
STATUS_CODES = (LAYOUT_OK, RECORD2_FIELDS, UNDETECTABLE)
DELIM_CODES = (":", ";", " ")


def _packed(layout: DataFrame) -> F.Column:
    status = F.array_position(F.array(*[F.lit(x) for x in STATUS_CODES]), F.col("status")) - 1
    delim = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in DELIM_CODES]), F.col("delim")) - 1, F.lit(0))
    first = F.coalesce(F.col("email_first").cast("int"), F.lit(0))
    return (status * 8 + delim * 2 + first).cast("int")


def _unpacked(code: F.Column) -> list[F.Column]:
    named = F.element_at(F.array(*[F.lit(x) for x in STATUS_CODES]), F.shiftright(code, 3) + 1)
    # asked of the code itself: Spark takes an element of such an array to be never null
    status = F.when(code.isNull(), F.lit(NO_LAYOUT)).otherwise(named)
    delim = F.element_at(F.array(*[F.lit(x) for x in DELIM_CODES]), F.shiftright(code, 1).bitwiseAND(3) + 1)
    return [
        F.when(status == LAYOUT_OK, delim).alias("delim"),
        F.when(status == LAYOUT_OK, code.bitwiseAND(1) == 1).alias("email_first"),
        status.alias("status"),
    ]


def layout_sides(
    layout: DataFrame,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    skip_header: bool = False,
    hash_key: bool = True,
) -> tuple[list[DataFrame], str]:
    """Compact, measured per-file layout table for the line join, in slices.

    Each file becomes ``(xxhash64(path), packed layout int)``: about 24 bytes,
    so millions of files still fit a broadcast.  The hash is used as the key
    only after checking, in the same job that measures the table, that it is
    unique over the files present; a collision falls back to the path key.
    A table above the bound is cut into slices under it, each broadcast, so
    that a line of clear text is never shuffled to meet its layout.
    Returns the slices and the join key's name.
    """
    header = (
        [F.col("header_at.block").alias("_hb"), F.col("header_at.seq").alias("_hs")] if skip_header else []
    )
    full = materialise(
        layout.select("source", F.xxhash64("source").alias("_fid"), _packed(layout).alias("_code"), *header)
    )
    st = full.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("_fid").alias("n_fid"),
        F.coalesce(F.sum(F.octet_length("source")), F.lit(0)).alias("path_bytes"),
    ).head()
    extra = ["_hb", "_hs"] if skip_header else []
    if hash_key and st["n"] == st["n_fid"]:
        key, size = "_fid", st["n"] * 8 * (3 + len(extra))
    else:
        key, size = "source", st["n"] * 8 * (4 + len(extra)) + st["path_bytes"]
    n = max(1, -(-size // max(1, max_broadcast_bytes)))
    n = min(n, max(1, st["n"]))
    sides = [full] if n == 1 else [full.where(F.pmod(F.col("_fid"), F.lit(n)) == k) for k in range(n)]
    return [F.broadcast(s.select(key, "_code", *extra)) for s in sides], key


def where_once(rows: DataFrame, condition: F.Column) -> DataFrame:
    """``rows`` that meet ``condition``, with each row's columns worked out once.

    A plain filter on derived columns is pushed below the staged projections that derive
    them, where it splits and trims a line anew for every use of a field.  A filter on
    what an ``explode`` gives out stays above it.
    """
    held = rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("_row"))
    return held.select("_row.*").where(condition)


def parse_detected(
    lines: DataFrame,
    layout: DataFrame,
    max_chars: int = MAX_RECORD_CHARS,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    skip_header: bool = False,
    hash_key: bool = True,
    keep_blank: bool = False,
) -> DataFrame:
    """``lines(source, block, seq, line)`` x ``layout`` -> :data:`PARSED_COLUMNS`.

    By default the first line is parsed like any other (layout detection
    skips it, loading does not); ``skip_header=True`` drops each file's
    first non-blank line instead.  Blank lines are dropped, or kept with
    the silent reason ``blank`` when ``keep_blank`` (so a file of blank
    lines still shows up in a manifest).
    """
    sides, key = layout_sides(layout, max_broadcast_bytes, skip_header, hash_key)
    j = lines.withColumn("_fid", F.xxhash64("source"))
    found = ["_code", *(["_hb", "_hs"] if skip_header else [])]
    for k, side in enumerate(sides):
        named = side.select(F.col(key).alias("_key"), *[F.col(c).alias(f"{c}{k}") for c in found])
        # the broadcast hint survives the renaming; a file is in one slice at most
        j = j.join(F.broadcast(named), F.col(key) == F.col("_key"), "left").drop("_key")
    for c in found:
        j = j.withColumn(c, F.coalesce(*[F.col(f"{c}{k}") for k in range(len(sides))]))
    if skip_header:
        is_header = (F.col("block") == F.col("_hb")) & (F.col("seq") == F.col("_hs"))
        j = j.where(~F.coalesce(is_header, F.lit(False)))
    j = j.select("source", "block", "seq", "line", *_unpacked(F.col("_code")))
    ok = F.col("status") == F.lit(LAYOUT_OK)
    # Staged projections: each intermediate is computed once per row.
    cleaned = j.select(
        "source", "block", "seq", "delim", "email_first", "status",
        F.when(ok, js_trim(strip_controls(F.col("line")))).alias("_clean"),
        F.when(~ok, js_trim(F.col("line")) != F.lit("")).alias("_nonblank"),
    )
    nonblank = F.when(ok, F.col("_clean") != F.lit("")).otherwise(F.col("_nonblank"))
    split = cleaned.withColumn("_blank", ~nonblank).select(
        "source", "block", "seq", "email_first", "status", "_blank",
        F.split(F.col("_clean"), F.col("delim"), -1).alias("_parts"),
    )
    fields = split.select(
        "source", "block", "seq", "email_first", "status", "_blank",
        F.size("_parts").alias("_n"),
        js_trim(F.get(F.col("_parts"), 0)).alias("_r1"),
        js_trim(F.get(F.col("_parts"), 1)).alias("_r2"),
    )
    email_first = F.col("email_first")
    staged = fields.select(
        "source", "block", "seq", "status", "_n", "_blank",
        F.when(email_first, F.col("_r1")).otherwise(F.col("_r2")).alias("ident"),
        F.when(email_first, F.col("_r2")).otherwise(F.col("_r1")).alias("secret"),
    )
    ok = F.col("status") == F.lit(LAYOUT_OK)
    reason = (
        F.when(F.col("_blank"), F.lit(BLANK))
        .when(~ok, F.col("status"))
        .when(F.col("_n") != 2, F.lit(FIELD_COUNT))
        .when((F.col("ident") == "") | (F.col("secret") == ""), F.lit(EMPTY_FIELD))
        .when(_oversize(F.col("ident"), F.col("secret"), F.col("source"), max_chars), F.lit(OVERSIZE))
    )
    scope = F.when(ok, F.lit(SCOPE_LINE)).otherwise(F.lit(SCOPE_FILE)).alias("scope")
    outcomes = ["source", "block", "seq", "ident", "secret", scope, reason.alias("reason")]
    if keep_blank:
        return staged.select(*outcomes)
    return where_once(staged.select(*outcomes, "_blank"), ~F.col("_blank")).drop("_blank")


def parse_first_colon(lines: DataFrame, keep_blank: bool = False) -> DataFrame:
    """First-``:`` parse (PRJ-01, FLT-01..03) -> :data:`PARSED_COLUMNS`.

    Zero-length lines are dropped, or kept as ``blank`` when ``keep_blank``.
    """
    v = F.col("line")
    sep = F.instr(v, ":")
    raw_ident = v.substr(F.lit(1), sep - F.lit(1))
    raw_secret = v.substr(sep + F.lit(1), F.length(v))
    reason = (
        F.when(F.length(v) == 0, F.lit(BLANK))
        .when(sep < 2, F.lit(NO_SEPARATOR))
        .when(~lower_trim(raw_ident).contains("@"), F.lit(NO_AT))
    )
    rows = lines if keep_blank else lines.where(F.length(v) > 0)
    return rows.select(
        "source", "block", "seq",
        F.when(sep >= 2, raw_ident).alias("ident"),
        F.when(sep >= 2, raw_secret).alias("secret"),
        F.lit(SCOPE_LINE).alias("scope"),
        reason.alias("reason"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return where_once(parsed, F.col("reason").isNull())


def counted_reject(reason: F.Column) -> F.Column:
    """A reject that is counted (blank lines are silent)."""
    return reason.isNotNull() & (reason != F.lit(BLANK))


def outcome_counts(parsed: DataFrame) -> DataFrame:
    """Accepted and rejected counts per source: ``(source, scope, reason, n)``
    with ``reason = 'accepted'`` for loaded lines (AGG-02).  A parse run with
    ``keep_blank`` also reports its silent ``blank`` lines under that name."""
    return parsed.groupBy(
        "source", "scope", F.coalesce(F.col("reason"), F.lit("accepted")).alias("reason")
    ).agg(F.count(F.lit(1)).alias("n"))
