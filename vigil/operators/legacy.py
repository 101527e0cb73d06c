"""Legacy JSONL shard records -> protected records (MNT-03, PRJ-11, FLT-11).

Legacy records carry a clear ``email`` and ``password``; other fields are not
needed and not read, so a record is kept whatever they hold.  Lines that are
not a JSON object, or lack either field as a string, are counted as
``malformed`` and never copied through, since an unparsed line may hold clear
text.  A record without a ``source`` is named after the file it came from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.paths import base_name, strip_gz
from vigil.operators.protect import Keys, protect_outcomes, records_of
from vigil.operators.sizing import materialise

LEGACY_SCHEMA = T.StructType(
    [
        T.StructField("password", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)
MALFORMED = "malformed"


def parse_legacy(jsonl: DataFrame, value: str = "value") -> DataFrame:
    """``(value[, root_file])`` JSON lines -> ``(ident, secret, source, root_file, reason)``."""
    rec = F.from_json(
        F.col(value),
        LEGACY_SCHEMA,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    file = F.col("root_file") if "root_file" in jsonl.columns else F.lit(None).cast("string")
    parsed = jsonl.select(rec.alias("r"), file.alias("root_file"))
    source = F.coalesce(F.col("r.source"), strip_gz(base_name(F.col("root_file"))))
    bad = (
        F.col("r").isNull()
        | F.col("r._corrupt").isNotNull()
        | F.col("r.email").isNull()
        | F.col("r.password").isNull()
        | source.isNull()
    )
    return parsed.select(
        F.when(~bad, F.col("r.email")).alias("ident"),
        F.when(~bad, F.col("r.password")).alias("secret"),
        F.when(~bad, source).alias("source"),
        "root_file",
        F.when(bad, F.lit(MALFORMED)).alias("reason"),
    )


def legacy_outcomes(jsonl: DataFrame, keys: Keys, value: str = "value") -> DataFrame:
    """Digest-only outcome rows: protected records, plus ``reason =
    'malformed'`` rows that carry their file only.  One pass feeds both the
    record sink and the malformed counts."""
    return protect_outcomes(parse_legacy(jsonl, value), keys, keep=["root_file"])


def protect_legacy(jsonl: DataFrame, keys: Keys, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(protected records, malformed counts ``(source, scope, reason, n)`` by
    file), both derived from one materialised outcome frame."""
    outcomes = materialise(legacy_outcomes(jsonl, keys, value))
    malformed = (
        outcomes.where(F.col("reason").isNotNull())
        .groupBy(F.col("root_file").alias("source"), "scope", "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return records_of(outcomes), malformed
