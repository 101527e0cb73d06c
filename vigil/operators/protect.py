"""Protected records (SCL-04, PRJ-06/07/09): digests only, clear text dropped.

``id_digest`` is the HMAC of the normalised identifier and ``secret_digest``
the HMAC of the secret under a second key.  ``p2``/``p4`` are the first two
and four hex digits of ``id_digest`` (shard directory and shard key).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.classify import hash_scheme, hash_scheme_compat, is_hash
from vigil.functions.digest import TEST_ID_KEY, TEST_SECRET_KEY, HmacKey, with_hmacs
from vigil.functions.text import js_trim, normalise_compat, normalise_identifier
from vigil.operators.parse import accepted

PROTECTED_COLUMNS = ["id_digest", "secret_digest", "is_hash", "hash_type", "source", "p2", "p4"]
RECORD_KEY = ["id_digest", "secret_digest", "source"]

PROTECTED_SCHEMA = T.StructType(
    [
        T.StructField("id_digest", T.StringType(), False),
        T.StructField("secret_digest", T.StringType(), False),
        T.StructField("is_hash", T.BooleanType(), False),
        T.StructField("hash_type", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("p2", T.StringType(), False),
        T.StructField("p4", T.StringType(), False),
    ]
)


@dataclass(frozen=True)
class Keys:
    identifier: HmacKey
    secret: HmacKey

    def __post_init__(self) -> None:
        if self.identifier.material == self.secret.material:
            raise ValueError("identifier and secret keys must differ")


TEST_KEYS = Keys(TEST_ID_KEY, TEST_SECRET_KEY)


def protect(
    parsed: DataFrame,
    keys: Keys,
    compat: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Accepted rows of a parse -> protected records (+ ``keep`` columns).

    ``compat=True`` uses the compatibility normaliser and classifier.
    """
    if "reason" in parsed.columns:
        needed = {"source", "ident", "secret", "reason", *keep}
        rows = accepted(parsed.select(*[c for c in parsed.columns if c in needed]))
    else:
        rows = parsed
    # Each stage is its own projection: a column used several times by the
    # next stage is computed once instead of being inlined into every use.
    staged = rows.select(
        (normalise_compat if compat else normalise_identifier)(F.col("ident")).alias("_norm"),
        "secret",
        (F.col("secret") if compat else js_trim(F.col("secret"))).alias("_pw"),
        "source",
        *keep,
    )
    scheme = hash_scheme_compat(F.col("_pw")) if compat else hash_scheme(F.col("_pw"), trimmed=True)
    hashed = with_hmacs(
        staged, [("id_digest", "_norm", keys.identifier), ("secret_digest", "secret", keys.secret)]
    )
    digested = hashed.select("id_digest", "secret_digest", scheme.alias("hash_type"), "source", *keep)
    return digested.select(
        "id_digest",
        "secret_digest",
        is_hash(F.col("hash_type")).alias("is_hash"),
        "hash_type",
        "source",
        F.substring("id_digest", 1, 2).alias("p2"),
        F.substring("id_digest", 1, 4).alias("p4"),
        *keep,
    )


def protect_outcomes(parsed: DataFrame, keys: Keys, compat: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Every parsed line as digest-only columns: accepted lines carry their
    digests and scheme, rejected lines only ``scope``/``reason``; ``keep``
    names further columns, free of clear text, that stay.

    The result holds no clear text, so it may be checkpointed, letting one
    parse feed both the record sink and the reject/manifest counts.
    """
    ok = F.col("reason").isNull()
    if "scope" not in parsed.columns:
        parsed = parsed.withColumn("scope", F.lit("line"))
    staged = parsed.select(
        "source", "scope", "reason", *keep,
        F.when(ok, (normalise_compat if compat else normalise_identifier)(F.col("ident"))).alias("_norm"),
        F.when(ok, F.col("secret")).alias("_secret"),
        F.when(ok, F.col("secret") if compat else js_trim(F.col("secret"))).alias("_pw"),
    )
    scheme = hash_scheme_compat(F.col("_pw")) if compat else hash_scheme(F.col("_pw"), trimmed=True)
    hashed = with_hmacs(
        staged, [("id_digest", "_norm", keys.identifier), ("secret_digest", "_secret", keys.secret)]
    )
    digested = hashed.select(
        "source", "scope", "reason", *keep, "id_digest", "secret_digest", F.when(ok, scheme).alias("hash_type")
    )
    return digested.select(
        "source", "scope", "reason", *keep, "id_digest", "secret_digest",
        is_hash(F.col("hash_type")).alias("is_hash"),
        "hash_type",
        F.substring("id_digest", 1, 2).alias("p2"),
        F.substring("id_digest", 1, 4).alias("p4"),
    )


def records_of(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("reason").isNull()).select(*PROTECTED_COLUMNS)
