"""Keyed HMAC-SHA256 composed from native ``sha2`` / ``concat`` / ``unhex``.

HMAC(K, m) = SHA256((K0 ^ opad) || SHA256((K0 ^ ipad) || m)), K0 = K padded
to the 64-byte block.

Key material never enters a plan as a literal: plan node strings reach
event logs and the UI unredacted.  :func:`with_hmacs` instead joins the
rows to a tiny key table (:data:`KEY_BUCKETS` identical rows holding the
pads, built in memory, so plan strings show only its column names) through
a broadcast hash join on ``xxhash64(message) & (KEY_BUCKETS - 1)``.  That is
a real equi-join on a data-derived column (a constant key would be folded
into a cartesian product) with a fixed, tiny build side.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_BYTES = 32
BLOCK_BYTES = 64
# Matches the display form of any 64-byte binary literal (the HMAC pads).
PAD_REDACTION = r"(?i)0x[0-9a-f]{128}"
_REDACTION_CONF = "spark.sql.redaction.string.regex"


@dataclass(frozen=True)
class HmacKey:
    """A 32-byte HMAC key.  ``repr`` never shows the material."""

    material: bytes = field(repr=False)

    def __post_init__(self) -> None:
        if not isinstance(self.material, (bytes, bytearray)) or len(self.material) != KEY_BYTES:
            raise ValueError(f"HMAC key must be exactly {KEY_BYTES} bytes")

    @classmethod
    def from_hex(cls, text: str) -> "HmacKey":
        text = text.strip()
        if not re.fullmatch(r"[0-9a-fA-F]{64}", text):
            raise ValueError("HMAC key must be 64 hex characters (32 bytes)")
        return cls(bytes.fromhex(text))

    @classmethod
    def from_file(cls, spark: SparkSession, path: str) -> "HmacKey":
        """Read a hex key from a one-line text file on shared storage."""
        row = spark.read.text(path).where(F.length(F.trim("value")) > 0).head()
        if row is None:
            raise ValueError("key file is empty")
        return cls.from_hex(row[0])

    def pads(self) -> tuple[bytes, bytes]:
        k0 = bytes(self.material) + b"\x00" * (BLOCK_BYTES - KEY_BYTES)
        return bytes(b ^ 0x36 for b in k0), bytes(b ^ 0x5C for b in k0)


# Public fixture keys (tests and registered fixture queries only): bytes
# 00..1f for identifiers and 20..3f for secrets.
TEST_ID_KEY = HmacKey(bytes(range(0, 32)))
TEST_SECRET_KEY = HmacKey(bytes(range(32, 64)))


def ensure_redaction(spark: SparkSession | None = None) -> None:
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    current = spark.conf.get(_REDACTION_CONF, None)
    if not current:
        spark.conf.set(_REDACTION_CONF, PAD_REDACTION)
    elif PAD_REDACTION not in current:
        spark.conf.set(_REDACTION_CONF, f"(?:{current})|(?:{PAD_REDACTION})")


KEY_BUCKETS = 16  # a power of two (bucket = hash & (KEY_BUCKETS - 1))


_KEY_TABLES: dict[tuple, DataFrame] = {}
_ARROW_CONF = "spark.sql.execution.arrow.pyspark.enabled"


def key_table(spark: SparkSession, keys: Sequence[HmacKey]) -> DataFrame:
    """``(_kb, _k{i}_ipad, _k{i}_opad ...)``: KEY_BUCKETS identical rows.

    Built from pandas through Arrow, which yields a JVM-side local relation:
    no Python job runs when it is broadcast, and plan strings show only
    column names.  Reused per session and key set.
    """
    import pandas as pd

    cache_key = (spark.sparkContext.applicationId, tuple(bytes(k.material) for k in keys))
    if cache_key in _KEY_TABLES:
        return _KEY_TABLES[cache_key]
    fields = [T.StructField("_kb", T.IntegerType(), False)]
    data: dict[str, list] = {"_kb": list(range(KEY_BUCKETS))}
    for i, k in enumerate(keys):
        ipad, opad = k.pads()
        fields += [
            T.StructField(f"_k{i}_ipad", T.BinaryType(), False),
            T.StructField(f"_k{i}_opad", T.BinaryType(), False),
        ]
        data[f"_k{i}_ipad"] = [ipad] * KEY_BUCKETS
        data[f"_k{i}_opad"] = [opad] * KEY_BUCKETS
    pdf = pd.DataFrame(data).astype({"_kb": "int32"})
    previous = spark.conf.get(_ARROW_CONF, None)
    spark.conf.set(_ARROW_CONF, "true")
    try:
        table = spark.createDataFrame(pdf, T.StructType(fields))
    finally:
        if previous is None:
            spark.conf.unset(_ARROW_CONF)
        else:
            spark.conf.set(_ARROW_CONF, previous)
    _KEY_TABLES[cache_key] = table
    return table


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_hmacs(df: DataFrame, specs: Sequence[tuple[str, Column | str, HmacKey]]) -> DataFrame:
    """``df`` plus one lower-case hex HMAC-SHA256 column per ``(out, message,
    key)``; the digest of a null message is null."""
    if not specs:
        return df
    ensure_redaction(df.sparkSession)
    keys: list[HmacKey] = []
    index: dict[bytes, int] = {}
    for _, _, k in specs:
        if bytes(k.material) not in index:
            index[bytes(k.material)] = len(keys)
            keys.append(k)
    # Non-nullable by construction (xxhash64 is never null): a nullable join
    # key would make Catalyst infer an is-not-null filter and push it down
    # through every projection below, re-evaluating the whole message
    # expression per row.
    bucket = F.xxhash64(_col(specs[0][1])).bitwiseAND(F.lit(KEY_BUCKETS - 1)).cast("int")
    joined = df.withColumn("_kb", bucket).join(F.broadcast(key_table(df.sparkSession, keys)), "_kb")
    outs = []
    for out, message, k in specs:
        i = index[bytes(k.material)]
        inner = F.unhex(F.sha2(F.concat(F.col(f"_k{i}_ipad"), F.encode(_col(message), "UTF-8")), 256))
        outs.append(F.sha2(F.concat(F.col(f"_k{i}_opad"), inner), 256).alias(out))
    return joined.select(*[F.col(c) for c in df.columns], *outs)
