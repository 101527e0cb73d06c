"""Hash-scheme classification of a secret string (SCL-06, SCL-07).

Each rule is guarded by a cheap prefix or length test so the regex only
runs on candidates; ``CaseWhen`` evaluates branches in order and stops at
the first match, which keeps "first match wins" semantics.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.text import js_trim

# Scheme patterns and names of the canonical classifier, in
# match order.  ``\z`` anchors at the very end of input, as JavaScript's
# ``$`` does without the multiline flag.
BCRYPT_RE = r"^\$2[aby]\$\d{2}\$[A-Za-z0-9./]{53}\z"
ARGON2_RE = r"^\$argon2(?:i|d|id)\$v=\d+\$.*\$.*\$.*\z"
CRYPT_RE = r"^\$[156]\$[^$]+\$[A-Za-z0-9./]+\z"
SSHA_RE = r"^\{SSHA\}[A-Za-z0-9+/=]+\z"
SHA_B64_RE = r"^\{SHA\}[A-Za-z0-9+/=]+\z"
HEX_RE = r"^[A-Fa-f0-9]+\z"
CRYPT_NAMES = {"1": "md5-crypt", "5": "sha256-crypt", "6": "sha512-crypt"}
HEX_NAMES = {32: "md5-hex", 40: "sha1-hex", 64: "sha256-hex", 128: "sha512-hex"}
PLAINTEXT = "plaintext"

# Compatibility classifier (two hex lengths, bare bcrypt prefix).
COMPAT_MD5_RE = r"^[0-9a-fA-F]{32}\z"
COMPAT_SHA1_RE = r"^[0-9a-fA-F]{40}\z"
COMPAT_BCRYPT_RE = r"^\$2[aby]\$"
COMPAT_NAMES = ("md5", "sha1", "bcrypt", PLAINTEXT)

SCHEMES = (
    "bcrypt",
    "argon2",
    "md5-crypt",
    "sha256-crypt",
    "sha512-crypt",
    "ssha",
    "sha1-base64",
    "md5-hex",
    "sha1-hex",
    "sha256-hex",
    "sha512-hex",
    PLAINTEXT,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_scheme(secret: Column | str, trimmed: bool = False) -> Column:
    """Canonical scheme name of ``secret`` after a JavaScript-style trim.

    Pass ``trimmed=True`` with an already trimmed column (projected once by
    the caller) to keep the generated code small.
    """
    pw = _col(secret) if trimmed else js_trim(_col(secret))
    n = F.length(pw)
    crypt_kind = pw.substr(2, 1)
    crypt_name = F.when(crypt_kind == "1", F.lit(CRYPT_NAMES["1"])).when(
        crypt_kind == "5", F.lit(CRYPT_NAMES["5"])
    ).otherwise(F.lit(CRYPT_NAMES["6"]))
    hex_name = F.when(n == 32, F.lit(HEX_NAMES[32])).when(
        n == 40, F.lit(HEX_NAMES[40])
    ).when(n == 64, F.lit(HEX_NAMES[64])).otherwise(F.lit(HEX_NAMES[128]))
    return (
        F.when(pw.startswith("$2") & (n == 60) & pw.rlike(BCRYPT_RE), F.lit("bcrypt"))
        .when(pw.startswith("$argon2") & pw.rlike(ARGON2_RE), F.lit("argon2"))
        .when(pw.startswith("$") & pw.rlike(CRYPT_RE), crypt_name)
        .when(pw.startswith("{SSHA}") & pw.rlike(SSHA_RE), F.lit("ssha"))
        .when(pw.startswith("{SHA}") & pw.rlike(SHA_B64_RE), F.lit("sha1-base64"))
        .when(n.isin(32, 40, 64, 128) & pw.rlike(HEX_RE), hex_name)
        .otherwise(F.lit(PLAINTEXT))
    )


def hash_scheme_compat(secret: Column | str) -> Column:
    """Compatibility classifier: md5 / sha1 by hex length, bcrypt by prefix."""
    pw = _col(secret)
    n = F.length(pw)
    return (
        F.when((n == 32) & pw.rlike(COMPAT_MD5_RE), F.lit("md5"))
        .when((n == 40) & pw.rlike(COMPAT_SHA1_RE), F.lit("sha1"))
        .when(pw.rlike(COMPAT_BCRYPT_RE), F.lit("bcrypt"))
        .otherwise(F.lit(PLAINTEXT))
    )


def is_hash(scheme: Column | str) -> Column:
    return _col(scheme) != F.lit(PLAINTEXT)
