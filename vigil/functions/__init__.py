"""Column-level building blocks (pure ``pyspark.sql.Column`` functions)."""

from vigil.functions.classify import hash_scheme, hash_scheme_compat, is_hash
from vigil.functions.digest import HmacKey, with_hmacs
from vigil.functions.text import (
    js_trim,
    normalise_compat,
    normalise_identifier,
    strip_controls,
)

__all__ = [
    "HmacKey",
    "hash_scheme",
    "hash_scheme_compat",
    "with_hmacs",
    "is_hash",
    "js_trim",
    "normalise_compat",
    "normalise_identifier",
    "strip_controls",
]
