"""String cleaning and identifier normalisation as native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that JavaScript's String.prototype.trim()
# removes (ECMAScript WhiteSpace plus LineTerminator), in code point order.
JS_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# Control characters removed from every line before splitting
# (U+0000..U+001F and U+007F).
CONTROL_CHARS = "".join(chr(c) for c in range(0x20)) + "\u007f"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def js_trim(c: Column | str) -> Column:
    """Trim like JavaScript ``trim()``: Unicode spaces, line breaks and BOM.

    Spark's ``trim`` removes U+0020 only, so ``btrim`` with the explicit
    character set is used (no regex, stays in codegen).
    """
    return F.btrim(_col(c), F.lit(JS_WHITESPACE))


def strip_controls(c: Column | str) -> Column:
    """Delete U+0000..U+001F and U+007F (``translate`` with no replacement)."""
    return F.translate(_col(c), CONTROL_CHARS, "")


def lower_trim(c: Column | str) -> Column:
    return js_trim(F.lower(_col(c)))


def normalise_identifier(c: Column | str) -> Column:
    """Canonical identifier normalisation (SCL-01).

    trim, lower-case, drop leading characters outside ``[a-z0-9]``; when an
    ``@`` follows at least one character, cut the local part at its first
    ``+`` and keep everything after the first ``@`` as the domain.  Written
    as two anchored regex replacements so the input appears once in the
    expression tree (the leading strip guarantees a non-empty local part
    whenever an ``@`` is present).
    """
    e = F.regexp_replace(F.lower(js_trim(_col(c))), r"^[^a-z0-9]+", "")
    return F.regexp_replace(e, r"^([^@+]*)\+[^@]*@", "$1@")


def normalise_compat(c: Column | str) -> Column:
    """Compatibility normalisation (SCL-02): lower-case, cut the whole string
    at its first ``+``.  ``a+t@d`` becomes ``a``; kept only for comparison."""
    return F.substring_index(F.lower(_col(c)), "+", 1)


def utf16_length(c: Column | str) -> Column:
    """Length in UTF-16 code units, the unit JavaScript's ``length`` counts."""
    return F.octet_length(F.encode(_col(c), "UTF-16BE")) / F.lit(2)
