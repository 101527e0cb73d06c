"""Composed parse -> protect steps shared by jobs and registered queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from vigil.operators.layout import infer_layout
from vigil.operators.parse import parse_detected, parse_first_colon
from vigil.operators.protect import Keys, protect
from vigil.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES


def detected(
    lines: DataFrame,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    skip_header: bool = False,
    keep_blank: bool = False,
) -> DataFrame:
    """Two passes over ``lines``: layout inference, then layout-driven parse."""
    return parse_detected(
        lines, infer_layout(lines), max_broadcast_bytes=max_broadcast_bytes,
        skip_header=skip_header, keep_blank=keep_blank,
    )


def protected_detected(
    lines: DataFrame, keys: Keys, compat: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    return protect(detected(lines), keys, compat=compat, keep=keep)


def protected_first_colon(lines: DataFrame, keys: Keys, keep: Sequence[str] = ()) -> DataFrame:
    return protect(parse_first_colon(lines), keys, keep=keep)
