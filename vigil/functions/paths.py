"""Path helpers over string columns (SCL-17, PRJ-10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def dir_name(c: Column) -> Column:
    return F.regexp_extract(c, r"^(.*)/[^/]*$", 1)


def relative(c: Column, root: Column | str) -> Column:
    """The path below ``root``; unchanged where it is not below it."""
    prefix = F.concat(F.rtrim(root if isinstance(root, Column) else F.lit(root), F.lit("/")), F.lit("/"))
    return F.when(F.startswith(c, prefix), F.substring(c, F.length(prefix) + 1, F.length(c))).otherwise(c)


def merge_destination(c: Column, root: Column | str, target: Column | str) -> Column:
    """Where a shard below ``root`` goes under ``target``: compressed files are written plain."""
    base = target if isinstance(target, Column) else F.lit(target)
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), strip_gz(relative(c, root)))


def strip_gz(c: Column) -> Column:
    return F.regexp_replace(c, r"\.gz$", "")


def plain_path(c: Column) -> Column:
    """The path that a file URI names: no scheme and host, nothing percent-encoded."""
    path = F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "")
    decoded = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path == c, c).otherwise(F.coalesce(decoded, path))


def partition_value(c: Column, name: str) -> Column:
    """Value of a ``name=value`` directory component of a path."""
    return F.regexp_extract(c, rf"/{name}=([^/]+)/", 1)
