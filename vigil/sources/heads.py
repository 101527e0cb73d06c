"""Layout inference from file heads (pass 1 without reading whole files).

The scan-based layout pass (:func:`vigil.operators.layout.infer_layout`)
reads every line once more before the parse, although only the first two
non-blank lines of a file decide its layout.  Here the file listing (no
contents read) is spread over tasks by Spark, and each task opens its files
with ``pyarrow.fs`` and reads only until two non-blank lines are found, as
the reference's first pass does.  Only the derived flags leave the task.

Lines are split like Spark's text source (``\\n``, ``\\r\\n`` or ``\\r``) and
decoded as UTF-8 with replacement.  ``header_at`` is not produced, so
``skip_header`` needs the scan-based layout.  The filesystem must be one
``pyarrow.fs`` can open from the executors (local, mounted, S3 or GCS with
credentials in the environment, HDFS with libhdfs).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vigil.functions.text import JS_WHITESPACE
from vigil.operators.layout import EMAIL_SHAPE_RE, LAYOUT_OK, RECORD2_FIELDS, UNDETECTABLE
from vigil.sources.text_files import TXT_ANY_CASE, list_files

HEAD_CHUNK = 64 * 1024
_SEP = re.compile(rb"\r\n|\r|\n")
_EMAIL = re.compile(EMAIL_SHAPE_RE.replace(r"\S", r"[^\t\n\x0b\x0c\r ]"))

LAYOUT_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("delim", T.StringType()),
        T.StructField("email_first", T.BooleanType()),
        T.StructField("status", T.StringType()),
    ]
)


def layout_of_line(line: str) -> tuple[str, bool | None, str]:
    """(delimiter, id-first, status) from a file's second non-blank line;
    the Python twin of the column rules in ``vigil.operators.layout``."""
    t = line.strip(JS_WHITESPACE)
    delim = ":" if ":" in t else ";" if ";" in t else " "
    parts = t.split(delim)
    if len(parts) > 2:
        return delim, None, RECORD2_FIELDS
    first = parts[0].strip(JS_WHITESPACE)
    return delim, _EMAIL.search(first) is not None, LAYOUT_OK


def _local_path(uri: str) -> str:
    from urllib.parse import unquote, urlparse

    return unquote(urlparse(uri).path)


def _open(uri: str):
    import pyarrow.fs as pafs

    if uri.startswith("file:"):
        return pafs.LocalFileSystem().open_input_stream(_local_path(uri))
    scheme, rest = uri.split("://", 1)
    normalised = ("s3" if scheme in ("s3a", "s3n") else scheme) + "://" + rest
    fs, path = pafs.FileSystem.from_uri(normalised)
    from urllib.parse import unquote

    return fs.open_input_stream(unquote(path))


def _blank(raw: bytes | bytearray) -> bool:
    return not raw.decode("utf-8", errors="replace").strip(JS_WHITESPACE)


def _second_nonblank(stream) -> str | None:
    """Read until the second non-blank line (or end of file).

    Each byte is searched once.  Of a long first line only the fact that it is
    not blank is kept; the second one is held whole, as the scan holds any line.
    """
    seen, said = 0, False  # non-blank lines so far; whether a cut-off part of this one was not blank
    buf, at, eof = bytearray(), 0, False
    while True:
        m = _SEP.search(buf, at)
        # a trailing \r may be the first half of \r\n: wait for more bytes
        if m is not None and not (m.group() == b"\r" and m.end() == len(buf) and not eof):
            line = buf[: m.start()]
            if said or not _blank(line):
                seen += 1
                if seen == 2:
                    return line.decode("utf-8", errors="replace")
            del buf[: m.end()]
            at, said = 0, False
            continue
        if eof:
            last = seen == 1 and not _blank(buf)
            return buf.decode("utf-8", errors="replace") if last else None
        if seen == 0 and len(buf) > HEAD_CHUNK:
            # the last bytes may be half a character or half a line end
            cut = len(buf) - 4
            while cut > len(buf) - 8 and buf[cut] & 0xC0 == 0x80:
                cut -= 1
            said = said or not _blank(buf[:cut])
            del buf[:cut]
        at = max(0, len(buf) - 1)
        chunk = stream.read(HEAD_CHUNK)
        eof = not chunk
        buf += chunk


def _layouts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for uri in pdf["source"]:
            with _open(uri) as stream:
                second = _second_nonblank(stream)
            if second is None:
                rows.append((uri, None, None, UNDETECTABLE))
            else:
                delim, first, status = layout_of_line(second)
                rows.append((uri, delim, first, status))
        yield pd.DataFrame(rows, columns=["source", "delim", "email_first", "status"])


def layouts_of(sources: DataFrame) -> DataFrame:
    """``(source, delim, email_first, status)`` of the files named by ``source``, reading heads only."""
    return sources.select("source").mapInPandas(_layouts, LAYOUT_SCHEMA)


def infer_layout_from_heads(
    spark: SparkSession, paths: str | Sequence[str], glob: str = TXT_ANY_CASE
) -> DataFrame:
    """``(source, delim, email_first, status)`` per listed file, reading heads only."""
    return layouts_of(list_files(spark, paths, glob=glob))
