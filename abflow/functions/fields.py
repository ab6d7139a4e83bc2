"""Delimited-text helpers (Column -> Column).

``split_keep`` keeps trailing empty fields (limit -1); ``split_java``
drops them the way a default ``String.split`` does; ``field`` reads an
element and gives null past the end instead of failing under ANSI.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import EXT_DURATION_ITEM, EXT_WATCH_ITEM


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_keep(col, sep: str) -> Column:
    return F.split(_c(col), re.escape(sep), -1)


def split_java(col, sep: str) -> Column:
    """Split dropping trailing empty strings; an all-separator string -> []."""
    s = _c(col)
    esc = re.escape(sep)
    trimmed = F.regexp_replace(s, f"({esc})+$", "")
    return (F.when(s.rlike(f"^({esc})+$"), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, esc, -1)))


def field(arr, i: int) -> Column:
    return F.get(_c(arr), i)


def kv_value(item) -> Column:
    """Part after the first ':' of a ``key:value`` item (null if none)."""
    return F.get(F.split(_c(item), ":", -1), 1)


def ext_item(ext, i: int) -> Column:
    return F.get(F.split(_c(ext), ",", -1), i)


def ext_long(ext, i: int) -> Column:
    return kv_value(ext_item(ext, i)).try_cast("bigint")


def watch_seconds(ext) -> Column:
    """Watch time from the ext field (item 2, after ':'), bigint or null."""
    return ext_long(ext, EXT_WATCH_ITEM)


def duration_seconds(ext) -> Column:
    """Media duration from the ext field (item 5, after ':'), bigint or null."""
    return ext_long(ext, EXT_DURATION_ITEM)


def watch_fields(df, ext: str = "ext"):
    """Add ``watch_s`` and ``dur_s`` (bigint or null) read from the ext field."""
    return df.withColumn("watch_s", watch_seconds(ext)).withColumn("dur_s", duration_seconds(ext))
