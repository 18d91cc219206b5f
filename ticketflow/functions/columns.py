"""Column expressions shared by the operators. All are built-in Spark expressions,
so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketflow.config import CITY_BBOX, FEED_TS_FORMAT, BBox


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_window(c: str | Column, start, end) -> Column:
    """Half-open ``start <= c < end``; bounds compare in the column's own type."""
    c = col(c)
    return (c >= F.lit(start)) & (c < F.lit(end))


def in_bbox(lon: str | Column, lat: str | Column, bbox: BBox = CITY_BBOX) -> Column:
    """Inclusive rectangle test; null coordinates give null (so filters drop them)."""
    return col(lat).between(bbox.south, bbox.north) & col(lon).between(bbox.west, bbox.east)


def lookup(mapping: Mapping[str, str], c: str | Column) -> Column:
    """Map a code through a literal map; unknown or null codes give null."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.create_map(*pairs)[col(c)]


def parse_ts(c: str | Column, fmt: str = FEED_TS_FORMAT) -> Column:
    """Strict text -> timestamp; malformed text gives null instead of failing (ANSI)."""
    return F.try_to_timestamp(col(c), F.lit(fmt))


def format_ts(c: str | Column, fmt: str = FEED_TS_FORMAT) -> Column:
    return F.date_format(col(c), fmt)


def any_null(cols: Iterable[str]) -> Column:
    """True when any of ``cols`` is null; an empty list is never null."""
    conds = [F.col(c).isNull() for c in cols]
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def is_blank(c: str | Column) -> Column:
    """Null, or only spaces (trim removes spaces only, not tabs)."""
    c = col(c)
    return c.isNull() | (F.trim(c) == "")


def day_diff(end: str | Column, start: str | Column) -> Column:
    """Calendar-day difference of two timestamps (null if either is null)."""
    return F.datediff(col(end), col(start))
