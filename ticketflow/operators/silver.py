"""Silver operators: raw, duplicated snapshots -> one clean, typed, in-bounds row per
ticket, plus the ticket x category bridge.

Every function is ``DataFrame -> DataFrame`` and lazy (no actions)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.config import (
    CATEGORY_ARRAY,
    CITY_BBOX,
    FEED_STATE_CODES,
    FEED_TS_COLUMNS,
    FEED_TS_FORMAT,
    BBox,
)
from ticketflow.functions.columns import col as as_col
from ticketflow.functions.columns import in_bbox, lookup, parse_ts


def latest_by(df: DataFrame, keys: Iterable[str], newest: Iterable[str | Column],
              n: int = 1) -> DataFrame:
    """The ``n`` newest rows of each key group; every ``newest`` column counts downwards,
    nulls last, and null keys form a group of their own.

    The rank filter becomes a group limit on each map partition *before* the shuffle, so a
    key with a huge number of rows ships at most ``n`` of them per input partition.
    """
    ranking = Window.partitionBy(*keys).orderBy(*(as_col(c).desc_nulls_last() for c in newest))
    ranked = df.select("*", F.row_number().over(ranking).alias(_RANK))
    return ranked.where(F.col(_RANK) <= n).select(*df.columns)


_RANK = "_rank_in_key"


def dedup_latest(df: DataFrame, key: str | Iterable[str] = "ticket_id",
                 order: str = "last_activity", tie_breakers: Iterable[str] = ()) -> DataFrame:
    """One row per key: the version with the greatest ``order``, then the greatest
    ``tie_breakers``."""
    return latest_by(df, [key] if isinstance(key, str) else key, [order, *tie_breakers])


def typed(ts_cols: Iterable[str], fmt: str, columns: Iterable[str]) -> dict[str, Column]:
    """Parsed replacements for those text timestamp columns that exist; bad text -> null."""
    names = set(columns)
    return {c: parse_ts(c, fmt) for c in ts_cols if c in names}


def parse_timestamps(df: DataFrame, cols: Iterable[str] = FEED_TS_COLUMNS,
                     fmt: str = FEED_TS_FORMAT) -> DataFrame:
    found = typed(cols, fmt, df.columns)
    return df.withColumns(found) if found else df


def bbox_filter(df: DataFrame, lon: str = "lon", lat: str = "lat",
                bbox: BBox = CITY_BBOX) -> DataFrame:
    """Rows inside the inclusive box; a null coordinate is outside."""
    return df.where(in_bbox(lon, lat, bbox))


def normalize_state(df: DataFrame, src: str = "state_type_latest", dst: str = "status",
                    mapping: Mapping[str, str] = FEED_STATE_CODES) -> DataFrame:
    """Add ``dst`` = canonical status of the raw code; the raw column is kept."""
    return df.select("*", lookup(mapping, src).alias(dst))


def publish_view(state: DataFrame, bbox: BBox = CITY_BBOX, ts_cols: Iterable[str] = FEED_TS_COLUMNS,
                 fmt: str = FEED_TS_FORMAT, state_map: Mapping[str, str] = FEED_STATE_CODES,
                 lon: str = "lon", lat: str = "lat", code: str = "state_type_latest",
                 status: str = "status") -> DataFrame:
    """Silver columns of deduplicated rows: one filter on the raw coordinates and one
    projection that parses the timestamps and adds the status."""
    new = typed(ts_cols, fmt, state.columns) | {status: lookup(state_map, code)}
    return state.where(in_bbox(lon, lat, bbox)).withColumns(new)


def silver_tickets(bronze: DataFrame, key: str = "ticket_id", order: str = "last_activity",
                   tie_breakers: Iterable[str] = (), **view) -> DataFrame:
    """The newest version of every key, then ``publish_view`` of those (its keyword
    arguments pass through).

    Versions are compared on the raw text and before the box filter, so a ticket whose
    newest version is out of bounds disappears even if an older one was inside.
    """
    return publish_view(dedup_latest(bronze, key, order, tie_breakers), **view)


def explode_bridge(df: DataFrame, array_col: str = CATEGORY_ARRAY,
                   key: str = "ticket_id", out: str = "category") -> DataFrame:
    """(key, element) for every array element: none for null or empty arrays, repeats kept."""
    return df.select(key, F.explode(array_col).alias(out))
