"""Parameters of the ticket lakehouse.

Everything an operator needs to know about the feed (which column is the key, which
orders versions, where the city is, how raw state codes read) is passed as an
argument; the defaults below are the feed's published conventions.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: must equal the feed's conventions for identical results -------
#
# City bounding box, inclusive on all four sides:
#   south (lat min) 13.49, west (lon min) 100.32, north (lat max) 14.00, east (lon max) 100.94
# Timestamp text format of the feed: yyyy-MM-dd HH:mm:ss (feed-local wall clock)
# String columns of the feed that hold such timestamps:
#   timestamp, last_activity, timestamp_inprogress, timestamp_finished
# Raw lifecycle code -> canonical status (anything else, and null, -> null):
#   start -> reported
#   inprogress -> in_progress
#   finish -> resolved
#   forward -> forwarded
#   irrelevant -> rejected
# Column of the feed that holds a ticket's category array: problem_type_fondue
# Minimum silver/bronze ratio of the row-count check: 0.5
# Time zone of the feed's wall clock: Asia/Bangkok
CITY_SOUTH, CITY_WEST, CITY_NORTH, CITY_EAST = 13.49, 100.32, 14.00, 100.94
FEED_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
FEED_TS_COLUMNS = ("timestamp", "last_activity", "timestamp_inprogress", "timestamp_finished")
FEED_STATE_CODES = {
    "start": "reported",
    "inprogress": "in_progress",
    "finish": "resolved",
    "forward": "forwarded",
    "irrelevant": "rejected",
}
CATEGORY_ARRAY = "problem_type_fondue"
MIN_SILVER_RATIO = 0.5
FEED_SOURCE_TAG = "feed"  # load-metadata _source tag (not part of any result)
FEED_ZONE = "Asia/Bangkok"  # the feed's wall clock
# --- end of fixed values ----------------------------------------------------------


@dataclass(frozen=True)
class BBox:
    """Inclusive latitude/longitude rectangle."""

    south: float
    west: float
    north: float
    east: float


CITY_BBOX = BBox(CITY_SOUTH, CITY_WEST, CITY_NORTH, CITY_EAST)


@dataclass(frozen=True)
class GateConfig:
    """What the silver quality gate checks."""

    key: str = "ticket_id"
    not_null: tuple[str, ...] = ("ticket_id", "lon", "lat")
    lon: str = "lon"
    lat: str = "lat"
    bbox: BBox = CITY_BBOX
    min_ratio: float = MIN_SILVER_RATIO
