"""Bronze load: landed pages -> page-range scan -> flatten -> window -> stamp ->
dated partition, as ONE Spark job for any number of polls.

Per-poll parameters (window bounds, run id, partition date) are columns, so a
backfill of N days is the same single plan as one day, and the dynamic partition
overwrite replaces exactly the days it lands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.config import FEED_SOURCE_TAG, FEED_TS_FORMAT, FEED_ZONE
from ticketflow.operators.bronze import flatten_features, stamp_load_metadata, window_filter
from ticketflow.sources.feed import PROPERTIES, page_features, page_until_boundary
from ticketflow.sources.lake import write_partitions


def poll_day_bounds(poll: str = "poll_id") -> dict[str, Column]:
    """Window of a poll named by its (past) day: [day 00:00:00, next day 00:00:00)."""
    day = F.to_date(F.col(poll))
    return {
        "start": F.concat(F.col(poll), F.lit(" 00:00:00")),
        "end": F.concat(F.date_format(F.date_add(day, 1), "yyyy-MM-dd"), F.lit(" 00:00:00")),
        "run_id": F.col(poll),
        "dt": day,
    }


def day_so_far_bounds(zone: str = FEED_ZONE, now: Column | None = None) -> dict[str, Column]:
    """Window of a poll taken now: [today 00:00:00, now), on the wall clock of the feed's
    ``zone``. ``now`` (an instant) defaults to the query's start; the session's own zone
    does not matter."""
    now = F.current_timestamp() if now is None else now
    local = _wall_clock(now, zone)
    day = F.to_date(local)
    return {
        "start": F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 00:00:00")),
        "end": F.date_format(local, FEED_TS_FORMAT),
        "run_id": F.date_format(day, "yyyy-MM-dd"),
        "dt": day,
    }


def _wall_clock(instant: Column, zone: str) -> Column:
    """The wall clock of ``zone`` at an instant, as a timestamp without a zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))


def window_rows(kept: DataFrame, source: str, b: dict[str, Column], poll: str = "poll_id",
                ingested_at: str | Column | None = None, schema: T.StructType = PROPERTIES) -> DataFrame:
    """The bronze rows in pages that are kept: flattened, within their poll's window, stamped, dated."""
    rows = flatten_features(page_features(kept, keep=(poll,)), "feature", (poll,), schema)
    rows = window_filter(rows, b["start"], b["end"])
    rows = stamp_load_metadata(rows, b["run_id"], source, ingested_at)
    return rows.withColumn("dt", b["dt"]).drop(poll)


def landed_rows(pages: DataFrame, page_size: int = 500, max_records: int | None = None,
                source: str = FEED_SOURCE_TAG, bounds: dict[str, Column] | None = None,
                poll: str = "poll_id", ingested_at: str | Column | None = None,
                schema: T.StructType = PROPERTIES) -> DataFrame:
    """The bronze rows a load of these pages lands (lazy). ``ingested_at`` defaults to the
    load time; ``schema`` names the properties that become typed columns."""
    b = bounds or poll_day_bounds(poll)
    kept = page_until_boundary(pages, b["start"], page_size, max_records, poll=poll)
    return window_rows(kept, source, b, poll, ingested_at, schema)


def load_bronze(pages: DataFrame, out_path: str, page_size: int = 500,
                max_records: int | None = None, source: str = FEED_SOURCE_TAG,
                bounds: dict[str, Column] | None = None,
                ingested_at: str | Column | None = None,
                schema: T.StructType = PROPERTIES) -> int:
    """Land the pages' windows as dated partitions; returns the rows written."""
    obs = write_partitions(landed_rows(pages, page_size, max_records, source, bounds,
                                       ingested_at=ingested_at, schema=schema), out_path, "dt")
    return int(obs.get["rows"])
