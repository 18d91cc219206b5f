"""Ticket-shaped inputs derived from the driver's order tables.

The mapping (see FIXTURES.md):

* ticket_id = order key; district = customer's nation name;
* reported at the order date; in progress at the first ship date on/after it;
  finished at the last such ship date, for finished orders only;
* categories = sorted distinct part types of the order's lines (null: no lines);
* count_reopen = returned lines; lon/lat = arithmetic on customer/order keys.

``bronze_snapshots`` turns each ticket into the raw feed's shape: one text-timestamped
row per observed lifecycle version (reported, in progress, finished), partitioned by
the version's day, so the silver dedup has real duplicates to reconcile. The first
version sits at a different, always-inside latitude, so a ticket whose newest version
is out of the box must vanish even though an older one was inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.config import CATEGORY_ARRAY
from ticketflow.functions.columns import col, format_ts
from ticketflow.sources.tables import read_table

# Fixed fixture rules (shared with the SQL oracle): order status -> raw state code of
# the final version: O -> start, F -> finish, P -> pending (a code the state map does
# not know); coordinates lon = 100.25 + (custkey % 80) / 100, lat = 13.45 +
# (orderkey % 60) / 100; the first version's lat = 13.50 + (orderkey % 50) / 100.


def _coord(base: float, key: str | Column, modulus: int):
    """base + (key % modulus) / 100, all in DOUBLE."""
    return F.lit(base) + (col(key) % modulus).cast("double") / F.lit(100.0)


def tickets(spark: SparkSession, root: str) -> DataFrame:
    """Typed, silver-shaped tickets (before any box filter), one row per order."""
    orders = read_table(spark, root, "orders",
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    lines = read_table(spark, root, "lineitem",
                       ["l_orderkey", "l_partkey", "l_returnflag", "l_shipdate"])
    parts = read_table(spark, root, "part", ["p_partkey", "p_type"])
    customers = read_table(spark, root, "customer", ["c_custkey", "c_nationkey"])
    nations = read_table(spark, root, "nation", ["n_nationkey", "n_name"])

    shipped = F.col("l_shipdate") >= F.col("o_orderdate")
    # parts first: the rows stay dealt by order key from the join with the orders on
    per_order = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(orders.select("o_orderkey", "o_orderdate", "o_orderstatus"),
              F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        .groupBy("l_orderkey")
        .agg(
            F.min(F.when(shipped, F.col("l_shipdate"))).alias("timestamp_inprogress"),
            F.max(F.when(shipped & (F.col("o_orderstatus") == "F"), F.col("l_shipdate")))
            .alias("timestamp_finished"),
            F.count_if(F.col("l_returnflag") == "R").alias("count_reopen"),
            F.array_sort(F.collect_set("p_type")).alias(CATEGORY_ARRAY),
        )
    )
    district = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    return (
        orders.join(district, F.col("o_custkey") == F.col("c_custkey"), "left")  # while the rows are narrow
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("ticket_id"),
            F.col("n_name").alias("district"),
            F.col("o_orderdate").alias("timestamp"),
            "timestamp_inprogress",
            "timestamp_finished",
            F.when(F.col("o_orderstatus") == "O", "start")
            .when(F.col("o_orderstatus") == "F", "finish")
            .otherwise("pending").alias("final_state"),
            "count_reopen",
            CATEGORY_ARRAY,
            _coord(100.25, "o_custkey", 80).alias("lon"),
            _coord(13.45, "o_orderkey", 60).alias("lat"),
        )
    )


def ticket_versions(spark: SparkSession, root: str) -> DataFrame:
    """One narrow row per ticket version: the milestones it knows, its number and its day
    ``dt``. ``snapshot_columns`` makes the raw feed row of it."""
    version, inprogress, finished = F.col("version"), F.col("timestamp_inprogress"), F.col("timestamp_finished")
    at = F.when(version == 1, F.col("timestamp")).when(version == 2, inprogress).otherwise(finished)
    return (
        tickets(spark, root)
        .withColumn("version", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .withColumn("dt", F.to_date(at)).where(at.isNotNull())
        .select("ticket_id", "timestamp", F.when(version >= 2, inprogress).alias("timestamp_inprogress"),
                F.when(version == 3, finished).alias("timestamp_finished"), "final_state", "district",
                CATEGORY_ARRAY, "count_reopen", "lon", "version", "dt")
    )


def snapshot_columns(versions: DataFrame) -> DataFrame:
    """The raw feed row of each version: text timestamps, state code, coordinates."""
    version, pending = F.col("version"), F.col("final_state") == "pending"
    at = (F.when(version == 1, F.col("timestamp")).when(version == 2, F.col("timestamp_inprogress"))
          .otherwise(F.col("timestamp_finished")))
    return versions.select(
        "ticket_id",
        format_ts("timestamp").alias("timestamp"),
        format_ts(at).alias("last_activity"),
        format_ts("timestamp_inprogress").alias("timestamp_inprogress"),
        format_ts("timestamp_finished").alias("timestamp_finished"),
        F.when(version == 1, "start").when(version == 3, "finish").when(pending, "pending")
        .otherwise("inprogress").alias("state_type_latest"),
        "district",
        CATEGORY_ARRAY,
        "count_reopen",
        version.cast("long").alias("view_count"),
        "lon",
        F.when(version == 1, _coord(13.50, "ticket_id", 50)).otherwise(_coord(13.45, "ticket_id", 60)).alias("lat"),
        "dt",
    )


def bronze_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Raw feed rows: one per ticket version, text timestamps, ``dt`` = version day."""
    return snapshot_columns(ticket_versions(spark, root))


SNAPSHOT_TIE_BREAKERS = ("view_count",)


# --- landed feed pages from the events table ---------------------------------------
#
# Fixed fixture rules (shared with the SQL oracle): one poll per event day D; the
# poll's newest-first feed lists the events of D and of D-1, ranked by event id from
# the newest event of D; pages hold FEED_PAGE_SIZE features. A feature is
# ticket_id 'U' || user_id, last_activity = ts as text, district = event_type,
# categories = [event_type], view_count = props.k, coordinates
# [100.25 + (user_id % 80) / 100, 13.45 + (event_id % 60) / 100], and the raw state
# code by event type: signup -> start, view -> inprogress, purchase -> finish,
# click -> forward, error -> irrelevant. Reported user_id % 3 days before the event; in
# progress at the event for views and purchases; finished at it for purchases;
# count_reopen = user_id % 2. The property event_id is not among the declared ones.
FEED_PAGE_SIZE = 50
EVENT_STATE_CODES = {"signup": "start", "view": "inprogress", "purchase": "finish",
                     "click": "forward", "error": "irrelevant"}


def _feed_events(spark: SparkSession, root: str, page_size: int) -> DataFrame:
    """(poll_day, page_offset, event): the events of every poll's feed, with what features need."""
    ev = (read_table(spark, root, "events", ["event_id", "ts", "user_id", "event_type", "props"])
          .withColumn("day", F.to_date("ts")))
    # one row per day: bounded by the calendar, so the joins below broadcast it, whatever the events' size
    tops = F.broadcast(ev.groupBy(F.col("day").alias("poll_day")).agg(F.max("event_id").alias("top")))
    same_day = ev.join(tops, F.col("day") == F.col("poll_day"))
    day_before = ev.join(tops, F.date_add(F.col("day"), 1) == F.col("poll_day"))
    offset = F.floor((F.col("top") - F.col("event_id")) / page_size).cast("long") * page_size
    event = F.struct("event_id", "ts", "user_id", "event_type",
                     F.get_json_object("props", "$.k").cast("long").alias("view_count"))
    return same_day.unionByName(day_before).select("poll_day", offset.alias("page_offset"), event.alias("event"))


def _feature(e: Column) -> Column:
    """The feature of an event."""
    state = F.create_map(*[F.lit(x) for kv in EVENT_STATE_CODES.items() for x in kv])
    kind, at = e["event_type"], format_ts(e["ts"])
    return F.struct(
        F.struct(F.lit("Point").alias("type"),
                 F.array(_coord(100.25, e["user_id"], 80), _coord(13.45, e["event_id"], 60))
                 .alias("coordinates")).alias("geometry"),
        F.struct(
            F.concat(F.lit("U"), e["user_id"].cast("string")).alias("ticket_id"),
            at.alias("last_activity"),
            kind.alias("district"),
            F.array(kind).alias(CATEGORY_ARRAY),
            state[kind].alias("state_type_latest"),
            format_ts(e["ts"] - F.make_dt_interval(e["user_id"] % 3)).alias("timestamp"),
            F.when(kind.isin("view", "purchase"), at).alias("timestamp_inprogress"),
            F.when(kind == "purchase", at).alias("timestamp_finished"),
            (e["user_id"] % 2).alias("count_reopen"),
            e["event_id"].alias("event_id"),
            e["view_count"].alias("view_count"),
        ).alias("properties"),
    )


def _poll_id() -> Column:
    return F.date_format("poll_day", "yyyy-MM-dd").alias("poll_id")


def feed_features(spark: SparkSession, root: str, page_size: int = FEED_PAGE_SIZE) -> DataFrame:
    """(poll_id, page_offset, feature) rows of every poll's feed."""
    return _feed_events(spark, root, page_size).select(_poll_id(), "page_offset", _feature(F.col("event")).alias("feature"))


def feed_pages(spark: SparkSession, root: str, page_size: int = FEED_PAGE_SIZE) -> DataFrame:
    """Pages as landed by the fetcher: one row per (poll, offset); a page holds at most
    ``page_size`` features, so the grouping is bounded. Events are grouped, and features are
    made of them after that."""
    return (_feed_events(spark, root, page_size)
            .groupBy("poll_day", "page_offset").agg(F.collect_list("event").alias("events"))
            .select(_poll_id(), "page_offset", F.transform("events", _feature).alias("features")))


#: Pages of a landed file, at most: compressed files are read by one task each.
PAGES_PER_FILE = 8192


def land_pages(pages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Pages written as the fetcher lands them: JSON records, compressed."""
    pages.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", PAGES_PER_FILE).json(path)
