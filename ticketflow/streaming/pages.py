"""Landed feed pages as a stream: every page once, however often it was landed.

A fetcher that is retried lands pages again, and a restarted query sees files that it has not committed
again. Pages are told apart by (poll, offset) in keyed state: the first copy passes, later ones
are dropped for as long as the state remembers the page. The watermark follows the time of the poll,
``delay`` behind the newest poll seen, and lets the state forget pages once it has passed them; a page
whose poll lies behind it is late: it is dropped and counted, and goes in by a batch load of its day.

Each micro-batch writes a folder of its own below the log, replacing what an earlier attempt of the
same batch left, so a batch that is repeated after a failure counts once. The page scan's stop rule
needs all pages of a poll, which a stream never knows to have; the window filter drops what lies
before the poll's day, so for a feed without gaps the log equals the batch load.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.config import FEED_SOURCE_TAG
from ticketflow.functions.columns import in_window
from ticketflow.operators.bronze import lift
from ticketflow.plans.bronze_load import poll_day_bounds, window_rows
from ticketflow.sources.feed import PAGE, PROPERTIES

BATCH = "_batch_id"
#: Kept reports of micro-batches, from which dropped pages are counted.
_REPORTS = 100_000


@dataclass(frozen=True)
class StreamReport:
    """What one run of the stream did: pages read, pages behind the watermark (dropped), pages whose state
    is still held, and micro-batches."""

    pages: int
    late_pages: int
    remembered: int
    batches: int


def distinct_pages(pages: DataFrame, delay: str, poll: str = "poll_id", offset: str = "page_offset",
                   poll_time: Column | None = None) -> DataFrame:
    """The first copy of every page of a stream. ``poll_time`` (a timestamp; default: the day that names
    the poll) drives the watermark."""
    at = F.to_timestamp(F.col(poll)) if poll_time is None else poll_time
    return (pages.withColumn("_poll_time", at).withWatermark("_poll_time", delay)
            .dropDuplicatesWithinWatermark([poll, offset]).drop("_poll_time"))


def within_window(pages: DataFrame, bounds: dict[str, Column], schema: T.StructType = PROPERTIES,
                  order_field: str = "last_activity") -> DataFrame:
    """Every page with those of its features that ``window_rows`` will keep."""
    return pages.withColumn("features", F.filter("features", lambda f: in_window(
        lift(f["properties"], schema[order_field]), bounds["start"], bounds["end"])))


def run_pages(spark: SparkSession, pages_path: str, log_path: str, checkpoint: str, delay: str = "7 days",
              source: str = FEED_SOURCE_TAG, bounds: dict[str, Column] | None = None, poll: str = "poll_id",
              ingested_at: str | Column | None = None, schema: T.StructType = PROPERTIES,
              max_files_per_trigger: int = 200) -> StreamReport:
    """Consume every page file now in ``pages_path`` that earlier runs with this checkpoint have not."""
    pages = (spark.readStream.schema(PAGE).option("mode", "FAILFAST")
             .option("maxFilesPerTrigger", max_files_per_trigger).json(pages_path))
    b = bounds or poll_day_bounds(poll)
    # features outside their poll's window end here, before pages are shuffled to their state
    rows = window_rows(distinct_pages(within_window(pages, b, schema), delay, poll), source, b, poll, ingested_at, schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        # all of the folder, also where an earlier attempt wrote days that this one does not have
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("dt").parquet(
            f"{log_path.rstrip('/')}/{BATCH}={batch_id}")

    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, str(_REPORTS))
    try:
        query = (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set(kept, before)
    reports = [p for p in query.recentProgress if p["stateOperators"]]
    state = [s for p in reports for s in p["stateOperators"]]
    return StreamReport(sum(p["numInputRows"] for p in reports), sum(s["numRowsDroppedByWatermark"] for s in state),
                        state[-1]["numRowsTotal"] if state else 0, len({p["batchId"] for p in reports}))


def read_pages_log(spark: SparkSession, log_path: str) -> DataFrame:
    """All bronze rows that the stream has landed."""
    return spark.read.option("basePath", log_path).parquet(log_path).drop(BATCH)
