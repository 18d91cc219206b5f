"""What to land again: days that are missing, late or only partly there, as contiguous ranges.

A calendar of expected days is compared with what landed (rows and load time per partition) and with what
the polls hold (rows that a complete load of the day would land). Days that are not in order are joined to
islands: runs of consecutive days with the same finding. The plan has a row per island, so a gap of a
year is one range and not 365 jobs; ``reland`` lands all ranges in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.config import FEED_SOURCE_TAG
from ticketflow.operators.quality import check_freshness
from ticketflow.plans.bronze_load import landed_rows, load_bronze
from ticketflow.sources.feed import PROPERTIES

MISSING, PARTIAL, LATE, COMPLETE = "missing", "partial", "late", "complete"


def day_findings(landed: DataFrame, held: DataFrame, expected: DataFrame, partition: str = "dt",
                 ingested_at: str = "_ingested_at", deadline_hours: int = 6) -> DataFrame:
    """(day, landed_rows, held_rows, finding) for every expected day. ``held`` has rows (or counts, column
    ``n``) by day of what complete loads would land. A day with too few rows is partial, whenever it
    landed; one that has nothing to land and did not is complete."""
    here = landed.groupBy(partition).agg(F.count(F.lit(1)).alias("landed_rows"))
    there = held if "n" in held.columns else held.withColumn("n", F.lit(1).cast("long"))
    there = there.groupBy(partition).agg(F.sum("n").alias("held_rows"))
    fresh = check_freshness(landed, partition, ingested_at, deadline_hours, expected)
    days = (expected.select(partition).distinct().join(here, partition, "left").join(there, partition, "left")
            .join(fresh.select(partition, "on_time"), partition, "left")
            .fillna({"landed_rows": 0, "held_rows": 0}))
    finding = (F.when(F.col("landed_rows") < F.col("held_rows"),
                      F.when(F.col("landed_rows") == 0, MISSING).otherwise(PARTIAL))
               .when((F.col("landed_rows") > 0) & ~F.col("on_time"), LATE).otherwise(COMPLETE))
    return days.select(partition, "landed_rows", "held_rows", finding.alias("finding"))


def backfill_plan(findings: DataFrame, partition: str = "dt") -> DataFrame:
    """(first_day, last_day, days, finding, missing_rows) per island of consecutive days with one finding
    that is not ``complete``. The windows run over the calendar, not over data."""
    numbered = F.date_diff(partition, F.lit("1970-01-01").cast("date"))
    order = F.row_number().over(Window.partitionBy("finding").orderBy(partition))
    return (findings.where(F.col("finding") != COMPLETE)
            .withColumn("island", numbered - order).groupBy("finding", "island")
            .agg(F.min(partition).alias("first_day"), F.max(partition).alias("last_day"),
                 F.count(F.lit(1)).alias("days"), F.sum(F.col("held_rows") - F.col("landed_rows")).alias("missing_rows"))
            .drop("island"))


def planned_pages(pages: DataFrame, plan: DataFrame, findings=(MISSING, PARTIAL), poll: str = "poll_id") -> DataFrame:
    """The pages of the polls in the plan's ranges. The ranges' days are part of a calendar, so they are
    broadcast and the pages aren't shuffled."""
    days = plan.where(F.col("finding").isin(*findings)).select(
        F.explode(F.sequence("first_day", "last_day")).alias("_day"))
    return pages.join(F.broadcast(days), F.to_date(poll) == F.col("_day"), "left_semi")


def reland(pages: DataFrame, plan: DataFrame, out_path: str, page_size: int = 500, findings=(MISSING, PARTIAL),
           source: str = FEED_SOURCE_TAG, poll: str = "poll_id", ingested_at: str | Column | None = None,
           schema: T.StructType = PROPERTIES) -> int:
    """Land the days of the plan's ranges again, all in one job; returns the rows written. Only the pages
    of their polls are read on."""
    wanted = planned_pages(pages, plan, findings, poll)
    return load_bronze(wanted, out_path, page_size, source=source, ingested_at=ingested_at, schema=schema)


def held_rows(pages: DataFrame, page_size: int = 500) -> DataFrame:
    """(dt, n): how many rows a complete load of each poll's day lands."""
    return landed_rows(pages, page_size).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
