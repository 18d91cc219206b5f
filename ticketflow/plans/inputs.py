"""Layer inputs over the driver's tables: bronze -> silver -> gold.

Each layer is published once per session into the shared folder named by
``spark.checkpoint.dir`` -- bronze as dated partitions, silver and gold as gated,
versioned publishes -- and later queries read the published tables, as the separate
jobs of a lakehouse do. Writing the layer cuts the lineage: a gold query does not
re-run the bronze dedup shuffle once per branch of its plan, and a lost executor
only costs the stage it was running.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.operators import gold
from ticketflow.operators.silver import silver_tickets
from ticketflow.plans.gold_build import build_gold
from ticketflow.plans.silver_publish import BRIDGE, TICKETS, publish_silver
from ticketflow.session import configure, scratch_path
from ticketflow.operators.bronze import flatten_features
from ticketflow.sources import feed, fixtures
from ticketflow.sources.lake import read_published, scan_partitioned, write_partitions

_STAGED: dict[tuple, str] = {}
_LOCK = threading.RLock()


def _staged(spark: SparkSession, root: str, layer: str, build) -> str:
    key = (spark.sparkContext.applicationId, os.path.abspath(root), layer)
    with _LOCK:
        if key not in _STAGED:
            path = scratch_path(spark, layer)
            build(path)
            _STAGED[key] = path
        return _STAGED[key]


def bronze_path(spark: SparkSession, root: str) -> str:
    configure(spark)
    return _staged(spark, root, "bronze",
                   lambda p: write_partitions(fixtures.ticket_versions(spark, root), p, "dt",
                                              after=fixtures.snapshot_columns))


def bronze(spark: SparkSession, root: str) -> DataFrame:
    """The bronze table: every dated partition of the landed snapshots."""
    return scan_partitioned(spark, bronze_path(spark, root))


def pages_path(spark: SparkSession, root: str) -> str:
    """Landed feed pages (JSON, one record per page) derived from the events table."""
    configure(spark)
    return _staged(spark, root, "landed",
                   lambda p: fixtures.land_pages(fixtures.feed_pages(spark, root), p))


def pages(spark: SparkSession, root: str) -> DataFrame:
    return feed.read_pages(spark, pages_path(spark, root))


def feed_rows(spark: SparkSession, root: str) -> DataFrame:
    """Every landed feature, flattened, with its poll and page; undeclared properties as
    JSON text."""
    keep = ("poll_id", "page_offset")
    rows = flatten_features(feed.page_features(pages(spark, root), keep), "feature", keep)
    return rows.withColumn("extra", F.to_json("extra"))


def events_by_day_path(spark: SparkSession, root: str) -> str:
    """The events table landed as daily partitions (the streaming source)."""
    configure(spark)
    ev = fixtures.read_table(spark, root, "events").withColumn("day", F.to_date("ts"))
    return _staged(spark, root, "events-by-day", lambda p: write_partitions(ev, p, "day"))


def silver_candidate(spark: SparkSession, root: str) -> DataFrame:
    """Silver tickets as a lazy plan over bronze (not yet gated or published)."""
    return silver_tickets(bronze(spark, root), tie_breakers=fixtures.SNAPSHOT_TIE_BREAKERS)


def silver_root(spark: SparkSession, root: str) -> str:
    def build(path):
        publish_silver(spark, bronze(spark, root), path,
                       tie_breakers=fixtures.SNAPSHOT_TIE_BREAKERS, report=lambda _: None)
    return _staged(spark, root, "silver", build)


def silver(spark: SparkSession, root: str) -> DataFrame:
    return read_published(spark, silver_root(spark, root), TICKETS)


def bridge(spark: SparkSession, root: str) -> DataFrame:
    return read_published(spark, silver_root(spark, root), BRIDGE)


def gold_root(spark: SparkSession, root: str) -> str:
    return _staged(spark, root, "gold",
                   lambda p: build_gold(spark, silver(spark, root), bridge(spark, root), p))


def gold_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_published(spark, gold_root(spark, root), table)


def daily(spark: SparkSession, root: str) -> DataFrame:
    """The daily fact built now from published silver (not read from gold)."""
    return gold.fact_daily(silver(spark, root))


def lifecycle(spark: SparkSession, root: str) -> DataFrame:
    return gold.fact_lifecycle(silver(spark, root))
