"""Landed feed pages: read them, and decide which pages a newest-first page scan
that stops at a time boundary would have kept.

A landed page is one JSON record ``{poll_id, page_offset, features: [feature...]}``
as fetched from the newest-first feed (the HTTP fetch itself is not part of this
library; pages are landed files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.config import CATEGORY_ARRAY
from ticketflow.functions.columns import col

#: Properties lifted as typed columns; any other property of a feature goes to ``extra``.
PROPERTIES = T.StructType([
    T.StructField("ticket_id", T.StringType()),
    T.StructField("last_activity", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("timestamp_inprogress", T.StringType()),
    T.StructField("timestamp_finished", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField(CATEGORY_ARRAY, T.ArrayType(T.StringType())),
    T.StructField("state_type_latest", T.StringType()),
    T.StructField("count_reopen", T.LongType()),
    T.StructField("view_count", T.LongType()),
])
FEATURE = T.StructType([
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ])),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
])
PAGE = T.StructType([
    T.StructField("poll_id", T.StringType()),
    T.StructField("page_offset", T.LongType()),
    T.StructField("features", T.ArrayType(FEATURE)),
])


def read_pages(spark: SparkSession, path: str, schema: T.StructType = PAGE) -> DataFrame:
    """Landed pages with a declared schema (no inference pass over the files).

    Properties are read as a map, so none is lost, whatever the source adds. A corrupt
    page fails the read: a page that silently became empty would end its poll early."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def page_features(pages: DataFrame, keep=("poll_id", "page_offset")) -> DataFrame:
    """One row per feature (struct column ``feature``), with the page's keys."""
    return pages.select(*keep, F.explode("features").alias("feature"))


PAGES_PER_BLOCK = 1024


def page_until_boundary(pages: DataFrame, boundary, page_size: int = 500,
                        max_records: int | None = None, poll: str = "poll_id",
                        offset: str = "page_offset",
                        order_field: str = "last_activity",
                        placeholders: DataFrame | None = None) -> DataFrame:
    """The pages a newest-first scan keeps: pages from offset 0 up to and including
    the first one whose oldest ``order_field`` is below ``boundary``. An empty page, or
    an offset at which no page landed, ends the scan. ``max_records`` (none by default)
    is checked before each page, so the last kept page may overshoot it. A page that
    landed twice counts once, and both copies are kept. ``placeholders`` (poll, offset) are
    pages that landed but can't be read: they hold their place and decide nothing.

    Each page needs three prefix values over the earlier pages of its poll: how many
    there are (fewer than its offset implies: a page is missing), features collected,
    and whether one already ended the scan. They are computed on one narrow summary row
    per page, in two levels so that no task ever holds a whole poll: pages are grouped
    into blocks of ``PAGES_PER_BLOCK`` consecutive offsets; block totals come from a
    group-by (map-side combined), a window over the *blocks* of a poll gives each
    block's prefix, and a window inside each block (at most ``PAGES_PER_BLOCK`` rows)
    finishes the page prefix. What is kept of a block is told by ranges of offsets, one for
    each run of pages without a gap: the normal scan has one range for ``PAGES_PER_BLOCK``
    pages, so the ranges are broadcast and the page rows, which hold the features, are kept
    where they are read, without a shuffle. ``boundary`` is a literal or a column of the page
    rows (per-poll bounds).
    """
    bound = col(boundary) if not isinstance(boundary, str) else F.lit(boundary)
    oldest = F.array_min(F.transform("features", lambda f: f["properties"][order_field]))
    marks = pages.select(poll, offset, F.size("features").alias("_n"),
                         ((oldest < bound) | (F.size("features") == 0)).alias("_stop"))
    if placeholders is not None:
        marks = marks.unionByName(placeholders.select(
            poll, offset, F.lit(0).alias("_n"), F.lit(False).alias("_stop")))
    block = F.floor(F.col(offset) / F.lit(page_size * PAGES_PER_BLOCK))
    summary = (
        marks.groupBy(poll, offset).agg(F.max("_n").alias("_n"), F.max("_stop").alias("_stop"))
        .withColumn("_block", block)
    )
    by_block = Window.partitionBy(poll).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = (
        summary.groupBy(poll, "_block")
        .agg(F.sum("_n").alias("_bn"), F.max("_stop").alias("_bstop"),
             F.count(F.lit(1)).alias("_bpages"))
        .select(poll, "_block",
                F.coalesce(F.sum("_bn").over(by_block), F.lit(0)).alias("_block_before"),
                F.coalesce(F.sum("_bpages").over(by_block), F.lit(0)).alias("_block_pages"),
                F.coalesce(F.max("_bstop").over(by_block), F.lit(False))
                .alias("_block_stopped"))
    )
    ordered = Window.partitionBy(poll, "_block").orderBy(offset)
    in_block = ordered.rowsBetween(Window.unboundedPreceding, -1)
    gapless = (F.col("_block_pages") + F.col("_rank")) * page_size == F.col(offset)
    under_cap = (F.lit(True) if max_records is None
                 else F.col("_block_before") + F.col("_before") < max_records)
    kept = (
        summary.select(
            poll, offset, "_block",
            (F.row_number().over(ordered) - 1).alias("_rank"),
            F.coalesce(F.sum("_n").over(in_block), F.lit(0)).alias("_before"),
            F.coalesce(F.max("_stop").over(in_block), F.lit(False)).alias("_stopped"),
        )
        .join(blocks, [poll, "_block"], "inner")
        .where(gapless & under_cap & ~(F.col("_block_stopped") | F.col("_stopped")))
        .select(poll, "_block", F.col(offset).alias("_at"))
    )
    # kept pages whose offsets follow each other have no page between them
    run = F.col("_at") - F.row_number().over(Window.partitionBy(poll, "_block").orderBy("_at")) * page_size
    ranges = (kept.withColumn("_run", run).groupBy(poll, "_block", "_run")
              .agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"))
              .select(F.col(poll).alias("_poll"), "_block", "_from", "_to"))
    mine = ((pages[poll] == ranges["_poll"])
            & (F.floor(pages[offset] / F.lit(page_size * PAGES_PER_BLOCK)) == ranges["_block"])
            & pages[offset].between(ranges["_from"], ranges["_to"]))
    return pages.join(F.broadcast(ranges), mine, "left_semi")
