"""Feed pages that cannot be read do not fail a load, and do not end their poll unseen.

Pages are read permissively, one JSON record a line, with the text of a bad one kept. A page is good if it
parses and has its poll, offset and features; all others go to a dead-letter table with the file they
came from, their address as far as it can be told, the reason, and the text. The load goes ahead with the good
pages unless the bad ones exceed a share of all. A bad page whose address can be told holds
its place in the page scan, so the pages after it land too; without an address the scan ends before it,
as at any page that did not land, and a re-fetch of the dead letters mends it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.config import FEED_SOURCE_TAG
from ticketflow.plans.bronze_load import poll_day_bounds, window_rows
from ticketflow.session import scratch_path
from ticketflow.sources.feed import FEATURE, PROPERTIES, page_until_boundary
from ticketflow.sources.lake import write_partitions

BAD = "_bad_record"
_READ = T.StructType([
    T.StructField("poll_id", T.StringType()), T.StructField("page_offset", T.LongType()),
    T.StructField("features", T.ArrayType(FEATURE)), T.StructField(BAD, T.StringType())])
DEAD_LETTER = "poll_id string, page_offset long, reason string, file string, record string"


class TooManyBadPages(RuntimeError):
    """The share of unreadable pages is above what the load accepts; nothing was landed."""


def read_with_dead_letters(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good pages, dead letters) of the landed pages at ``path``. Read once and staged, as both come from
    one pass over the text."""
    lines = spark.read.schema(_READ).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).json(path)
    text = F.col(BAD)
    reason = (F.when(text.isNotNull(), F.when(F.trim(text) == "", "empty").otherwise("not a page"))
              .when(F.col("poll_id").isNull(), "no poll_id").when(F.col("page_offset").isNull(), "no page_offset")
              .when(F.col("features").isNull(), "no features"))
    staged = scratch_path(spark, "pages-read")
    (lines.withColumns({"reason": reason, "file": F.input_file_name(), "good": reason.isNull()})
     .write.partitionBy("good").parquet(staged))
    rows = spark.read.schema(T.StructType([*_READ, T.StructField("reason", T.StringType()), T.StructField(
        "file", T.StringType()), T.StructField("good", T.BooleanType())])).parquet(staged)
    good = rows.where("good").select("poll_id", "page_offset", "features")
    # the address of a broken record, if its beginning says so
    poll = F.regexp_extract(text, r'"poll_id"\s*:\s*"([^"]*)"', 1)
    offset = F.regexp_extract(text, r'"page_offset"\s*:\s*(\d{1,18})(?!\d)', 1)
    dead = rows.where("not good").select(
        F.coalesce("poll_id", F.nullif(poll, F.lit(""))).alias("poll_id"),
        F.coalesce("page_offset", offset.try_cast("long")).alias("page_offset"),
        "reason", "file", F.coalesce(text, F.to_json(F.struct("poll_id", "page_offset"))).alias("record"))
    return good, dead


def load_with_quarantine(spark: SparkSession, pages_path: str, out_path: str, dead_path: str, page_size: int = 500,
                         most_bad: float = 0.01, source: str = FEED_SOURCE_TAG,
                         bounds: dict[str, Column] | None = None, ingested_at: str | Column | None = None,
                         schema: T.StructType = PROPERTIES) -> dict[str, int]:
    """Land the good pages' windows as dated partitions and write the dead letters; returns pages, bad
    pages and rows written. Dead letters are written in any case; above ``most_bad`` of all pages nothing is
    landed and ``TooManyBadPages`` is raised."""
    good, dead = read_with_dead_letters(spark, pages_path)
    dead.write.mode("overwrite").parquet(dead_path)
    dead = spark.read.schema(DEAD_LETTER).parquet(dead_path)
    n_good, n_bad = good.count(), dead.count()
    if n_bad > most_bad * (n_good + n_bad):
        raise TooManyBadPages(f"{n_bad} of {n_good + n_bad} pages can't be read; dead letters at {dead_path}")
    b = bounds or poll_day_bounds("poll_id")
    placed = dead.where("poll_id is not null and page_offset is not null").select("poll_id", "page_offset").distinct()
    kept = page_until_boundary(good, b["start"], page_size, placeholders=placed)
    written = write_partitions(window_rows(kept, source, b, "poll_id", ingested_at, schema), out_path, "dt")
    return {"pages": n_good + n_bad, "bad_pages": n_bad, "rows": int(written.get["rows"])}
