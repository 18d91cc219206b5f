"""Gold build: published silver -> three dimensions and two facts, published together.

Dimensions are written first and read back, so the daily fact's grid is built from
the small written tables instead of re-deriving them from silver.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.operators import gold
from ticketflow.session import scratch_path
from ticketflow.sources.lake import drop_partitions, run_path, set_current, write_table

GOLD_TABLES = ("dim_district", "dim_category", "dim_date", "fact_ticket_lifecycle",
               "fact_district_daily")


def write_daily(daily: DataFrame, path: str) -> None:
    """Write the daily fact by year, the range that reports and refreshes prune on."""
    write_table(daily.withColumn("year", F.year("date")), path, "year")


def build_gold(spark: SparkSession, tickets: DataFrame, bridge: DataFrame, out_root: str,
               end_date=None, run_id: str | None = None,
               exact_median: bool = False) -> dict[str, int]:
    run_id = run_id or uuid.uuid4().hex[:16]
    path = {t: run_path(out_root, run_id, t) for t in GOLD_TABLES}
    write_table(gold.dim_district(tickets), path["dim_district"])
    write_table(gold.dim_category(bridge), path["dim_category"])
    write_table(gold.dim_date(tickets, end_date), path["dim_date"])
    write_table(gold.fact_lifecycle(tickets), path["fact_ticket_lifecycle"])
    dims = [spark.read.parquet(path[t]) for t in ("dim_district", "dim_category", "dim_date")]
    write_daily(gold.fact_daily(tickets, None, *dims, exact_median=exact_median),
                path["fact_district_daily"])
    set_current(spark, out_root, run_id)
    counts = [spark.read.parquet(path[t]).agg(F.lit(t).alias("t"), F.count(F.lit(1)).alias("n")) for t in GOLD_TABLES]
    return {r["t"]: r["n"] for r in reduce(DataFrame.unionByName, counts).collect()}  # one job for all


def refresh_daily(path: str, tickets: DataFrame, since: Column, exact_median: bool = False) -> int:
    """Bring the daily fact at ``path`` up to date after tickets changed (``since`` as in
    ``gold.incremental_daily``); returns how many rows were written.

    Only the years from ``since`` on are computed and written; they are staged first, for they
    are computed from the old ones. Where that is every year (a change in the first one, new
    or vanished cells, another start of the calendar), the fact is rebuilt."""
    spark = tickets.sparkSession
    day = spark.range(1).select(since.alias("d")).first()["d"]
    if day is None:  # nothing changed
        return 0
    old = spark.read.parquet(path)
    first, last = gold.calendar_bounds(tickets).first()
    was_first, was_last = old.agg(F.min("date"), F.max("date")).first()
    now = gold.dense_cells(gold.dim_district(tickets), gold.dim_category(gold.ticket_category_rows(tickets)))
    # every cell has a row on every day, so one day tells which cells there were
    was = old.where(F.col("date") == F.lit(was_first)).select(*gold.CELL)
    if first is None or first != was_first or day.year <= first.year or not _same(now, was):
        daily = gold.fact_daily(tickets, exact_median=exact_median)
        write_daily(daily, path)
        return 0 if first is None else spark.read.schema(old.schema).parquet(path).count()
    new = gold.incremental_daily(old, tickets, F.lit(day), exact_median=exact_median).withColumn(
        "year", F.year("date")).where(F.col("year") >= day.year)
    staged = scratch_path(spark, "daily-refresh")
    new.write.parquet(staged)
    rows = spark.read.schema(new.schema).parquet(staged)
    (rows.write.partitionBy("year").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    if last.year < was_last.year:
        drop_partitions(spark, path, "year", lambda y: int(y) > last.year)
    return rows.count()


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables of distinct rows hold the same rows."""
    sign = lambda df, n: df.withColumn("_n", F.lit(n))
    both = sign(a, 1).unionByName(sign(b, -1))
    return both.groupBy(*a.columns).agg(F.sum("_n").alias("n")).where("n <> 0").isEmpty()
