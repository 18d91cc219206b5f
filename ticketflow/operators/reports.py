"""Analytical queries on the gold facts. The latest day is a scalar subquery inside
the plan, not a value collected to the driver; ties are broken by district so top-k
results are deterministic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.operators.gold import median_of


def latest_day(daily: DataFrame) -> DataFrame:
    """One row: the latest snapshot day."""
    return daily.agg(F.max("date").alias("latest_date"))


def top_backlog(daily: DataFrame, category: str, k: int = 5,
                calendar: DataFrame | None = None) -> DataFrame:
    """Top-k districts by backlog for one category on the latest day.

    With the ``calendar`` dimension the latest day comes from it, not from a scan of the
    fact; a fact laid out by ``year`` is read for that day's year only."""
    latest = (daily if calendar is None else calendar).agg(F.max("date")).scalar()
    rows = daily.where((F.col("category") == category) & (F.col("date") == latest))
    if "year" in daily.columns:
        rows = rows.where(F.col("year") == F.year(latest))
    return (
        rows.select("district", "backlog")
        .orderBy(F.col("backlog").desc_nulls_last(), F.col("district").asc_nulls_first())
        .limit(k)
    )


def median_resolution(lifecycle: DataFrame, k: int = 5, exact: bool = False) -> DataFrame:
    """Median days to resolve per district over resolved tickets; the k slowest.

    A null district is its own group, as in any group-by.
    """
    return (
        lifecycle.where(F.col("is_resolved"))
        .groupBy("district")
        .agg(median_of("days_to_resolve", exact).alias("median_days"),
             F.count(F.lit(1)).alias("resolved_n"))
        .orderBy(F.col("median_days").desc_nulls_last(), F.col("district").asc_nulls_first())
        .limit(k)
    )
