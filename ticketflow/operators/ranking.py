"""Extension: TOPSIS "service stress" ranking of districts (described by the
reference's plans, not built there).

Criteria per district come from the lifecycle fact; every criterion is "higher means
more stressed". Column norms and the ideal/anti-ideal points are single-row
aggregates over the per-district table (scalar subqueries), so the whole ranking is
columnar Spark expressions with no driver round trip.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_WEIGHTS = {"open_tickets": 0.4, "median_days": 0.4, "reopen_rate": 0.2}


def district_criteria(lifecycle: DataFrame) -> DataFrame:
    """open tickets, median days to resolve (resolved only) and reopen rate."""
    days = F.when(F.col("is_resolved"), F.col("days_to_resolve"))
    return (
        lifecycle.where(F.col("district").isNotNull())
        .groupBy("district")
        .agg(
            F.count_if(~F.col("is_resolved")).cast("double").alias("open_tickets"),
            F.coalesce(F.percentile_approx(days, 0.5), F.lit(0)).cast("double")
            .alias("median_days"),
            (F.count_if(F.col("is_reopened")) / F.count(F.lit(1))).alias("reopen_rate"),
        )
    )


def topsis(criteria: DataFrame, weights: Mapping[str, float] = DEFAULT_WEIGHTS,
           key: str = "district", digits: int = 6) -> DataFrame:
    """Closeness of each alternative to the most-stressed ideal, in [0, 1]."""
    cols = list(weights)
    norms = {c: criteria.agg(F.sqrt(F.sum(F.col(c) * F.col(c)))).scalar() for c in cols}
    weighted = criteria.select(key, *cols, *[
        (F.when(norms[c] > 0, F.col(c) / norms[c]).otherwise(F.lit(0.0)) * F.lit(weights[c]))
        .alias(f"_w_{c}") for c in cols])
    best = {c: weighted.agg(F.max(f"_w_{c}")).scalar() for c in cols}
    worst = {c: weighted.agg(F.min(f"_w_{c}")).scalar() for c in cols}
    d_best = F.sqrt(sum((F.col(f"_w_{c}") - best[c]) ** 2 for c in cols))
    d_worst = F.sqrt(sum((F.col(f"_w_{c}") - worst[c]) ** 2 for c in cols))
    score = F.when(d_best + d_worst > 0, d_worst / (d_best + d_worst)).otherwise(F.lit(0.0))
    return weighted.select(key, *cols, F.round(score, digits).alias("stress_score"))
