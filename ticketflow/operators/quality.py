"""Silver quality gate, computed in ONE aggregation pass over the candidate.

Each check is a metric column of a single-row aggregate; the gate unpivots them into
``(name, passed, detail)`` rows. Only the few result rows ever reach the driver
(``assert_quality``), never data.

Fixed values, which other systems match on: the names of the checks (``non_empty``, ``not_null``,
``unique_<key>``, ``geo_bounds``, ``rowcount_delta``) and the wording of their details
(``<n> rows``, ``<n> rows null in [<columns>]``, ``<n> duplicate <key>``,
``<n> rows outside the city bbox``, ``silver=<n> vs bronze_distinct=<n> (min_ratio=<r>)``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.config import GateConfig
from ticketflow.functions.columns import any_null, in_bbox

@dataclass(frozen=True)
class CheckResult:
    name: str
    passed: bool
    detail: str


def distinct_keys(df: DataFrame, key: str) -> Column:
    """Distinct key values with null counted as one value (like select.distinct.count)."""
    return F.count_distinct(key) + F.max(F.col(key).isNull().cast("int"))


def _rows(df: DataFrame) -> Column:
    return F.count(F.lit(1))


def _not_null_label(cols) -> str:
    return "[" + ", ".join(f"'{c}'" for c in cols) + "]"


def check_non_empty(df: DataFrame) -> DataFrame:
    m = df.agg(_rows(df).alias("n"))
    return m.select(F.lit("non_empty").alias("name"), (F.col("n") > 0).alias("passed"),
                    F.format_string("%d rows", "n").alias("detail"))


def check_not_null(df: DataFrame, cols=("ticket_id", "lon", "lat")) -> DataFrame:
    m = df.agg(F.count_if(any_null(cols)).alias("bad"))
    return m.select(F.lit("not_null").alias("name"), (F.col("bad") == 0).alias("passed"),
                    F.format_string(f"%d rows null in {_not_null_label(cols)}", "bad")
                    .alias("detail"))


def check_unique(df: DataFrame, key: str = "ticket_id") -> DataFrame:
    m = df.agg(_rows(df).alias("n"), distinct_keys(df, key).alias("d"))
    dup = F.col("n") - F.coalesce(F.col("d"), F.lit(0))
    return m.select(F.lit(f"unique_{key}").alias("name"), (dup == 0).alias("passed"),
                    F.format_string(f"%d duplicate {key}", dup).alias("detail"))


def check_geo_bounds(df: DataFrame, cfg: GateConfig = GateConfig()) -> DataFrame:
    m = df.agg(F.count_if(~in_bbox(cfg.lon, cfg.lat, cfg.bbox)).alias("bad"))
    return m.select(F.lit("geo_bounds").alias("name"), (F.col("bad") == 0).alias("passed"),
                    F.format_string("%d rows outside the city bbox", "bad").alias("detail"))


def _delta_passed(n: Column, base: Column, ratio: float) -> Column:
    return (base > 0) & (n <= base) & (n >= base * F.lit(ratio))


def check_rowcount_delta(df: DataFrame, bronze_count: Column | int,
                         min_ratio: float = 0.5) -> DataFrame:
    """Silver rows within ``[min_ratio * bronze, bronze]`` of the distinct bronze keys.

    ``bronze_count`` may be a number or a scalar-subquery column (then the baseline
    is computed inside the same plan, not collected first)."""
    base = bronze_count if isinstance(bronze_count, Column) else F.lit(bronze_count)
    m = df.agg(_rows(df).alias("n")).withColumn("b", base.cast("long"))
    return m.select(
        F.lit("rowcount_delta").alias("name"),
        F.coalesce(_delta_passed(F.col("n"), F.col("b"), min_ratio), F.lit(False))
        .alias("passed"),
        F.format_string(f"silver=%d vs bronze_distinct=%d (min_ratio={min_ratio})",
                        "n", "b").alias("detail"),
    )


def gate_metrics(df: DataFrame, cfg: GateConfig = GateConfig()) -> DataFrame:
    """All candidate metrics in one aggregate (one scan, one shuffle for the distinct)."""
    return df.agg(
        _rows(df).alias("n"),
        F.count_if(any_null(cfg.not_null)).alias("null_rows"),
        distinct_keys(df, cfg.key).alias("distinct_keys"),
        F.count_if(~in_bbox(cfg.lon, cfg.lat, cfg.bbox)).alias("outside"),
    )


def quality_gate(df: DataFrame, bronze_count: Column | int | None = None,
                 cfg: GateConfig = GateConfig()) -> DataFrame:
    """``(name, passed, detail)`` for every check; the delta check only with a baseline."""
    m = gate_metrics(df, cfg)
    dup = F.col("n") - F.coalesce(F.col("distinct_keys"), F.lit(0))
    checks = [
        F.struct(F.lit("non_empty").alias("name"), (F.col("n") > 0).alias("passed"),
                 F.format_string("%d rows", "n").alias("detail")),
        F.struct(F.lit("not_null").alias("name"), (F.col("null_rows") == 0).alias("passed"),
                 F.format_string(f"%d rows null in {_not_null_label(cfg.not_null)}",
                                 "null_rows").alias("detail")),
        F.struct(F.lit(f"unique_{cfg.key}").alias("name"), (dup == 0).alias("passed"),
                 F.format_string(f"%d duplicate {cfg.key}", dup).alias("detail")),
        F.struct(F.lit("geo_bounds").alias("name"), (F.col("outside") == 0).alias("passed"),
                 F.format_string("%d rows outside the city bbox", "outside").alias("detail")),
    ]
    if bronze_count is not None:
        base = bronze_count if isinstance(bronze_count, Column) else F.lit(bronze_count)
        m = m.withColumn("b", base.cast("long"))
        checks.append(F.struct(
            F.lit("rowcount_delta").alias("name"),
            F.coalesce(_delta_passed(F.col("n"), F.col("b"), cfg.min_ratio), F.lit(False))
            .alias("passed"),
            F.format_string(f"silver=%d vs bronze_distinct=%d (min_ratio={cfg.min_ratio})",
                            "n", "b").alias("detail")))
    return m.select(F.inline(F.array(*checks)))


def bronze_baseline(bronze: DataFrame, key: str = "ticket_id") -> Column:
    """Distinct bronze keys (null as one value) as a scalar subquery column."""
    return bronze.agg(distinct_keys(bronze, key)).scalar()


class QualityError(ValueError):
    """A gate that did not pass; ``failures`` are the checks that failed."""

    def __init__(self, failures: list[CheckResult]):
        self.failures = failures
        super().__init__("; ".join(f"{c.name} failed: {c.detail}" for c in failures))


def collect_results(gate: DataFrame) -> list[CheckResult]:
    """The handful of result rows (one per check) on the driver."""
    return [CheckResult(r["name"], bool(r["passed"]), r["detail"]) for r in gate.collect()]


def assert_quality(df: DataFrame, bronze_count: Column | int | None = None,
                   cfg: GateConfig = GateConfig(), report=print) -> list[CheckResult]:
    """All checks of the gate, one ``report`` call each; ``QualityError`` if any failed."""
    outcome: dict[bool, list[CheckResult]] = {True: [], False: []}
    for check in collect_results(quality_gate(df, bronze_count, cfg)):
        outcome[check.passed].append(check)
        report(f"{check.name}: {'ok' if check.passed else 'not ok'} ({check.detail})")
    if outcome[False]:
        raise QualityError(outcome[False])
    return outcome[True]


# --- extensions described by the reference's docs ------------------------------------

def check_referential(fact: DataFrame, dim: DataFrame, fk: str = "district",
                      pk: str | None = None) -> DataFrame:
    """Non-null foreign keys missing from the dimension (anti-join; the dimension is a
    distinct-value table, broadcast by AQE when it measures small)."""
    pk = pk or fk
    orphans = (fact.where(F.col(fk).isNotNull())
               .join(dim.select(F.col(pk).alias(fk)), fk, "left_anti"))
    m = orphans.agg(F.count(F.lit(1)).alias("bad"))
    return m.select(F.lit(f"referential_{fk}").alias("name"), (F.col("bad") == 0).alias("passed"),
                    F.format_string(f"%d rows with {fk} missing from the dimension", "bad")
                    .alias("detail"))


def check_referentials(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """``check_referential`` for several foreign keys in one pass over the fact: each key's values are
    counted (summed before the shuffle), and only the distinct ones meet the dimensions, in which a key
    has its own name."""
    keys = list(dims)
    text = lambda c: F.col(c).cast("string").alias("value")
    values = fact.select(F.explode(F.array(*(F.struct(F.lit(k).alias("fk"), text(k)) for k in keys))).alias("v"))
    counted = (values.select("v.*").where("value is not null").groupBy("fk", "value")
               .agg(F.count(F.lit(1)).alias("n")))
    known = None
    for k, dim in dims.items():
        rows = dim.select(F.lit(k).alias("fk"), text(k))
        known = rows if known is None else known.unionByName(rows)
    bad = counted.join(known, ["fk", "value"], "left_anti").groupBy("fk").agg(F.sum("n").alias("n"))
    bad = bad.agg(F.map_from_entries(F.collect_list(F.struct("fk", "n"))).alias("bad"))  # an entry a key
    rows = bad.select("bad", F.posexplode(F.array(*map(F.lit, keys))).alias("k", "fk"))
    n = F.coalesce(F.try_element_at("bad", F.col("fk")), F.lit(0).cast("long"))
    return rows.select(F.concat(F.lit("referential_"), F.col("fk")).alias("name"), (n == 0).alias("passed"),
                       F.format_string("%d rows with %s missing from the dimension", n, F.col("fk")).alias("detail"))


def expected_days(spark, first: str, last: str, partition: str = "dt") -> DataFrame:
    """The days ``first..last`` that a source should have landed."""
    day = lambda d: F.lit(d).cast("date")
    return spark.range(1).select(F.explode(F.sequence(day(first), day(last))).alias(partition))


def check_freshness(landed: DataFrame, partition: str = "dt", ingested_at: str = "_ingested_at",
                    deadline_hours: int = 6, expected: DataFrame | None = None) -> DataFrame:
    """Per dated partition: was it landed by the next day's deadline (UTC)? With ``expected`` (the days
    that should be there, see ``expected_days``) a day that never landed is a row too, not on time and
    without a landing time."""
    landed_at = F.to_timestamp(F.substring(F.col(ingested_at), 1, 19),
                               "yyyy-MM-dd'T'HH:mm:ss")
    per_day = landed.groupBy(partition).agg(F.max(landed_at).alias("last_landed_at"))
    if expected is not None:
        per_day = expected.select(partition).distinct().join(per_day, partition, "full")
    deadline = (F.to_timestamp(F.date_add(F.col(partition), 1))
                + F.make_dt_interval(F.lit(0), F.lit(deadline_hours)))
    return per_day.select(partition, "last_landed_at", deadline.alias("deadline"),
                          F.coalesce(F.col("last_landed_at") <= deadline, F.lit(False)).alias("on_time"))
