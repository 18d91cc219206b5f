"""Plan-level properties: builders run no Spark job, grid days are made after the exchange of
the cells and by several tasks, narrow tables are written without a shuffle."""

import datetime as dt

from pyspark.sql import functions as F

from ticketflow.operators import gold, reports
from ticketflow.operators.quality import quality_gate
from ticketflow.sources.lake import write_table


def jobs_started(spark, fn):
    sc = spark.sparkContext
    sc.setJobGroup("plan-probe", "builders must stay lazy")
    before = set(sc.statusTracker().getJobIdsForGroup("plan-probe"))
    fn()
    after = set(sc.statusTracker().getJobIdsForGroup("plan-probe"))
    sc.setJobGroup("", "")
    return after - before


def tickets(spark):
    schema = ("ticket_id string, district string, timestamp timestamp, timestamp_inprogress timestamp,"
              " timestamp_finished timestamp, status string, count_reopen long,"
              " problem_type_fondue array<string>")
    t = dt.datetime(2025, 5, 1, 9)
    return spark.createDataFrame([("A", "P", t, None, t + dt.timedelta(days=2), "resolved", 0, ["f"])],
                                 schema)


def test_builders_run_no_job(spark):
    t = tickets(spark)
    assert jobs_started(spark, lambda: gold.dim_date(t)) == set()
    assert jobs_started(spark, lambda: gold.fact_daily(t)) == set()
    assert jobs_started(spark, lambda: reports.top_backlog(gold.fact_daily(t), "f")) == set()
    cand = t.selectExpr("ticket_id", "100.5 AS lon", "13.8 AS lat")
    assert jobs_started(spark, lambda: quality_gate(cand)) == set()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_are_made_after_the_cell_exchange(spark):
    plan = plan_of(gold.fact_daily(tickets(spark)))
    top, rest = plan.split("Union", 1)
    assert "Exchange" not in top and "Window [" in top  # densify and backlog reuse the cells' partitioning
    grid = rest.split("Exchange hashpartitioning(district", 1)[0]
    assert "Generate explode" in grid  # above the exchange of the cells


def test_grid_rows_are_made_in_several_tasks(spark):
    t = tickets(spark)
    many = t.limit(0).unionByName(t.selectExpr("* except (district)", "explode(sequence(1, 60)) as n").selectExpr(
        "* except (n)", "concat('D', n) as district"))
    made = gold.cell_days(gold.dense_cells(gold.dim_district(many), gold.dim_category(gold.ticket_category_rows(many))),
                          F.lit("2025-01-01").cast("date"), F.lit("2025-03-01").cast("date"))
    parts = made.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 60 * 60


def test_narrow_tables_are_written_without_a_shuffle(spark, scratch):
    t = tickets(spark)
    write_table(gold.fact_lifecycle(t), scratch)
    assert "Exchange" not in plan_of(gold.fact_lifecycle(t))
    assert len(spark.read.parquet(scratch).inputFiles()) <= max(1, t.rdd.getNumPartitions())
