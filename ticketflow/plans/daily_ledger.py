"""The daily fact kept up to date by deltas, without reading tickets that did not change.

Beside the fact lies a *ledger*: how many tickets were reported and finished, and how many
ticket-categories were opened and closed after how many days, per district, category and day. All of it
is additive, so a changed ticket is a few signed entries: minus what its old version counted, plus what
the new one does. A refresh adds them to the ledger of the years they fall on, and writes these years
of the fact anew from the ledger alone.

The fact's backlog is kept within the year (a prefix sum over its days); what a cell carries into a year is
a row of the small *carry* table. A change in one year moves later years by their carried value only:
their files stay as they are. ``read_daily`` puts both together. All years are written only where the
grid itself changed: new or vanished districts or categories, or another first day.

Every refresh writes a new run; its manifest names, for each year, the run that holds the year's files,
so unchanged years are shared between runs. The pointer moves last: readers see all of a run or none,
a refresh that dies leaves the old one in force, and one that was overtaken by another is refused.

Medians are the lower middle of the days to resolve, exact, from the ledger's counts by days.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ticketflow.config import CATEGORY_ARRAY
from ticketflow.functions.columns import day_diff, is_blank
from ticketflow.operators import gold
from ticketflow.session import scratch_path
from ticketflow.sources.lake import names_in, _pointed, read_text, run_path, set_current, write_text

LEDGER = "kind string, district string, category string, date date, days int, n long"
FACT = "district string, category string, date date, opened long, closed long, in_year long, median_resolution_time int"
SUMMARY = "year int, district string, category string, tickets long, entries long, net long"
CARRY = "district string, category string, year int, carried long"
#: Kinds of entries: a ticket reported or finished, a ticket-category opened or closed.
REPORTED, FINISHED, OPENED, CLOSED = "reported", "finished", "opened", "closed"
CELL = list(gold.CELL)


def contributions(tickets: DataFrame, sign: int = 1, array_col: str = CATEGORY_ARRAY) -> DataFrame:
    """Entries (kind, district, category, date, days, n) of silver ``tickets``."""
    reported, finished = F.to_date("timestamp"), F.to_date("timestamp_finished")
    none, days = F.lit(None), day_diff("timestamp_finished", "timestamp")
    entry = lambda kind, category, date, days: F.struct(
        F.lit(kind).alias("kind"), category.cast("string").alias("category"), date.alias("date"),
        days.cast("int").alias("days"))
    own = F.array(entry(REPORTED, none, reported, none), entry(FINISHED, none, finished, none))
    by_category = F.flatten(F.transform(F.coalesce(array_col, F.array().cast("array<string>")), lambda c: F.array(
        entry(OPENED, c, reported, none), entry(CLOSED, c, finished, days))))
    # a ticket without a report date still makes its district and categories known
    return (tickets.select("district", F.explode(F.concat(own, by_category)).alias("e")).select("e.*", "district")
            .where(F.col("date").isNotNull() | F.col("kind").isin(REPORTED, OPENED))
            .select("kind", "district", "category", "date", "days", F.lit(sign).cast("long").alias("n")))


def _summed(entries: DataFrame) -> DataFrame:
    keys = ("kind", "district", "category", "date", "days")
    return entries.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


def _by_year(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.coalesce(F.year("date"), F.lit(0)))


def activity(ledger: DataFrame) -> DataFrame:
    """(district, category, date, opened, closed, median_resolution_time) of a ledger's cell-days."""
    day = Window.partitionBy(*gold.GRID_KEYS)
    closed = F.when(F.col("kind") == CLOSED, F.col("n")).otherwise(0)
    # the lower middle: the least days at which half of those with days are reached
    known = F.when(F.col("days").isNotNull(), closed).otherwise(0)
    upto = day.orderBy(F.col("days").asc_nulls_last()).rangeBetween(Window.unboundedPreceding, 0)
    rows = (ledger.where(F.col("kind").isin(OPENED, CLOSED) & F.col("date").isNotNull())
            .withColumns({"closed": closed, "below": F.sum(known).over(upto), "known": F.sum(known).over(day)}))
    return rows.groupBy(*gold.GRID_KEYS).agg(
        F.sum(F.when(F.col("kind") == OPENED, F.col("n")).otherwise(0)).alias("opened"),
        F.sum("closed").alias("closed"),
        F.min(F.when((F.col("known") > 0) & (F.col("below") * 2 >= F.col("known")) & F.col("days").isNotNull(), F.col("days")))
        .alias("median_resolution_time"))


class Manifest:
    """Which run holds the files of each year, and what is known of the ledger's years."""

    def __init__(self, spark: SparkSession, root: str, run: str = ""):
        self.spark, self.root, self.run = spark, root, run
        found = json.loads(read_text(spark, run_path(root, run, "manifest.json"))) if run else {}
        self.tables = {t: {int(y): r for y, r in found.get(t, {}).items()} for t in ("ledger", "fact")}
        #: year -> (first day reported, last day reported or finished), as text; years without either lack
        self.spans = {int(y): tuple(s) for y, s in found.get("spans", {}).items()}
        self.cells = found.get("cells")

    def write(self, run: str) -> None:
        text = json.dumps({**self.tables, "spans": self.spans, "cells": self.cells}, sort_keys=True)
        write_text(self.spark, run_path(self.root, run, "manifest.json"), text)

    def span(self) -> tuple[str | None, str | None]:
        """First reported day; last reported or finished day."""
        first = min((s[0] for s in self.spans.values() if s[0]), default=None)
        return first, max((s[1] for s in self.spans.values() if s[1]), default=None)

    def read(self, table: str, schema: str, years: Iterable[int] | None = None) -> DataFrame:
        runs = self.tables[table]
        wanted = [f"{run_path(self.root, runs[y], table)}/year={y}" for y in (runs if years is None else years) if y in runs]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*wanted)

    def own(self, table: str, schema: str) -> DataFrame:
        """A table that every run writes whole."""
        if not self.run:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(run_path(self.root, self.run, table))


def _written_by_year(df: DataFrame, path: str) -> None:
    """A year's rows in as many files as their size asks for, not one for every task that had some."""
    df.hint("rebalance", "year").write.partitionBy("year").parquet(path)


def _years_in(spark: SparkSession, folder: str) -> set[int]:
    return {int(n.partition("=")[2]) for n in names_in(spark, folder) if n.startswith("year=")}


def _dense(ledger: DataFrame, cells: DataFrame, first: str, last: str, years: list[int]) -> DataFrame:
    """FACT rows (with ``year``) of every cell and day of ``years`` within ``first..last``."""
    day = lambda d: F.lit(d).cast("date")
    spans = F.array(*(F.sequence(day(max(first, f"{y:04d}-01-01")), day(min(last, f"{y:04d}-12-31"))) for y in years))
    grid = gold._by_cell(cells).select(*CELL, F.explode(F.flatten(spans)).alias("date"))
    cell_days = _by_year(gold.densify(grid, activity(ledger)))
    upto = Window.partitionBy(*CELL, "year").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    in_year = F.sum(F.col("opened")).over(upto) - F.sum(F.col("closed")).over(upto)
    return cell_days.withColumn("in_year", in_year).select(
        *gold.GRID_KEYS, "opened", "closed", "in_year", "median_resolution_time", "year")


def refresh_daily_ledger(spark: SparkSession, root: str, new: DataFrame, old: DataFrame | None = None,
                         run_id: str | None = None) -> dict:
    """Publish a new run under ``root``: ``new`` has the tickets that are new or changed as they are now,
    ``old`` the ones that changed or vanished as they were (none: nothing was published before). Returns
    the run and the years whose ledger and fact were written."""
    base = Manifest(spark, root, _pointed(spark, root))
    run, now = run_id or uuid.uuid4().hex[:16], Manifest(spark, root, base.run)
    at = lambda table: run_path(root, run, table)
    entries = contributions(new)
    if old is not None:
        entries = entries.unionByName(contributions(old, -1))
    deltas = scratch_path(spark, "daily-deltas")
    _written_by_year(_by_year(_summed(entries)), deltas)
    changed = sorted(_years_in(spark, deltas))
    if not changed and base.run:
        return {"run_id": base.run, "ledger_years": [], "fact_years": []}

    # the ledger of the changed years, and the days they span
    seen = Observation()
    span = [e for y in changed for e in (
        F.min(F.when((F.col("year") == y) & (F.col("kind") == REPORTED), F.col("date"))).cast("string").alias(f"first{y}"),
        F.max(F.when((F.col("year") == y) & F.col("kind").isin(REPORTED, FINISHED), F.col("date"))).cast("string").alias(f"last{y}"))]
    if changed:
        both = base.read("ledger", LEDGER, changed).unionByName(spark.read.schema(LEDGER).parquet(deltas).drop("year"))
        _written_by_year(_by_year(_summed(both)).observe(seen, *span), at("ledger"))
        found = seen.get
        for y in changed:
            now.spans.pop(y, None)
            if found[f"first{y}"] or found[f"last{y}"]:
                now.spans[y] = (found[f"first{y}"], found[f"last{y}"])
    left = _years_in(spark, at("ledger"))
    for y in changed:
        now.tables["ledger"].pop(y, None)
        if y in left:
            now.tables["ledger"][y] = run
    first, last = now.span()

    # by year and cell: what it adds to later years; then what each year starts with
    in_calendar = F.col("date") >= F.lit(first).cast("date")
    net = (F.when(F.col("kind") == OPENED, F.col("n")).when(F.col("kind") == CLOSED, -F.col("n")).otherwise(0)
           * F.when(in_calendar, 1).otherwise(0))
    moved = first != base.span()[0]
    recount = list(now.tables["ledger"]) if moved else changed
    now_ledger = _by_year(now.read("ledger", LEDGER, recount))
    counted = now_ledger.groupBy("year", *CELL).agg(
        F.sum(F.when(F.col("kind") == REPORTED, F.col("n")).otherwise(0)).alias("tickets"),
        F.sum(F.when(F.col("kind") == OPENED, F.col("n")).otherwise(0)).alias("entries"), F.sum(net).alias("net"))
    kept = base.own("summary", SUMMARY).where(~F.col("year").isin(recount)) if base.run else None
    counted = counted.select("year", *CELL, "tickets", "entries", "net")
    (counted if kept is None else kept.unionByName(counted)).write.parquet(at("summary"))
    summary = spark.read.schema(SUMMARY).parquet(at("summary"))
    districts = summary.where(F.col("tickets") > 0).where(~is_blank("district")).select("district").distinct()
    categories = summary.where(F.col("entries") > 0).where(~is_blank("category")).select("category").distinct()
    cells = gold.dense_cells(districts, categories)
    span_years = list(range(int(first[:4]), int(last[:4]) + 1)) if first and last else []
    starts = (cells.select(*CELL, F.explode(F.array(*map(F.lit, span_years)).cast("array<int>")).alias("year"))
              .join(summary.select(*CELL, "year", "net"), [*CELL, "year"], "left").fillna({"net": 0}))
    before = Window.partitionBy(*CELL).orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    sign = Observation()
    starts = starts.select(*CELL, "year", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("carried"))
    mark = F.when(F.col("year") == (span_years[0] if span_years else 0), F.xxhash64(*CELL).cast("decimal(38,0)"))
    starts.observe(sign, F.count(mark).alias("n"), F.sum(mark).cast("string").alias("s")).write.parquet(at("carry"))
    now.cells = [sign.get["n"], sign.get["s"]]

    # the years of the fact to write: those that changed, those whose days did, or all for another grid
    was_first, was_last = base.span()
    if now.cells != base.cells or first != was_first:
        years = span_years
    else:
        ends = range(min(int(last[:4]), int(was_last[:4])), max(int(last[:4]), int(was_last[:4])) + 1) if last != was_last else ()
        years = [y for y in span_years if y in changed or y in ends]
    if years:
        cells = spark.read.schema(CARRY).parquet(at("carry")).where(F.col("year") == span_years[0]).select(*CELL)
        _written_by_year(_dense(now.read("ledger", LEDGER, years), cells, first, last, years), at("fact"))
    written = _years_in(spark, at("fact"))
    now.tables["fact"] = {y: r for y, r in now.tables["fact"].items() if y in span_years and y not in years} | dict.fromkeys(written, run)
    now.write(run)
    set_current(spark, root, run, onto=base.run)
    return {"run_id": run, "ledger_years": changed, "fact_years": sorted(written)}


def read_daily(spark: SparkSession, root: str, years: Iterable[int] | None = None) -> DataFrame:
    """The published daily fact, of all years or of ``years`` (only their files are read)."""
    current = Manifest(spark, root, _pointed(spark, root))
    fact = current.read("fact", FACT, years).withColumn("year", F.year("date"))
    return fact.join(current.own("carry", CARRY), [*CELL, "year"]).withColumn(
        "backlog", F.col("in_year") + F.col("carried")).select(*gold.DAILY_COLUMNS)
