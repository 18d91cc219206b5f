"""Schema log, bucketed state, sketches, gap plans, quarantine, history merges, compaction."""

import json
import os
from random import Random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.operators import history, quality, rollup
from ticketflow.plans import backfill
from ticketflow.plans.bronze_load import load_bronze
from ticketflow.session import scratch_path
from ticketflow.sources import buckets, compaction, key_sketches, quarantine, schema_log
from ticketflow.sources.feed import read_pages


def files_of(path):
    root = path.removeprefix("file:")
    return sorted(os.path.join(os.path.relpath(d, root), n) for d, _, names in os.walk(root) for n in names if n.endswith(".parquet"))


# --- schema log --------------------------------------------------------------------

def day(spark, dt, schema, *rows):
    return spark.createDataFrame(list(rows), schema).withColumn("dt", F.lit(dt).cast("date"))


def test_columns_of_all_partitions_are_read(spark, scratch):
    land = schema_log.land_evolving
    assert land(day(spark, "2025-01-01", "k string, n int, s struct<a:int>", ("a", 1, (1,))), scratch) == 1
    land(day(spark, "2025-01-02", "k string, n long, extra string, s struct<a:long,b:string>", ("b", 1 << 40, "x", (2, "y"))), scratch)
    land(day(spark, "2025-01-03", "f double, k string", (0.5, "c")), scratch)
    rows = {r["k"]: r.asDict(True) for r in schema_log.read_evolving(spark, scratch).collect()}
    assert {k: (r["n"], r["extra"], r["f"]) for k, r in rows.items()} == {
        "a": (1, None, None), "b": (1 << 40, "x", None), "c": (None, None, 0.5)}
    assert rows["a"]["s"] == {"a": 1, "b": None} and rows["b"]["s"] == {"a": 2, "b": "y"} and rows["c"]["s"] is None
    pruned = schema_log.read_evolving(spark, scratch, start="2025-01-02", end="2025-01-03")
    assert [r["k"] for r in pruned.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(dt" in pruned._jdf.queryExecution().toString()


def test_drift_is_refused_before_anything_lands(spark, scratch):
    schema_log.land_evolving(day(spark, "2025-01-01", "k string, n long", ("a", 1)), scratch)
    before = files_of(scratch)
    for schema, row, what in (("k string, n string", ("b", "x"), "n"), ("k string, N long", ("b", 1), "N"),
                              ("k array<string>, n long", (["b"], 1), "k"), ("k string, n double", ("b", 1.0), "n")):
        with pytest.raises(schema_log.SchemaDrift) as told:
            schema_log.land_evolving(day(spark, "2025-01-02", schema, row), scratch)
        assert [p[0] for p in told.value.problems] == [what] and told.value.partitions == ["dt=2025-01-02"]
        assert "dt=2025-01-02" in str(told.value)
    assert files_of(scratch) == before and schema_log.read_evolving(spark, scratch).count() == 1


def test_two_loads_that_widen_at_once_lose_nothing(spark, scratch):
    schema_log.land_evolving(day(spark, "2025-01-01", "k string", ("a",)), scratch)
    base = schema_log.table_schema(spark, scratch)
    for name in ("left", "right"):  # both saw the same log
        grown = T.StructType([*base, T.StructField(name, T.LongType())])
        schema_log.write_text(spark, f"{scratch}/_schemas/000001-{name}.json", grown.json())
    assert schema_log.table_schema(spark, scratch).names == ["k", "dt", "left", "right"]


# --- bucketed state ------------------------------------------------------------------

VERSIONS = "ticket_id long, last_activity string, n long"


def test_an_upsert_rewrites_touched_buckets_only(spark, scratch):
    state = spark.createDataFrame([(k, "1", k) for k in range(200)], VERSIONS)
    buckets.write_buckets(state, scratch, buckets=8)
    before = files_of(scratch)
    changes = spark.createDataFrame([(3, "2", -3), (3, "0", 0), (1000, "1", 1)], VERSIONS)
    touched = buckets.upsert_buckets(spark, scratch, changes)
    after = files_of(scratch)
    kept = lambda files: [f for f in files if int(f.split("=")[1].split("/")[0]) not in touched]
    assert 1 <= len(touched) <= 2 and kept(before) == kept(after) and before != after
    got = {r["ticket_id"]: r["n"] for r in buckets.read_buckets(spark, scratch).collect()}
    assert got == {k: k for k in range(200)} | {3: -3, 1000: 1}
    assert buckets.upsert_buckets(spark, scratch, changes) == touched  # again, after a failure say
    assert {r["ticket_id"]: r["n"] for r in buckets.read_buckets(spark, scratch).collect()} == got
    assert buckets.upsert_buckets(spark, scratch, changes.limit(0)) == []
    plan = buckets.read_buckets(spark, scratch, touched)._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan


# --- sketches --------------------------------------------------------------------------

def test_medians_roll_up_exactly_while_they_fit_and_closely_beyond(spark):
    rng = Random(4)
    base = [("P" if k % 3 else "Q", "x", f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", int(rng.paretovariate(0.6)))
            for k in range(6000)]
    rows = spark.createDataFrame(base, "district string, category string, d string, days_to_resolve int").withColumn(
        "finished_date", F.to_date("d"))

    def medians(k, by, period):
        return {(r[0], str(r[1])): r["median_days"] for r in
                rollup.rollup_medians(rollup.resolution_sketches(rows, k), by, period).collect()}

    groups = {}
    for d, _, date, n in base:
        groups.setdefault((d, date[:7] + "-01"), []).append(n)
    assert medians(4096, ("district",), "month") == {g: sorted(v)[(len(v) - 1) // 2] for g, v in groups.items()}
    everything = sorted(n for *_, n in base)
    small = rollup.rollup_medians(rollup.resolution_sketches(rows, 200), (), None, {"q10": 0.1, "q50": 0.5, "q90": 0.9}).first()
    for name, q in (("q10", 0.1), ("q50", 0.5), ("q90", 0.9)):  # the rank, as values have gaps
        below = sum(n < small[name] for n in everything) / len(everything)
        upto = sum(n <= small[name] for n in everything) / len(everything)
        assert below - 0.03 <= q <= upto + 0.03
    with pytest.raises(ValueError):
        rollup.period_start("decade")


def test_distinct_keys_from_sketches(spark, scratch):
    rows = spark.range(30_000).select(F.concat(F.lit("T"), F.col("id") % 9000).alias("ticket_id"),
                                      F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("dt"))
    key_sketches.refresh_sketches(rows, scratch)
    estimate = lambda **days: key_sketches.distinct_estimate(
        key_sketches.read_sketches(spark, scratch, **days)).first()["distinct_keys"]
    slack = key_sketches.ERRORS * key_sketches.relative_error()
    assert abs(estimate() / 9000 - 1) < slack
    one_day = rows.where("dt = '2025-01-04'").select("ticket_id").distinct().count()
    assert abs(estimate(start="2025-01-04", end="2025-01-05") / one_day - 1) < slack
    check = lambda n: key_sketches.check_rowcount_delta_estimated(
        spark.range(n), key_sketches.read_sketches(spark, scratch)).first()["passed"]
    assert check(9000) and check(4600) and not check(9600) and not check(4000)
    key_sketches.refresh_sketches(rows.where("dt = '2025-01-04'").limit(1).unionByName(
        rows.limit(1).select(F.lit(None).cast("string").alias("ticket_id"), F.lit("2025-01-04").cast("date").alias("dt"))), scratch)
    assert estimate(start="2025-01-04", end="2025-01-05") == 2  # replaced with its partition; null is a key
    assert not key_sketches.check_rowcount_delta_estimated(
        spark.range(3), key_sketches.read_sketches(spark, scratch, end="2000-01-01")).first()["passed"]


# --- gap plans ---------------------------------------------------------------------------

def days(spark, *rows):
    return spark.createDataFrame(list(rows), "d string, _ingested_at string").select(F.to_date("d").alias("dt"), "_ingested_at")


def test_islands_of_missing_partial_and_late_days(spark):
    at = lambda d, hour=0: (f"2025-01-{d:02d}", f"2025-01-{d + 1:02d}T{hour:02d}:00:00+00:00")
    landed = days(spark, at(1), at(1), at(4, 9), at(5, 9), at(6), at(9), at(9, 8))
    held = spark.createDataFrame([(f"2025-01-{d:02d}", n) for d, n in ((1, 2), (2, 1), (3, 4), (4, 1), (5, 1), (6, 5), (9, 2))],
                                 "d string, n long").select(F.to_date("d").alias("dt"), "n")
    findings = backfill.day_findings(landed, held, quality.expected_days(spark, "2025-01-01", "2025-01-10"))
    plan = {(r["finding"], r["first_day"].day, r["last_day"].day, r["days"], r["missing_rows"])
            for r in backfill.backfill_plan(findings).collect()}
    assert plan == {("missing", 2, 3, 2, 5), ("late", 4, 5, 2, 0), ("partial", 6, 6, 1, 4), ("late", 9, 9, 1, 0)}


def test_days_that_never_landed_are_told(spark):
    found = quality.check_freshness(days(spark, ("2025-01-01", "2025-01-02T01:00:00"), ("2025-01-03", "2025-01-04T01:00:00")),
                                    expected=quality.expected_days(spark, "2025-01-01", "2025-01-03"))
    assert {r["dt"].day: (r["on_time"], r["last_landed_at"] is None) for r in found.collect()} == {
        1: (True, False), 2: (False, True), 3: (True, False)}


# --- quarantine ---------------------------------------------------------------------------

def page(poll, offset, *tickets, at="12:00:00"):
    return json.dumps({"poll_id": poll, "page_offset": offset, "features": [
        {"geometry": {"type": "Point", "coordinates": [100.5, 13.8]},
         "properties": {"ticket_id": t, "last_activity": f"{poll} {at}"}} for t in tickets]})


def test_bad_pages_are_listed_and_end_nothing(spark, tmp_path):
    src, out, dead = str(tmp_path / "src"), scratch_path(spark, "q-out"), scratch_path(spark, "q-dead")
    day = "2025-03-01"
    lines = [page(day, 0, "a", "b"), page(day, 2, "c", "d")[:70], page(day, 4, "e"), page("2025-03-02", 0, "f"),
             "<html>busy</html>", '{"poll_id": "2025-03-03", "page_offset": 0}', '{"page_offset": 0, "features": []}',
             page("2025-03-04", 0, "g", "h"), '{"poll_id": "2025-03-04", "features": []}', page("2025-03-04", 4, "i")]
    os.makedirs(src)
    (tmp_path / "src" / "p.json").write_text("\n".join(lines))
    done = quarantine.load_with_quarantine(spark, src, out, dead, page_size=2, most_bad=0.6)
    assert done == {"pages": 10, "bad_pages": 5, "rows": 6}
    # the torn page holds its place; the one of March 4 that can't be placed ends its poll there
    assert sorted(r["ticket_id"] for r in spark.read.parquet(out).collect()) == ["a", "b", "e", "f", "g", "h"]
    letters = spark.read.parquet(dead).collect()
    assert sorted((r["poll_id"] or "", r["page_offset"] if r["page_offset"] is not None else -1, r["reason"]) for r in letters) == [
        ("", -1, "not a page"), ("", 0, "no poll_id"), (day, 2, "not a page"), ("2025-03-03", 0, "no features"),
        ("2025-03-04", -1, "no page_offset")]
    assert all(r["file"].endswith("p.json") and r["record"] for r in letters)
    assert any(r["record"] == lines[1] for r in letters)


def test_too_many_bad_pages_land_nothing(spark, tmp_path):
    src, out, dead = str(tmp_path / "src"), scratch_path(spark, "q-out"), scratch_path(spark, "q-dead")
    os.makedirs(src)
    (tmp_path / "src" / "p.json").write_text("\n".join([page("2025-03-01", 0, "a"), "broken"]))
    with pytest.raises(quarantine.TooManyBadPages):
        quarantine.load_with_quarantine(spark, src, out, dead, most_bad=0.4)
    assert not os.path.exists(out.removeprefix("file:")) and spark.read.parquet(dead).count() == 1
    clean = str(tmp_path / "clean")
    os.makedirs(clean)
    (tmp_path / "clean" / "p.json").write_text(page("2025-03-01", 0, "a"))
    assert quarantine.load_with_quarantine(spark, clean, out, dead)["bad_pages"] == 0
    plain = scratch_path(spark, "plain")
    load_bronze(read_pages(spark, clean), plain)
    assert spark.read.parquet(out).drop("_ingested_at").collect() == spark.read.parquet(plain).drop("_ingested_at").collect()


# --- history ---------------------------------------------------------------------------

SNAPSHOTS = "ticket_id long, district string, last_activity string, view_count long"


def drawn_versions(rng, n, keys=6):
    seen = {}
    for _ in range(n):
        v = (rng.randrange(keys), f"2025-01-{rng.randint(1, 28):02d} 00:00:00", rng.randrange(3))
        seen.setdefault(v, rng.choice(["P", "P", "Q", None]))
    return [(k, d, at, c) for (k, at, c), d in seen.items()]


@pytest.mark.parametrize("seed", range(3))
def test_merged_histories_equal_rebuilt_ones(spark, seed):
    rng = Random(seed)
    rows = drawn_versions(rng, 140)
    rng.shuffle(rows)
    args = {"tie_breakers": ("view_count",)}
    everything = spark.createDataFrame(rows, SNAPSHOTS)
    old, new = spark.createDataFrame(rows[:90], SNAPSHOTS), spark.createDataFrame([r for r in rows[90:] if r[0] != 3], SNAPSHOTS)
    everything = old.unionByName(new)
    merged = history.scd2_merge(history.scd2_bounds(old, **args), new, everything, **args)
    listed = lambda df: sorted(map(str, df.collect()))
    assert listed(merged) == listed(history.scd2_bounds(everything, **args))
    plain = history.scd2_history(everything, **args)
    assert listed(merged.select(*plain.columns)) == listed(plain)


def test_late_versions_inside_a_run(spark):
    """Equal value: nothing changes. Another value: the run's later versions are found in the snapshots."""
    at = lambda d: f"2025-01-{d:02d} 00:00:00"
    old = spark.createDataFrame([(1, "P", at(d), 0) for d in (1, 5, 9, 13)] + [(2, "P", at(d), 0) for d in (1, 9)], SNAPSHOTS)
    new = spark.createDataFrame([(1, "Q", at(6), 0), (2, "P", at(4), 0)], SNAPSHOTS)
    merged = history.scd2_merge(history.scd2_bounds(old), new, old.unionByName(new))
    assert sorted((r["ticket_id"], r["district"], r["valid_from"][8:10], r["is_current"]) for r in merged.collect()) == [
        (1, "P", "01", False), (1, "P", "09", True), (1, "Q", "06", False), (2, "P", "01", True)]


def test_facts_take_the_value_of_their_time(spark):
    h = history.scd2_history(spark.createDataFrame(
        [(1, "P", "2025-01-02 00:00:00", 0), (1, None, "2025-01-05 00:00:00", 0), (1, "Q", "2025-01-05 00:00:00", 1),
         (2, "P", "2025-01-01 00:00:00", 0), (2, None, "2025-01-03 00:00:00", 0)], SNAPSHOTS), tie_breakers=("view_count",))
    facts = [(1, "2025-01-01 00:00:00"), (1, "2025-01-02 00:00:00"), (1, "2025-01-04 00:00:00"), (1, "2025-01-05 00:00:00"),
             (2, "2025-01-02 00:00:00"), (2, "2025-01-09 00:00:00"), (3, "2025-01-09 00:00:00"), (1, None), (1, "2025-01-04 00:00:00")]
    df = spark.createDataFrame(facts, "ticket_id long, at string").withColumn("at", F.to_timestamp("at"))
    got = sorted((r["ticket_id"], str(r["at"])[8:10] if r["at"] else "", r["district"] or "") for r in history.as_of(df, h, "at").collect())
    assert got == [(1, "", ""), (1, "01", ""), (1, "02", "P"), (1, "04", "P"), (1, "04", "P"), (1, "05", "Q"),
                   (2, "02", "P"), (2, "09", ""), (3, "09", "")]


# --- compaction, references -----------------------------------------------------------------

def test_compaction_packs_files_and_is_done_once(spark, scratch):
    rows = spark.range(4000).select("id", (F.col("id") % 4).alias("dt"))
    rows.repartition(7, "id").write.partitionBy("dt").parquet(scratch)
    spark.createDataFrame([(9, 9)], "id long, dt long").write.mode("append").partitionBy("dt").parquet(scratch)
    whole = [f for f in files_of(scratch) if f.startswith("dt=9/")]
    done = compaction.compact_partitions(spark, scratch)
    assert done == {str(k): (7, 1) for k in range(4)}
    assert {k: len(v) for k, v in compaction.partition_files(spark, scratch).items()} == dict.fromkeys("01239", 1)
    assert [f for f in files_of(scratch) if f.startswith("dt=9/")] == whole
    back = spark.read.parquet(scratch)
    assert back.agg(F.count("id"), F.sum("id")).first()[:] == (4001, 4000 * 3999 // 2 + 9)
    assert compaction.compact_partitions(spark, scratch) == {}
    many = scratch_path(spark, "many")
    rows.repartition(12, "id").write.partitionBy("dt").parquet(many)
    sizes = compaction.partition_files(spark, many)["0"]
    done = compaction.compact_partitions(spark, many, target_bytes=sum(sizes) // 3 + 1)
    assert done["0"] == (12, 3) and len(compaction.partition_files(spark, many)["0"]) <= 3
    assert spark.read.parquet(many).distinct().count() == 4000


def test_all_references_in_one_pass(spark):
    fact = spark.createDataFrame([("P", "x", 1), ("P", "y", 2), ("Q", None, 3), (None, "x", 3)], "district string, category string, n long")
    dims = {"district": spark.createDataFrame([("P",)], "district string"),
            "category": spark.createDataFrame([("x",), ("y",)], "category string"), "n": spark.createDataFrame([(1,), (2,)], "n long")}
    got = quality.collect_results(quality.check_referentials(fact, dims))
    assert {(r.name, r.passed, r.detail) for r in got} == {
        ("referential_district", False, "1 rows with district missing from the dimension"),
        ("referential_category", True, "0 rows with category missing from the dimension"),
        ("referential_n", False, "2 rows with n missing from the dimension")}
