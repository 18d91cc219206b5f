"""Bronze: page scan, flatten, windows, load metadata, dated partitions and the chained layers."""

import datetime as dt
import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.operators.bronze import flatten_features, stamp_load_metadata, window_filter
from ticketflow.plans.bronze_load import day_so_far_bounds, landed_rows, load_bronze
from ticketflow.plans.gold_build import build_gold
from ticketflow.plans.silver_publish import BRIDGE, TICKETS, publish_silver
from ticketflow.session import clear_scratch, scratch_path, shared_root
from ticketflow.sources import feed
from ticketflow.sources.lake import (
    current_run,
    partition_path,
    path_exists,
    read_published,
    scan_partitioned,
    set_current,
    write_partitions,
    write_table,
)


def feature(k, at, **more):
    return {"geometry": {"type": "Point", "coordinates": [100.5 + k / 1e4, 13.7]},
            "properties": {"ticket_id": f"T{k}", "last_activity": at, **more}}


def land(tmp_path, *pages):
    """Pages (poll, offset, features) as JSON files, one each."""
    for n, (poll, offset, features) in enumerate(pages):
        (tmp_path / f"p{n}.json").write_text(json.dumps({"poll_id": poll, "page_offset": offset, "features": features}))
    return str(tmp_path)


def poll_pages(poll, times, size, start=0):
    """A newest-first feed cut into pages."""
    times = sorted(times, reverse=True)
    return [(poll, o, [feature(start + o + k, t) for k, t in enumerate(times[o:o + size])]) for o in range(0, len(times), size)]


def walk(pages, boundary, size, cap=None):
    """What a client that fetches page after page keeps."""
    kept, rows, offset = [], 0, 0
    at = {o: f for _, o, f in pages}
    while cap is None or rows < cap:
        page = at.get(offset)
        if page:
            kept.append(offset)
        if not page or min(f["properties"]["last_activity"] for f in page) < boundary:
            return kept
        rows += len(page)
        offset += size
    return kept


def kept_offsets(spark, path, boundary, size, cap=None):
    rows = feed.page_until_boundary(feed.read_pages(spark, path), boundary, size, cap).select("poll_id", "page_offset").collect()
    return {p: sorted(r[1] for r in rows if r[0] == p) for p in {r[0] for r in rows}}


@pytest.mark.parametrize("seed", range(6))
def test_page_scan_equals_a_client(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(feed, "PAGES_PER_BLOCK", 3)
    rnd = random.Random(seed)
    polls, size = {}, rnd.randrange(1, 4)
    for poll in ("a", "b", "c"):
        times = [f"2040-03-{rnd.randrange(1, 29):02d} {rnd.randrange(24):02d}:30:00" for _ in range(rnd.randrange(1, 60))]
        pages = poll_pages(poll, times, size)
        for _ in range(rnd.randrange(3)):  # a page that never landed, an empty one
            at = rnd.randrange(len(pages))
            pages[at] = (poll, pages[at][1], []) if rnd.random() < 0.5 else pages[at]
            if rnd.random() < 0.5 and len(pages) > 1:
                pages.pop(rnd.randrange(len(pages)))
        polls[poll] = pages
    boundary, cap = f"2040-03-{rnd.randrange(1, 15):02d} 00:00:00", rnd.choice([None, 0, 7, 20])
    got = kept_offsets(spark, land(tmp_path, *(p for pages in polls.values() for p in pages)), boundary, size, cap)
    for poll, pages in polls.items():
        want = walk(pages, boundary, size, cap)
        # the empty page that ends a scan is kept, but holds nothing
        empty = {o for _, o, f in pages if not f}
        assert [o for o in got.get(poll, []) if o not in empty] == want


def test_a_missing_page_ends_the_scan(spark, tmp_path):
    pages = poll_pages("x", ["2040-05-05 05:05:05"] * 6, 2)
    assert kept_offsets(spark, land(tmp_path, pages[0], pages[2]), "2040-01-01", 2) == {"x": [0]}


def test_a_page_that_landed_twice_counts_once(spark, tmp_path):
    pages = poll_pages("x", [f"2040-05-05 05:05:{s:02d}" for s in range(6)], 2)
    path = land(tmp_path, *pages, pages[1])
    assert kept_offsets(spark, path, "2040-01-01", 2) == {"x": [0, 2, 2, 4]}


def test_large_polls_land_whole_unless_capped(spark, tmp_path):
    path = land(tmp_path, *poll_pages("2040-06-01", [f"2040-06-01 {h:02d}:{m:02d}:{s:02d}" for h in range(2) for m in range(60) for s in range(60)], 500))
    pages = feed.read_pages(spark, path)
    assert load_bronze(pages, scratch_path(spark, "b")) == 7200
    assert landed_rows(pages, max_records=900).count() == 1000


def test_corrupt_pages_fail_the_load(spark, tmp_path):
    land(tmp_path, *poll_pages("2040-06-01", ["2040-06-01 10:00:00"] * 4, 2))
    (tmp_path / "cut.json").write_text('{"poll_id": "2040-06-01", "page_offset": 4, "features": [{"geom')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        load_bronze(feed.read_pages(spark, str(tmp_path)), scratch_path(spark, "b"), 2)


def test_every_property_survives(spark, tmp_path):
    one = feature(1, "2040-01-01 10:00:00", district="Dell", problem_type_fondue=["mud", "ice"], view_count=12, count_reopen="x",
                  note="línea", likes=3, nested={"a": [1, 2]}, nothing=None)
    bare = {"properties": {"ticket_id": "T2"}}
    short = {"geometry": {"type": "Point", "coordinates": [7.5]}, "properties": {"ticket_id": "T3", "view_count": None}}
    pages = feed.read_pages(spark, land(tmp_path, ("p", 0, [one, bare, short])))
    rows = {r["ticket_id"]: r for r in flatten_features(feed.page_features(pages), "feature", ("poll_id",)).collect()}
    got = rows["T1"]
    assert (got["district"], got["problem_type_fondue"], got["view_count"], got["count_reopen"]) == ("Dell", ["mud", "ice"], 12, None)
    assert got["extra"] == {"note": "línea", "likes": "3", "nested": '{"a": [1, 2]}', "nothing": None}
    assert (got["lon"], got["lat"], got["poll_id"]) == (100.5001, 13.7, "p")
    assert (rows["T2"]["lon"], rows["T2"]["lat"]) == (None, None) and (rows["T3"]["lon"], rows["T3"]["lat"]) == (7.5, None)
    more = T.StructType([*feed.PROPERTIES, T.StructField("likes", T.IntegerType())])
    typed = flatten_features(feed.page_features(pages), "feature", schema=more).where("ticket_id = 'T1'").first()
    assert typed["likes"] == 3 and "likes" not in typed["extra"]


def test_struct_features_are_lifted_as_they_are(spark):
    schema = "geometry struct<coordinates: array<double>>, properties struct<ticket_id: string, width: int>"
    df = spark.createDataFrame([(([1.0, 2.0],), ("q", 4)), (None, ("r", None))], schema)
    assert [tuple(r) for r in flatten_features(df).collect()] == [("q", 4, 1.0, 2.0), ("r", None, None, None)]


def test_windows_tile_time(spark):
    times = [f"2041-0{m}-1{d} 0{h}:00:00" for m in (1, 2) for d in range(3) for h in (0, 9)]
    df = spark.createDataFrame([(t,) for t in times] + [(None,)], "last_activity string")
    cuts = ["2041-01-10 00:00:00", "2041-01-11 09:00:00", "2041-02-10 00:00:00", "2041-03-01 00:00:00"]
    parts = [[r[0] for r in window_filter(df, a, b).collect()] for a, b in zip(cuts, cuts[1:], strict=False)]
    assert sorted(sum(parts, [])) == sorted(times) and all(a <= t < b for p, a, b in zip(parts, cuts, cuts[1:], strict=False) for t in p)


@pytest.mark.parametrize("zone", ["UTC", "America/Lima", "Asia/Tokyo"])
def test_day_so_far_is_on_the_feeds_clock(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        now = F.timestamp_seconds(F.lit(int(dt.datetime(2042, 7, 1, 20, 15, 9, tzinfo=dt.UTC).timestamp())))
        b = day_so_far_bounds("Asia/Bangkok", now)
        r = spark.range(1).select(*(c.alias(n) for n, c in b.items())).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r["start"], r["end"], r["run_id"], r["dt"]) == (
        "2042-07-02 00:00:00", "2042-07-02 03:15:09", "2042-07-02", dt.date(2042, 7, 2))


def test_metadata_defaults_to_the_load_time(spark):
    before = dt.datetime.now(dt.UTC)
    r = stamp_load_metadata(spark.range(1), "r1").first()
    assert before - dt.timedelta(seconds=5) <= dt.datetime.fromisoformat(r["_ingested_at"]) <= dt.datetime.now(dt.UTC)
    fixed = stamp_load_metadata(spark.range(1), F.lit("r2"), "src", "then").first()
    assert (fixed["_ingested_at"], fixed["_source"], fixed["_run_id"]) == ("then", "src", "r2")


@pytest.mark.parametrize("bad", [None, "", "   "])
def test_blank_run_ids_are_refused(spark, bad):
    with pytest.raises(ValueError):
        stamp_load_metadata(spark.range(1), bad)
    rows = spark.createDataFrame([("ok",), (bad,)], "run string")
    with pytest.raises(PySparkException, match="run_id is required"):
        stamp_load_metadata(rows, F.col("run")).collect()


def test_partitions_are_replaced_one_by_one(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([(k, f"2043-01-0{k % 3 + 1}") for k in range(30)], "k int, dt string")
    write_partitions(df, path)
    write_partitions(df.where("dt = '2043-01-02'").limit(4), path)
    write_partitions(df.limit(0), path)
    got = {str(r["dt"]): r["n"] for r in spark.read.parquet(path).groupBy("dt").count().withColumnRenamed("count", "n").collect()}
    assert got == {"2043-01-01": 10, "2043-01-02": 4, "2043-01-03": 10}
    part = scan_partitioned(spark, path, start="2043-01-02", end="2043-01-03")
    assert part.count() == 4 and "PartitionFilters: [isnotnull(dt" in part._jdf.queryExecution().executedPlan().toString()
    assert partition_path("s3://lake/bronze/", "feed", "2043-01-02") == "s3://lake/bronze/feed/dt=2043-01-02"


def test_publishes_are_ordered_without_a_clock(spark):
    root = scratch_path(spark, "pub")
    with pytest.raises(FileNotFoundError):
        current_run(spark, root)
    for run in ("zeta", "alpha", "run-with-dash"):
        write_table(spark.range(3), f"{root}/runs/{run}/t")
        set_current(spark, root, run)
        assert current_run(spark, root) == run
    assert read_published(spark, root, "t").count() == 3


def test_scratch_is_cleared(spark):
    kept = shared_root(spark)
    path = scratch_path(spark, "gone")
    spark.range(2).write.parquet(path)
    assert path.startswith(kept) and path_exists(spark, path)
    from ticketflow import session

    others = [e for e in session._SCRATCH if e[1] != path]
    session._SCRATCH[:] = [e for e in session._SCRATCH if e[1] == path]
    assert clear_scratch(spark) == 1 and not path_exists(spark, path)
    session._SCRATCH[:] = others


def test_layers_chain_from_pages_to_gold(spark, tmp_path):
    times = {"2044-02-01": ["2044-02-01 08:00:00", "2044-02-01 09:00:00", "2044-01-31 07:00:00"],
             "2044-02-02": ["2044-02-02 10:00:00", "2044-02-01 09:30:00"], "2044-02-03": ["2044-02-01 01:00:00"]}  # the last day is empty
    pages = []
    for poll, ts in times.items():
        feats = [feature(k, t, timestamp="2044-01-30 00:00:00", district="Dell", problem_type_fondue=["mud"], state_type_latest="finish",
                         timestamp_finished=t, color=f"c{k}") for k, t in enumerate(sorted(ts, reverse=True))]
        pages.append((poll, 0, feats))
    bronze = scratch_path(spark, "b")
    schema = T.StructType([*feed.PROPERTIES, T.StructField("color", T.StringType())])
    assert load_bronze(feed.read_pages(spark, land(tmp_path, *pages)), bronze, schema=schema) == 3
    landed = spark.read.parquet(bronze)
    assert sorted(str(r[0]) for r in landed.select("dt").distinct().collect()) == ["2044-02-01", "2044-02-02"]
    silver, gold = scratch_path(spark, "s"), scratch_path(spark, "g")
    publish_silver(spark, landed, silver, report=lambda _: None)
    tickets = read_published(spark, silver, TICKETS)
    build_gold(spark, tickets, read_published(spark, silver, BRIDGE), gold)
    got = sorted((r["ticket_id"], str(r["finished_at"]), r["days_to_resolve"], r["status"]) for r in read_published(spark, gold, "fact_ticket_lifecycle").collect())
    assert got == [("T0", "2044-02-02 10:00:00", 3, "resolved"), ("T1", "2044-02-01 08:00:00", 2, "resolved")]
    assert {r["color"] for r in tickets.collect()} == {"c0", "c1"}
