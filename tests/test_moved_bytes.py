"""What is moved: narrow rows cross exchanges, wide ones are made or kept where they lie."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ticketflow.plans import backfill, inputs
from ticketflow.sources import feed, fixtures
from ticketflow.sources.lake import write_partitions
from ticketflow.streaming import pages as stream


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_small_tables(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def landed(tmp_path, offsets, poll="2040-05-05"):
    f = {"geometry": {"type": "Point", "coordinates": [100.5, 13.7]},
         "properties": {"ticket_id": "T", "last_activity": f"{poll} 05:05:05"}}
    lines = [json.dumps({"poll_id": poll, "page_offset": o, "features": [f, f]}) for o in offsets]
    (tmp_path / "pages.json").write_text("\n".join(lines))
    return str(tmp_path)


# --- bronze snapshots ---------------------------------------------------------------

def order_tables(spark, root):
    day = lambda d: dt.datetime(1996, 3, d)
    for name, schema, rows in (
            ("orders", "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
             [(1, 1, "F", day(1)), (1, 1, "F", day(1)), (2, 9, "O", day(2)), (3, 2, "P", None), (None, 1, "O", day(4))]),
            ("lineitem", "l_orderkey long, l_partkey long, l_returnflag string, l_shipdate timestamp_ntz",
             [(1, 1, "R", day(5)), (1, 2, "N", day(7)), (1, None, "N", None), (2, 7, "R", day(1)), (None, 1, "R", day(9))]),
            ("part", "p_partkey long, p_type string", [(1, "B"), (2, "A"), (2, "C"), (3, None)]),
            ("customer", "c_custkey long, c_nationkey int", [(1, 1), (2, 1), (2, 2)]),
            ("nation", "n_nationkey int, n_name string", [(1, "X"), (2, "Y")])):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")


def test_snapshots_of_repeated_and_null_keys(spark, tmp_path):
    order_tables(spark, str(tmp_path))
    got = sorted((str(r["ticket_id"]), r["view_count"], r["last_activity"][:10], r["state_type_latest"], r["district"],
                  r["problem_type_fondue"], r["count_reopen"], r["lat"], str(r["dt"]))
                 for r in fixtures.bronze_snapshots(spark, str(tmp_path)).collect())
    first = lambda k, d, *more: (str(k), 1, d, "start", *more, d)
    one = [("1", 2, "1996-03-05", "inprogress", "X", ["A", "B", "C"], 2, 13.45 + 1 / 100, "1996-03-05"),
           ("1", 3, "1996-03-07", "finish", "X", ["A", "B", "C"], 2, 13.45 + 1 / 100, "1996-03-07")]
    want = [first(1, "1996-03-01", "X", ["A", "B", "C"], 2, 13.5 + 1 / 100), *one] * 2
    want += [first(2, "1996-03-02", None, [], 1, 13.5 + 2 / 100), first(None, "1996-03-04", "X", None, None, None)]
    assert got == sorted(want, key=lambda r: r[:3])


def test_bronze_rows_get_their_text_past_the_exchange(spark, tmp_path):
    root = str(tmp_path)
    order_tables(spark, root)
    moved = fixtures.ticket_versions(spark, root)
    assert not {"last_activity", "state_type_latest", "lat"} & set(moved.columns)
    assert dict(moved.dtypes)["timestamp"] == "timestamp_ntz"
    as_text = sorted(map(str, fixtures.bronze_snapshots(spark, root).collect()))
    b = inputs.bronze(spark, root)
    assert sorted(map(str, b.select(*fixtures.bronze_snapshots(spark, root).columns).collect())) == as_text


def test_a_projection_after_the_exchange_is_what_is_written(spark, scratch):
    rows = spark.range(20).select("id", F.date_add(F.lit("2040-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("dt"))
    obs = write_partitions(rows, scratch, after=lambda d: d.select((F.col("id") * 2).alias("twice"), "dt"))
    assert obs.get["rows"] == 20
    assert sorted(r["twice"] for r in spark.read.parquet(scratch).collect()) == [2 * k for k in range(20)]


# --- landed pages ---------------------------------------------------------------

def events(spark, root):
    at = dt.datetime(2040, 5, 5, 10)
    rows = [(k, at + dt.timedelta(hours=k), None if k == 5 else 10 + k, kind, '{"k": %d}' % k)
            for k, kind in enumerate(["view", "purchase", "click", None, "error", "signup", "purchase", "odd"] * 4)]
    (spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string")
     .write.parquet(f"{root}/events.parquet"))


def test_landed_pages_are_compressed_and_hold_every_feature(spark, tmp_path):
    root = str(tmp_path)
    events(spark, root)
    path = inputs.pages_path(spark, root)
    files = [r["f"] for r in spark.read.text(path).select(F.input_file_name().alias("f")).distinct().collect()]
    assert files and all(f.endswith(".json.gz") for f in files)
    text = lambda df: sorted(df.select(F.to_json(F.struct("poll_id", "page_offset", "feature")).alias("j")).toPandas()["j"])
    loose = fixtures.feed_features(spark, root)
    got = fixtures.feed_pages(spark, root).select("poll_id", "page_offset", F.explode("features").alias("feature"))
    assert loose.count() == got.count() == feed.page_features(inputs.pages(spark, root)).count() > 32
    assert text(got) == text(loose)


def test_events_are_not_shuffled_to_meet_their_days(spark, tmp_path, no_small_tables):
    events(spark, str(tmp_path))
    assert "SortMergeJoin" not in plan_of(fixtures.feed_pages(spark, str(tmp_path)))


def test_features_are_made_after_events_are_grouped(spark, tmp_path):
    events(spark, str(tmp_path))
    above, below = plan_of(fixtures.feed_pages(spark, str(tmp_path))).split("Exchange hashpartitioning(poll_day", 1)
    assert "collect_list(event#" in above and "Point" not in below and "date_format" not in below


# --- streamed pages ---------------------------------------------------------------

def test_features_outside_the_window_do_not_reach_the_state(spark, tmp_path, monkeypatch):
    def page(offset, *days):
        return json.dumps({"poll_id": "2040-05-05", "page_offset": offset, "features": [
            {"geometry": None, "properties": {"ticket_id": d, "last_activity": f"{d} 01:00:00"}} for d in days]})

    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json").write_text("\n".join([page(0, "2040-05-05", "2040-05-04"), page(2, "2040-05-04")]))
    reached = []
    plain = stream.distinct_pages

    def seen(pages, *args):
        reached.append(pages._jdf.queryExecution().analyzed().toString())
        return plain(pages, *args)

    monkeypatch.setattr(stream, "distinct_pages", seen)
    report = stream.run_pages(spark, str(src), str(tmp_path / "log"), str(tmp_path / "ckpt"), ingested_at="x")
    assert "filter(features" in reached[0] and report.pages == 2
    assert [r["ticket_id"] for r in stream.read_pages_log(spark, str(tmp_path / "log")).collect()] == ["2040-05-05"]


# --- pages ---------------------------------------------------------------

def test_kept_pages_are_not_shuffled(spark, tmp_path, no_small_tables):
    pages = feed.read_pages(spark, landed(tmp_path, [0, 2, 4]))
    own, rest = plan_of(feed.page_until_boundary(pages, "2040-01-01", 2)).split("BroadcastExchange", 1)
    assert "BroadcastHashJoin" in own and "Exchange" not in own and "Exchange" in rest


def test_runs_of_kept_pages_hold_no_other_page(spark, tmp_path, monkeypatch):
    pages = feed.read_pages(spark, landed(tmp_path, [0, 2, 3, 6, 8, 14, 6]))
    for block in (1, 2, 1024):
        monkeypatch.setattr(feed, "PAGES_PER_BLOCK", block)
        kept = feed.page_until_boundary(pages, "2040-01-01", 2).collect()
        assert sorted(r["page_offset"] for r in kept) == [0, 2, 6, 6, 8]


def test_planned_pages_are_not_shuffled(spark, tmp_path, no_small_tables):
    pages = feed.read_pages(spark, landed(tmp_path, [0, 2]))
    day = dt.date(2040, 5, 5)
    plan = spark.createDataFrame([(day, day, "missing"), (day, day, "late")], "first_day date, last_day date, finding string")
    wanted = backfill.planned_pages(pages, plan)
    assert "Exchange" not in plan_of(wanted).split("BroadcastExchange", 1)[0] and wanted.count() == 2
