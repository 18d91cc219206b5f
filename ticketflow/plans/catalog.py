"""Registered queries: one callable ``(spark, root) -> DataFrame`` per operator.

Every query reads the driver's tables at ``root`` (or what Spark derives from them)
in full; nothing is sampled or capped except the top-k reports, whose limit is the
feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.operators import gold, history, quality, ranking, reports, rollup, silver
from ticketflow.operators.bronze import flatten_features, stamp_load_metadata, window_filter
from ticketflow.plans import backfill, daily_ledger, inputs
from ticketflow.plans.bronze_load import load_bronze
from ticketflow.plans.gold_build import GOLD_TABLES, build_gold, refresh_daily, write_daily
from ticketflow.plans.silver_publish import BRIDGE, TICKETS, publish_silver
from ticketflow.session import scratch_path
from ticketflow.sources import buckets, compaction, feed, key_sketches, quarantine, schema_log
from ticketflow.sources.fixtures import FEED_PAGE_SIZE, SNAPSHOT_TIE_BREAKERS, land_pages
from ticketflow.sources.lake import read_published, scan_partitioned, write_partitions
from ticketflow.streaming import change_log
from ticketflow.streaming import current_state as streams
from ticketflow.streaming import pages as page_stream

Query = Callable[[SparkSession, str], DataFrame]

# Category the backlog report ranks (one of the fixture's part types).
REPORT_CATEGORY = "STANDARD"


# --- ingest ----------------------------------------------------------------------

FEED_WINDOW = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
FIXED_RUN = ("2024-01-31", "2024-02-01T00:00:00+00:00")  # run id, logical load time


def _load_time():
    """Logical load time of a poll, fixed so that a re-run lands the same bytes: the midnight
    after its day, and for days 7, 14, 21 and 28 a load that came ten hours late."""
    day = F.to_date("poll_id")
    hour = F.when(F.dayofmonth(day) % 7 == 0, "10").otherwise("00")
    return F.concat(F.date_format(F.date_add(day, 1), "yyyy-MM-dd"), F.lit("T"), hour, F.lit(":00:00+00:00"))


def _landed(spark, path):
    """A loaded bronze table; undeclared properties as JSON text."""
    return spark.read.parquet(path).withColumn("extra", F.to_json("extra"))


def q_feed_pages(spark, root):
    """Landed pages read with a declared schema: one summary row per page."""
    p = inputs.pages(spark, root)
    times = F.transform("features", lambda f: f["properties"]["last_activity"])
    return p.select("poll_id", "page_offset",
                    F.size("features").cast("long").alias("n_features"),
                    F.array_min(times).alias("oldest"), F.array_max(times).alias("newest"))


def q_page_until_boundary(spark, root):
    p = inputs.pages(spark, root)
    kept = feed.page_until_boundary(p, F.concat(F.col("poll_id"), F.lit(" 00:00:00")),
                                    FEED_PAGE_SIZE)
    keep = ("poll_id", "page_offset")
    rows = flatten_features(feed.page_features(kept, keep), "feature", keep)
    return rows.withColumn("extra", F.to_json("extra"))


def q_flatten_json(spark, root):
    return inputs.feed_rows(spark, root)


def q_window_filter(spark, root):
    return window_filter(inputs.feed_rows(spark, root), *FEED_WINDOW)


def q_stamp_load_metadata(spark, root):
    return stamp_load_metadata(inputs.feed_rows(spark, root), FIXED_RUN[0],
                               ingested_at=FIXED_RUN[1])


def q_bronze_load(spark, root):
    path = scratch_path(spark, "bronze-load")
    load_bronze(inputs.pages(spark, root), path, FEED_PAGE_SIZE, ingested_at=_load_time())
    return _landed(spark, path)


def q_feed_lifecycle(spark, root):
    """The layers chained: landed pages -> bronze load -> silver publish -> gold build. One
    property that is not declared by default is lifted by extending the schema."""
    bronze, silver_at, gold_at = (scratch_path(spark, n) for n in ("feed-bronze", "feed-silver", "feed-gold"))
    schema = T.StructType([*feed.PROPERTIES, T.StructField("event_id", T.LongType())])
    load_bronze(inputs.pages(spark, root), bronze, FEED_PAGE_SIZE, ingested_at=_load_time(), schema=schema)
    publish_silver(spark, spark.read.parquet(bronze), silver_at, tie_breakers=("event_id",),
                   report=lambda _: None)
    build_gold(spark, read_published(spark, silver_at, TICKETS), read_published(spark, silver_at, BRIDGE), gold_at)
    return read_published(spark, gold_at, "fact_ticket_lifecycle")


# --- silver ----------------------------------------------------------------------

def q_dedup_latest(spark, root):
    return silver.dedup_latest(inputs.bronze(spark, root), "ticket_id", "last_activity",
                               SNAPSHOT_TIE_BREAKERS)


def q_parse_timestamps(spark, root):
    return silver.parse_timestamps(inputs.bronze(spark, root))


def q_bbox_filter(spark, root):
    return silver.bbox_filter(inputs.bronze(spark, root))


def q_normalize_state(spark, root):
    return silver.normalize_state(inputs.bronze(spark, root))


def q_explode_bridge(spark, root):
    return inputs.bridge(spark, root)


def q_silver_tickets(spark, root):
    return inputs.silver_candidate(spark, root)


def q_silver_publish(spark, root):
    return inputs.silver(spark, root)


# --- bronze tables -----------------------------------------------------------------

SCAN_RANGE = ("1997-01-01", "1998-01-01")


def q_scan_partitioned(spark, root):
    return scan_partitioned(spark, inputs.bronze_path(spark, root), "dt", *SCAN_RANGE)


def q_partition_overwrite(spark, root):
    """Land bronze, re-land one year changed, land an empty frame: only that year's
    partitions change and the empty write lands nothing."""
    b = inputs.bronze(spark, root)
    path = scratch_path(spark, "overwrite")
    write_partitions(b, path)
    changed = (b.where(F.year("dt") == 1996)
               .withColumn("view_count", F.col("view_count") + 100))
    write_partitions(changed, path)
    write_partitions(b.limit(0), path)
    return spark.read.parquet(path)


# --- quality -----------------------------------------------------------------------

def q_dq_non_empty(spark, root):
    return quality.check_non_empty(inputs.bronze(spark, root))


def q_dq_not_null(spark, root):
    return quality.check_not_null(inputs.bronze(spark, root), ["ticket_id", "district", "lon"])


def q_dq_unique(spark, root):
    return quality.check_unique(inputs.bronze(spark, root))


def q_dq_geo_bounds(spark, root):
    return quality.check_geo_bounds(inputs.bronze(spark, root))


def q_dq_rowcount_delta(spark, root):
    b = inputs.bronze(spark, root)
    return quality.check_rowcount_delta(inputs.silver(spark, root), quality.bronze_baseline(b))


def q_quality_gate(spark, root):
    b = inputs.bronze(spark, root)
    return quality.quality_gate(inputs.silver(spark, root), quality.bronze_baseline(b))


def q_quality_gate_bronze(spark, root):
    return quality.quality_gate(inputs.bronze(spark, root))


# --- gold ------------------------------------------------------------------------

def q_dim_district(spark, root):
    return gold.dim_district(inputs.silver(spark, root))


def q_dim_category(spark, root):
    return gold.dim_category(inputs.bridge(spark, root))


def q_dim_date(spark, root):
    return gold.dim_date(inputs.silver(spark, root))


def q_fact_lifecycle(spark, root):
    return inputs.lifecycle(spark, root)


def q_ticket_category_base(spark, root):
    return gold.ticket_category_rows(inputs.silver(spark, root))


def _activity(spark, root):
    return gold.daily_activity(gold.ticket_category_rows(inputs.silver(spark, root)))


def q_opened_daily(spark, root):
    return gold.opened_daily(_activity(spark, root))


def q_closed_daily(spark, root):
    return gold.closed_daily(_activity(spark, root))


def _grid(spark, root):
    dims = [inputs.gold_table(spark, root, t) for t in ("dim_district", "dim_category", "dim_date")]
    return gold.dense_grid(*dims)


def q_dense_grid(spark, root):
    return _grid(spark, root)


def q_densify(spark, root):
    return gold.densify(_grid(spark, root), _activity(spark, root))


def q_running_backlog(spark, root):
    """Backlog over the category table kept apart from the tickets."""
    s = gold.with_categories(inputs.silver(spark, root), inputs.bridge(spark, root))
    activity = gold.daily_activity(gold.ticket_category_rows(s))
    return gold.running_backlog(gold.densify(_grid(spark, root), activity)).select(*gold.DAILY_COLUMNS)


def q_fact_daily(spark, root):
    return inputs.daily(spark, root)


def q_fact_daily_exact(spark, root):
    return gold.fact_daily(inputs.silver(spark, root), exact_median=True)


def q_gold_build(spark, root):
    """Row counts of every published gold table (counted from the written tables)."""
    counts = [inputs.gold_table(spark, root, t).agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(t).alias("table_name"), "rows") for t in GOLD_TABLES]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


# --- reports ---------------------------------------------------------------------

def q_latest_day(spark, root):
    return reports.latest_day(inputs.gold_table(spark, root, "fact_district_daily"))


def q_top_backlog(spark, root):
    return reports.top_backlog(inputs.gold_table(spark, root, "fact_district_daily"),
                               REPORT_CATEGORY, calendar=inputs.gold_table(spark, root, "dim_date"))


def q_median_resolution(spark, root):
    return reports.median_resolution(inputs.gold_table(spark, root, "fact_ticket_lifecycle"))


# --- extensions (described by the reference's docs, not built there) -----------------

SEED_CUTOFF = "1998-01-01"


def seed_and_daily(spark, root):
    b = inputs.bronze(spark, root)
    return (b.where(F.col("dt") < F.lit(SEED_CUTOFF).cast("date")),
            b.where(F.col("dt") >= F.lit(SEED_CUTOFF).cast("date")))


def q_seed_reconcile(spark, root):
    seed, daily = seed_and_daily(spark, root)
    return history.seed_reconcile(seed.drop("count_reopen"), daily,
                                  tie_breakers=SNAPSHOT_TIE_BREAKERS)


def q_incremental_upsert(spark, root):
    """Current state from the seed, written; then one upsert of the later loads,
    written; the published view must equal the full rebuild."""
    seed, daily = seed_and_daily(spark, root)
    state0 = scratch_path(spark, "state")
    silver.dedup_latest(seed, "ticket_id", "last_activity", SNAPSHOT_TIE_BREAKERS) \
        .write.parquet(state0)
    state1 = scratch_path(spark, "state")
    history.upsert_current(spark.read.parquet(state0), daily,
                           tie_breakers=SNAPSHOT_TIE_BREAKERS).write.parquet(state1)
    return history.publish_state(spark.read.parquet(state1))


def seed_daily(spark, root, path):
    """The daily fact of the seed-era state, written by year at ``path``, and that state."""
    seed, _ = seed_and_daily(spark, root)
    old = history.publish_state(
        silver.dedup_latest(seed, "ticket_id", "last_activity", SNAPSHOT_TIE_BREAKERS))
    write_daily(gold.fact_daily(old), path)
    return old


def q_incremental_daily(spark, root):
    """Daily fact of the seed-era state, written; then refreshed in place for the later loads:
    only the years they touch are computed and written. Must equal the full rebuild."""
    path = scratch_path(spark, "daily")
    old = seed_daily(spark, root, path)
    _, later = seed_and_daily(spark, root)
    new = inputs.silver(spark, root)
    refresh_daily(path, new, gold.affected_since(old, new, later.select("ticket_id").distinct()))
    return spark.read.parquet(path).select(*gold.DAILY_COLUMNS)


BACKFILL_POLLS = ("2024-01-05", "2024-01-15")


def q_backfill(spark, root):
    """Re-land a range of poll days in one job; only those dt partitions are written."""
    path = scratch_path(spark, "backfill")
    p = inputs.pages(spark, root)
    in_range = (F.col("poll_id") >= BACKFILL_POLLS[0]) & (F.col("poll_id") < BACKFILL_POLLS[1])
    load_bronze(p.where(in_range), path, FEED_PAGE_SIZE, ingested_at=_load_time())
    return _landed(spark, path)


def q_scd2_history(spark, root):
    """Type-2 history of the raw state code per ticket over all snapshot versions."""
    return history.scd2_history(inputs.bronze(spark, root), "state_type_latest",
                                tie_breakers=SNAPSHOT_TIE_BREAKERS)


STALE_DISTRICTS_BEFORE = "C"  # a dimension that lacks every district from here on


def q_dq_referential(spark, root):
    """The lifecycle fact against its published dimension, and against a stale one."""
    fact = inputs.gold_table(spark, root, "fact_ticket_lifecycle")
    dim = inputs.gold_table(spark, root, "dim_district")
    stale = dim.where(F.col("district") < STALE_DISTRICTS_BEFORE)
    return (quality.check_referential(fact, dim).withColumn("dimension", F.lit("published"))
            .unionByName(quality.check_referential(fact, stale).withColumn("dimension", F.lit("stale"))))


def q_dq_freshness(spark, root):
    path = scratch_path(spark, "bronze-load")
    load_bronze(inputs.pages(spark, root), path, FEED_PAGE_SIZE, ingested_at=_load_time())
    return quality.check_freshness(spark.read.parquet(path))


def q_topsis_rank(spark, root):
    lc = inputs.gold_table(spark, root, "fact_ticket_lifecycle")
    return ranking.topsis(ranking.district_criteria(lc))


def q_stream_current(spark, root):
    src = inputs.bronze_path(spark, root)
    log, ckpt = scratch_path(spark, "stream-state"), scratch_path(spark, "stream-ckpt")
    streams.run_current_state(spark, src, spark.read.parquet(src).schema, log, ckpt,
                              tie_breakers=SNAPSHOT_TIE_BREAKERS, max_files_per_trigger=500)
    state = streams.read_current_state(spark, log, tie_breakers=SNAPSHOT_TIE_BREAKERS)
    return history.publish_state(state)


def q_stream_daily_opened(spark, root):
    src = inputs.events_by_day_path(spark, root)
    log, ckpt = scratch_path(spark, "stream-counts"), scratch_path(spark, "stream-ckpt")
    streams.run_windowed_counts(spark, src, spark.read.parquet(src).schema, log, ckpt,
                                max_files_per_trigger=5)
    return streams.read_windowed_counts(spark, log)


REPLAY_DAYS, REPLAY_DELAY = 7, "8 days"


def q_stream_pages(spark, root):
    """Feed pages streamed as they land, week by week, with the pages of each week's end landed once
    more a week later; the stream is stopped after the second week and resumed when all have landed."""
    src, log, ckpt = (scratch_path(spark, n) for n in ("stream-landed", "stream-pages", "stream-ckpt"))
    p = inputs.pages(spark, root)
    poll = F.to_date("poll_id")
    first, last = p.agg(F.min(poll), F.max(poll)).first()
    weeks = range(0, (last - first).days + 1, REPLAY_DAYS) if first else ()
    for n, start in enumerate(weeks):
        day = F.datediff(poll, F.lit(first))
        land_pages(p.where((day >= start - REPLAY_DAYS // 2) & (day < start + REPLAY_DAYS)), src, "append")
        if n == 1 or start + REPLAY_DAYS > (last - first).days:
            page_stream.run_pages(spark, src, log, ckpt, REPLAY_DELAY, ingested_at=_load_time(), max_files_per_trigger=8)
    return page_stream.read_pages_log(spark, log).withColumn("extra", F.to_json("extra"))


def seed_ledger(spark, root, path):
    """The daily ledger of the seed-era state, published at ``path``; and that state."""
    seed, _ = seed_and_daily(spark, root)
    state = scratch_path(spark, "seed-silver")
    history.publish_state(silver.dedup_latest(seed, "ticket_id", "last_activity", SNAPSHOT_TIE_BREAKERS)).write.parquet(state)
    old = spark.read.parquet(state)
    daily_ledger.refresh_daily_ledger(spark, path, old)
    return old


def changed_since_seed(spark, root, old):
    """The tickets of the later loads, as they are now and as they were in ``old``."""
    _, later = seed_and_daily(spark, root)
    keys = later.select("ticket_id").distinct()
    return (inputs.silver(spark, root).join(keys, "ticket_id", "left_semi"), old.join(keys, "ticket_id", "left_semi"))


def q_daily_ledger(spark, root):
    """The daily fact of the seed-era state, then refreshed by the deltas of the tickets that later loads
    touch. Must equal the full rebuild."""
    path = scratch_path(spark, "daily-ledger")
    new, was = changed_since_seed(spark, root, seed_ledger(spark, root, path))
    daily_ledger.refresh_daily_ledger(spark, path, new, was)
    return daily_ledger.read_daily(spark, path)


ERAS = ("1994-01-01", "1996-01-01")


def q_schema_evolution(spark, root):
    """Snapshots landed in three eras: first without a column and with a narrower number, then whole, then
    with a column more; and a load whose types do not fit, which is refused."""
    b, path = inputs.bronze(spark, root), scratch_path(spark, "evolving")
    dt, (second, third) = F.col("dt"), (F.lit(d).cast("date") for d in ERAS)
    land = schema_log.land_evolving
    land(b.where(dt < second).drop("count_reopen").withColumn("view_count", F.col("view_count").cast("int")), path)
    land(b.where((dt >= second) & (dt < third)), path)
    land(b.where(dt >= third).withColumn("is_finished", F.col("timestamp_finished").isNotNull()), path)
    try:
        land(b.where(dt >= third).withColumn("view_count", F.col("view_count").cast("string")), path)
    except schema_log.SchemaDrift:
        return schema_log.read_evolving(spark, path)
    raise AssertionError("a load with other types was landed")


def q_upsert_bucketed(spark, root):
    """``incremental_upsert`` on a state laid out by hash bucket, in place."""
    seed, daily = seed_and_daily(spark, root)
    path = scratch_path(spark, "state-buckets")
    buckets.write_buckets(silver.dedup_latest(seed, "ticket_id", "last_activity", SNAPSHOT_TIE_BREAKERS), path, buckets=16)
    buckets.upsert_buckets(spark, path, daily, tie_breakers=SNAPSHOT_TIE_BREAKERS)
    return history.publish_state(buckets.read_buckets(spark, path).drop(buckets.BUCKET))


def q_stream_compacted(spark, root):
    """The snapshots streamed into a change log whose closed batches are folded into its base as it grows."""
    src = inputs.bronze_path(spark, root)
    log = change_log.ChangeLog(spark, scratch_path(spark, "stream-log"),
                               change_log.latest_versions(tie_breakers=SNAPSHOT_TIE_BREAKERS))
    change_log.run_change_log(spark, src, spark.read.parquet(src).schema, log, scratch_path(spark, "stream-ckpt"),
                              compact_every=2, max_files_per_trigger=500)
    return history.publish_state(log.read())


def q_median_rollup(spark, root):
    """Medians by district and month, and by category and week, from the stored sketches of cell-days."""
    path = scratch_path(spark, "sketches")
    rollup.sketches_of(inputs.silver(spark, root)).write.parquet(path)
    sketches = spark.read.parquet(path)
    parts = [rollup.rollup_medians(sketches, (by,), period).select(
        F.lit(f"{by} {period}").alias("grain"), F.col(by).alias("value"), "period_start", "closed", "median_days")
        for by, period in (("district", "month"), ("category", "week"))]
    return parts[0].unionByName(parts[1])


#: Days that the gap planner's lake lacks, days of which it has two pages only, and all expected ones.
UNLANDED, CUT_SHORT, EXPECTED = ("2024-01-12", "2024-01-17"), ("2024-01-20", "2024-01-23"), ("2024-01-01", "2024-02-02")


def _gappy_lake(spark, root):
    """A lake that was landed with gaps: its path."""
    p, path = inputs.pages(spark, root), scratch_path(spark, "gappy")
    within = lambda days: (F.col("poll_id") >= days[0]) & (F.col("poll_id") < days[1])
    load_bronze(p.where(~within(UNLANDED) & ~within(CUT_SHORT)), path, FEED_PAGE_SIZE, ingested_at=_load_time())
    load_bronze(p.where(within(CUT_SHORT)), path, FEED_PAGE_SIZE, max_records=2 * FEED_PAGE_SIZE, ingested_at=_load_time())
    return path


def _gap_plan(spark, root, path):
    findings = backfill.day_findings(spark.read.parquet(path), backfill.held_rows(inputs.pages(spark, root), FEED_PAGE_SIZE),
                                     quality.expected_days(spark, *EXPECTED))
    return backfill.backfill_plan(findings)


def q_backfill_plan(spark, root):
    """Ranges of days to land again: missing, partial, late."""
    return _gap_plan(spark, root, _gappy_lake(spark, root))


def q_backfill_planned(spark, root):
    """The lake after its plan's ranges were landed again: equal to the full load."""
    path = _gappy_lake(spark, root)
    plan = _gap_plan(spark, root, path)
    backfill.reland(inputs.pages(spark, root), plan, path, FEED_PAGE_SIZE, ingested_at=_load_time())
    return _landed(spark, path)


def q_dq_freshness_expected(spark, root):
    """Freshness of all expected days, those that never landed too."""
    return quality.check_freshness(spark.read.parquet(_gappy_lake(spark, root)),
                                   expected=quality.expected_days(spark, *EXPECTED))


#: Polls whose second page arrives cut short, and one whose last page arrives as something else.
TORN, GARBLED = ("2024-01-08", "2024-01-11"), "2024-01-15"


def _spoiled_pages(spark, root):
    """The landed pages with some of them spoiled on the way: their path."""
    path = scratch_path(spark, "spoiled")
    lines = spark.read.text(inputs.pages_path(spark, root))
    poll = F.get_json_object("value", "$.poll_id")
    offset = F.get_json_object("value", "$.page_offset").cast("long")
    torn = (poll >= TORN[0]) & (poll < TORN[1]) & (offset == FEED_PAGE_SIZE)
    last = lines.where(poll == GARBLED).agg(F.max(offset)).scalar()
    text = F.when(torn, F.substring("value", 1, 80)).when((poll == GARBLED) & (offset == last), "<html>busy</html>")
    lines.select(F.coalesce(text, F.col("value")).alias("value")).write.text(path)
    return path


def _quarantined(spark, root):
    out, dead = scratch_path(spark, "quarantine-bronze"), scratch_path(spark, "dead-letters")
    quarantine.load_with_quarantine(spark, _spoiled_pages(spark, root), out, dead, FEED_PAGE_SIZE, most_bad=0.2,
                                    ingested_at=_load_time())
    return out, dead


def q_quarantine_load(spark, root):
    """The rows of all readable pages, with some pages spoiled."""
    return _landed(spark, _quarantined(spark, root)[0])


def q_dead_letters(spark, root):
    """The pages that could not be read, and why."""
    return spark.read.parquet(_quarantined(spark, root)[1]).select("poll_id", "page_offset", "reason")


def q_scd2_merge(spark, root):
    """``scd2_history`` of all versions from that of the seed era and the versions that came later."""
    seed, later = seed_and_daily(spark, root)
    names = ("state_type_latest", "ticket_id", "last_activity", SNAPSHOT_TIE_BREAKERS)
    path = scratch_path(spark, "history")
    history.scd2_bounds(seed, *names).write.parquet(path)
    merged = history.scd2_merge(spark.read.parquet(path), later, inputs.bronze(spark, root), *names)
    return merged.drop("first_seen", "last_seen")


AS_OF_DAYS = 30


def q_as_of_state(spark, root):
    """The raw state that each ticket had a month after it was reported, from the history of states."""
    h = history.scd2_history(inputs.bronze(spark, root), "state_type_latest", tie_breakers=SNAPSHOT_TIE_BREAKERS)
    facts = inputs.silver(spark, root).select("ticket_id", (F.col("timestamp") + F.make_dt_interval(F.lit(AS_OF_DAYS))).alias("at"))
    return history.as_of(facts, h, "at", "state_type_latest", name="state_then")


def q_dq_rowcount_estimated(spark, root):
    """The row-count check of the published silver against merged sketches of bronze's partitions."""
    path = scratch_path(spark, "key-sketches")
    key_sketches.refresh_sketches(inputs.bronze(spark, root), path)
    return key_sketches.check_rowcount_delta_estimated(
        inputs.silver(spark, root), key_sketches.read_sketches(spark, path)).select("name", "passed")


def q_compact_partitions(spark, root):
    """Events landed by day in many small files, then compacted: the same rows in a file a day."""
    path = scratch_path(spark, "small-files")
    events = inputs.events_by_day_path(spark, root)
    spark.read.parquet(events).repartition(6).write.partitionBy("day").parquet(path)
    return compaction.compacted(spark, path, "day")


def q_dq_referential_all(spark, root):
    """The daily fact's three keys against their published dimensions and against stale ones, one pass each."""
    fact = inputs.gold_table(spark, root, "fact_district_daily")
    dims = {k: inputs.gold_table(spark, root, f"dim_{k}") for k in ("district", "category", "date")}
    stale = {"district": dims["district"].where(F.col("district") < STALE_DISTRICTS_BEFORE), "category": dims["category"],
             "date": dims["date"].where(F.col("date") < F.lit(SEED_CUTOFF).cast("date"))}
    return (quality.check_referentials(fact, dims).withColumn("dimensions", F.lit("published"))
            .unionByName(quality.check_referentials(fact, stale).withColumn("dimensions", F.lit("stale"))))


QUERIES: dict[str, Query] = {
    "feed_pages": q_feed_pages,
    "page_until_boundary": q_page_until_boundary,
    "flatten_json": q_flatten_json,
    "window_filter": q_window_filter,
    "stamp_load_metadata": q_stamp_load_metadata,
    "bronze_load": q_bronze_load,
    "feed_lifecycle": q_feed_lifecycle,
    "dedup_latest": q_dedup_latest,
    "parse_timestamps": q_parse_timestamps,
    "bbox_filter": q_bbox_filter,
    "normalize_state": q_normalize_state,
    "explode_bridge": q_explode_bridge,
    "silver_tickets": q_silver_tickets,
    "silver_publish": q_silver_publish,
    "scan_partitioned": q_scan_partitioned,
    "partition_overwrite": q_partition_overwrite,
    "dq_non_empty": q_dq_non_empty,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_geo_bounds": q_dq_geo_bounds,
    "dq_rowcount_delta": q_dq_rowcount_delta,
    "quality_gate": q_quality_gate,
    "quality_gate_bronze": q_quality_gate_bronze,
    "dim_district": q_dim_district,
    "dim_category": q_dim_category,
    "dim_date": q_dim_date,
    "fact_lifecycle": q_fact_lifecycle,
    "ticket_category_base": q_ticket_category_base,
    "opened_daily": q_opened_daily,
    "closed_daily": q_closed_daily,
    "dense_grid": q_dense_grid,
    "densify": q_densify,
    "running_backlog": q_running_backlog,
    "fact_daily": q_fact_daily,
    "fact_daily_exact": q_fact_daily_exact,
    "gold_build": q_gold_build,
    "latest_day": q_latest_day,
    "top_backlog": q_top_backlog,
    "median_resolution": q_median_resolution,
    "seed_reconcile": q_seed_reconcile,
    "incremental_daily": q_incremental_daily,
    "backfill": q_backfill,
    "scd2_history": q_scd2_history,
    "incremental_upsert": q_incremental_upsert,
    "dq_referential": q_dq_referential,
    "dq_freshness": q_dq_freshness,
    "topsis_rank": q_topsis_rank,
    "stream_current": q_stream_current,
    "stream_daily_opened": q_stream_daily_opened,
    "stream_pages": q_stream_pages,
    "daily_ledger": q_daily_ledger,
    "schema_evolution": q_schema_evolution,
    "upsert_bucketed": q_upsert_bucketed,
    "stream_compacted": q_stream_compacted,
    "median_rollup": q_median_rollup,
    "backfill_plan": q_backfill_plan,
    "backfill_planned": q_backfill_planned,
    "dq_freshness_expected": q_dq_freshness_expected,
    "quarantine_load": q_quarantine_load,
    "dead_letters": q_dead_letters,
    "scd2_merge": q_scd2_merge,
    "as_of_state": q_as_of_state,
    "dq_rowcount_estimated": q_dq_rowcount_estimated,
    "compact_partitions": q_compact_partitions,
    "dq_referential_all": q_dq_referential_all,
}
