"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written against the raw driver tables; the CTEs rebuild the same lineage (fixture ->
bronze -> silver -> gold) in plain SQL, so a bug in a Spark operator cannot hide in
a shared helper. Types are cast to what Spark returns (INTEGER for calendar parts
and day differences, BIGINT for counts and sums).
"""

from __future__ import annotations

TS_FMT = "'%Y-%m-%d %H:%M:%S'"


def _coord(base: str, key: str, modulus: int) -> str:
    return f"(CAST({base} AS DOUBLE) + CAST({key} % {modulus} AS DOUBLE) / CAST(100.0 AS DOUBLE))"


TICKETS = f"""
per_order AS (
  SELECT l_orderkey,
    min(CASE WHEN l_shipdate >= o_orderdate THEN l_shipdate END) AS timestamp_inprogress,
    max(CASE WHEN l_shipdate >= o_orderdate AND o_orderstatus = 'F' THEN l_shipdate END)
      AS timestamp_finished,
    CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS count_reopen,
    list_sort(list_distinct(list(p_type))) AS problem_type_fondue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey
),
tickets AS (
  SELECT o_orderkey AS ticket_id, n_name AS district, o_orderdate AS "timestamp",
    timestamp_inprogress, timestamp_finished,
    CASE o_orderstatus WHEN 'O' THEN 'start' WHEN 'F' THEN 'finish' ELSE 'pending' END
      AS final_state,
    count_reopen, problem_type_fondue,
    {_coord('100.25', 'o_custkey', 80)} AS lon,
    {_coord('13.45', 'o_orderkey', 60)} AS lat
  FROM orders
  LEFT JOIN per_order ON o_orderkey = l_orderkey
  LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey) ON o_custkey = c_custkey
),
versions AS (
  SELECT *, "timestamp" AS v_at, 'start' AS v_state, CAST(NULL AS TIMESTAMP) AS v_inprogress,
    CAST(NULL AS TIMESTAMP) AS v_finished, 1 AS v_version,
    {_coord('13.50', 'ticket_id', 50)} AS v_lat
  FROM tickets
  UNION ALL
  SELECT *, timestamp_inprogress,
    CASE WHEN final_state = 'pending' THEN 'pending' ELSE 'inprogress' END,
    timestamp_inprogress, CAST(NULL AS TIMESTAMP), 2, lat
  FROM tickets
  UNION ALL
  SELECT *, timestamp_finished, 'finish', timestamp_inprogress, timestamp_finished, 3, lat
  FROM tickets
),
bronze AS (
  SELECT ticket_id,
    strftime("timestamp", {TS_FMT}) AS "timestamp",
    strftime(v_at, {TS_FMT}) AS last_activity,
    strftime(v_inprogress, {TS_FMT}) AS timestamp_inprogress,
    strftime(v_finished, {TS_FMT}) AS timestamp_finished,
    v_state AS state_type_latest, district, problem_type_fondue, count_reopen,
    CAST(v_version AS BIGINT) AS view_count, lon, v_lat AS lat, CAST(v_at AS DATE) AS dt
  FROM versions WHERE v_at IS NOT NULL
)"""

STATUS = """CASE state_type_latest
      WHEN 'start' THEN 'reported' WHEN 'inprogress' THEN 'in_progress'
      WHEN 'finish' THEN 'resolved' WHEN 'forward' THEN 'forwarded'
      WHEN 'irrelevant' THEN 'rejected' END"""

IN_BOX = ("lat BETWEEN CAST(13.49 AS DOUBLE) AND CAST(14.00 AS DOUBLE) "
          "AND lon BETWEEN CAST(100.32 AS DOUBLE) AND CAST(100.94 AS DOUBLE)")

PARSED = ", ".join(
    f'try_strptime("{c}", {TS_FMT}) AS "{c}"'
    for c in ("timestamp", "last_activity", "timestamp_inprogress", "timestamp_finished")
)

DEDUP = """deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ticket_id
      ORDER BY last_activity DESC NULLS LAST, view_count DESC NULLS LAST) AS rn
    FROM bronze) WHERE rn = 1
)"""

SILVER = f"""{TICKETS},
{DEDUP},
silver AS (
  SELECT * REPLACE ({PARSED}), {STATUS} AS status
  FROM deduped WHERE {IN_BOX}
),
bridge AS (
  SELECT ticket_id, unnest(problem_type_fondue) AS category FROM silver
)"""

LIFECYCLE = """lifecycle AS (
  SELECT ticket_id, district, CAST("timestamp" AS DATE) AS reported_date,
    "timestamp" AS reported_at, timestamp_inprogress AS in_progress_at,
    timestamp_finished AS finished_at, status,
    coalesce(count_reopen, 0) > 0 AS is_reopened,
    timestamp_finished IS NOT NULL AS is_resolved,
    CAST(date_diff('day', CAST("timestamp" AS DATE), CAST(timestamp_finished AS DATE))
      AS INTEGER) AS days_to_resolve
  FROM silver
)"""

DIMS = """dim_district AS (
  SELECT DISTINCT district FROM silver WHERE district IS NOT NULL AND trim(district, ' ') <> ''
),
dim_category AS (
  SELECT DISTINCT category FROM bridge WHERE category IS NOT NULL AND trim(category, ' ') <> ''
),
bounds AS (
  SELECT min(CAST("timestamp" AS DATE)) AS s,
    greatest(max(CAST("timestamp" AS DATE)), max(CAST(timestamp_finished AS DATE))) AS e
  FROM silver
),
dim_date AS (
  SELECT CAST(g AS DATE) AS date,
    CAST(year(g) AS INTEGER) AS year, CAST(month(g) AS INTEGER) AS month,
    CAST(day(g) AS INTEGER) AS day, CAST(dayofweek(g) + 1 AS INTEGER) AS day_of_week,
    CAST(weekofyear(g) AS INTEGER) AS week_of_year, dayofweek(g) IN (0, 6) AS is_weekend,
    monthname(g) AS month_name, CAST(quarter(g) AS INTEGER) AS quarter
  FROM bounds, generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY) AS t(g)
  WHERE s <= e
)"""

BASE = """base AS (
  SELECT b.ticket_id, b.category, s.district, CAST(s."timestamp" AS DATE) AS reported_date,
    CAST(s.timestamp_finished AS DATE) AS finished_date,
    CAST(date_diff('day', CAST(s."timestamp" AS DATE), CAST(s.timestamp_finished AS DATE))
      AS INTEGER) AS days_to_resolve
  FROM bridge b JOIN silver s ON b.ticket_id = s.ticket_id
),
opened AS (
  SELECT district, category, reported_date AS date, count(*) AS opened
  FROM base GROUP BY ALL
),
closed AS (
  SELECT district, category, finished_date AS date, count(*) AS closed,
    quantile_disc(days_to_resolve, 0.5) AS median_resolution_time
  FROM base WHERE finished_date IS NOT NULL GROUP BY ALL
),
grid AS (
  SELECT d.district, c.category, t.date
  FROM dim_district d, dim_category c, dim_date t
),
cells AS (
  SELECT g.district, g.category, g.date, coalesce(o.opened, 0) AS opened,
    coalesce(c.closed, 0) AS closed, c.median_resolution_time
  FROM grid g
  LEFT JOIN opened o USING (district, category, date)
  LEFT JOIN closed c USING (district, category, date)
),
daily AS (
  SELECT district, category, date, opened, closed,
    CAST(sum(opened - closed) OVER (PARTITION BY district, category ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS backlog,
    median_resolution_time
  FROM cells
)"""

GOLD = f"{SILVER},\n{LIFECYCLE},\n{DIMS},\n{BASE}"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


REPORT_CATEGORY = "STANDARD"

FEED = f"""ev AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
tops AS (SELECT day AS poll_day, max(event_id) AS top FROM ev GROUP BY day),
feed AS (
  SELECT t.poll_day, t.top, e.* FROM ev e JOIN tops t ON e.day = t.poll_day
  UNION ALL
  SELECT t.poll_day, t.top, e.* FROM ev e JOIN tops t ON e.day + 1 = t.poll_day
),
feat AS (
  SELECT strftime(poll_day, '%Y-%m-%d') AS poll_id,
    CAST(floor((top - event_id) / 50) * 50 AS BIGINT) AS page_offset,
    'U' || CAST(user_id AS VARCHAR) AS ticket_id,
    strftime(ts, {TS_FMT}) AS last_activity,
    event_type AS district, [event_type] AS problem_type_fondue,
    CASE event_type WHEN 'signup' THEN 'start' WHEN 'view' THEN 'inprogress'
      WHEN 'purchase' THEN 'finish' WHEN 'click' THEN 'forward'
      WHEN 'error' THEN 'irrelevant' END AS state_type_latest,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS view_count,
    strftime(ts - to_days(CAST(user_id % 3 AS INTEGER)), {TS_FMT}) AS "timestamp",
    CASE WHEN event_type IN ('view', 'purchase') THEN strftime(ts, {TS_FMT}) END AS timestamp_inprogress,
    CASE WHEN event_type = 'purchase' THEN strftime(ts, {TS_FMT}) END AS timestamp_finished,
    CAST(user_id % 2 AS BIGINT) AS count_reopen,
    '{{"event_id":"' || event_id || '"}}' AS extra,
    {_coord('100.25', 'user_id', 80)} AS lon,
    {_coord('13.45', 'event_id', 60)} AS lat
  FROM feed
),
pages AS (
  SELECT poll_id, page_offset, count(*) AS n_features, min(last_activity) AS oldest,
    max(last_activity) AS newest
  FROM feat GROUP BY ALL
),
marks AS (
  SELECT poll_id, page_offset,
    count(*) OVER w AS pages_before,
    coalesce(bool_or(oldest < poll_id || ' 00:00:00' OR n_features = 0) OVER w, false)
      AS stopped
  FROM pages
  WINDOW w AS (PARTITION BY poll_id ORDER BY page_offset
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
kept AS (SELECT poll_id, page_offset FROM marks WHERE pages_before * 50 = page_offset AND NOT stopped)"""

LOADED = """strftime(CAST(poll_id AS DATE) + 1, '%Y-%m-%d')
    || CASE WHEN day(CAST(poll_id AS DATE)) % 7 = 0 THEN 'T10:00:00' ELSE 'T00:00:00' END"""
NEXT_DAY = "strftime(CAST(poll_id AS DATE) + 1, '%Y-%m-%d')"

# A lake that lacks the days 12 to 16, has two pages of the polls of days 20 to 22, and is looked at from
# January 1 to February 2.
GAPPY = f"""capped AS (
  SELECT poll_id, page_offset, coalesce(sum(n_features) OVER (PARTITION BY poll_id ORDER BY page_offset
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS collected
  FROM pages
),
counted AS (
  SELECT CAST(poll_id AS DATE) AS dt, count(*) AS held,
    count(*) FILTER (WHERE collected < 100) AS first_pages, max(CAST({LOADED} AS TIMESTAMP)) AS landed_at
  FROM feat f JOIN kept USING (poll_id, page_offset) JOIN capped USING (poll_id, page_offset)
  WHERE last_activity >= poll_id || ' 00:00:00' AND last_activity < {NEXT_DAY} || ' 00:00:00'
  GROUP BY 1
),
days AS (
  SELECT CAST(g AS DATE) AS dt, coalesce(held, 0) AS held, landed_at,
    CASE WHEN g >= '2024-01-12' AND g < '2024-01-17' THEN 0
      WHEN g >= '2024-01-20' AND g < '2024-01-23' THEN coalesce(first_pages, 0) ELSE coalesce(held, 0) END AS n,
    g + INTERVAL 30 HOUR AS deadline
  FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-02', INTERVAL 1 DAY) AS t(g)
  LEFT JOIN counted ON dt = CAST(g AS DATE)
),
findings AS (
  SELECT *, CASE WHEN n < held THEN CASE WHEN n = 0 THEN 'missing' ELSE 'partial' END
    WHEN n > 0 AND landed_at > deadline THEN 'late' ELSE 'complete' END AS finding
  FROM days
)"""

NOT_NULL_BRONZE = "ticket_id IS NULL OR district IS NULL OR lon IS NULL"


def _gate(rel: str, not_null: str, label: str, with_delta: bool) -> str:
    delta = ""
    if with_delta:
        delta = f""",
  ('rowcount_delta', coalesce(b > 0 AND n <= b AND n >= b * 0.5, false),
   printf('silver=%d vs bronze_distinct=%d (min_ratio=0.5)', n, b))"""
    return f"""m AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE {not_null}) AS null_rows,
    count(*) - (count(DISTINCT ticket_id) + max(CAST(ticket_id IS NULL AS INTEGER))) AS dup,
    count(*) FILTER (WHERE NOT ({IN_BOX})) AS outside,
    (SELECT count(DISTINCT ticket_id) + max(CAST(ticket_id IS NULL AS INTEGER)) FROM bronze) AS b
  FROM {rel}
)
SELECT t.* FROM m, LATERAL (VALUES
  ('non_empty', n > 0, printf('%d rows', n)),
  ('not_null', null_rows = 0, printf('%d rows null in {label}', null_rows)),
  ('unique_ticket_id', dup = 0, printf('%d duplicate ticket_id', dup)),
  ('geo_bounds', outside = 0, printf('%d rows outside the city bbox', outside)){delta}
) AS t(name, passed, detail)"""

TOPSIS = """crit AS (
  SELECT district,
    CAST(count(*) FILTER (WHERE NOT is_resolved) AS DOUBLE) AS open_tickets,
    CAST(coalesce(quantile_disc(CASE WHEN is_resolved THEN days_to_resolve END, 0.5), 0)
      AS DOUBLE) AS median_days,
    count(*) FILTER (WHERE is_reopened) / count(*) AS reopen_rate
  FROM lifecycle WHERE district IS NOT NULL GROUP BY district
),
norms AS (
  SELECT sqrt(sum(open_tickets * open_tickets)) AS n1, sqrt(sum(median_days * median_days)) AS n2,
    sqrt(sum(reopen_rate * reopen_rate)) AS n3 FROM crit
),
w AS (
  SELECT crit.*,
    (CASE WHEN n1 > 0 THEN open_tickets / n1 ELSE 0.0 END) * CAST(0.4 AS DOUBLE) AS w1,
    (CASE WHEN n2 > 0 THEN median_days / n2 ELSE 0.0 END) * CAST(0.4 AS DOUBLE) AS w2,
    (CASE WHEN n3 > 0 THEN reopen_rate / n3 ELSE 0.0 END) * CAST(0.2 AS DOUBLE) AS w3
  FROM crit, norms
),
ideal AS (SELECT max(w1) AS b1, max(w2) AS b2, max(w3) AS b3, min(w1) AS s1, min(w2) AS s2,
  min(w3) AS s3 FROM w),
dist AS (
  SELECT w.*, sqrt(pow(w1 - b1, 2) + pow(w2 - b2, 2) + pow(w3 - b3, 2)) AS db,
    sqrt(pow(w1 - s1, 2) + pow(w2 - s2, 2) + pow(w3 - s3, 2)) AS dw
  FROM w, ideal
)"""

SEEDED = """seeded AS (
  SELECT * REPLACE (CASE WHEN dt < DATE '1998-01-01' THEN NULL ELSE count_reopen END
    AS count_reopen) FROM bronze
)"""

ORACLE: dict[str, str] = {
    "feed_pages": _with(FEED, "SELECT * FROM pages"),
    "page_until_boundary": _with(FEED, "SELECT f.* FROM feat f JOIN kept USING (poll_id, page_offset)"),
    "flatten_json": _with(FEED, "SELECT * FROM feat"),
    "window_filter": _with(FEED, """SELECT * FROM feat
WHERE last_activity >= '2024-01-10 00:00:00' AND last_activity < '2024-01-20 00:00:00'"""),
    "stamp_load_metadata": _with(FEED, """SELECT *, '2024-02-01T00:00:00+00:00' AS _ingested_at,
  'feed' AS _source, '2024-01-31' AS _run_id FROM feat"""),
    "bronze_load": _with(FEED, f"""SELECT f.* EXCLUDE (poll_id, page_offset),
  {LOADED} || '+00:00' AS _ingested_at, 'feed' AS _source, poll_id AS _run_id,
  CAST(poll_id AS DATE) AS dt
FROM feat f JOIN kept USING (poll_id, page_offset)
WHERE last_activity >= poll_id || ' 00:00:00' AND last_activity < {NEXT_DAY} || ' 00:00:00'"""),
    "stream_pages": _with(FEED, f"""SELECT f.* EXCLUDE (poll_id, page_offset),
  {LOADED} || '+00:00' AS _ingested_at, 'feed' AS _source, poll_id AS _run_id,
  CAST(poll_id AS DATE) AS dt
FROM feat f
WHERE last_activity >= poll_id || ' 00:00:00' AND last_activity < {NEXT_DAY} || ' 00:00:00'"""),
    "feed_lifecycle": _with(FEED + ",", f"""landed AS (
  SELECT f.*, CAST(json_extract_string(extra, '$.event_id') AS BIGINT) AS event_id
  FROM feat f JOIN kept USING (poll_id, page_offset)
  WHERE last_activity >= poll_id || ' 00:00:00' AND last_activity < {NEXT_DAY} || ' 00:00:00'
),
newest AS (
  SELECT * FROM landed
  QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY last_activity DESC, event_id DESC) = 1
),
silver AS (SELECT * REPLACE ({PARSED}), {STATUS} AS status FROM newest WHERE {IN_BOX}),
{LIFECYCLE}
SELECT * FROM lifecycle"""),
    "dedup_latest": _with(f"{TICKETS},\n{DEDUP}", "SELECT * FROM deduped"),
    "parse_timestamps": _with(TICKETS, f"SELECT * REPLACE ({PARSED}) FROM bronze"),
    "bbox_filter": _with(TICKETS, f"SELECT * FROM bronze WHERE {IN_BOX}"),
    "normalize_state": _with(TICKETS, f"SELECT *, {STATUS} AS status FROM bronze"),
    "explode_bridge": _with(SILVER, "SELECT * FROM bridge"),
    "silver_tickets": _with(SILVER, "SELECT * FROM silver"),
    "silver_publish": _with(SILVER, "SELECT * FROM silver"),
    "scan_partitioned": _with(TICKETS, """SELECT * FROM bronze
WHERE dt >= DATE '1997-01-01' AND dt < DATE '1998-01-01'"""),
    "partition_overwrite": _with(TICKETS, """SELECT * REPLACE (
  CASE WHEN year(dt) = 1996 THEN view_count + 100 ELSE view_count END AS view_count)
FROM bronze"""),
    "dq_non_empty": _with(TICKETS, """SELECT 'non_empty' AS name, count(*) > 0 AS passed,
  printf('%d rows', count(*)) AS detail FROM bronze"""),
    "dq_not_null": _with(TICKETS, f"""SELECT 'not_null' AS name, count(*) = 0 AS passed,
  printf('%d rows null in [''ticket_id'', ''district'', ''lon'']', count(*)) AS detail
FROM bronze WHERE {NOT_NULL_BRONZE}"""),
    "dq_unique": _with(TICKETS, """SELECT 'unique_ticket_id' AS name, d = 0 AS passed,
  printf('%d duplicate ticket_id', d) AS detail
FROM (SELECT count(*) - (count(DISTINCT ticket_id)
  + max(CAST(ticket_id IS NULL AS INTEGER))) AS d FROM bronze)"""),
    "dq_geo_bounds": _with(TICKETS, f"""SELECT 'geo_bounds' AS name, count(*) = 0 AS passed,
  printf('%d rows outside the city bbox', count(*)) AS detail
FROM bronze WHERE NOT ({IN_BOX})"""),
    "dq_rowcount_delta": _with(SILVER, """SELECT 'rowcount_delta' AS name,
  coalesce(b > 0 AND n <= b AND n >= b * 0.5, false) AS passed,
  printf('silver=%d vs bronze_distinct=%d (min_ratio=0.5)', n, b) AS detail
FROM (SELECT (SELECT count(*) FROM silver) AS n,
  (SELECT count(DISTINCT ticket_id) + max(CAST(ticket_id IS NULL AS INTEGER)) FROM bronze) AS b)"""),
    "quality_gate": _with(SILVER + ",\n" + _gate(
        "silver", "ticket_id IS NULL OR lon IS NULL OR lat IS NULL",
        "[''ticket_id'', ''lon'', ''lat'']", True), ""),
    "quality_gate_bronze": _with(TICKETS + ",\n" + _gate(
        "bronze", "ticket_id IS NULL OR lon IS NULL OR lat IS NULL",
        "[''ticket_id'', ''lon'', ''lat'']", False), ""),
    "dim_district": _with(GOLD, "SELECT * FROM dim_district"),
    "dim_category": _with(GOLD, "SELECT * FROM dim_category"),
    "dim_date": _with(GOLD, "SELECT * FROM dim_date"),
    "fact_lifecycle": _with(GOLD, "SELECT * FROM lifecycle"),
    "ticket_category_base": _with(GOLD, "SELECT * FROM base"),
    "opened_daily": _with(GOLD, "SELECT * FROM opened"),
    "closed_daily": _with(GOLD, "SELECT * FROM closed"),
    "dense_grid": _with(GOLD, "SELECT * FROM grid"),
    "densify": _with(GOLD, "SELECT * FROM cells"),
    "running_backlog": _with(GOLD, "SELECT * FROM daily"),
    "fact_daily": _with(GOLD, "SELECT * FROM daily"),
    "fact_daily_exact": _with(GOLD, "SELECT * FROM daily"),
    "seed_reconcile": _with(f"{TICKETS},\n{SEEDED}", """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY ticket_id
    ORDER BY last_activity DESC NULLS LAST, view_count DESC NULLS LAST) AS rn FROM seeded)
WHERE rn = 1"""),
    "incremental_upsert": _with(SILVER, "SELECT * FROM silver"),
    "scd2_history": _with(TICKETS + ",", """marked AS (
  SELECT ticket_id, state_type_latest, last_activity, view_count,
    lag(state_type_latest) OVER w AS prev, row_number() OVER w AS n
  FROM bronze
  WINDOW w AS (PARTITION BY ticket_id ORDER BY last_activity NULLS FIRST, view_count NULLS FIRST)
),
runs AS (SELECT * FROM marked WHERE n = 1 OR prev IS DISTINCT FROM state_type_latest)
SELECT ticket_id, state_type_latest, last_activity AS valid_from,
  lead(last_activity) OVER w AS valid_to, lead(last_activity) OVER w IS NULL AS is_current
FROM runs
WINDOW w AS (PARTITION BY ticket_id ORDER BY last_activity NULLS FIRST, view_count NULLS FIRST)"""),
    "incremental_daily": _with(GOLD, "SELECT * FROM daily"),
    "backfill": _with(FEED, f"""SELECT f.* EXCLUDE (poll_id, page_offset),
  {LOADED} || '+00:00' AS _ingested_at, 'feed' AS _source, poll_id AS _run_id,
  CAST(poll_id AS DATE) AS dt
FROM feat f JOIN kept USING (poll_id, page_offset)
WHERE last_activity >= poll_id || ' 00:00:00' AND last_activity < {NEXT_DAY} || ' 00:00:00'
  AND poll_id >= '2024-01-05' AND poll_id < '2024-01-15'"""),
    "stream_current": _with(SILVER, "SELECT * FROM silver"),
    "daily_ledger": _with(GOLD, "SELECT * FROM daily"),
    "schema_evolution": _with(TICKETS, """SELECT * REPLACE (
  CASE WHEN dt >= DATE '1994-01-01' THEN count_reopen END AS count_reopen),
  CASE WHEN dt >= DATE '1996-01-01' THEN timestamp_finished IS NOT NULL END AS is_finished
FROM bronze"""),
    "upsert_bucketed": _with(SILVER, "SELECT * FROM silver"),
    "stream_compacted": _with(SILVER, "SELECT * FROM silver"),
    "median_rollup": _with(GOLD, """SELECT 'district month' AS grain, district AS value,
  CAST(date_trunc('month', finished_date) AS DATE) AS period_start, count(*) AS closed,
  CAST(quantile_disc(days_to_resolve, 0.5) AS BIGINT) AS median_days
FROM base WHERE finished_date IS NOT NULL AND days_to_resolve IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 'category week', category, CAST(date_trunc('week', finished_date) AS DATE), count(*),
  CAST(quantile_disc(days_to_resolve, 0.5) AS BIGINT)
FROM base WHERE finished_date IS NOT NULL AND days_to_resolve IS NOT NULL GROUP BY ALL"""),
    "backfill_plan": _with(FEED + ",", f"""{GAPPY},
marked AS (SELECT *, dt - CAST(row_number() OVER (PARTITION BY finding ORDER BY dt) AS INTEGER) AS island
  FROM findings WHERE finding <> 'complete')
SELECT finding, min(dt) AS first_day, max(dt) AS last_day, count(*) AS days,
  CAST(sum(held - n) AS BIGINT) AS missing_rows
FROM marked GROUP BY finding, island"""),
    "backfill_planned": _with(FEED, f"""SELECT f.* EXCLUDE (poll_id, page_offset),
  {LOADED} || '+00:00' AS _ingested_at, 'feed' AS _source, poll_id AS _run_id,
  CAST(poll_id AS DATE) AS dt
FROM feat f JOIN kept USING (poll_id, page_offset)
WHERE last_activity >= poll_id || ' 00:00:00' AND last_activity < {NEXT_DAY} || ' 00:00:00'"""),
    "dq_freshness_expected": _with(FEED + ",", f"""{GAPPY}
SELECT dt, CASE WHEN n > 0 THEN landed_at END AS last_landed_at, deadline,
  n > 0 AND landed_at <= deadline AS on_time FROM days"""),
    "quarantine_load": _with(FEED, f"""SELECT f.* EXCLUDE (poll_id, page_offset),
  {LOADED} || '+00:00' AS _ingested_at, 'feed' AS _source, poll_id AS _run_id,
  CAST(poll_id AS DATE) AS dt
FROM feat f
WHERE last_activity >= poll_id || ' 00:00:00' AND last_activity < {NEXT_DAY} || ' 00:00:00'
  AND NOT (poll_id >= '2024-01-08' AND poll_id < '2024-01-11' AND page_offset = 50)
  AND NOT (poll_id = '2024-01-15' AND page_offset = (SELECT max(page_offset) FROM pages WHERE poll_id = '2024-01-15'))"""),
    "dead_letters": _with(FEED, """SELECT poll_id, page_offset, 'not a page' AS reason FROM pages
WHERE poll_id >= '2024-01-08' AND poll_id < '2024-01-11' AND page_offset = 50
UNION ALL SELECT NULL, NULL, 'not a page' FROM pages WHERE poll_id = '2024-01-15'
  AND page_offset = (SELECT max(page_offset) FROM pages WHERE poll_id = '2024-01-15')"""),
    "as_of_state": _with(SILVER + ",", """facts AS (SELECT ticket_id, "timestamp" + INTERVAL 30 DAY AS at FROM silver),
seen AS (SELECT *, try_strptime(last_activity, '%Y-%m-%d %H:%M:%S') AS v_at FROM bronze)
SELECT f.ticket_id, f.at, arg_max(v.state_type_latest, (v.v_at, v.view_count)) AS state_then
FROM facts f LEFT JOIN seen v ON v.ticket_id = f.ticket_id AND v.v_at <= f.at
GROUP BY f.ticket_id, f.at"""),
    "dq_rowcount_estimated": _with(SILVER, """SELECT 'rowcount_delta' AS name,
  coalesce(b > 0 AND n <= b AND n >= b * 0.5, false) AS passed
FROM (SELECT (SELECT count(*) FROM silver) AS n,
  (SELECT count(DISTINCT ticket_id) + max(CAST(ticket_id IS NULL AS INTEGER)) FROM bronze) AS b)"""),
    "compact_partitions": "SELECT *, CAST(ts AS DATE) AS day FROM events",
    "dq_referential_all": _with(GOLD, " UNION ALL ".join(f"""
SELECT 'referential_{k}' AS name, count(*) = 0 AS passed,
  printf('%d rows with {k} missing from the dimension', count(*)) AS detail, '{label}' AS dimensions
FROM daily WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM dim_{k} WHERE {rule})"""
                              for label, rules in (("published", ("true", "true", "true")),
                                                   ("stale", ("district < 'C'", "true", "date < DATE '1998-01-01'")))
                              for k, rule in zip(("district", "category", "date"), rules, strict=True))),
    "dq_referential": _with(GOLD, """SELECT 'referential_district' AS name, bad = 0 AS passed,
  printf('%d rows with district missing from the dimension', bad) AS detail, dimension
FROM (SELECT 'published' AS dimension, count(*) AS bad FROM lifecycle
      WHERE district IS NOT NULL AND district NOT IN (SELECT district FROM dim_district)
      UNION ALL
      SELECT 'stale', count(*) FROM lifecycle WHERE district IS NOT NULL
        AND district NOT IN (SELECT district FROM dim_district WHERE district < 'C'))"""),
    "dq_freshness": _with(FEED + ",", f"""landed AS (
  SELECT CAST(poll_id AS DATE) AS dt, CAST({LOADED} AS TIMESTAMP) AS landed_at
  FROM feat f JOIN kept USING (poll_id, page_offset)
  WHERE last_activity >= poll_id || ' 00:00:00' AND last_activity < {NEXT_DAY} || ' 00:00:00'
)
SELECT dt, max(landed_at) AS last_landed_at,
  CAST(dt + 1 AS TIMESTAMP) + INTERVAL 6 HOUR AS deadline,
  max(landed_at) <= CAST(dt + 1 AS TIMESTAMP) + INTERVAL 6 HOUR AS on_time
FROM landed GROUP BY dt"""),
    "topsis_rank": _with(f"{GOLD},\n{TOPSIS}", """SELECT district, open_tickets, median_days,
  reopen_rate, round(CASE WHEN db + dw > 0 THEN dw / (db + dw) ELSE 0.0 END, 6) AS stress_score
FROM dist"""),
    "stream_daily_opened": """SELECT date_trunc('day', ts) AS window_start,
  date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n
FROM events GROUP BY ALL""",
    "gold_build": _with(GOLD, """SELECT 'dim_district' AS table_name, count(*) AS "rows" FROM dim_district
UNION ALL SELECT 'dim_category', count(*) FROM dim_category
UNION ALL SELECT 'dim_date', count(*) FROM dim_date
UNION ALL SELECT 'fact_ticket_lifecycle', count(*) FROM lifecycle
UNION ALL SELECT 'fact_district_daily', count(*) FROM daily"""),
    "latest_day": _with(GOLD, "SELECT max(date) AS latest_date FROM daily"),
    "top_backlog": _with(GOLD, f"""SELECT district, backlog FROM daily
WHERE category = '{REPORT_CATEGORY}' AND date = (SELECT max(date) FROM daily)
ORDER BY backlog DESC NULLS LAST, district ASC NULLS FIRST LIMIT 5"""),
    "median_resolution": _with(GOLD, """SELECT district,
  quantile_disc(days_to_resolve, 0.5) AS median_days, count(*) AS resolved_n
FROM lifecycle WHERE is_resolved GROUP BY district
ORDER BY median_days DESC NULLS LAST, district ASC NULLS FIRST LIMIT 5"""),
}

ORACLE["scd2_merge"] = ORACLE["scd2_history"]
