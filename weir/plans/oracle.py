"""Equivalent SQL for each registered query, runnable by DuckDB on the
driver's tables (views ``orders``, ``lineitem``, ``events``, ...).

The shaping rules of ``weir.sources.shaped`` are restated here in SQL, then
the expected result is computed the plain way (joins instead of document
round trips), so the Spark pipeline and this text agree only if both are
right. Column names equal the Spark query's.
"""

from __future__ import annotations

# ---- shaping rules as CTEs ------------------------------------------------------

_TIER = (
    "CASE WHEN TRY_CAST(string_split({u}, '{d}')[-1] AS BIGINT) % 3 = 0 THEN 'premium' "
    "WHEN TRY_CAST(string_split({u}, '{d}')[-1] AS BIGINT) % 2 = 0 THEN 'standard' ELSE 'free' END"
)

PAGES = """pages AS (
  SELECT l_orderkey, list_sort(list('vid_' || l_partkey)) AS pages FROM lineitem GROUP BY l_orderkey)"""

SESSIONS = PAGES + """,
sessions AS (
  SELECT 'watch_' || o.o_orderkey AS session_id,
         'user_' || o.o_custkey AS user_id,
         o.o_orderdate AS start_time,
         o.o_orderdate + to_seconds(300 + (o.o_orderkey * 37) % 14100) AS end_time,
         CAST(300 + (o.o_orderkey * 37) % 14100 AS INTEGER) AS session_duration_seconds,
         """ + _TIER.format(u="('user_' || o.o_custkey)", d="_") + """ AS subscription_type,
         p.pages AS pages_visited,
         CASE o.o_custkey % 3 WHEN 0 THEN '{"type":"tv","os":"Tizen","app":"SmartTV"}'
                              WHEN 1 THEN '{"type":"mobile","os":"iOS","app":"StreamingApp"}'
                              ELSE '{"type":"desktop","os":"Windows","app":"Browser"}' END AS device,
         CASE o.o_orderstatus WHEN 'F' THEN '["play","pause"]' WHEN 'O' THEN '["play","seek","like"]'
                              ELSE '["play"]' END AS actions,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 3 ELSE 0 END AS off_h,
         o.o_orderkey
  FROM orders o LEFT JOIN pages p ON p.l_orderkey = o.o_orderkey)"""

CASES = """msgs AS (
  SELECT l_orderkey,
         list({'sender': CASE WHEN l_linenumber % 2 = 1 THEN 'user' ELSE 'support' END,
               'message': 'line ' || l_linenumber || ' part ' || l_partkey,
               'timestamp': strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'}
              ORDER BY l_linenumber, l_partkey, l_shipdate) AS messages
  FROM lineitem GROUP BY l_orderkey),
cases AS (
  SELECT 'case_' || o.o_orderkey AS ticket_id,
         'user_' || o.o_custkey AS user_id,
         CASE WHEN o.o_orderstatus = 'F' AND o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'resolved'
              WHEN o.o_orderstatus = 'F' THEN 'closed'
              WHEN o.o_orderstatus = 'O' THEN 'open' ELSE 'in_progress' END AS status,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'billing' WHEN '2-HIGH' THEN 'quality'
              WHEN '3-MEDIUM' THEN 'access' ELSE 'other' END AS issue_type,
         m.messages,
         o.o_orderdate AS created_at,
         o.o_orderdate + to_hours((o.o_orderkey * 13) % 48 + 1) AS updated_at
  FROM orders o LEFT JOIN msgs m ON m.l_orderkey = o.o_orderkey)"""

REPORTS = """reports_all AS (
  SELECT 'abuse_' || l.l_orderkey || '_' || l.l_linenumber AS review_id,
         'user_' || o.o_custkey AS user_id,
         'vid_' || l.l_partkey AS object_id,
         'returned ' || CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) || ' of part ' || l.l_partkey AS review_text,
         CAST(CAST(l.l_quantity AS INTEGER) % 5 + 1 AS INTEGER) AS rating,
         CASE WHEN l.l_linestatus = 'O' THEN 'pending' WHEN l.l_returnflag = 'R' THEN 'rejected'
              ELSE 'approved' END AS moderation_status,
         CASE l.l_returnflag WHEN 'R' THEN '["spam_suspected"]' WHEN 'A' THEN '["other","nudity"]'
              ELSE '[]' END AS flags,
         l.l_shipdate AS submitted_at,
         row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber
             ORDER BY l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_discount,
                      l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate) AS rn
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
reports AS (SELECT * EXCLUDE (rn) FROM reports_all WHERE rn = 1)"""

IOT = """iot AS (
  SELECT event_id AS seq,
         'dev_' || user_id AS id,
         date_trunc('hour', ts) AS noted_ts,
         strftime(ts, '%d-%m-%Y %H:00') AS noted_text,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS temp,
         CASE WHEN event_type = 'error' THEN 'nan' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS temp_text,
         CASE WHEN event_type IN ('view', 'click') THEN 'In' ELSE 'Out' END AS out_in,
         event_type
  FROM events)"""

TRIMMED = IOT + """,
bounds AS (SELECT quantile_cont(temp, 0.05) AS lo, quantile_cont(temp, 0.95) AS hi FROM iot WHERE out_in = 'In'),
trimmed AS (
  SELECT i.id, CAST(i.noted_ts AS DATE) AS day, CAST(i.temp AS DOUBLE) AS temp
  FROM iot i, bounds b WHERE i.out_in = 'In' AND i.temp >= b.lo AND i.temp <= b.hi),
daily AS (
  SELECT day, avg(temp) AS avg_temp, min(temp) AS min_temp, max(temp) AS max_temp FROM trimmed GROUP BY day)"""


def _window(src: str, name: str) -> str:
    return f"""{name} AS (SELECT * FROM {src} WHERE noted_ts >= (SELECT max(noted_ts) FROM {src}) - INTERVAL 7 DAY)"""


def _batch(window: str, name: str, batch_id: str, device: str = "right(id, 15)") -> str:
    return f"""{name}_all AS (
  SELECT noted_ts AS noted_date, CAST(temp AS DOUBLE) AS temperature, left(out_in, 10) AS location,
         {device} AS device_id, '{batch_id}' AS batch_id, seq,
         row_number() OVER (PARTITION BY noted_ts, {device} ORDER BY seq DESC) AS rn
  FROM {window}),
{name} AS (SELECT * EXCLUDE (rn) FROM {name}_all WHERE rn = 1)"""


INC_BATCH = "inc_20240131_020000"
INC_EARLY_BATCH = "inc_20240125_020000"

WATCH_MART = """SELECT CAST(s.start_time AS DATE) AS activity_date, s.user_id,
       CAST(count(*) AS INTEGER) AS sessions_count,
       CAST(CAST(sum(s.session_duration_seconds) AS DECIMAL(12,2)) / 60 AS DECIMAL(12,2)) AS total_watch_time_minutes,
       CAST(count(DISTINCT 'vid_' || l.l_partkey) AS INTEGER) AS videos_count,
       CAST(avg(CASE WHEN s.subscription_type = 'premium' THEN 1.0 ELSE 0.0 END) AS DECIMAL(5,2)) AS premium_ratio
FROM sessions s LEFT JOIN lineitem l ON l.l_orderkey = s.o_orderkey"""

ORACLE: dict[str, str] = {}

ORACLE["raw_watch_sessions"] = f"""WITH {SESSIONS}
SELECT session_id, user_id, start_time, end_time, session_duration_seconds, subscription_type,
       to_json(pages_visited) AS pages_visited, device, actions
FROM sessions"""

ORACLE["raw_playback_events"] = """SELECT 'play_' || event_id AS event_id, ts AS "timestamp", event_type,
  to_json({'video_id': 'vid_' || user_id,
           'position_seconds': CAST(floor(value * 10) AS INTEGER),
           'quality': ['144p', '360p', '720p', '1080p'][CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 + 1]}) AS details
FROM events"""

ORACLE["raw_support_cases"] = f"""WITH {CASES}
SELECT ticket_id, user_id, status, issue_type, to_json(messages) AS messages, created_at, updated_at,
       CASE WHEN status IN ('resolved', 'closed') THEN CAST(date_diff('second', created_at, updated_at) AS INTEGER) END
         AS resolution_time_seconds,
       CAST(coalesce(len(messages), 0) AS INTEGER) AS messages_count
FROM cases"""

ORACLE["raw_recommendations"] = f"""WITH {PAGES},
r AS (SELECT 'user_' || o.o_custkey AS user_id, p.pages, o.o_orderdate AS last_updated,
             row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderkey) AS rn
      FROM orders o LEFT JOIN pages p ON p.l_orderkey = o.o_orderkey)
SELECT user_id, to_json(pages) AS recommended_content, last_updated FROM r WHERE rn = 1"""

ORACLE["raw_reports"] = f"""WITH {REPORTS}
SELECT review_id, user_id, object_id, review_text, rating, moderation_status, flags, submitted_at FROM reports"""

ORACLE["subscription_tier"] = (
    "SELECT c_custkey, c_name AS user_id, "
    + _TIER.format(u="c_name", d="#")
    + " AS subscription_type FROM customer"
)

ORACLE["str_suffix_prefix"] = """SELECT c_custkey, right(c_name, 10) AS suffix_10, right(c_name, 15) AS suffix_15,
       left(c_name, 10) AS prefix_10 FROM customer"""

ORACLE["dedup_first"] = """SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
           l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST,
           l_shipdate NULLS FIRST) = 1"""

ORACLE["explode_inner"] = """SELECT 'watch_' || o.o_orderkey AS session_id, 'vid_' || l.l_partkey AS video_id
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""

ORACLE["explode_outer"] = """SELECT 'watch_' || o.o_orderkey AS session_id,
       CASE WHEN l.l_orderkey IS NOT NULL THEN 'vid_' || l.l_partkey END AS video_id
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""

ORACLE["to_json_arrays"] = f"""WITH {SESSIONS}
SELECT session_id, to_json(pages_visited) AS pages_json,
       CASE WHEN len(pages_visited) > 0 THEN to_json(pages_visited) END AS pages_json_nonempty,
       device AS device_json, actions AS actions_json
FROM sessions"""


def _iso(ts: str, off: str) -> str:
    return (
        f"strftime({ts} + to_hours({off}), '%Y-%m-%dT%H:%M:%S.%f') || "
        f"CASE WHEN {off} = 3 THEN '+03:00' ELSE '+00:00' END"
    )


ORACLE["src_json_docs"] = f"""WITH {SESSIONS}
SELECT session_id, user_id, {_iso('start_time', 'off_h')} AS start_time, {_iso('end_time', 'off_h')} AS end_time,
       to_json(pages_visited) AS pages_visited, device, actions
FROM sessions"""

ORACLE["watch_activity_daily"] = f"""WITH {SESSIONS}
{WATCH_MART}
GROUP BY 1, 2"""

ORACLE["watch_activity_daily_per_session"] = f"""WITH {SESSIONS},
agg AS (
  SELECT CAST(start_time AS DATE) AS activity_date, user_id,
         CAST(count(*) AS INTEGER) AS sessions_count,
         CAST(CAST(sum(session_duration_seconds) AS DECIMAL(12,2)) / 60 AS DECIMAL(12,2)) AS total_watch_time_minutes,
         CAST(avg(CASE WHEN subscription_type = 'premium' THEN 1.0 ELSE 0.0 END) AS DECIMAL(5,2)) AS premium_ratio
  FROM sessions GROUP BY 1, 2),
vids AS (
  SELECT CAST(s.start_time AS DATE) AS activity_date, s.user_id, count(DISTINCT 'vid_' || l.l_partkey) AS n
  FROM sessions s JOIN lineitem l ON l.l_orderkey = s.o_orderkey GROUP BY 1, 2)
SELECT a.activity_date, a.user_id, a.sessions_count, a.total_watch_time_minutes,
       CAST(coalesce(v.n, 0) AS INTEGER) AS videos_count, a.premium_ratio
FROM agg a LEFT JOIN vids v ON v.activity_date = a.activity_date AND v.user_id = a.user_id"""

_DS = "DATE '1998-01-01'"

ORACLE["support_and_abuse_daily"] = f"""WITH {CASES}, {REPORTS},
u AS (SELECT user_id FROM cases UNION SELECT user_id FROM reports),
sc AS (SELECT user_id, count(*) AS cnt, max(updated_at) AS last_update FROM cases
       WHERE CAST(created_at AS DATE) <= {_DS} GROUP BY user_id),
ar AS (SELECT user_id, count(*) AS cnt, max(submitted_at) AS last_report FROM reports
       WHERE CAST(submitted_at AS DATE) <= {_DS} GROUP BY user_id)
SELECT {_DS} AS snapshot_date, u.user_id,
       CAST(coalesce(sc.cnt, 0) AS INTEGER) AS support_cases_count,
       CAST(coalesce(ar.cnt, 0) AS INTEGER) AS abuse_reports_count,
       sc.last_update AS last_support_update, ar.last_report AS last_abuse_report
FROM u LEFT JOIN sc ON sc.user_id = u.user_id LEFT JOIN ar ON ar.user_id = u.user_id"""

ORACLE["user_union"] = f"""WITH {CASES}, {REPORTS}
SELECT user_id FROM cases UNION SELECT user_id FROM reports"""

ORACLE["flat_pets"] = """SELECT role || '-' || conv_id || '-' || turn AS name, role AS species,
       CASE WHEN role = 'system' THEN NULL ELSE to_json(string_split(text, chr(10))) END AS fav_foods,
       CASE WHEN role = 'system' THEN NULL ELSE CAST(2000 + turn AS INTEGER) END AS birth_year,
       'images/' || role || '-' || conv_id || '.jpg' AS photo
FROM conversations"""

ORACLE["flat_foods"] = """SELECT p_name || ', ' || p_type || CASE WHEN p_size > 45 THEN ' ' ELSE '' END AS food_name,
       p_brand AS manufacturer,
       CAST(p_size AS VARCHAR) AS serving_size,
       CAST(p_size * 10 AS INTEGER) AS calories_total,
       CASE WHEN p_type = 'SMALL' THEN NULL ELSE CAST(p_size * 3 AS INTEGER) END AS calories_fat,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS total_fat,
       CAST(p_size % 10 AS VARCHAR) AS saturated_fat,
       CAST(p_partkey % 300 AS VARCHAR) AS cholesterol,
       CAST(p_size * 20 AS VARCHAR) AS sodium,
       CAST(p_size % 30 AS VARCHAR) AS carb,
       CAST(p_size % 5 AS VARCHAR) AS fiber,
       CAST(p_size % 12 AS VARCHAR) AS protein,
       CASE WHEN p_type = 'ECONOMY' THEN '0' ELSE CAST(p_size % 40 AS VARCHAR) END AS vitamin_a,
       CASE WHEN p_type = 'ECONOMY' THEN '0' ELSE CAST(p_size % 50 AS VARCHAR) END AS vitamin_c,
       CASE WHEN p_type = 'PROMO' THEN '0' ELSE CAST(p_size % 9 AS VARCHAR) END AS calcium,
       CASE WHEN p_type = 'PROMO' THEN '0' ELSE CAST(p_size % 21 AS VARCHAR) END AS iron
FROM part"""

ORACLE["temp_percentiles"] = f"""WITH {IOT}
SELECT round(quantile_cont(temp, 0.05), 6) AS p_low, round(quantile_cont(temp, 0.95), 6) AS p_high
FROM iot WHERE out_in = 'In'"""

ORACLE["temp_trimmed"] = f"""WITH {TRIMMED}
SELECT id, day, temp FROM trimmed"""

ORACLE["temp_daily_stats"] = f"""WITH {TRIMMED}
SELECT day, round(avg_temp, 6) AS avg_temp, min_temp, max_temp FROM daily"""

_HOT = "(SELECT * FROM daily ORDER BY avg_temp DESC, day LIMIT 5)"
_COLD = "(SELECT * FROM daily ORDER BY avg_temp, day LIMIT 5)"

ORACLE["temp_hottest"] = f"""WITH {TRIMMED}
SELECT day, round(avg_temp, 6) AS avg_temp, min_temp, max_temp FROM {_HOT}"""

ORACLE["temp_coldest"] = f"""WITH {TRIMMED}
SELECT day, round(avg_temp, 6) AS avg_temp, min_temp, max_temp FROM {_COLD}"""

ORACLE["temp_extremes"] = f"""WITH {TRIMMED}
SELECT day, round(avg_temp, 6) AS avg_temp, min_temp, max_temp FROM (SELECT * FROM {_HOT} UNION SELECT * FROM {_COLD})"""

ORACLE["src_csv_scan"] = f"""WITH {IOT}
SELECT id, 'Room Admin' AS "room_id/id", noted_text AS noted_date, temp_text AS temp, out_in AS "out/in" FROM iot"""

ORACLE["temp_full_clean"] = f"""WITH {IOT}
SELECT noted_ts AS noted_date, CAST(temp AS DOUBLE) AS temperature, out_in AS location, right(id, 10) AS device_id
FROM iot"""

ORACLE["incremental_window"] = f"""WITH {IOT}, {_window('iot', 'w')}
SELECT noted_ts AS noted_date, id, temp_text AS temp, out_in FROM w"""

ORACLE["dedup_last"] = f"""WITH {IOT}, {_window('iot', 'w')}, {_batch('w', 'b', INC_BATCH)}
SELECT noted_date, device_id, temperature, seq FROM b"""

ORACLE["temp_incremental"] = f"""WITH {IOT}, {_window('iot', 'w')}, {_batch('w', 'b', INC_BATCH)}
SELECT noted_date, temperature, location, device_id, batch_id FROM b"""

_FALLBACK = "CASE WHEN event_type = 'signup' THEN fallback ELSE right(id, 15) END"

ORACLE["incremental_fallback_key"] = f"""WITH {IOT},
named AS (
  SELECT *, 'row_' || md5(strftime(noted_ts, '%Y-%m-%d %H:%M:%S') || '|' || temp_text || '|' || out_in) || '-'
            || row_number() OVER (PARTITION BY noted_ts, temp_text, out_in, event_type = 'signup' ORDER BY seq) AS fallback
  FROM iot), {_window('named', 'w')}, {_batch('w', 'b', INC_BATCH, _FALLBACK)}
SELECT noted_date, temperature, location, device_id, batch_id FROM b"""

ORACLE["temp_incremental_summary"] = f"""WITH {IOT}, {_window('iot', 'w')}, {_batch('w', 'b', INC_BATCH)}
SELECT count(*) AS total_records, min(noted_date) AS period_start, max(noted_date) AS period_end,
       round(avg(temperature), 2) AS avg_temperature, round(min(temperature), 2) AS min_temperature,
       round(max(temperature), 2) AS max_temperature
FROM b"""

ORACLE["normalise_nulls"] = f"""WITH {IOT}
SELECT seq, CAST(temp AS DOUBLE) AS temperature, out_in AS location, id AS device FROM iot"""

_ROWS = f"""{IOT}, {_window('iot', 'w')},
rows AS (SELECT noted_ts AS noted_date, left(out_in, 10) AS location, right(id, 15) AS device_id,
                '{INC_BATCH}' AS batch_id FROM w),
{SESSIONS}"""


def _check(table: str, rule: str, col: str, agg: str, src: str) -> str:
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{col}' AS column_name, CAST({agg} AS BIGINT) AS violations FROM {src}"


_TI = "temperature_incremental"
_WS = "watch_sessions_raw"
ORACLE["contract_violations"] = f"""WITH {_ROWS}
""" + "\nUNION ALL\n".join(
    [
        _check(_TI, "not_null", "noted_date", "count(*) FILTER (WHERE noted_date IS NULL)", "rows"),
        _check(_TI, "max_length", "location", "count(*) FILTER (WHERE length(location) > 10)", "rows"),
        _check(_TI, "not_null", "device_id", "count(*) FILTER (WHERE device_id IS NULL)", "rows"),
        _check(_TI, "max_length", "device_id", "count(*) FILTER (WHERE length(device_id) > 50)", "rows"),
        _check(_TI, "max_length", "batch_id", "count(*) FILTER (WHERE length(batch_id) > 50)", "rows"),
        _check(_TI, "unique", "noted_date,device_id", "coalesce(sum(n - 1), 0)",
               "(SELECT count(*) AS n FROM rows GROUP BY noted_date, device_id)"),
    ]
    + [
        _check(_WS, "not_null", c, f"count(*) FILTER (WHERE {c} IS NULL)", "sessions")
        for c in ("session_id", "user_id", "start_time", "end_time", "session_duration_seconds")
    ]
    + [
        _check(_WS, "unique", "session_id", "coalesce(sum(n - 1), 0)",
               "(SELECT count(*) AS n FROM sessions GROUP BY session_id)"),
    ]
)

_EV = "SELECT event_id, ts, user_id, event_type, value FROM events"

ORACLE["load_append"] = f"""{_EV} WHERE ts < TIMESTAMP '2024-01-16'
UNION ALL
{_EV} WHERE ts >= TIMESTAMP '2024-01-15'"""

ORACLE["load_full_replace"] = _EV

ORACLE["load_upsert"] = """SELECT event_id, ts, user_id, event_type,
       CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN value + 1 ELSE value END AS value,
       CASE WHEN ts < TIMESTAMP '2024-01-20' THEN TIMESTAMP '2024-02-01 00:00:00'
            ELSE TIMESTAMP '2024-02-02 00:00:00' END AS created_at,
       CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN TIMESTAMP '2024-02-02 00:00:00'
            ELSE TIMESTAMP '2024-02-01 00:00:00' END AS updated_at
FROM events"""

ORACLE["load_upsert_bucketed"] = ORACLE["load_upsert"]

ORACLE["load_upsert_composite"] = f"""WITH {IOT},
early AS (SELECT * FROM iot WHERE noted_ts < TIMESTAMP '2024-01-25'),
{_window('early', 'wa')}, {_batch('wa', 'ba', INC_EARLY_BATCH)},
{_window('iot', 'wb')}, {_batch('wb', 'bb', INC_BATCH)}
SELECT noted_date, device_id, temperature, location, batch_id, TIMESTAMP '2024-02-02 00:00:00' AS load_timestamp FROM bb
UNION ALL
SELECT a.noted_date, a.device_id, a.temperature, a.location, a.batch_id, TIMESTAMP '2024-02-01 00:00:00' AS load_timestamp
FROM ba a WHERE NOT EXISTS (SELECT 1 FROM bb b WHERE b.noted_date = a.noted_date AND b.device_id = a.device_id)"""

ORACLE["load_partition_replace"] = f"""WITH {SESSIONS}
{WATCH_MART}
WHERE CAST(s.start_time AS DATE) <> DATE '1998-06-16'
GROUP BY 1, 2"""

ORACLE["audit_full_load"] = """SELECT 'full-20240201' AS batch_id, count(*) AS records_loaded,
       TIMESTAMP '2024-02-01 02:00:00' AS created_at
FROM events"""

ORACLE["audit_run_state"] = f"""WITH {IOT}, {_window('iot', 'w')}, {_batch('w', 'b', INC_BATCH)}
SELECT 'incremental' AS load_type, '{INC_BATCH}' AS batch_id,
       TIMESTAMP '2024-01-31 02:00:00' AS start_date, TIMESTAMP '2024-01-31 02:05:00' AS end_date,
       count(*) AS records_loaded, 'success' AS load_status, CAST(NULL AS VARCHAR) AS error_message
FROM b"""

ORACLE["stream_ingest_sessions"] = ORACLE["raw_watch_sessions"]

ORACLE["stream_dedup_readings"] = """SELECT DISTINCT date_trunc('hour', ts) AS noted_date, 'dev_' || user_id AS device_id
FROM events"""


def _extremes(src: str, name: str) -> str:
    return f"""{name}_b AS (SELECT quantile_cont(temp, 0.05) AS lo, quantile_cont(temp, 0.95) AS hi FROM {src} WHERE out_in = 'In'),
{name}_d AS (
  SELECT CAST(i.noted_ts AS DATE) AS day, avg(CAST(i.temp AS DOUBLE)) AS avg_temp,
         CAST(min(i.temp) AS DOUBLE) AS min_temp, CAST(max(i.temp) AS DOUBLE) AS max_temp
  FROM {src} i, {name}_b b WHERE i.out_in = 'In' AND i.temp >= b.lo AND i.temp <= b.hi GROUP BY 1),
{name} AS (SELECT * FROM (SELECT * FROM {name}_d ORDER BY avg_temp DESC, day LIMIT 5)
           UNION SELECT * FROM (SELECT * FROM {name}_d ORDER BY avg_temp, day LIMIT 5))"""


ORACLE["temp_extremes_upsert"] = f"""WITH {IOT},
early AS (SELECT * FROM iot WHERE noted_ts < TIMESTAMP '2024-01-16'),
{_extremes('early', 'e1')}, {_extremes('iot', 'e2')}
SELECT day, round(avg_temp, 6) AS avg_temp, min_temp, max_temp FROM e2
UNION ALL
SELECT day, round(avg_temp, 6) AS avg_temp, min_temp, max_temp FROM e1 WHERE day NOT IN (SELECT day FROM e2)"""


def _two_loads(rows: str, key: str) -> str:
    """A collection loaded twice, at first the keys that end in 0-4."""
    return f"""SELECT r.*, CASE WHEN right({key}, 1) IN ('0', '1', '2', '3', '4') THEN TIMESTAMP '2024-02-01 00:00:00'
       ELSE TIMESTAMP '2024-02-02 00:00:00' END AS created_at, TIMESTAMP '2024-02-02 00:00:00' AS updated_at
FROM ({rows}) r"""


for _load, _rows, _key in (
    ("load_raw_sessions", "raw_watch_sessions", "session_id"),
    ("load_raw_events", "raw_playback_events", "event_id"),
    ("load_raw_recommendations", "raw_recommendations", "user_id"),
    ("load_raw_reports", "raw_reports", "review_id"),
):
    ORACLE[_load] = _two_loads(ORACLE[_rows], _key)

ORACLE["load_raw_cases"] = f"SELECT r.*, TIMESTAMP '2024-02-02 00:00:00' AS loaded_at FROM ({ORACLE['raw_support_cases']}) r"

ORACLE["load_rejects"] = """SELECT CASE event_id % 10 WHEN 7 THEN 'malformed' WHEN 9 THEN 'no key' ELSE 'loaded' END AS reason,
       count(*) AS records
FROM events GROUP BY 1"""

ORACLE["load_support_abuse_daily"] = ORACLE["support_and_abuse_daily"]


# ---- loads with rejects, tables by event date, streams with faults ---------------

_CHUNK = "(p_partkey // 8)"
ORACLE["load_flat_pets"] = ORACLE["flat_pets"] + "\nWHERE conv_id % 5 <> 3"
ORACLE["load_flat_foods"] = ORACLE["flat_foods"] + f"\nWHERE {_CHUNK} % 7 <> 5"


def _count(source: str, reason: str, what: str, rows: str) -> str:
    return f"SELECT '{source}' AS source, '{reason}' AS reason, {what} AS records FROM {rows}"


ORACLE["load_rejects_counted"] = f"""WITH {IOT}, good AS (SELECT * FROM iot WHERE seq % 11 <> 4),
{_window('good', 'w')}, {_batch('w', 'b', INC_BATCH)}
""" + "\nUNION ALL\n".join(
    [
        _count("pets", "loaded", "count(*)", "conversations WHERE conv_id % 5 <> 3"),
        _count("pets", "malformed", "count(*)", "(SELECT DISTINCT conv_id, turn // 4 FROM conversations WHERE conv_id % 5 = 3)"),
        _count("foods", "loaded", "count(*)", f"part WHERE {_CHUNK} % 7 <> 5"),
        _count("foods", "malformed", "count(*)", f"(SELECT DISTINCT {_CHUNK} FROM part WHERE {_CHUNK} % 7 = 5)"),
        _count("full", "loaded", "count(*)", "good"),
        _count("full", "bad date", "count(*)", "iot WHERE seq % 11 = 4"),
        _count("incremental", "loaded", "count(*)", "b"),
        _count("incremental", "bad date", "count(*)", "iot WHERE seq % 11 = 4"),
    ]
)

_L1, _L2 = "TIMESTAMP '2024-02-01 00:00:00'", "TIMESTAMP '2024-02-02 00:00:00'"

ORACLE["load_dated_events"] = f"""SELECT r.*, CAST("timestamp" AS DATE) AS event_date,
       CASE right(event_id, 1) WHEN '3' THEN {_L2} ELSE {_L1} END AS created_at,
       CASE WHEN right(event_id, 1) IN ('3', '5') THEN {_L2} ELSE {_L1} END AS updated_at
FROM ({ORACLE['raw_playback_events']}) r"""

ORACLE["refresh_watch_activity"] = ORACLE["watch_activity_daily"]


def _streamed(rows: str, key: str, stamp: str) -> str:
    """A collection whose keys ending in 0-4 come with the first export."""
    return f"""SELECT r.*, CASE WHEN right({key}, 1) IN ('0', '1', '2', '3', '4') THEN {_L1} ELSE {_L2} END AS {stamp}
FROM ({rows}) r"""


for _stream, _rows, _key, _stamp in (
    ("stream_ingest_events", "raw_playback_events", "event_id", "created_at"),
    ("stream_ingest_cases", "raw_support_cases", "ticket_id", "loaded_at"),
    ("stream_ingest_recommendations", "raw_recommendations", "user_id", "created_at"),
    ("stream_ingest_reports", "raw_reports", "review_id", "created_at"),
):
    ORACLE[_stream] = _streamed(ORACLE[_rows], _key, _stamp)

ORACLE["stream_ingest_replayed"] = f"""SELECT CASE WHEN event_id % 10 IN (1, 7) THEN 'changed' ELSE event_type END AS event_type,
       CASE WHEN event_id % 10 = 7 THEN {_L2} ELSE {_L1} END AS created_at,
       CASE WHEN event_id % 10 IN (1, 7) THEN {_L2} ELSE {_L1} END AS updated_at, count(*) AS records
FROM events GROUP BY ALL
UNION ALL
SELECT 'malformed', NULL, NULL, count(*) FROM events WHERE event_id % 10 = 7"""

ORACLE["stream_last_readings"] = """WITH r AS (
  SELECT date_trunc('hour', ts) AS noted_date, 'dev_' || user_id AS device_id, value, event_id FROM events)
SELECT noted_date, device_id, arg_max(value, event_id) AS temperature, max(event_id) AS seq
FROM r WHERE noted_date <= (SELECT max(noted_date) FROM r) - INTERVAL 7 DAY GROUP BY noted_date, device_id"""

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
ORACLE["load_raw_unknown_fields"] = f"""SELECT 'play_' || event_id AS event_id,
       '{{' || CASE WHEN event_id % 10 = 3 THEN '"buffer":{{"a":true,"z":' || CAST(floor(value * 10) AS INTEGER) || '}},' ELSE '' END
           || CASE WHEN event_id % 10 IN (1, 3) THEN '"codec":"' || event_type || '",' ELSE '' END
           || '"position_seconds":' || CAST(floor(value * 10) AS INTEGER)
           || ',"quality":"' || ['144p', '360p', '720p', '1080p'][{_K} % 4 + 1]
           || '","video_id":"vid_' || user_id || '"}}' AS details,
       CASE WHEN event_id % 10 < 5 THEN {_L1} ELSE {_L2} END AS created_at
FROM events"""
