"""SQL oracles of the registered queries, for DuckDB on the same tables.

They are written independently of the Spark side: dates and times come from the timestamps instead
of the generated texts, and percentiles from ``quantile_disc`` over rows repeated by volume.
"""

_BAND = """CASE WHEN {h} BETWEEN 0 AND 5 THEN '凌晨' WHEN {h} BETWEEN 6 AND 8 THEN '早尖峰'
  WHEN {h} BETWEEN 9 AND 15 THEN '日間' WHEN {h} BETWEEN 16 AND 18 THEN '晚尖峰'
  WHEN {h} BETWEEN 19 AND 23 THEN '夜間' ELSE '未分類' END"""

_EVENTS = """e AS (
  SELECT event_id, ts, user_id, event_type, value,
    CAST(regexp_extract(props, '"k": (-?[0-9]+)', 1) AS BIGINT) AS k,
    event_type || '_' || (user_id % 10) AS pair_id,
    CASE WHEN isodow(ts) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type
  FROM events)"""

_CLEAN = f"""{_EVENTS}, c AS (
  SELECT pair_id, CAST(ts AS DATE) AS record_date, CAST(year(ts) AS INTEGER) AS record_year,
    strftime(ts, '%Y-%m') AS record_month, strftime(ts, '%H:%M') AS record_time_minute, day_type,
    {_BAND.format(h="hour(ts)")} AS time_period,
    CAST(user_id % 5 AS VARCHAR) AS vehicle_type, CAST(floor(value) AS INTEGER) AS travel_time_sec,
    k AS volume
  FROM e WHERE floor(value) > 0 AND k > 0)"""

_LANES = """c AS (
  SELECT 'N' || s_nationkey || '_N' || c_nationkey AS pair_id, CAST(o_orderdate AS DATE) AS record_date,
    CASE WHEN isodow(o_orderdate) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
    CASE left(o_orderpriority, 1) WHEN '1' THEN '凌晨' WHEN '2' THEN '早尖峰' WHEN '3' THEN '日間'
      WHEN '4' THEN '晚尖峰' WHEN '5' THEN '夜間' END AS time_period,
    CAST(l_linenumber AS VARCHAR) AS vehicle_type,
    CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS travel_time_sec,
    CAST(l_quantity AS BIGINT) AS volume, s_nationkey AS s, c_nationkey AS d
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
  WHERE date_diff('day', o_orderdate, l_shipdate) > 0 AND CAST(l_quantity AS BIGINT) > 0)"""

# Lanes that have a location: both nations lie in one region.
_KNOWN = """k AS (SELECT a.n_nationkey AS s, b.n_nationkey AS d, n_regionkey AS region
  FROM nation a JOIN nation b USING (n_regionkey))"""

_LEVEL_KEYS = {
    "L1_DAY_TYPE": ("day_type", "'ALL'"),
    "L2_TIME_PERIOD": ("'ALL'", "time_period"),
    "L3_DAY_TYPE_TIME_PERIOD": ("day_type", "time_period"),
    "L4_OVERALL": ("'ALL'", "'ALL'"),
}


def _union(select: str, source: str, group: str) -> str:
    parts = []
    for level, (day, period) in _LEVEL_KEYS.items():
        parts.append(
            f"SELECT '{level}' AS summary_level, pair_id, {day} AS day_type, {period} AS time_period, {select} "
            f"FROM {source} GROUP BY {group.format(day=day, period=period)}"
        )
    return "\nUNION ALL ".join(parts)


def _with_levels(base: str) -> str:
    body = _union(
        "travel_time_sec, CAST(sum(volume) AS BIGINT) AS volume",
        "c",
        "pair_id, {day}, {period}, travel_time_sec",
    )
    return f"{base}, v AS ({body})"


def _with_summary(base: str) -> str:
    body = _union(
        "quantile_disc(travel_time_sec, 0.5) AS p50, quantile_disc(travel_time_sec, 0.95) AS p95",
        "x",
        "pair_id, {day}, {period}",
    )
    return f"""{base},
x AS (SELECT pair_id, day_type, time_period, travel_time_sec FROM c, range(volume)),
q AS ({body}),
s AS (
  SELECT summary_level, pair_id, day_type, time_period, p50 AS p50_travel_time_sec,
    p95 AS p95_travel_time_sec, p95 - p50 AS buffer_time_sec,
    CAST(p95 - p50 AS DOUBLE) / p50 AS buffer_index,
    CASE WHEN CAST(p95 - p50 AS DOUBLE) / p50 < 0.25 THEN '穩定'
      WHEN CAST(p95 - p50 AS DOUBLE) / p50 < 0.5 THEN '普通'
      WHEN CAST(p95 - p50 AS DOUBLE) / p50 < 1 THEN '不穩定' ELSE '高風險' END AS reliability_level
  FROM q)"""


_EVENT_LEVELS = _with_levels(_CLEAN)
_EVENT_SUMMARY = _with_summary(_CLEAN)
_LANE_LEVELS = _with_levels(_LANES)
_LANE_SUMMARY = _with_summary(_LANES)

_LOCATIONS = """loc AS (
  SELECT pair_id, 'Road ' || pair_id AS pair_roadname, 'G' || a AS start_gantry_id,
    'Start ' || a AS start_roadname, CAST(NULL AS VARCHAR) AS start_link_id,
    CAST(120 + a * 0.25 AS DOUBLE) AS start_longitude, CAST(22 + a * 0.125 AS DOUBLE) AS start_latitude,
    'G' || b AS end_gantry_id, 'End ' || b AS end_roadname, CAST(NULL AS VARCHAR) AS end_link_id,
    CAST(120 + b * 0.25 AS DOUBLE) AS end_longitude, CAST(22 + b * 0.125 AS DOUBLE) AS end_latitude,
    CAST(a + b AS DOUBLE) AS distance_km, CASE WHEN a > b THEN 'North' ELSE 'South' END AS direction
  FROM (SELECT DISTINCT pair_id, length(event_type) AS a, user_id % 10 AS b FROM e))"""

_SPLIT = """SELECT CAST(year(ts) AS INTEGER) AS year, pair_id, strftime(ts, '%Y/%-m/%-d') AS date,
  strftime(ts, '%H:%M') AS time, CAST(user_id % 5 AS VARCHAR) AS vehicle_type,
  CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS travel_time_sec, CAST(k AS VARCHAR) AS volume
FROM e WHERE k NOT IN (0, 1)"""

_HISTOGRAM = """SELECT pair_id, day_type, time_period, 'ALL' AS vehicle_type_group, travel_time_sec,
  CAST(sum(volume) AS BIGINT) AS total_volume FROM c {where}
GROUP BY pair_id, day_type, time_period, travel_time_sec"""

_FILES = """f AS (
  SELECT event_id, pair_id, event_type, k, value, user_id, ts,
    '/split/' || pair_id || '/' || strftime(ts, '%Y%m%d') || '.csv' AS source_file FROM e),
g AS (
  SELECT pair_id, source_file, count(*) AS n, bool_or(event_type = 'purchase' AND k = 0) AS short,
    bool_or(event_type = 'signup' AND isodow(ts) >= 6) AS late_header,
    bool_or(event_type = 'error' AND user_id % 10 = 3) AS decimal_time
  FROM f GROUP BY pair_id, source_file),
j AS (
  SELECT pair_id, source_file, n, CASE WHEN short THEN 'not five columns'
    WHEN late_header THEN 'header after the first row' WHEN decimal_time THEN 'wrong type' END AS reason
  FROM g)"""

_EVENT_TARGET = """CASE pair_id WHEN 'click_0' THEN 'click_2' WHEN 'click_1' THEN 'click_2'
  WHEN 'view_2' THEN 'view_3' WHEN 'view_1' THEN 'view_2' WHEN 'purchase_0' THEN 'purchase_new'
  ELSE pair_id END"""

_NOISY = """n AS (
  SELECT CAST(ts AS DATE) AS cal_date, CASE WHEN event_type = 'signup' OR isodow(ts) >= 6
    THEN 'Weekend' ELSE 'Weekday' END AS t
  FROM events WHERE event_type <> 'error' AND isodow(ts) < 7)"""

_DURATION = """CASE WHEN {x} < 60 THEN {x} || ' 秒' WHEN {x} % 60 = 0 THEN ({x} // 60) || ' 分'
  ELSE ({x} // 60) || ' 分 ' || ({x} % 60) || ' 秒' END"""

_MINUTES = ", ".join(
    f"round({c}_sec / 60.0::DOUBLE, 2) AS {c}_min" for c in ("p50_travel_time", "p95_travel_time", "buffer_time")
)


def _levels(base: str, level: str | None = None) -> str:
    return f"WITH {base} SELECT * FROM v" + (f" WHERE summary_level = '{level}'" if level else "")


def _norm_time() -> str:
    return """SELECT event_id,
  CAST(CASE WHEN event_id % 7 < 5 THEN hour(ts) END AS INTEGER) AS clock_hour,
  CAST(CASE WHEN event_id % 7 < 4 THEN minute(ts) WHEN event_id % 7 < 6 THEN 0 END AS INTEGER) AS clock_minute,
  CASE WHEN event_id % 7 < 4 THEN strftime(ts, '%H:%M') WHEN event_id % 7 = 4 THEN strftime(ts, '%H:00')
    WHEN event_id % 7 = 5 THEN '00' ELSE '' END AS record_time_minute
FROM events"""


def _feed_files() -> str:
    return """WITH p AS (
  SELECT event_type, isodow(ts) >= 6 AS weekend, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%H') AS hour,
    CASE WHEN event_type = 'click' THEN 'tdcs_m04a_' || strftime(ts, '%Y%m%d_%H%M') || '.CSV'
      ELSE 'TDCS_M04A_' || strftime(ts, '%Y%m%d_%H%M') || '.csv' END AS name
  FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-26'),
h AS (
  SELECT DISTINCT strftime(ts, '%Y%m%d') AS day FROM events
  WHERE isodow(ts) < 6 AND event_type NOT IN ('error', 'signup'))
SELECT DISTINCT '/feed/' || day || '/' || hour || '/' || name AS path FROM p
WHERE NOT weekend AND event_type IN ('click', 'view')
UNION SELECT '/feed/' || day || '/' || name FROM p
WHERE (weekend OR event_type = 'error') AND event_type <> 'purchase' AND day NOT IN (SELECT day FROM h)"""


def _quality() -> str:
    zero = [
        *(("null_or_blank", c) for c in ("pair_id", "record_date", "vehicle_type", "travel_time_sec", "volume")),
        ("location_duplicates", "pairs"),
        ("missing_locations", "pairs"),
        ("null_coordinates", "rows"),
        ("p95_below_p50", "rows"),
        *(("rollup_difference", level) for level in _LEVEL_KEYS),
    ]
    values = ", ".join(f"('{check}', '{scope}', CAST(0 AS BIGINT))" for check, scope in zero)
    cells = {"L1_DAY_TYPE": 2, "L2_TIME_PERIOD": 5, "L3_DAY_TYPE_TIME_PERIOD": 10, "L4_OVERALL": 1}
    short = " ".join(f"WHEN '{level}' THEN {n}" for level, n in cells.items())
    return f"""WITH {_EVENT_SUMMARY}, {_NOISY},
d AS (SELECT count(*) - 1 AS extra FROM c GROUP BY pair_id, record_date, record_time_minute, vehicle_type)
SELECT 'uncovered_dates' AS "check", 'rows' AS scope, count(*) AS bad_rows FROM e
WHERE CAST(ts AS DATE) NOT IN (SELECT cal_date FROM n)
UNION ALL SELECT 'calendar_conflicts', 'dates', count(*) FROM
  (SELECT cal_date FROM n GROUP BY cal_date HAVING count(DISTINCT t) > 1)
UNION ALL SELECT 'duplicate_observations', 'rows', CAST(sum(extra) AS BIGINT) FROM d
UNION ALL SELECT 'level_shortfall', summary_level,
  CAST((CASE summary_level {short} END) * (SELECT count(DISTINCT pair_id) FROM c) - count(*) AS BIGINT)
FROM s GROUP BY summary_level
UNION ALL SELECT * FROM (VALUES {values})"""


def _dirty_quality() -> str:
    blank = {"pair_id": "event_id % 101 = 0 OR event_id % 103 = 0", "record_date": "event_id % 107 = 0", "vehicle_type": "event_id % 109 = 0",
             "travel_time_sec": "event_id % 113 = 0", "volume": "event_id % 127 = 0"}
    blanks = " UNION ALL ".join(f"SELECT 'null_or_blank' AS \"check\", '{c}' AS scope, count(*) AS bad_rows FROM e WHERE {test}" for c, test in blank.items())
    cells = {"L1_DAY_TYPE": 2, "L2_TIME_PERIOD": 5, "L3_DAY_TYPE_TIME_PERIOD": 10, "L4_OVERALL": 1}
    kept = {level: "pair_id NOT LIKE 'purchase%'" if level == "L4_OVERALL" else "true" for level in cells}
    short = " UNION ALL ".join(
        f"SELECT 'level_shortfall', '{level}', {n} * (SELECT count(DISTINCT pair_id) FROM c) - (SELECT count(*) FROM s WHERE summary_level = '{level}' AND {kept[level]})"
        for level, n in cells.items())
    total = {"L1_DAY_TYPE": "2 * sum(volume)", "L2_TIME_PERIOD": "sum(volume) FILTER (pair_id NOT LIKE 'click%')", "L3_DAY_TYPE_TIME_PERIOD": "sum(volume)",
             "L4_OVERALL": "sum(volume + 1)"}
    off = " UNION ALL ".join(
        f"SELECT 'rollup_difference', '{level}', CAST(abs((SELECT {amount} FROM v WHERE summary_level = '{level}') - (SELECT sum(volume) FROM v WHERE summary_level = 'L3_DAY_TYPE_TIME_PERIOD')) AS BIGINT)"
        for level, amount in total.items())
    used = "s.pair_id NOT LIKE 'purchase%' OR s.summary_level <> 'L4_OVERALL'"
    return f"""WITH {_with_levels(_EVENT_SUMMARY)}, {_NOISY},
d AS (SELECT count(*) - 1 AS extra FROM c GROUP BY pair_id, record_date, record_time_minute, vehicle_type)
{blanks}
UNION ALL SELECT 'uncovered_dates', 'rows', count(*) FROM e WHERE event_id % 107 <> 0 AND CAST(ts AS DATE) NOT IN (SELECT cal_date FROM n)
UNION ALL SELECT 'calendar_conflicts', 'dates', count(*) FROM (SELECT cal_date FROM n GROUP BY cal_date HAVING count(DISTINCT t) > 1)
UNION ALL SELECT 'duplicate_observations', 'rows', CAST(sum(extra) AS BIGINT) FROM d
UNION ALL SELECT 'location_duplicates', 'pairs', count(DISTINCT pair_id) FROM e WHERE event_type = 'click'
UNION ALL SELECT 'missing_locations', 'pairs', count(DISTINCT pair_id) FROM s WHERE pair_id LIKE 'error%' AND ({used})
UNION ALL SELECT 'null_coordinates', 'rows', count(*) FROM s WHERE pair_id LIKE 'view%' AND ({used})
UNION ALL SELECT 'p95_below_p50', 'rows', count(*) FROM s WHERE pair_id LIKE 'signup%' AND ({used})
UNION ALL {short} UNION ALL {off}"""


def statements() -> dict[str, str]:
    lane_pairs = f"WITH {_LANES}, {_KNOWN}"
    known_lane = "(s, d) IN (SELECT (s, d) FROM k)"
    half = "strftime(ts, '%Y%m%d') <= '20240115'"
    return {
        "split_parse": f"WITH {_EVENTS} {_SPLIT}",
        "split_year_filter": f"""WITH {_EVENTS} {_SPLIT}
          AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
        "split_metrics": f"""WITH {_EVENTS}, r AS (
            SELECT *, strftime(ts, '%Y%m%d/%H') AS file, k <> 0 AND ts >= TIMESTAMP '2024-01-05' AS fits FROM e)
          SELECT count(DISTINCT file) AS files,
            count(DISTINCT file) - count(DISTINCT CASE WHEN fits THEN file END) AS empty_files,
            count(*) AS rows_read, count(*) FILTER (k = 0) AS rows_unparsed,
            count(*) FILTER (k <> 0 AND NOT fits) AS rows_out_of_range,
            count(*) FILTER (fits AND k = 1) AS rows_without_pair,
            count(*) FILTER (fits AND k <> 1) AS rows_written,
            count(DISTINCT CASE WHEN fits AND k <> 1 THEN pair_id END) AS pairs,
            count(DISTINCT CASE WHEN fits AND k <> 1 THEN pair_id || year(ts) END) AS pair_years
          FROM r""",
        "feed_file_selection": _feed_files(),
        "known_pairs_semi": f"""{lane_pairs} SELECT pair_id, record_date, vehicle_type, travel_time_sec, volume
          FROM c WHERE {known_lane}""",
        "unknown_pairs": f"""{lane_pairs} SELECT pair_id, count(*) AS skipped_rows FROM c
          WHERE NOT {known_lane} GROUP BY pair_id""",
        "pair_reuse": f"""{lane_pairs} SELECT CASE WHEN {known_lane} THEN 'reused' ELSE 'new' END AS status,
            count(DISTINCT pair_id) AS pairs, count(*) AS n_rows FROM c GROUP BY ALL""",
        "remap_pairs": f"WITH {_EVENTS} SELECT event_id, pair_id, CASE pair_id WHEN 'click_9' THEN 'view_9' "
        f"ELSE {_EVENT_TARGET} END AS target_pair_id FROM e",
        "remap_kept_source": f"""WITH {_EVENTS}, m(a, b) AS (VALUES ('click_0', 'click_1'), ('click_0', 'click_2'),
            ('click_1', 'click_2'), ('view_2', 'view_3'), ('view_1', 'view_2'),
            ('purchase_0', 'purchase_new'), ('click_9', 'view_9'))
          SELECT event_id, pair_id, pair_id AS target_pair_id FROM e
          UNION ALL SELECT event_id, pair_id, b FROM e JOIN m ON a = pair_id""",
        "remap_chain": """WITH r AS (
            SELECT s_nationkey AS n, CAST(l_quantity AS BIGINT) AS volume
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
          SELECT 'N' || n AS pair_id, 'N' || CASE WHEN n >= 20 THEN n WHEN n % 5 % 2 = 0 THEN 20 + n % 5
            ELSE n + 5 END AS target_pair_id, count(*) AS n_rows, CAST(sum(volume) AS BIGINT) AS volume
          FROM r GROUP BY n""",
        "remap_dedup": """WITH r AS (
            SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
              CASE WHEN c_nationkey = 8 AND year(o_orderdate) < 1998 THEN 'N8old' ELSE 'N' || c_nationkey END AS origin,
              strftime(o_orderdate, '%Y/%-m/1') AS date, '00:00' AS time,
              CAST(l_linenumber AS VARCHAR) AS vehicle_type,
              CAST(CAST(floor(date_diff('day', o_orderdate, l_shipdate) / 1000.0) AS BIGINT) AS VARCHAR) AS travel_time_sec,
              CAST(CAST(floor(l_quantity / 25) AS BIGINT) AS VARCHAR) AS volume
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
          t AS (SELECT *, CASE origin WHEN 'N0' THEN 'N5' WHEN 'N1' THEN 'N99' WHEN 'N2' THEN 'N12'
              WHEN 'N7' THEN 'N12' WHEN 'N3' THEN 'N8' ELSE origin END AS pair_id FROM r),
          g AS (SELECT year, pair_id, count(DISTINCT origin) AS origins FROM t GROUP BY year, pair_id)
          SELECT DISTINCT year, pair_id, date, time, vehicle_type, travel_time_sec, volume
          FROM t JOIN g USING (year, pair_id) WHERE origins > 1
          UNION ALL SELECT year, pair_id, date, time, vehicle_type, travel_time_sec, volume
          FROM t JOIN g USING (year, pair_id) WHERE origins = 1""",
        "csv_header_reject": f"""WITH {_EVENTS}, {_FILES} SELECT pair_id, source_file,
            CASE WHEN reason IS NULL THEN 'converted' ELSE 'failed' END AS status, reason, n AS data_rows FROM j""",
        "converted_rows": f"""WITH {_EVENTS}, {_FILES}
          SELECT f.pair_id, f.source_file, strftime(ts, '%Y/%-m/%-d') AS "RecordDate",
            strftime(ts, '%H:%M') AS "RecordTime", CAST(user_id % 5 AS SMALLINT) AS "VehicleType",
            CAST(floor(value) AS INTEGER) AS "TravelTime", CAST(k AS INTEGER) AS "Volume"
          FROM f JOIN j USING (pair_id, source_file) WHERE reason IS NULL""",
        "conversion_plan": f"""WITH {_EVENTS}, {_FILES} SELECT DISTINCT pair_id, source_file FROM f
          WHERE NOT {half}""",
        "conversion_metrics": f"""WITH {_EVENTS}, {_FILES},
          a AS (SELECT DISTINCT pair_id, source_file, {half} AS done FROM f)
          SELECT pair_id, count(*) AS files, count(*) FILTER (NOT done AND reason IS NULL) AS converted,
            count(*) FILTER (done) AS skipped, count(*) FILTER (NOT done AND reason IS NOT NULL) AS failed
          FROM a JOIN j USING (pair_id, source_file) GROUP BY pair_id""",
        "norm_date": """SELECT event_id, CASE WHEN event_id % 7 < 6 THEN CAST(ts AS DATE) END AS record_date
          FROM events""",
        "norm_time": _norm_time(),
        "hour_bands": f"""WITH h AS (SELECT CASE WHEN hour(ts) = 0 THEN 24 ELSE hour(ts) END AS h FROM events)
          SELECT CAST(h AS INTEGER) AS hour, {_BAND.format(h="h")} AS time_period, count(*) AS n_rows
          FROM h GROUP BY h""",
        "clean_filter": f"WITH {_CLEAN} SELECT * EXCLUDE (day_type) FROM c",
        "exclude_ids": f"""WITH {_CLEAN} SELECT pair_id, count(*) AS n_rows, CAST(sum(volume) AS BIGINT) AS volume
          FROM c WHERE pair_id NOT IN ('click_3', 'error_0', 'view_7') GROUP BY pair_id""",
        "quality_report_dirty": _dirty_quality(),
        "lookup_route_name_repeated": f"""WITH {_EVENTS} SELECT pair_id, count(*) AS n_rows,
            coalesce('Road ' || (max(event_id) FILTER (user_id % 2 = 0) * 7 % 10), pair_id) AS route_name FROM e GROUP BY pair_id""",
        "exclude_ids_by_table": f"""{lane_pairs} SELECT pair_id, count(*) AS n_rows,
            CAST(sum(volume) AS BIGINT) AS volume FROM c WHERE NOT {known_lane} GROUP BY pair_id""",
        "calendar_dim": f"WITH {_NOISY} SELECT cal_date, min(t) AS day_type FROM n GROUP BY cal_date",
        "calendar_conflicts": f"""WITH {_NOISY} SELECT cal_date, min(t) AS kept_day_type, max(t) AS other_day_type
          FROM n GROUP BY cal_date HAVING count(DISTINCT t) > 1""",
        "clean_join": f"WITH {_CLEAN} SELECT * FROM c",
        "uncovered_dates": """SELECT CAST(l_shipdate AS DATE) AS record_date, count(*) AS lost_rows FROM lineitem
          WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders) GROUP BY 1""",
        "event_volume_histogram": f"WITH {_CLEAN} {_HISTOGRAM.format(where='')}",
        "lane_histogram": f"WITH {_LANES} {_HISTOGRAM.format(where='')}",
        "histogram_exclude_dates": f"WITH {_CLEAN} "
        + _HISTOGRAM.format(where="WHERE record_date NOT IN (DATE '2024-01-01', DATE '2024-01-15')"),
        "level_l1": _levels(_LANE_LEVELS, "L1_DAY_TYPE"),
        "level_l2": _levels(_LANE_LEVELS, "L2_TIME_PERIOD"),
        "level_l3": _levels(_LANE_LEVELS, "L3_DAY_TYPE_TIME_PERIOD"),
        "level_l4": _levels(_LANE_LEVELS, "L4_OVERALL"),
        "levels_union": _levels(_LANE_LEVELS),
        "levels_grouping_sets": _levels(_LANE_LEVELS),
        "levels_expanded": _levels(_LANE_LEVELS),
        "sentinel_rows": f"""WITH {_CLEAN} SELECT pair_id, day_type, 'ALL' AS time_period, travel_time_sec,
            CAST(sum(volume) AS BIGINT) AS volume FROM c WHERE time_period = '夜間'
          GROUP BY pair_id, day_type, travel_time_sec""",
        "running_volume": f"""WITH {_EVENT_LEVELS} SELECT a.*, CAST(sum(b.volume) AS BIGINT) AS cumulative_volume
          FROM v a JOIN v b USING (summary_level, pair_id, day_type, time_period)
          WHERE b.travel_time_sec <= a.travel_time_sec GROUP BY ALL""",
        "total_volume": f"""WITH {_EVENT_LEVELS}, t AS (SELECT summary_level, pair_id, day_type, time_period,
            CAST(sum(volume) AS BIGINT) AS total_volume FROM v GROUP BY ALL)
          SELECT v.*, total_volume FROM v JOIN t USING (summary_level, pair_id, day_type, time_period)""",
        "weighted_p50_p95": f"""WITH {_EVENT_SUMMARY} SELECT summary_level, pair_id, day_type, time_period,
            p50_travel_time_sec, p95_travel_time_sec FROM s""",
        "buffer_index": f"WITH {_EVENT_SUMMARY} SELECT * EXCLUDE (reliability_level) FROM s",
        "grade": f"""WITH {_EVENT_SUMMARY} SELECT summary_level, reliability_level, count(*) AS n_rows
          FROM s GROUP BY summary_level, reliability_level""",
        "reliability_summary": f"WITH {_EVENT_SUMMARY} SELECT * FROM s",
        "lane_summary": f"WITH {_LANE_SUMMARY} SELECT * FROM s",
        "lane_summary_grouping_sets": f"WITH {_LANE_SUMMARY} SELECT * FROM s",
        "lane_summary_union": f"WITH {_LANE_SUMMARY} SELECT * FROM s",
        "level_counts": f"""WITH {_LANES} SELECT 'L1_DAY_TYPE' AS summary_level,
            count(DISTINCT (pair_id, day_type)) AS n_rows FROM c
          UNION ALL SELECT 'L2_TIME_PERIOD', count(DISTINCT (pair_id, time_period)) FROM c
          UNION ALL SELECT 'L3_DAY_TYPE_TIME_PERIOD', count(DISTINCT (pair_id, day_type, time_period)) FROM c
          UNION ALL SELECT 'L4_OVERALL', count(DISTINCT pair_id) FROM c""",
        "invalid_percentiles": f"""WITH {_LANE_SUMMARY} SELECT count(*) AS n_invalid FROM s
          WHERE p95_travel_time_sec < p50_travel_time_sec""",
        "location_dim": f"WITH {_EVENTS}, {_LOCATIONS} SELECT * FROM loc",
        "location_duplicates": f"""WITH {_EVENTS} SELECT pair_id, count(DISTINCT user_id) AS n_rows FROM e
          GROUP BY pair_id HAVING count(DISTINCT user_id) > 1""",
        "location_missing": f"{lane_pairs} SELECT DISTINCT pair_id FROM c WHERE NOT {known_lane}",
        "location_without_coordinates": f"""WITH {_LANE_SUMMARY}, {_KNOWN}, z AS (SELECT DISTINCT pair_id FROM c
            WHERE (s, d) IN (SELECT (s, d) FROM k WHERE region = 0))
          SELECT pair_id, count(*) AS lost_rows FROM s JOIN z USING (pair_id) GROUP BY pair_id""",
        "map_join": f"WITH {_EVENT_SUMMARY}, {_LOCATIONS} SELECT * FROM s JOIN loc USING (pair_id)",
        "map_join_partial": f"""WITH {_LANE_SUMMARY}, {_KNOWN}, z AS (SELECT DISTINCT pair_id, s AS a, d AS b FROM c
            WHERE (s, d) IN (SELECT (s, d) FROM k WHERE region > 0))
          SELECT pair_id, CASE WHEN a > b THEN 'North' ELSE 'South' END AS direction,
            CAST(120 + a * 0.25 AS DOUBLE) AS start_longitude, CAST(22 + b * 0.125 AS DOUBLE) AS end_latitude,
            count(*) AS n_rows FROM s JOIN z USING (pair_id) GROUP BY pair_id, a, b""",
        "geojson_features": f"""WITH {_EVENT_SUMMARY}, {_LOCATIONS} SELECT 'Feature' AS type,
            'LineString' AS geometry_type, * FROM s JOIN loc USING (pair_id)""",
        "bi_export": f"WITH {_LANE_SUMMARY} SELECT *, {_MINUTES} FROM s",
        "lookup_filter": f"""WITH {_EVENT_SUMMARY}, {_LOCATIONS}
          SELECT pair_id, p50_travel_time_sec, p95_travel_time_sec, buffer_time_sec, reliability_level,
            summary_level, day_type, time_period, direction, pair_roadname AS route_name,
            start_longitude, start_latitude, end_longitude, end_latitude
          FROM s JOIN loc USING (pair_id) WHERE summary_level = 'L3_DAY_TYPE_TIME_PERIOD'
            AND day_type = 'Weekday' AND time_period = '早尖峰' AND direction = 'North'""",
        "lookup_level_without_period": f"""WITH {_LANE_SUMMARY} SELECT *, 'South' AS direction FROM s
          WHERE summary_level = 'L1_DAY_TYPE' AND day_type = 'Weekend'""",
        "lookup_route_name": f"""{lane_pairs} SELECT pair_id, count(*) AS n_rows,
            CASE WHEN {known_lane} THEN 'Road ' || pair_id ELSE pair_id END AS route_name FROM c GROUP BY pair_id, s, d""",
        "duration_text": f"""WITH {_LANE_SUMMARY} SELECT summary_level, pair_id, day_type, time_period,
            {_DURATION.format(x="p50_travel_time_sec")} AS p50_text,
            {_DURATION.format(x="p95_travel_time_sec")} AS p95_text,
            {_DURATION.format(x="buffer_time_sec")} AS buffer_text FROM s""",
        "grade_colour": f"""WITH {_EVENT_SUMMARY} SELECT summary_level, pair_id, day_type, time_period,
            CASE reliability_level WHEN '穩定' THEN '#22C55E' WHEN '普通' THEN '#F59E0B'
              WHEN '不穩定' THEN '#F97316' ELSE '#EF4444' END AS colour FROM s""",
        "quality_report": _quality(),
    }
