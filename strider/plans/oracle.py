"""DuckDB SQL twins of the registered queries (same column names and values)."""

from __future__ import annotations

import math

from strider.plans import queries as Q
from strider.plans.tree_sql import nodes_sql, sweep_sql
from strider.plans.views_sql import (
    CLEAN_MOTION_VIEW, LABEL_VIEW, LOCATION_VIEW, MOTION_VIEW, POI_VIEW,
    activity_sql, duration_text_sql, percentage_sql, slot_sql, slot_text_sql, with_views,
)

ORACLE: dict[str, str] = {}


def _composition_sql(source: str, by: list[str]) -> str:
    keys = ", ".join(by + ["CoarseLabel"])
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    return f"""SELECT {keys}, Count, TotalInstances,
       {duration_text_sql('Count * 10')} AS TotalTime,
       {activity_sql('CoarseLabel')} AS Activity,
       {percentage_sql('Count', 'TotalInstances')} AS Percentage
  FROM (SELECT {keys}, count(CoarseLabel) AS Count,
               sum(count(*)) OVER ({part}) AS TotalInstances
          FROM {source} GROUP BY {keys}) g"""


ORACLE["dataset_activity_stats"] = with_views(LABEL_VIEW) + f"""
SELECT Activity, TotalTime, Percentage FROM ({_composition_sql('label_view', [])}) s"""

ORACLE["daily_activity_stats"] = with_views(LABEL_VIEW) + f"""
SELECT date, Activity, TotalTime, Percentage
  FROM ({_composition_sql('(SELECT * FROM label_view WHERE date IS NOT NULL)', ['date'])}) s"""

ORACLE["range_activity_stats"] = with_views(LABEL_VIEW) + f"""
SELECT Activity, TotalTime, Percentage
  FROM ({_composition_sql(f'(SELECT * FROM label_view WHERE Time BETWEEN {Q.RANGE_START_MS} AND 1704931199999)', [])}) s"""

ORACLE["dataset_total_time"] = with_views(LABEL_VIEW) + f"""
SELECT TotalCount, TotalCount * 10 AS TotalTimeMs,
       {duration_text_sql('TotalCount * 10', 'python')} AS TotalTime
  FROM (SELECT count(*) AS TotalCount FROM label_view) t WHERE TotalCount > 0"""

ORACLE["daily_stats_for_date"] = with_views(LABEL_VIEW) + f"""
SELECT date, Activity, TotalTime, Percentage
  FROM ({_composition_sql('(SELECT * FROM label_view WHERE date IS NOT NULL)', ['date'])}) s
 WHERE date = '{Q.SELECTED_DAY}'"""

ORACLE["distinct_dates"] = with_views(LABEL_VIEW) + """
SELECT DISTINCT date FROM label_view WHERE date IS NOT NULL"""

ORACLE["expectation_checks"] = with_views(LABEL_VIEW, MOTION_VIEW) + f"""
SELECT 'transportation_types' AS "check", 'CoarseLabel' AS "column", CAST({Q.EXPECTED_LABELS} AS BIGINT) AS expected,
       count(DISTINCT CoarseLabel) AS actual, count(DISTINCT CoarseLabel) = {Q.EXPECTED_LABELS} AS passed
  FROM label_view
UNION ALL
SELECT 'dates', 'date', CAST({Q.EXPECTED_DAYS} AS BIGINT), count(DISTINCT date), count(DISTINCT date) = {Q.EXPECTED_DAYS}
  FROM motion_view"""

ORACLE["clean_motion"] = with_views(MOTION_VIEW, CLEAN_MOTION_VIEW) + """
SELECT * FROM clean_motion"""

_STD_INPUT = """CASE event_id % 4
         WHEN 0 THEN date
         WHEN 1 THEN substr(date, 1, 2) || '-' || substr(date, 3, 2) || '-' || substr(date, 5, 2)
         WHEN 2 THEN strftime(strptime(date, '%d%m%y'), '%m/%d/%Y')
         ELSE date || '7' END"""

ORACLE["standardize_dates"] = with_views(LABEL_VIEW) + f"""
SELECT event_id, date_in,
       CASE WHEN length(d) = 6
            THEN substr(d, 3, 2) || '/' || substr(d, 1, 2) || '/' ||
                 CASE WHEN CAST(substr(d, 5, 2) AS INTEGER) < 50 THEN '20' ELSE '19' END || substr(d, 5, 2)
            ELSE date_in END AS date
  FROM (SELECT event_id, date_in, regexp_replace(date_in, '[^0-9]', '', 'g') AS d
          FROM (SELECT event_id, {_STD_INPUT} AS date_in FROM label_view) i) s"""

ORACLE["parse_sensor_lines"] = with_views(LOCATION_VIEW) + """
SELECT event_id, date, user_id, Time, Ignore1, Ignore2, Accuracy, Latitude, Longitude, Altitude
  FROM location_view"""

ORACLE["top_rows"] = with_views(LOCATION_VIEW) + f"""
SELECT * FROM location_view ORDER BY Time, event_id LIMIT {Q.TOP_ROWS}"""

ORACLE["label_motion_join"] = with_views(LABEL_VIEW, MOTION_VIEW, CLEAN_MOTION_VIEW) + """
SELECT l.date, l.Time, l.CoarseLabel, l.event_id,
       m.AccelerationX, m.AccelerationY, m.AccelerationZ,
       m.MagnetometerX, m.MagnetometerY, m.MagnetometerZ,
       m.LinearAccelerationX, m.LinearAccelerationY, m.LinearAccelerationZ,
       m.event_id AS motion_event_id
  FROM label_view l JOIN clean_motion m ON l.date = m.date AND l.Time = m.Time"""

ORACLE["motion_magnitudes"] = with_views(LABEL_VIEW, MOTION_VIEW, CLEAN_MOTION_VIEW) + """
SELECT l.date, l.Time, l.event_id, m.event_id AS motion_event_id, l.CoarseLabel,
       sqrt(m.AccelerationX * m.AccelerationX + m.AccelerationY * m.AccelerationY + m.AccelerationZ * m.AccelerationZ) AS AccelerationMagnitude,
       sqrt(m.MagnetometerX * m.MagnetometerX + m.MagnetometerY * m.MagnetometerY + m.MagnetometerZ * m.MagnetometerZ) AS MagnetometerMagnitude,
       sqrt(m.LinearAccelerationX * m.LinearAccelerationX + m.LinearAccelerationY * m.LinearAccelerationY + m.LinearAccelerationZ * m.LinearAccelerationZ) AS LinearAccelerationMagnitude
  FROM label_view l JOIN clean_motion m ON l.date = m.date AND l.Time = m.Time"""

ORACLE["half_hour_features"] = with_views(LOCATION_VIEW) + f"""
SELECT event_id, Time,
       CAST(hour(epoch_ms(Time)) AS INTEGER) AS hour,
       CAST(minute(epoch_ms(Time)) AS INTEGER) AS minute,
       {slot_sql('Time')} AS half_hour_interval,
       CAST(isodow(epoch_ms(Time)) AS INTEGER) AS day_of_week
  FROM location_view"""

ORACLE["ordinal_date"] = with_views(LABEL_VIEW) + """
SELECT date,
       strftime(d, '%B') || ' ' || CAST(day(d) AS VARCHAR) ||
       CASE WHEN day(d) BETWEEN 11 AND 13 THEN 'th'
            WHEN day(d) % 10 = 1 THEN 'st' WHEN day(d) % 10 = 2 THEN 'nd'
            WHEN day(d) % 10 = 3 THEN 'rd' ELSE 'th' END ||
       ', ' || CAST(year(d) AS VARCHAR) AS formatted_date
  FROM (SELECT DISTINCT date, CAST(strptime(date, '%d%m%y') AS DATE) AS d
          FROM label_view WHERE date IS NOT NULL) t"""

_ANOM = ["AccelerationX", "AccelerationY", "AccelerationZ", "GyroscopeX", "GyroscopeY",
         "GyroscopeZ", "GravityX", "GravityY", "GravityZ", "Pressure"]

ORACLE["scaled_features"] = with_views(MOTION_VIEW, CLEAN_MOTION_VIEW) + "SELECT event_id, " + ", ".join(
    f"round(CASE WHEN stddev_samp({c}) OVER () = 0 THEN 0.0 ELSE {c} / stddev_samp({c}) OVER () END, 6) AS {c}"
    for c in _ANOM) + " FROM clean_motion"

ORACLE["location_zscores"] = with_views(LOCATION_VIEW) + """
SELECT event_id,
       round((Latitude - avg(Latitude) OVER ()) / stddev_pop(Latitude) OVER (), 6) AS Latitude_z,
       round((Longitude - avg(Longitude) OVER ()) / stddev_pop(Longitude) OVER (), 6) AS Longitude_z
  FROM location_view"""

_LAGS = ", ".join(
    f"lag({v}, {j}) OVER w AS {v}_lag{j}" for j in range(1, Q.SEQUENCE_LENGTH + 1)
    for v in ("Latitude", "Longitude"))

ORACLE["location_sequences"] = with_views(LOCATION_VIEW) + f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT user_id, event_id, Time, Latitude, Longitude, {_LAGS},
         row_number() OVER w AS rn
    FROM location_view
  WINDOW w AS (PARTITION BY user_id ORDER BY Time, event_id)) s
 WHERE rn > {Q.SEQUENCE_LENGTH}"""

ORACLE["chronological_split"] = with_views(LOCATION_VIEW) + f"""
SELECT event_id,
       CASE WHEN row_number() OVER (ORDER BY Time, event_id) <= floor({Q.TRAIN_FRACTION} * count(*) OVER ())
            THEN 'train' ELSE 'test' END AS split
  FROM location_view"""

ORACLE["histogram_50"] = f"""
WITH v AS (SELECT value AS x FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
mm AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
b AS (SELECT CAST(CASE WHEN hi - lo = 0 THEN 1
                       ELSE least(floor((x - lo) / (hi - lo) * {Q.HISTOGRAM_BINS}) + 1, {Q.HISTOGRAM_BINS}) END AS INTEGER) AS bin
        FROM v, mm),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(g.bin AS INTEGER) AS bin,
       round(lo + (g.bin - 1) * (hi - lo) / {Q.HISTOGRAM_BINS}, 6) AS bin_start,
       round(lo + g.bin * (hi - lo) / {Q.HISTOGRAM_BINS}, 6) AS bin_end,
       coalesce(c.n, 0) AS count
  FROM range(1, {Q.HISTOGRAM_BINS} + 1) g(bin) CROSS JOIN mm LEFT JOIN c ON c.bin = g.bin"""

ORACLE["contamination_cut"] = f"""
WITH t AS (SELECT quantile_cont(value, {Q.CONTAMINATION}) AS thr FROM events)
SELECT round(thr, 6) AS threshold,
       (SELECT count(*) FROM events) AS n_rows,
       (SELECT count(*) FROM events, t WHERE value < thr) AS n_below
  FROM t"""

_ROUTE = """route AS (
  SELECT Latitude AS lat, Longitude AS lng, slot AS half_hour_interval
    FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY Time DESC, event_id DESC) AS rn
            FROM (SELECT *, {slot} AS slot FROM location_view {where}) s) r
   WHERE rn = 1)"""


def _route(where: str = "") -> str:
    return _ROUTE.format(slot=slot_sql("Time"), where=where)


ORACLE["predicted_route"] = with_views(LOCATION_VIEW, _route()) + f"""
SELECT lat, lng, half_hour_interval, {slot_text_sql('half_hour_interval')} AS time
  FROM route WHERE lat < 50.9"""

ORACLE["route_json"] = with_views(LOCATION_VIEW, _route()) + f"""
SELECT half_hour_interval,
       CAST(to_json(struct_pack(lat := lat, lng := lng, half_hour_interval := half_hour_interval,
                                time := {slot_text_sql('half_hour_interval')})) AS VARCHAR) AS location_json
  FROM route"""

_REQ = ", ".join(f"({s})" for s in Q.LOOKUP_SLOTS)
ORACLE["next_location_lookup"] = with_views(LOCATION_VIEW, _route()) + f"""
SELECT coalesce(r.lat, CAST(50.8231 AS DOUBLE)) AS lat, coalesce(r.lng, CAST(-0.1383 AS DOUBLE)) AS lng,
       req.half_hour_interval,
       CASE WHEN r.lat IS NULL THEN 'N/A' ELSE {slot_text_sql('req.half_hour_interval')} END AS time
  FROM (SELECT CAST(s AS INTEGER) AS half_hour_interval FROM (VALUES {_REQ}) v(s)) req
  LEFT JOIN route r ON r.half_hour_interval = req.half_hour_interval"""

ORACLE["half_hour_grid"] = with_views(LOCATION_VIEW, _route()) + f"""
SELECT lat, lng, half_hour_interval, {slot_text_sql('half_hour_interval')} AS time FROM route
UNION ALL
SELECT CAST(50.8231 AS DOUBLE) + i * CAST(0.01 AS DOUBLE), CAST(-0.1383 AS DOUBLE) + i * CAST(0.01 AS DOUBLE),
       CAST(i AS INTEGER), {slot_text_sql('i')}
  FROM range(48) t(i) WHERE NOT EXISTS (SELECT 1 FROM route)"""

ORACLE["whole_route_json"] = with_views(LOCATION_VIEW, _route()) + f"""
SELECT coalesce(CAST(to_json(list(struct_pack(lat := lat, lng := lng, half_hour_interval := half_hour_interval,
                                time := {slot_text_sql('half_hour_interval')}) ORDER BY half_hour_interval)) AS VARCHAR), '[]') AS locations_json
  FROM route"""

# The previous position of the user stands as the prediction of every row in the last fifth of the sequences.
ORACLE["predictions_to_next_stop"] = with_views(LOCATION_VIEW) + f"""
, seq AS (
  SELECT event_id, Time, lag(Latitude) OVER w AS lat, lag(Longitude) OVER w AS lng, row_number() OVER w AS rn
    FROM location_view WINDOW w AS (PARTITION BY user_id ORDER BY Time, event_id)),
full_seq AS (SELECT *, row_number() OVER (ORDER BY Time, event_id) AS at, count(*) OVER () AS n FROM seq WHERE rn > 10),
route AS (
  SELECT lat, lng, slot AS half_hour_interval
    FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY Time DESC, event_id DESC) AS last
            FROM (SELECT *, {slot_sql('Time')} AS slot FROM full_seq WHERE at > floor(0.8 * n)) t) r
   WHERE last = 1 AND lat < 50.9)
SELECT round(coalesce(r.lat, CAST(50.8231 AS DOUBLE)), 9) AS lat, round(coalesce(r.lng, CAST(-0.1383 AS DOUBLE)), 9) AS lng,
       req.half_hour_interval,
       CASE WHEN r.lat IS NULL THEN 'N/A' ELSE {slot_text_sql('req.half_hour_interval')} END AS time
  FROM (SELECT CAST(s AS INTEGER) AS half_hour_interval FROM (VALUES (0), (17), (99)) v(s)) req
  LEFT JOIN route r ON r.half_hour_interval = req.half_hour_interval"""

_RAD = "CAST('0.017453292519943295' AS DOUBLE)"
ORACLE["nearby_top_k"] = with_views(LOCATION_VIEW, POI_VIEW) + f"""
, o AS (SELECT DISTINCT Latitude AS lat, Longitude AS lng FROM location_view),
pr AS (
  SELECT o.lat AS origin_lat, o.lng AS origin_lng, p.poi_id, p.name,
         round(CAST(12742000.0 AS DOUBLE) * asin(sqrt(
               sin((p.lat - o.lat) * {_RAD} / 2) * sin((p.lat - o.lat) * {_RAD} / 2)
             + cos(o.lat * {_RAD}) * cos(p.lat * {_RAD})
               * (sin((p.lng - o.lng) * {_RAD} / 2) * sin((p.lng - o.lng) * {_RAD} / 2)))), 2) AS distance_m
    FROM o, poi_view p)
SELECT origin_lat, origin_lng, CAST(rank AS INTEGER) AS rank, poi_id, name, distance_m
  FROM (SELECT *, row_number() OVER (PARTITION BY origin_lat, origin_lng ORDER BY distance_m, poi_id) AS rank
          FROM pr WHERE distance_m <= 1500) r
 WHERE rank <= 10"""

ORACLE["classification_metrics"] = with_views(LABEL_VIEW) + """
, p AS (SELECT CAST(CoarseLabel AS DOUBLE) AS l,
               CAST((CoarseLabel + CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END) % 9 AS DOUBLE) AS p
          FROM label_view),
cm AS (SELECT l, p, count(*) AS n FROM p GROUP BY l, p),
bl AS (SELECT l, sum(n) AS n_l, sum(CASE WHEN l = p THEN n ELSE 0 END) AS tp FROM cm GROUP BY l),
bp AS (SELECT p AS l, sum(n) AS n_p FROM cm GROUP BY p),
per AS (SELECT bl.l, bl.n_l, bl.tp, bp.n_p FROM bl LEFT JOIN bp ON bl.l = bp.l)
SELECT round(sum(tp) / sum(n_l), 6) AS accuracy,
       round(sum(CASE WHEN n_p > 0 THEN tp / n_p ELSE 0.0 END * n_l) / sum(n_l), 6) AS weighted_precision,
       round(sum(tp / n_l * n_l) / sum(n_l), 6) AS weighted_recall
  FROM per"""

ORACLE["vote_fold"] = """
WITH a AS (
  SELECT event_id,
         [CAST(user_id % 9 AS DOUBLE), CAST(CAST(props->>'$.k' AS INTEGER) % 9 AS DOUBLE),
          CAST(event_id % 9 AS DOUBLE), CAST(user_id % 9 AS DOUBLE), CAST(event_id % 3 AS DOUBLE)] AS v
    FROM events),
u AS (SELECT event_id, unnest(v) AS x FROM a),
c AS (SELECT event_id, x, count(*) AS n FROM u GROUP BY event_id, x),
b AS (SELECT event_id, x FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY n DESC, x ASC) AS rn
                                 FROM c) r WHERE rn = 1)
SELECT a.event_id, b.x AS final_prediction,
       ((((CAST(0.0 AS DOUBLE) + v[1]) + v[2]) + v[3]) + v[4]) + v[5] AS prediction_sum
  FROM a JOIN b ON a.event_id = b.event_id"""

# Uniform number of a row: first 13 hex digits of the MD5 of date:Time:seed, over 16**13.
_UNIFORM = "(CAST('0x' || substr(md5(date || ':' || Time || ':{seed}'), 1, 13) AS BIGINT) / 4503599627370496.0)"

ORACLE["train_test_split"] = with_views(LABEL_VIEW) + f"""
SELECT event_id, date, Time, CASE WHEN {_UNIFORM.format(seed=1234)} < 0.8 THEN 'train' ELSE 'test' END AS split
  FROM label_view"""


def _poisson_sql(u: str) -> str:
    """Poisson(1) count whose cumulative probability first exceeds ``u``."""
    bounds = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(17)]
    return f"CAST(CASE {' '.join(f'WHEN {u} < {b!r} THEN {k}' for k, b in enumerate(bounds))} ELSE 17 END AS DOUBLE)"


ORACLE["bootstrap_weights"] = with_views(LABEL_VIEW) + f"""
SELECT event_id, {', '.join(f'{_poisson_sql(_UNIFORM.format(seed=i))} AS w{i}' for i in range(5))}
  FROM label_view"""

_FLAGGED = "(SELECT *, CASE WHEN event_id % 20 = 3 THEN -1 ELSE 1 END AS prediction FROM clean_motion)"
ORACLE["anomalies_only"] = with_views(MOTION_VIEW, CLEAN_MOTION_VIEW) + f"""
SELECT event_id, date, Time, Pressure, prediction FROM {_FLAGGED} f WHERE prediction = -1"""

_SUMMARY = ["AccelerationX", "AccelerationY", "AccelerationZ", "GyroscopeX", "GyroscopeY", "GyroscopeZ",
            "GravityX", "GravityY", "GravityZ", "Pressure"]
ORACLE["feature_summary"] = with_views(MOTION_VIEW, CLEAN_MOTION_VIEW) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, prediction, count(*) AS rows, min({c}) AS min, max({c}) AS max, "
    f"round(avg({c}), 6) AS mean FROM {_FLAGGED} f GROUP BY prediction" for c in _SUMMARY)

# 320 pixel columns.
ORACLE["feature_series"] = with_views(MOTION_VIEW, CLEAN_MOTION_VIEW) + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, prediction, CAST(pixel AS INTEGER) AS pixel,
       first({c} ORDER BY Time, event_id) AS first, last({c} ORDER BY Time, event_id) AS last,
       min({c}) AS min, max({c}) AS max, count({c}) AS rows
  FROM (SELECT *, (Time - (SELECT min(Time) FROM {_FLAGGED} a)) * 320
                  // ((SELECT max(Time) - min(Time) FROM {_FLAGGED} b) + 1) AS pixel FROM {_FLAGGED} f) g
 GROUP BY prediction, pixel""" for c in _SUMMARY)

# The tree of depth 10 level by level; cut at 1 and 5 for the sweep.
ORACLE["histogram_tree_nodes"] = nodes_sql(10)
ORACLE["histogram_tree_sweep"] = sweep_sql((1, 5, 10))
ORACLE["metrics_for_depth"] = f"SELECT * FROM ({sweep_sql((1, 5, 10))}) s WHERE Depth = 5"

# 100 trees, 256 rows each, seed 42: two ranks out of every hash.
ORACLE["forest_sample"] = with_views(MOTION_VIEW, CLEAN_MOTION_VIEW) + """
SELECT tree_id, CAST(position AS INTEGER) AS position, event_id
  FROM (SELECT event_id, tree_id, row_number() OVER (
                 PARTITION BY tree_id
                 ORDER BY substr(md5(event_id || ':42:' || (tree_id // 2)), 1 + 16 * (tree_id % 2), 16), event_id) AS position
          FROM clean_motion, (SELECT CAST(t AS INTEGER) AS tree_id FROM range(100) r(t)) trees) s
 WHERE position <= 256"""
