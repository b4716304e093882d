"""DuckDB text of the derived sensor views (mirror of ``strider.sources.bindings``)."""

from __future__ import annotations

_BASE = """SELECT event_id,
       strftime(ts, '%d%m%y') AS date,
       epoch_us(ts) // 1000 AS Time,
       user_id,
       user_id % 9 AS _c,
       value AS _v,
       CAST(props->>'$.k' AS INTEGER) AS _k
  FROM events"""

LABEL_VIEW = f"""label_view AS (
  SELECT event_id, date, Time,
         CAST(_c AS INTEGER) AS CoarseLabel,
         CAST(event_id % 19 AS INTEGER) AS FineLabel,
         CAST(event_id % 5 AS INTEGER) AS RoadLabel,
         CAST(event_id % 6 AS INTEGER) AS TrafficLabel,
         CAST(event_id % 2 AS INTEGER) AS TunnelsLabel,
         CAST(event_id % 4 AS INTEGER) AS SocialLabel,
         CAST(event_id % 3 AS INTEGER) AS FoodLabel
    FROM ({_BASE}) b)"""

MOTION_VIEW = f"""motion_view AS (
  SELECT event_id, date, Time,
         _c + _k / 100 AS AccelerationX,
         (event_id % 97) / 10 AS AccelerationY,
         _v / 100 AS AccelerationZ,
         (event_id % 17) / 10 AS GyroscopeX,
         (event_id % 19) / 10 AS GyroscopeY,
         _v / 50 AS GyroscopeZ,
         _c * 2 + (event_id % 13) / 10 AS MagnetometerX,
         (event_id % 31) / 10 AS MagnetometerY,
         _k / 10 AS MagnetometerZ,
         CAST(1.0 AS DOUBLE) AS OrientationW,
         CAST(0.0 AS DOUBLE) AS OrientationX,
         CAST(0.0 AS DOUBLE) AS OrientationY,
         CAST(0.0 AS DOUBLE) AS OrientationZ,
         (event_id % 3) / 10 AS GravityX,
         (event_id % 5) / 10 AS GravityY,
         9 + _k / 100 AS GravityZ,
         (event_id % 7) + _c / 10 AS LinearAccelerationX,
         (event_id % 11) / 10 AS LinearAccelerationY,
         _k / 50 AS LinearAccelerationZ,
         CASE WHEN event_id % 50 = 0 THEN CAST(NULL AS DOUBLE)
              WHEN event_id % 50 = 1 THEN CAST('NaN' AS DOUBLE)
              ELSE 1000 + (event_id % 23) / 10 END AS Pressure,
         CAST(0.0 AS DOUBLE) AS Altitude,
         CASE WHEN event_id % 50 = 2 THEN CAST(NULL AS DOUBLE)
              ELSE 20 + (event_id % 5) / 10 END AS Temperature
    FROM ({_BASE}) b)"""

LOCATION_VIEW = f"""location_view AS (
  SELECT event_id, date, Time, user_id,
         CAST(0.0 AS DOUBLE) AS Ignore1,
         CAST(0.0 AS DOUBLE) AS Ignore2,
         CAST(event_id % 40 + 1 AS DOUBLE) AS Accuracy,
         CAST(50.80 AS DOUBLE) + (user_id % 10) / 100 + _k / 10000 AS Latitude,
         CAST(-0.20 AS DOUBLE) + (user_id % 15) / 100 + _k / 10000 AS Longitude,
         _v AS Altitude
    FROM ({_BASE}) b)"""

POI_VIEW = """poi_view AS (
  SELECT s_suppkey AS poi_id, s_name AS name,
         CAST(50.80 AS DOUBLE) + (s_suppkey % 20) / 200 AS lat,
         CAST(-0.20 AS DOUBLE) + (s_suppkey % 30) / 200 AS lng
    FROM supplier)"""

# Cleaned motion: no null / NaN in any column, then Altitude and Temperature dropped.
CLEAN_MOTION_VIEW = """clean_motion AS (
  SELECT * EXCLUDE (Altitude, Temperature) FROM motion_view
   WHERE Pressure IS NOT NULL AND NOT isnan(Pressure)
     AND Temperature IS NOT NULL AND NOT isnan(Temperature)
     AND AccelerationX IS NOT NULL AND AccelerationY IS NOT NULL AND AccelerationZ IS NOT NULL
     AND GyroscopeX IS NOT NULL AND GyroscopeY IS NOT NULL AND GyroscopeZ IS NOT NULL
     AND MagnetometerX IS NOT NULL AND MagnetometerY IS NOT NULL AND MagnetometerZ IS NOT NULL
     AND GravityX IS NOT NULL AND GravityY IS NOT NULL AND GravityZ IS NOT NULL
     AND LinearAccelerationX IS NOT NULL AND LinearAccelerationY IS NOT NULL
     AND LinearAccelerationZ IS NOT NULL AND date IS NOT NULL AND Time IS NOT NULL
     AND NOT isnan(AccelerationX) AND NOT isnan(AccelerationY) AND NOT isnan(AccelerationZ)
     AND NOT isnan(GyroscopeX) AND NOT isnan(GyroscopeY) AND NOT isnan(GyroscopeZ)
     AND NOT isnan(MagnetometerX) AND NOT isnan(MagnetometerY) AND NOT isnan(MagnetometerZ)
     AND NOT isnan(GravityX) AND NOT isnan(GravityY) AND NOT isnan(GravityZ)
     AND NOT isnan(LinearAccelerationX) AND NOT isnan(LinearAccelerationY)
     AND NOT isnan(LinearAccelerationZ))"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


def duration_text_sql(ms: str, style: str = "sql") -> str:
    """DuckDB twin of ``strider.functions.durations.duration_text``."""
    def text(unit_ms: int, name: str) -> str:
        step = unit_ms // 100
        h = f"(({ms}) * 2 + {step}) // {2 * step}"
        whole = f"CAST(({h}) // 100 AS VARCHAR)"
        frac = f"(({h}) % 100)"
        if style == "python":
            dec = f"lpad(CAST({frac} AS VARCHAR), 2, '0')"
        else:
            dec = (f"CASE WHEN {frac} = 0 THEN '0' WHEN {frac} % 10 = 0 "
                   f"THEN CAST({frac} // 10 AS VARCHAR) ELSE lpad(CAST({frac} AS VARCHAR), 2, '0') END")
        return f"{whole} || '.' || {dec} || ' {name}'"
    return (f"CASE WHEN ({ms}) < 60000 THEN {text(1000, 'seconds')} "
            f"WHEN ({ms}) < 3600000 THEN {text(60000, 'minutes')} "
            f"ELSE {text(3600000, 'hours')} END")


def percentage_sql(count: str, total: str) -> str:
    return f"CAST((CAST({count} AS BIGINT) * 20000 + ({total})) // (2 * ({total})) AS DOUBLE) / 100"


def activity_sql(code: str) -> str:
    from strider.schemas import ACTIVITY_LABELS, UNKNOWN_ACTIVITY
    whens = " ".join(f"WHEN {code} = {k} THEN '{v}'" for k, v in ACTIVITY_LABELS.items())
    return f"CASE {whens} ELSE '{UNKNOWN_ACTIVITY}' END"


def slot_sql(ms: str) -> str:
    return f"CAST(floor((hour(epoch_ms({ms})) * 60 + minute(epoch_ms({ms}))) / 30) AS INTEGER)"


def slot_text_sql(slot: str) -> str:
    hours = f"(({slot}) * 30 // 60)"
    minutes = f"(({slot}) * 30 % 60)"
    return (f"CAST(CASE WHEN {hours} % 12 = 0 THEN 12 ELSE {hours} % 12 END AS VARCHAR) || ':' || "
            f"lpad(CAST({minutes} AS VARCHAR), 2, '0') || ' ' || "
            f"CASE WHEN {hours} < 12 THEN 'AM' ELSE 'PM' END")
