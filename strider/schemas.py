"""Table schemas of the sensor data model and the activity label table.

Every raw sensor file kind has a fixed column list; files carry no header, so the
kind (picked from the file name) decides the names and types.  All tables gain a
string ``date`` column (the day folder) when loaded.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column lists per sensor file kind, in file order.
# ---------------------------------------------------------------------------
API_COLUMNS = [
    "Time", "Ignore1", "Ignore2",
    "StillConfidence", "OnFootConfidence", "WalkingConfidence", "RunningConfidence",
    "BikeConfidence", "VehicleConfidence", "TiltingConfidence", "UnknownConfidence",
]
MOTION_COLUMNS = [
    "Time",
    "AccelerationX", "AccelerationY", "AccelerationZ",
    "GyroscopeX", "GyroscopeY", "GyroscopeZ",
    "MagnetometerX", "MagnetometerY", "MagnetometerZ",
    "OrientationW", "OrientationX", "OrientationY", "OrientationZ",
    "GravityX", "GravityY", "GravityZ",
    "LinearAccelerationX", "LinearAccelerationY", "LinearAccelerationZ",
    "Pressure", "Altitude", "Temperature",
]
LABEL_COLUMNS = [
    "Time", "CoarseLabel", "FineLabel", "RoadLabel", "TrafficLabel",
    "TunnelsLabel", "SocialLabel", "FoodLabel",
]
LOCATION_COLUMNS = [
    "Time", "Ignore1", "Ignore2", "Accuracy", "Latitude", "Longitude", "Altitude",
]
TRACK_MAIN_COLUMNS = ["StartTime", "EndTime", "Activity"]
TRACK_COLUMNS = ["StartTime", "EndTime", "Label"]

# File-name substrings in matching order; the first one contained in a
# file name decides its kind (case-sensitive).
KIND_ORDER = [
    "API", "Motion", "Label", "Location",
    "labels_track_food", "labels_track_main", "labels_track_road",
    "labels_track_social", "labels_track_traffic", "labels_track_tunnels",
]

# Activity text per CoarseLabel code; any other code (8, null) is "Unknown".
ACTIVITY_LABELS = {
    0: "Still",
    1: "Walking",
    2: "Running",
    3: "Biking",
    4: "Driving",
    5: "On Bus",
    6: "On Train",
    7: "On Subway",
}
UNKNOWN_ACTIVITY = "Unknown"

# One sample row stands for 10 ms of recording.
SAMPLE_PERIOD_MS = 10

# Columns removed by cleaning (general tables, and the hips motion table).
IGNORED_COLUMNS_GENERAL = ["Ignore1", "Ignore2", "Ignore"]
IGNORED_COLUMNS_MOTION = ["Altitude", "Temperature"]

# Feature sets of the models.
MAGNITUDE_FEATURES = [
    "AccelerationMagnitude", "MagnetometerMagnitude", "LinearAccelerationMagnitude",
]
AXIS_FEATURES = [
    "AccelerationX", "AccelerationY", "AccelerationZ",
    "MagnetometerX", "MagnetometerY", "MagnetometerZ",
    "LinearAccelerationX", "LinearAccelerationY", "LinearAccelerationZ",
]
ANOMALY_FEATURES = [
    "AccelerationX", "AccelerationY", "AccelerationZ",
    "GyroscopeX", "GyroscopeY", "GyroscopeZ",
    "GravityX", "GravityY", "GravityZ",
    "Pressure",
]


def _struct(columns: list[str], types: dict[str, T.DataType], default: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(c, types.get(c, default), True) for c in columns])


_LONG_TIME = {"Time": T.LongType(), "StartTime": T.LongType(), "EndTime": T.LongType()}

API_SCHEMA = _struct(API_COLUMNS, _LONG_TIME, T.DoubleType())
MOTION_SCHEMA = _struct(MOTION_COLUMNS, _LONG_TIME, T.DoubleType())
LABEL_SCHEMA = _struct(LABEL_COLUMNS, _LONG_TIME, T.IntegerType())
LOCATION_SCHEMA = _struct(LOCATION_COLUMNS, _LONG_TIME, T.DoubleType())
TRACK_MAIN_SCHEMA = _struct(TRACK_MAIN_COLUMNS, _LONG_TIME, T.StringType())
TRACK_SCHEMA = _struct(TRACK_COLUMNS, _LONG_TIME, T.StringType())

SCHEMAS: dict[str, T.StructType] = {
    "API": API_SCHEMA,
    "Motion": MOTION_SCHEMA,
    "Label": LABEL_SCHEMA,
    "Location": LOCATION_SCHEMA,
    "labels_track_food": TRACK_SCHEMA,
    "labels_track_main": TRACK_MAIN_SCHEMA,
    "labels_track_road": TRACK_SCHEMA,
    "labels_track_social": TRACK_SCHEMA,
    "labels_track_traffic": TRACK_SCHEMA,
    "labels_track_tunnels": TRACK_SCHEMA,
}

def kind_of(file_name: str) -> str | None:
    """Kind of a raw sensor file: first kind name contained in the file name."""
    if not file_name.endswith(".txt"):
        return None
    for kind in KIND_ORDER:
        if kind in file_name:
            return kind
    return None


def with_date(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField("date", T.StringType(), True)])
