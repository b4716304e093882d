"""Sensor-table views over the driver's tables.

The test tables hold no sensor files, so each sensor table of the data model is
derived from ``events`` (one row per event = one sample) and points of interest from
``supplier``.  Every view keeps ``event_id`` as a row key for total tie-breaks.
Formulas are plain arithmetic that another SQL engine repeats bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strider.functions.timecols import day_folder, epoch_ms
from strider.schemas import LOCATION_COLUMNS

# Constants of the derived views.
ORIENTATION = {"OrientationW": 1.0, "OrientationX": 0.0, "OrientationY": 0.0, "OrientationZ": 0.0}
BASE_LAT = 50.80
BASE_LNG = -0.20
LINE_SEPARATORS = ("  ", "\t")     # fields are joined alternately by two spaces and a tab


def read_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Whole-table scan; the format is a parameter so another connector can be plugged."""
    return spark.read.format(fmt).load(f"{base.rstrip('/')}/{name}.{fmt}")


def _base(events: DataFrame) -> DataFrame:
    """Keys and the helper terms e (event id), c (class), v (value), k (props.k).

    ``k`` comes from ``json_tuple``: a generator parses each document once, and
    filters on derived columns are not rewritten into repeated JSON parses.
    """
    parsed = events.select("event_id", "ts", "user_id", "value", F.json_tuple("props", "k").alias("_kj"))
    return parsed.select(
        F.col("event_id"),
        day_folder("ts").alias("date"),
        epoch_ms("ts").alias("Time"),
        F.col("user_id"),
        (F.col("user_id") % 9).alias("_c"),
        F.col("value").alias("_v"),
        F.col("_kj").cast("int").alias("_k"),
    )


def _e(m: int) -> Column:
    return F.col("event_id") % m


def label_view(events: DataFrame) -> DataFrame:
    b = _base(events)
    return b.select(
        "event_id", "date", "Time",
        F.col("_c").cast("int").alias("CoarseLabel"),
        _e(19).cast("int").alias("FineLabel"),
        _e(5).cast("int").alias("RoadLabel"),
        _e(6).cast("int").alias("TrafficLabel"),
        _e(2).cast("int").alias("TunnelsLabel"),
        _e(4).cast("int").alias("SocialLabel"),
        _e(3).cast("int").alias("FoodLabel"),
    )


def motion_view(events: DataFrame) -> DataFrame:
    b = _base(events)
    c, v, k = F.col("_c"), F.col("_v"), F.col("_k")
    e50 = _e(50)
    return b.select(
        "event_id", "date", "Time",
        (c + k / 100).alias("AccelerationX"),
        (_e(97) / 10).alias("AccelerationY"),
        (v / 100).alias("AccelerationZ"),
        (_e(17) / 10).alias("GyroscopeX"),
        (_e(19) / 10).alias("GyroscopeY"),
        (v / 50).alias("GyroscopeZ"),
        (c * 2 + _e(13) / 10).alias("MagnetometerX"),
        (_e(31) / 10).alias("MagnetometerY"),
        (k / 10).alias("MagnetometerZ"),
        *[F.lit(val).alias(name) for name, val in ORIENTATION.items()],
        (_e(3) / 10).alias("GravityX"),
        (_e(5) / 10).alias("GravityY"),
        (F.lit(9) + k / 100).alias("GravityZ"),
        (_e(7) + c / 10).alias("LinearAccelerationX"),
        (_e(11) / 10).alias("LinearAccelerationY"),
        (k / 50).alias("LinearAccelerationZ"),
        F.when(e50 == 0, F.lit(None).cast("double"))
         .when(e50 == 1, F.lit(float("nan")))
         .otherwise(F.lit(1000) + _e(23) / 10).alias("Pressure"),
        F.lit(0.0).alias("Altitude"),
        F.when(e50 == 2, F.lit(None).cast("double"))
         .otherwise(F.lit(20) + _e(5) / 10).alias("Temperature"),
    )


def location_view(events: DataFrame) -> DataFrame:
    b = _base(events)
    k = F.col("_k")
    return b.select(
        "event_id", "date", "Time", "user_id",
        F.lit(0.0).alias("Ignore1"),
        F.lit(0.0).alias("Ignore2"),
        (_e(40) + 1).cast("double").alias("Accuracy"),
        (F.lit(BASE_LAT) + (F.col("user_id") % 10) / 100 + k / 10000).alias("Latitude"),
        (F.lit(BASE_LNG) + (F.col("user_id") % 15) / 100 + k / 10000).alias("Longitude"),
        F.col("_v").alias("Altitude"),
    )


def line_view(events: DataFrame) -> DataFrame:
    """``location_view`` as raw text lines ``value`` (plus keys), mixed separators."""
    loc = location_view(events)
    parts = []
    for i, name in enumerate(LOCATION_COLUMNS):
        if i:
            parts.append(F.lit(LINE_SEPARATORS[(i - 1) % 2]))
        parts.append(F.col(name).cast("string"))
    return loc.select("event_id", "date", "user_id", F.concat(*parts).alias("value"))


def poi_view(supplier: DataFrame) -> DataFrame:
    """Points of interest: one per supplier."""
    return supplier.select(
        F.col("s_suppkey").alias("poi_id"),
        F.col("s_name").alias("name"),
        (F.lit(BASE_LAT) + (F.col("s_suppkey") % 20) / 200).alias("lat"),
        (F.lit(BASE_LNG) + (F.col("s_suppkey") % 30) / 200).alias("lng"),
    )


class Tables:
    """Lazy access to the driver tables and the derived sensor views of one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.base, name)

    @property
    def labels(self) -> DataFrame:
        return label_view(self.raw("events"))

    @property
    def motion(self) -> DataFrame:
        return motion_view(self.raw("events"))

    @property
    def location(self) -> DataFrame:
        return location_view(self.raw("events"))

    @property
    def lines(self) -> DataFrame:
        return line_view(self.raw("events"))

    @property
    def pois(self) -> DataFrame:
        return poi_view(self.raw("supplier"))
