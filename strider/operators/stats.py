"""Activity composition: whole dataset, per day, per time range.

One sample row stands for ``sample_period_ms`` of recording.  Each composition is a
single grouped aggregation with map-side partial counts, so a hot label or a hot day
never concentrates raw rows in one task; the denominator is summed over the already
aggregated groups (at most labels × days rows) instead of a second scan or a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strider.functions.dates import parse_day
from strider.functions.durations import duration_text, percentage
from strider.functions.labels import activity_text
from strider.functions.timecols import day_end_ms
from strider.schemas import SAMPLE_PERIOD_MS

REPORT_COLUMNS = ["Activity", "TotalTime", "Percentage"]


def _composition(labels: DataFrame, by: list[str], label_col: str,
                 sample_period_ms: int) -> DataFrame:
    grouped = labels.groupBy(*by, label_col).agg(
        F.count(label_col).alias("Count"),          # null label → 0, as count(column)
        F.count(F.lit(1)).alias("_rows"),
    )
    # The window runs over the aggregated groups only (≤ labels rows per partition key).
    total = F.sum("_rows").over(Window.partitionBy(*[F.col(c) for c in by]) if by
                                else Window.partitionBy(F.lit(0)))
    return (grouped
            .withColumn("TotalInstances", total)
            .withColumn("TotalTimeMs", F.col("Count") * F.lit(sample_period_ms))
            .withColumn("TotalTime", duration_text("TotalTimeMs", "sql"))
            .withColumn("Activity", activity_text(label_col))
            .withColumn("Percentage", percentage("Count", "TotalInstances"))
            .drop("_rows"))


def dataset_activity_stats(labels: DataFrame, label_col: str = "CoarseLabel",
                           sample_period_ms: int = SAMPLE_PERIOD_MS,
                           detailed: bool = False) -> DataFrame:
    """Share and duration of each activity over all rows (null labels count in the total).

    Ordered by label code (null first).  ``detailed`` keeps code, count and totals.
    """
    comp = _composition(labels, [], label_col, sample_period_ms).orderBy(F.col(label_col).asc_nulls_first())
    if detailed:
        return comp.select(label_col, "Activity", "Count", "TotalInstances", "TotalTimeMs",
                           "TotalTime", "Percentage")
    return comp.select(*REPORT_COLUMNS)


def daily_activity_stats(labels: DataFrame, label_col: str = "CoarseLabel",
                         date_col: str = "date", sample_period_ms: int = SAMPLE_PERIOD_MS,
                         detailed: bool = False) -> DataFrame:
    """Composition per day; the share is of that day's rows.  Rows without a day are dropped."""
    comp = _composition(labels.where(F.col(date_col).isNotNull()), [date_col], label_col,
                        sample_period_ms)
    comp = comp.orderBy(parse_day(date_col), F.col(date_col), F.col(label_col).asc_nulls_first())
    if detailed:
        return comp.select(date_col, label_col, "Activity", "Count", "TotalInstances",
                           "TotalTimeMs", "TotalTime", "Percentage")
    return comp.select(date_col, *REPORT_COLUMNS)


def range_activity_stats(labels: DataFrame, start_ms: int, end_ms: int | None = None,
                         tz: str = "UTC", time_col: str = "Time", **kw) -> DataFrame:
    """Composition of rows with ``start_ms <= Time <= end_ms``.

    Without ``end_ms`` the range ends at 23:59:59.999 of the start's day in ``tz``.  An
    empty range gives an empty result (no separate count job).
    """
    if end_ms is None:
        end_ms = day_end_ms(start_ms, tz)
    return dataset_activity_stats(labels.where(F.col(time_col).between(start_ms, end_ms)), **kw)


def total_time(labels: DataFrame, sample_period_ms: int = SAMPLE_PERIOD_MS) -> DataFrame:
    """One row: row count, recorded milliseconds and readable total; no row if empty."""
    return (labels.agg(F.count(F.lit(1)).alias("TotalCount"))
            .where(F.col("TotalCount") > 0)
            .withColumn("TotalTimeMs", F.col("TotalCount") * F.lit(sample_period_ms))
            .withColumn("TotalTime", duration_text("TotalTimeMs", "python")))


def stats_for_date(daily_stats: DataFrame, day: str | None, date_col: str = "date",
                   exclude: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Rows of one day from a daily-stats table (no day → empty), minus ``exclude`` columns."""
    cond: Column = F.col(date_col) == day if day is not None else F.lit(False)
    return daily_stats.where(cond).drop(*exclude)


def distinct_dates(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Distinct non-null days, in calendar order."""
    return (df.select(date_col).where(F.col(date_col).isNotNull()).distinct()
            .orderBy(parse_day(date_col), F.col(date_col)))
