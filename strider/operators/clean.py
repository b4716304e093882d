"""Cleaning, date standardisation and data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strider.functions.dates import standardize_date
from strider.schemas import IGNORED_COLUMNS_GENERAL, IGNORED_COLUMNS_MOTION

MOTION_TABLES = ("Hips_Motion",)


def clean_table(df: DataFrame, ignored: list[str] | tuple[str, ...] = tuple(IGNORED_COLUMNS_GENERAL),
                null_check: str = "all") -> DataFrame:
    """Delete rows holding any null or NaN, then drop the ignored columns (absent ones are skipped).

    ``null_check="all"`` tests every column, the ignored ones included (a null in a
    column about to be dropped still deletes the row); ``"kept"`` tests only the
    columns that remain.
    """
    if null_check == "all":
        return df.na.drop(how="any").drop(*ignored)
    if null_check == "kept":
        return df.drop(*ignored).na.drop(how="any")
    raise ValueError(f"null_check must be 'all' or 'kept', not {null_check!r}")


def clean_motion(df: DataFrame, null_check: str = "all") -> DataFrame:
    """Cleaning of the hips motion table: also drops Altitude and Temperature."""
    return clean_table(df, tuple(IGNORED_COLUMNS_MOTION), null_check)


def clean_tables(tables: dict[str, DataFrame], motion_tables=MOTION_TABLES,
                 null_check: str = "all") -> dict[str, DataFrame]:
    """Apply the matching cleaning to every named table (lazy; nothing runs here)."""
    return {name: (clean_motion(df, null_check) if name in motion_tables
                   else clean_table(df, null_check=null_check))
            for name, df in tables.items()}


def clean_catalog_tables(spark, names: list[str] | tuple[str, ...], suffix: str = "_clean",
                         motion_tables=MOTION_TABLES, null_check: str = "all",
                         database: str | None = None) -> list[str]:
    """Clean the named catalog tables into ``<name><suffix>`` tables; returns the new names.

    The table list is explicit, so result tables are never cleaned by accident.  Each
    table is one distributed read → filter → write; nothing passes through the driver.
    """
    written = []
    for name in names:
        qualified = f"{database}.{name}" if database else name
        base = name.split(".")[-1]
        cleaned = clean_tables({base: spark.table(qualified)}, motion_tables, null_check)[base]
        target = f"{qualified}{suffix}"
        cleaned.write.mode("overwrite").saveAsTable(target)
        written.append(target)
    return written


def standardize_dates(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Rewrite ``date`` to MM/DD/YYYY where it holds six digits; other values untouched."""
    if date_col not in df.columns:
        return df
    return df.withColumn(date_col, standardize_date(date_col))


def expectation_checks(checks: list[tuple[str, DataFrame, str, int]]) -> DataFrame:
    """Distinct-count expectations: (check, column, expected, actual, passed), one row each."""
    rows = [df.agg(F.count_distinct(F.col(column)).alias("actual"))
              .select(F.lit(name).alias("check"), F.lit(column).alias("column"),
                      F.lit(expected).cast("long").alias("expected"), "actual",
                      (F.col("actual") == F.lit(expected)).alias("passed"))
            for name, df, column, expected in checks]
    return reduce(DataFrame.unionByName, rows)
