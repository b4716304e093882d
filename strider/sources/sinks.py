"""Writers.  All are distributed file writes (no collect to the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, partition_by: tuple[str, ...] | list[str] = ("date",),
              mode: str = "overwrite") -> None:
    """CSV with header, one folder per day."""
    writer = df.write.mode(mode).option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_table(df: DataFrame, path: str, mode: str = "append",
                partition_by: tuple[str, ...] | list[str] = ("date",),
                dynamic_overwrite: bool = False, fmt: str = "parquet") -> None:
    """Parquet table partitioned by day.

    ``append`` adds rows (a rerun duplicates them); ``overwrite`` replaces the table,
    or with ``dynamic_overwrite`` only the days present in ``df`` (idempotent reloads).
    """
    if partition_by:                        # few files per day; AQE splits a day that is large
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int,
                  partition_by: tuple[str, ...] | list[str] = ("date",), mode: str = "overwrite") -> None:
    """Catalog table bucketed on join keys, so joins on ``keys`` skip the shuffle.

    Rows are first gathered by day and bucket: few files each; AQE splits a large one.
    """
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    df = df.withColumn("_bucket", bucket).hint("rebalance", *partition_by, "_bucket").drop("_bucket")
    writer = df.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def replace_results(results: DataFrame | None, path: str, fmt: str = "parquet") -> bool:
    """Overwrite a result table, unless the new result is missing or empty.

    An empty statistics result (for example a time range without rows) leaves the
    previous result in place.  The (small) result is computed once: the emptiness test
    and the write share it.  Returns whether the table was written.
    """
    if results is None:
        return False
    once = results.persist()
    try:
        if once.isEmpty():
            return False
        once.write.mode("overwrite").format(fmt).save(path)
        return True
    finally:
        once.unpersist()


# Heading and rule of the text report.
REPORT_TITLE = "Decision Tree Classifier Results"
REPORT_RULE = "-------------------------------"


def report_lines(report: DataFrame, title: str = REPORT_TITLE) -> DataFrame:
    """Report rows (Depth, Accuracy, Precision, Recall[, Tree]) → text lines.

    Metrics are printed with 4 decimals, followed by the tree structure when present.
    """
    fmt = F.concat_ws("\n", F.lit(title), F.lit(REPORT_RULE),
                      F.format_string("Accuracy: %.4f", "Accuracy"),
                      F.format_string("Precision: %.4f", "Precision"),
                      F.format_string("Recall: %.4f", "Recall"),
                      *([F.lit(""), F.lit("Decision Tree Structure:"), F.col("Tree")]
                        if "Tree" in report.columns else []))
    return report.select(fmt.alias("value"))


def write_report_text(report: DataFrame, path: str) -> None:
    """Model report as a text file (one small file; the report has one row per depth)."""
    report_lines(report).coalesce(1).write.mode("overwrite").text(path)


def write_report(report: DataFrame, path: str) -> None:
    """Model report rows (metrics, tree text) as JSON lines in one file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_predictions(predictions: DataFrame, path: str,
                      columns: tuple[str, ...] = ("date", "Time", "final_prediction")) -> None:
    """Per-row predictions as CSV with header."""
    predictions.select(*columns).write.mode("overwrite").option("header", "true").csv(path)


def write_anomalies(scored: DataFrame, path: str, prediction_col: str = "prediction") -> None:
    """Rows flagged -1 as CSV with header."""
    (scored.where(scored[prediction_col] == -1).write.mode("overwrite")
     .option("header", "true").csv(path))


def write_predicted_locations(locations: DataFrame, path: str) -> None:
    """Predicted locations (overwrite)."""
    locations.write.mode("overwrite").parquet(path)
