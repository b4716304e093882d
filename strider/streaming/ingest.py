"""Incremental ingest of raw sensor files with Structured Streaming.

New day folders land under a base folder over time.  The file stream source lists
only files it has not seen (its log lives in the checkpoint), every micro-batch is
parsed by the same code as the batch reader, and the file sink commits each batch
exactly once, so a rerun after a failure neither loses nor duplicates rows (unlike a
plain append).  ``availableNow`` processes whatever is new and stops, which suits a
scheduled job; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from strider.session import ensure_checkpoint_dir
from strider.sources.sensor_files import typed_sensor_lines


def default_checkpoint(spark: SparkSession, name: str) -> str:
    """``<spark.checkpoint.dir>/streams/<name>``; the folder must be shared on a cluster."""
    root = ensure_checkpoint_dir(spark)
    if root is None:
        raise RuntimeError("no checkpoint folder: pass checkpoint_location or set spark.checkpoint.dir")
    return f"{root.rstrip('/')}/streams/{name}"


def ingest_sensor_stream(spark: SparkSession, base: str, kind: str, table_path: str,
                         checkpoint_location: str | None = None, mode: str = "strict",
                         available_now: bool = True, processing_time: str | None = None,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream: ``<base>/**/<*kind*>.txt`` → typed rows → Parquet partitioned by ``date``."""
    reader = (spark.readStream.format("text")
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", f"*{kind}*.txt"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = typed_sensor_lines(reader.load(base), kind, mode)
    writer = (rows.writeStream.format("parquet")
              .option("checkpointLocation", checkpoint_location or default_checkpoint(spark, f"ingest_{kind}"))
              .partitionBy("date")
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(table_path)


def ingest_csv_stream(spark: SparkSession, base: str, kind: str, table_path: str,
                      file_name: str | None = None, checkpoint_location: str | None = None,
                      available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start a stream: header CSV files of ``kind`` (or one named file per day folder,
    e.g. ``Hips_Location.csv``) → typed rows + ``date`` → Parquet partitioned by ``date``."""
    from pyspark.sql import functions as F

    from strider.schemas import SCHEMAS
    from strider.sources.sensor_files import date_from_path
    pattern = f"{base.rstrip('/')}/*/{file_name or f'*{kind}*.csv'}"
    rows = (spark.readStream.schema(SCHEMAS[kind]).option("header", "true").csv(pattern)
            .withColumn("date", date_from_path(F.col("_metadata.file_path"))))
    name = (file_name or kind).replace(".", "_")
    writer = (rows.writeStream.format("parquet")
              .option("checkpointLocation", checkpoint_location or default_checkpoint(spark, f"ingest_csv_{name}"))
              .partitionBy("date")
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(table_path)
