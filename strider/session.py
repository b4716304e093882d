"""Spark session helpers.

The library never owns the cluster configuration: it reads what the session says
(``spark.checkpoint.dir`` in particular) and only fills gaps that a local test run
leaves open.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session built here carries.  AQE re-plans joins and partition counts
# at run time, coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Remove reliable checkpoint files once the checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "strider",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None,
                  checkpoint_fallback: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``checkpoint_fallback`` is used only when the session names no
    ``spark.checkpoint.dir`` (local tests); on a cluster the shared folder comes from
    the cluster configuration.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_fallback)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Make the session's checkpoint folder active and return it.

    Order: a folder already set on the context, else ``spark.checkpoint.dir`` from the
    session configuration, else ``fallback`` (tests only).  Returns None when none is
    known; callers that must cut lineage then fail loudly instead of guessing a path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    target = configured or fallback
    if target:
        sc.setCheckpointDir(target)
        return sc.getCheckpointDir()
    return None


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once for several later passes: a reliable checkpoint.

    Later stages read the files in the shared folder, so they survive executor loss.  Without
    ``spark.checkpoint.dir`` a cluster session fails; a local one gets a temporary folder.
    """
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _shared_folder(spark: SparkSession) -> str:
    found = ensure_checkpoint_dir(spark)
    if found is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("no checkpoint folder: set spark.checkpoint.dir to a shared folder")
        found = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="strider-checkpoints-"))
    return found.rstrip("/")


def staged_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder; drop it with ``dropped``."""
    return f"{_shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def dropped(spark: SparkSession, path: str) -> bool:
    """Delete a folder through Spark's own file system access; False if it was not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
