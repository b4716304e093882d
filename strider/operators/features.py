"""Label ⋈ motion join, derived features, scaling and ordered sequences."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strider.functions.timecols import half_hour_slot, iso_weekday, ms_to_utc
from strider.functions.vectors import magnitude
from strider.operators.quantiles import bracketed_statistics, kth_row
from strider.schemas import ANOMALY_FEATURES, AXIS_FEATURES

JOIN_KEYS = ("date", "Time")

# The three magnitudes and the axes they are built from.
MAGNITUDES = {
    "AccelerationMagnitude": ("AccelerationX", "AccelerationY", "AccelerationZ"),
    "MagnetometerMagnitude": ("MagnetometerX", "MagnetometerY", "MagnetometerZ"),
    "LinearAccelerationMagnitude": ("LinearAccelerationX", "LinearAccelerationY", "LinearAccelerationZ"),
}


def label_motion_join(labels: DataFrame, motion: DataFrame, label_col: str = "CoarseLabel",
                      axes: list[str] | tuple[str, ...] = tuple(AXIS_FEATURES),
                      keys: tuple[str, ...] = JOIN_KEYS) -> DataFrame:
    """Inner equi-join of labels and motion on ``(date, Time)``; duplicate keys multiply.

    Both sides are pruned to the needed columns first.  Catalyst picks the strategy
    (sort-merge on the keys for two large tables; AQE splits skewed partitions).
    Row keys ``event_id`` of both sides are carried when present.  Tables of several body
    positions are joined within each position.
    """
    if "position" in labels.columns and "position" in motion.columns and "position" not in keys:
        keys = (*keys, "position")
    lcols = [*keys, label_col] + (["event_id"] if "event_id" in labels.columns else [])
    mcols = [*keys, *axes]
    m = motion.select(*mcols, *([F.col("event_id").alias("motion_event_id")]
                                if "event_id" in motion.columns else []))
    return labels.select(*lcols).join(m, list(keys), "inner")


def with_magnitudes(df: DataFrame, drop_incomplete: bool = True) -> DataFrame:
    """Add the acceleration, magnetometer and linear-acceleration magnitudes."""
    out = df.withColumns({name: magnitude(*axes) for name, axes in MAGNITUDES.items()})
    return out.na.drop() if drop_incomplete else out


def moments_fit(df: DataFrame, features: list[str] | tuple[str, ...], population: bool = False) -> dict:
    """Fit: row count, mean and standard deviation per feature, as one aggregate row.

    One distributed pass with partial aggregation; only this single row reaches the
    driver (like an ML estimator's ``fit``), and the transform uses its values as
    literals.
    """
    std = F.stddev_pop if population else F.stddev_samp
    row = df.agg(F.count(F.lit(1)).alias("count"),
                 *[std(f).alias(f"std_{f}") for f in features],
                 *[F.avg(f).alias(f"mean_{f}") for f in features]).first()
    return row.asDict()


def scale_features(df: DataFrame, features: list[str] | tuple[str, ...] = tuple(ANOMALY_FEATURES),
                   keep: list[str] | tuple[str, ...] = (), with_mean: bool = False) -> DataFrame:
    """Divide each feature by its sample standard deviation (no centring by default).

    Rows with a null or NaN feature are skipped (as the vector assembler does).  A
    feature with zero deviation scales to 0.  Same result as Spark ML's
    ``StandardScaler(withStd=True, withMean=False)`` but as plain column arithmetic,
    so the projection stays inside whole-stage code generation.
    """
    features = list(features)
    data = df.select(*keep, *[c for c in features if c not in keep]).na.drop(subset=features)
    fit = moments_fit(data, features)

    def scaled(f: str) -> Column:
        std = fit[f"std_{f}"]
        if not std:
            return F.lit(0.0).alias(f)
        x = F.col(f) - F.lit(fit[f"mean_{f}"]) if with_mean else F.col(f)
        return (x / F.lit(std)).alias(f)
    return data.select(*keep, *[scaled(f) for f in features if f not in keep])


def scale_features_ml(df: DataFrame, features: list[str] | tuple[str, ...] = tuple(ANOMALY_FEATURES),
                      keep: list[str] | tuple[str, ...] = (), with_mean: bool = False) -> DataFrame:
    """``scale_features`` through Spark ML (``VectorAssembler`` + ``StandardScaler``)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="skip")
    vec = assembler.transform(df.select(*keep, *features))
    scaler = StandardScaler(inputCol="_features", outputCol="scaled_features",
                            withStd=True, withMean=with_mean)
    scaled = scaler.fit(vec).transform(vec)
    arr = vector_to_array("scaled_features")
    return scaled.select(*keep, *[arr[i].alias(name) for i, name in enumerate(features)])


def zscores(df: DataFrame, cols: list[str] | tuple[str, ...] = ("Latitude", "Longitude"),
            keep: list[str] | tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
    """(x - mean) / population std per column; returns the frame and the fit values
    (``mean_<c>``, ``std_<c>``) for the inverse transform.

    Rows with a null or NaN in one of the columns are dropped; a constant column is only
    centred (deviation taken as 1).
    """
    df = df.na.drop(subset=list(cols))
    fit = moments_fit(df, cols, population=True)
    fit |= {f"std_{c}": fit[f"std_{c}"] or 1.0 for c in cols}
    scaled = df.select(*keep, *[((F.col(c) - F.lit(fit[f"mean_{c}"])) / F.lit(fit[f"std_{c}"])).alias(f"{c}_z")
                                for c in cols])
    return scaled, fit


def unscale(z: Column, fit: dict, col: str) -> Column:
    """Inverse of ``zscores`` for one column."""
    return z * F.lit(fit[f"std_{col}"]) + F.lit(fit[f"mean_{col}"])


def half_hour_features(df: DataFrame, time_col: str = "Time") -> DataFrame:
    """Hour, minute, half-hour slot (0..47) and ISO weekday (Mon=1) of epoch-ms ``Time``, in UTC."""
    ts = ms_to_utc(time_col)
    return df.withColumns({
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "half_hour_interval": half_hour_slot(time_col),
        "day_of_week": iso_weekday(time_col),
    })


def lag_sequences(df: DataFrame, value_cols: list[str], n: int = 10,
                  partition_cols: list[str] | tuple[str, ...] = ("user_id",),
                  order_cols: list[str] | tuple[str, ...] = ("Time", "event_id"),
                  block_rows: int | None = 1 << 20, rows_per_partition: int | None = None) -> DataFrame:
    """Each row with its ``n`` predecessors (per partition key, in ``order_cols`` order).

    Adds ``<v>_lag1`` … ``<v>_lag<n>`` (lag 1 = previous row) and keeps only rows that
    have a full history, i.e. the first ``n`` rows of every key give none.

    A plain ``Window.partitionBy(key)`` sorts a whole key in one task, which fails when
    one key (or one time span of it) holds a large share of the rows.  Instead:

    1. range-partition on the full order ``(key, order_cols)`` — unique per row, so the
       sampled range boundaries split any hot key into balanced partitions — sort
       within partitions and cut the lineage with a reliable checkpoint (partition
       contents stay fixed if work is recomputed);
    2. number rows inside each partition and add the partition's start, taken from the
       per-partition counts (one row per partition), giving a contiguous global index;
    3. cut the index into blocks of ``block_rows`` rows, copy the last ``n`` rows of
       each block into the next one as history, and take the lags in a window per
       block (at most ``block_rows + n`` rows); a lag is kept only when the row ``n``
       back has the same key.

    There are ``spark.sql.shuffle.partitions`` range partitions, small ones coalesced at run
    time (AQE), or with ``rows_per_partition`` as many as a row count gives.  ``block_rows=None`` uses the single window per key instead.
    """
    from strider.session import materialize

    p = list(partition_cols)
    o = list(order_cols)
    lags = {f"{v}_lag{j}": (v, j) for j in range(1, n + 1) for v in value_cols}
    if block_rows is None:
        w = Window.partitionBy(*p).orderBy(*o)
        out = df.withColumns({name: F.lag(v, j).over(w) for name, (v, j) in lags.items()})
        return (out.withColumn("_rn", F.row_number().over(w))
                .where(F.col("_rn") > n).drop("_rn"))
    if block_rows < n:
        raise ValueError("block_rows must be at least n")
    keys = p + o
    parts = [max(1, -(-df.count() // rows_per_partition))] if rows_per_partition else []
    ranged = materialize(df.repartitionByRange(*parts, *keys).sortWithinPartitions(*keys))
    pid = F.spark_partition_id()
    placed = ranged.select("*", pid.alias("_pid"),
                           (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("_pos"))
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range partition: a single-partition window and a broadcast are bounded.
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    indexed = (placed.join(F.broadcast(starts), "_pid")
               .withColumn("_idx", F.col("_start") + F.col("_pos"))
               .drop("_pid", "_pos", "_start"))
    own = F.floor(F.col("_idx") / F.lit(block_rows)).cast("long")
    halo = F.pmod(F.col("_idx"), F.lit(block_rows)) >= block_rows - n
    copies = indexed.withColumn("_own", own).withColumn(
        "_blk", F.explode(F.when(halo, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy("_blk").orderBy("_idx")
    same_key = reduce(lambda a, b: a & b, [F.lag(c, n).over(w).eqNullSafe(F.col(c)) for c in p])
    out = copies.withColumns({name: F.lag(v, j).over(w) for name, (v, j) in lags.items()})
    out = out.withColumn("_full", same_key)
    return (out.where((F.col("_blk") == F.col("_own")) & F.col("_full"))
            .drop("_blk", "_own", "_idx", "_full"))


def chronological_split(df: DataFrame, fraction: float = 0.8,
                        order_cols: list[str] | tuple[str, ...] = ("Time", "event_id"),
                        flag_col: str = "split") -> DataFrame:
    """Mark the first ``floor(fraction * n)`` rows in ``order_cols`` order ``train``, the rest ``test``.

    The cut row is found by exact distributed selection (the row count comes from the
    selection's first aggregate), then the split is a plain comparison with it — no
    global window sorting all rows in one task.
    """
    o = list(order_cols)
    n, first = bracketed_statistics(df, o[0], lambda total: [int(fraction * total)])
    k = int(fraction * n)
    if k >= n:
        return df.withColumn(flag_col, F.lit("train"))
    if k <= 0:
        return df.withColumn(flag_col, F.lit("test"))
    value, n_less = first[k]
    rest = kth_row(df.where(F.col(o[0]) == F.lit(value)), o[1:], k - n_less) if len(o) > 1 else ()
    cut = (value, *rest)
    before: Column = F.lit(False)
    for i in reversed(range(len(o))):
        same = F.lit(True)
        for j in range(i):
            same = same & (F.col(o[j]) == F.lit(cut[j]))
        before = (same & (F.col(o[i]) < F.lit(cut[i]))) | before
    return df.withColumn(flag_col, F.when(before, F.lit("train")).otherwise(F.lit("test")))
