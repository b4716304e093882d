"""Activity recognition: decision trees, bagged trees, votes and metrics (Spark ML)."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strider.functions.vectors import array_sum, majority_vote

SPLIT_SEED = 1234
TRAIN_FRACTION = 0.8
# Depths of the reference sweep and of the reported tree.
SWEEP_DEPTHS = (1, 5, 10)
# Independent fits are submitted from this many driver threads at once (Spark runs
# their jobs side by side, as CrossValidator's ``parallelism`` does).
FIT_PARALLELISM = 4
REPORT_DEPTH = 10
NUM_TREES = 5
_HASH_SPACE = 1 << 52


def uniform_hash(key_cols: list[str] | tuple[str, ...], seed: int) -> Column:
    """Deterministic uniform [0, 1) per row from its key (same value on any re-run).

    The first 52 bits of the MD5 of ``key:key:...:seed`` (null key: empty text), which any SQL
    engine can repeat.
    """
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / _HASH_SPACE


def hash_split(df: DataFrame, key_cols: list[str] | tuple[str, ...], fraction: float = TRAIN_FRACTION,
               seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """Reproducible random split by key hash.

    Unlike ``randomSplit`` the membership of a row does not depend on partitioning or
    row order, so a recomputed partition after an executor loss lands identically.
    """
    u = uniform_hash(key_cols, seed)
    return df.where(u < fraction), df.where(u >= fraction)


def poisson_weight(key_cols: list[str] | tuple[str, ...], seed: int) -> Column:
    """Bootstrap multiplicity of a row: a Poisson(1) draw from the key hash.

    Sampling with replacement at fraction 1 gives each row a Poisson(1) count; using it
    as an instance weight trains on the bootstrap sample without copying rows.  The table of
    counts goes on until the rest of the distribution is below the hash's resolution.
    """
    u = uniform_hash(key_cols, seed)
    cdf, term, bounds = 0.0, math.exp(-1.0), []
    while 1 - cdf > 1 / _HASH_SPACE:
        cdf += term
        bounds.append(cdf)
        term /= len(bounds)

    def count(x: Column) -> Column:
        expr = F.lit(len(bounds))
        for k, bound in reversed(list(enumerate(bounds))):
            expr = F.when(x < bound, F.lit(k)).otherwise(expr)
        return expr
    # Inside a one-element array the hash is computed once, not once per bound.
    return F.get(F.transform(F.array(u), count), F.lit(0)).cast("double")


def classification_metrics(predictions: DataFrame, label_col: str = "CoarseLabel",
                           prediction_col: str = "prediction") -> DataFrame:
    """Accuracy, weighted precision and weighted recall from one pass over ``predictions``.

    One grouped count gives the confusion cells (map-side partial aggregation, at most
    labels × labels rows); label and prediction totals are window sums over those
    cells, so the input is read once.  Weights are label frequencies; a label never
    predicted correctly contributes 0.
    """
    lab = F.col(label_col).cast("double")
    pred = F.col(prediction_col).cast("double")
    cm = predictions.groupBy(lab.alias("l"), pred.alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return confusion_metrics(cm)


def confusion_metrics(cm: DataFrame, *by: str) -> DataFrame:
    """Metrics of confusion cells (label ``l``, prediction ``p``, rows ``n``), per group of ``by``."""
    cells = (cm.withColumn("n_l", F.sum("n").over(Window.partitionBy(*by, "l")))
               .withColumn("n_p", F.sum("n").over(Window.partitionBy(*by, "p")))
               .withColumn("total", F.sum("n").over(Window.partitionBy(*by, F.lit(0)))))
    diag = F.col("l") == F.col("p")
    tp = F.when(diag, F.col("n")).otherwise(F.lit(0))
    total = F.max("total")
    return cells.groupBy(*by).agg(
        (F.sum(tp) / total).alias("accuracy"),
        (F.sum(F.when(diag, F.col("n") / F.col("n_p") * F.col("n_l"))) / total).alias("weighted_precision"),
        (F.sum(F.when(diag, F.col("n") / F.col("n_l") * F.col("n_l"))) / total).alias("weighted_recall"),
    ).na.fill(0.0)


def _assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features",
                           handleInvalid="skip").transform(df)


def fit_tree(train: DataFrame, label_col: str, max_depth: int | None = None,
             prediction_col: str = "prediction", weight_col: str | None = None, seed: int | None = None):
    params = {"featuresCol": "features", "labelCol": label_col, "predictionCol": prediction_col}
    if max_depth is not None:
        params["maxDepth"] = max_depth
    if weight_col:
        params["weightCol"] = weight_col
    if seed is not None:
        params["seed"] = seed
    return DecisionTreeClassifier(**params).fit(train)


def tree_reports(df: DataFrame, features: list[str], label_col: str = "CoarseLabel",
                 depths: tuple[int, ...] = (REPORT_DEPTH,), key_cols: tuple[str, ...] = ("date", "Time"),
                 fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED,
                 with_tree: bool = False, parallelism: int = FIT_PARALLELISM) -> DataFrame:
    """Fit one tree per depth on a hash split; rows Depth, Accuracy, Precision, Recall (+ Tree).

    The assembled data is persisted (memory, spilling to disk) while the trees are
    fitted and evaluated, then released.  Each evaluation is one pass over the test
    rows returning one metrics row, so the report is a handful of driver-side rows.
    """
    narrow = dict.fromkeys([*key_cols, label_col, "features"])
    data = _assemble(df.na.drop(), features).select(*narrow).persist(StorageLevel.MEMORY_AND_DISK)
    train, test = hash_split(data, key_cols, fraction, seed)

    def report(depth: int) -> tuple:
        model = fit_tree(train, label_col, depth)
        m = classification_metrics(model.transform(test), label_col).first()
        return (int(depth), float(m["accuracy"]), float(m["weighted_precision"]),
                float(m["weighted_recall"]), model.toDebugString if with_tree else None)
    try:
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(depths)))) as pool:
            rows = list(pool.map(report, depths))
    finally:
        data.unpersist()
    report = df.sparkSession.createDataFrame(
        rows, "Depth int, Accuracy double, Precision double, Recall double, Tree string")
    return report if with_tree else report.drop("Tree")


def metrics_for_depth(metrics: DataFrame, depth: int) -> DataFrame:
    """Row of a depth sweep for one depth."""
    return metrics.where(F.col("Depth") == depth)


def bagged_trees(df: DataFrame, features: list[str], label_col: str = "CoarseLabel",
                 num_trees: int = NUM_TREES, max_depth: int | None = None,
                 key_cols: tuple[str, ...] = ("date", "Time"), fraction: float = TRAIN_FRACTION,
                 seed: int = SPLIT_SEED, keep: tuple[str, ...] = ("date", "Time"),
                 parallelism: int = FIT_PARALLELISM) -> DataFrame:
    """Bootstrap-aggregated decision trees; one output row per test row.

    Tree ``i`` trains on a bootstrap sample drawn with seed ``i``, expressed as Poisson
    instance weights (rows of weight 0 are skipped).  Every tree then predicts on the
    same test frame (chained transforms, no joins); ``final_prediction`` is the majority
    vote (ties → lowest label) and ``prediction_sum`` the plain sum of the votes.
    """
    data = _assemble(df.na.drop(), features)
    train, test = hash_split(data, key_cols, fraction, seed)
    train = train.select(*dict.fromkeys([*key_cols, label_col, "features"])).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(i: int):
        sample = train.withColumn("_w", poisson_weight(key_cols, i)).where(F.col("_w") > 0)
        return fit_tree(sample, label_col, max_depth, f"prediction_{i}", "_w")
    try:
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, num_trees))) as pool:
            models = list(pool.map(fit, range(num_trees)))
    finally:
        train.unpersist()
    out = test
    for i, model in enumerate(models):
        model.setRawPredictionCol(f"_raw_{i}").setProbabilityCol(f"_prob_{i}")
        out = model.transform(out).drop(f"_raw_{i}", f"_prob_{i}")
    preds = [f"prediction_{i}" for i in range(num_trees)]
    out = out.withColumn("_votes", F.array(*preds))
    return out.select(*keep, label_col, *preds,
                      majority_vote("_votes").alias("final_prediction"),
                      array_sum("_votes").alias("prediction_sum"))
