"""Anomaly detection: isolation forest, per-feature summary, two-cluster outliers.

Isolation forest (Liu, Ting and Zhou, 2008) on Spark:

1. Scale the features (``StandardScaler``, no centring) in one distributed fit.
2. Draw each tree's sample of exactly ``psi = min(max_samples, n)`` rows without replacement:
   the ``psi`` smallest hash ranks of that tree (``forest_sample``).  Deterministic for a seed,
   independent of partitioning, and about ``oversample * psi`` rows per tree are shuffled,
   whatever the input.
3. Build the trees in ``groupBy(tree).applyInPandas`` (one small group per tree).
4. The node table has at most ``trees * (2 psi - 1)`` rows, a bound fixed by the
   parameters, so it is collected once and broadcast.
5. Score every row with ``mapInPandas`` (numpy traversal of all trees at once).
6. The contamination cut is the exact ``contamination`` quantile of the scores
   (distributed selection over materialised scores) or, optionally, an approximate
   percentile in the same plan.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strider.operators.quantiles import exact_quantile
from strider.schemas import ANOMALY_FEATURES
from strider.session import materialize

EULER_GAMMA = 0.5772156649015329
#: Ranks are 16 hexadecimal digits, so an MD5 serves two trees.
_RANK_DIGITS, _RANKS_PER_HASH = 16, 2

NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType()),
    T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("path", T.DoubleType()),
])


def average_path_length(n):
    """c(n): mean path length of an unsuccessful search in a binary search tree of n keys."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def build_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """One isolation tree over sample ``x`` → rows (node, feature, threshold, left, right, path)."""
    nodes: list[list] = [[-1, math.nan, -1, -1, math.nan]]
    stack = [(0, np.arange(len(x)), 0)]
    while stack:
        nid, idx, depth = stack.pop()
        size = len(idx)
        if depth < max_depth and size > 1:
            sub = x[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            varying = np.flatnonzero(hi > lo)
            if len(varying):
                f = int(rng.choice(varying))
                thr = float(rng.uniform(lo[f], hi[f]))
                go_left = sub[:, f] <= thr
                if go_left.all():
                    thr = float(lo[f])
                    go_left = sub[:, f] <= thr
                left, right = len(nodes), len(nodes) + 1
                nodes.append([-1, math.nan, -1, -1, math.nan])
                nodes.append([-1, math.nan, -1, -1, math.nan])
                nodes[nid] = [f, thr, left, right, math.nan]
                stack.append((left, idx[go_left], depth + 1))
                stack.append((right, idx[~go_left], depth + 1))
                continue
        nodes[nid] = [-1, math.nan, -1, -1, depth + float(average_path_length([size])[0])]
    return [(i, *row) for i, row in enumerate(nodes)]


def _tree_builder(max_depth: int, seed: int, cols: list[str]):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("position", kind="mergesort")
        tree_id = int(pdf["tree_id"].iloc[0])
        x = pdf[cols].to_numpy(dtype=float)
        rows = build_tree(x, np.random.default_rng([seed, tree_id]), max_depth)
        out = pd.DataFrame(rows, columns=["node", "feature", "threshold", "left", "right", "path"])
        out.insert(0, "tree_id", tree_id)
        return out.astype({"tree_id": "int32", "node": "int32", "feature": "int32",
                           "left": "int32", "right": "int32"})
    return build


def _pack_forest(nodes: list) -> dict:
    """Node rows → flat arrays with global child indices and one root per tree."""
    pdf = pd.DataFrame(nodes, columns=[f.name for f in NODE_SCHEMA.fields])
    pdf = pdf.sort_values(["tree_id", "node"], kind="mergesort").reset_index(drop=True)
    sizes = pdf.groupby("tree_id", sort=True)["node"].count()
    starts = np.concatenate([[0], np.cumsum(sizes.to_numpy())[:-1]])
    offset = np.repeat(starts, sizes.to_numpy())
    internal = pdf["left"].to_numpy() >= 0
    left = np.where(internal, pdf["left"].to_numpy() + offset, -1)
    right = np.where(internal, pdf["right"].to_numpy() + offset, -1)
    return {
        "feature": np.where(internal, pdf["feature"].to_numpy(), 0).astype(np.int64),
        "threshold": np.nan_to_num(pdf["threshold"].to_numpy(dtype=float)),
        "left": left.astype(np.int64),
        "right": right.astype(np.int64),
        "path": np.nan_to_num(pdf["path"].to_numpy(dtype=float)),
        "roots": starts.astype(np.int64),
    }


def _scorer(forest_bc, psi: int, max_depth: int, out_cols: list[str], x_cols: list[str],
            stds: list[float | None] | None = None):
    """Scores of batches; columns are divided by ``stds`` (a constant column, without one, is 0)."""
    divisors = np.array([s or np.inf for s in stds]) if stds else 1.0
    c_psi = float(average_path_length([psi])[0]) or 1.0

    def score(batches):
        f = forest_bc.value
        feat, thr, left, right, path, roots = (f["feature"], f["threshold"], f["left"], f["right"],
                                               f["path"], f["roots"])
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = pdf[x_cols].to_numpy(dtype=float) / divisors
            rows = np.arange(len(x))[:, None]
            node = np.broadcast_to(roots, (len(x), len(roots))).copy()
            for _ in range(max_depth):
                inner = left[node] >= 0
                if not inner.any():
                    break
                go_left = x[rows, feat[node]] <= thr[node]
                node = np.where(inner, np.where(go_left, left[node], right[node]), node)
            mean_path = path[node].mean(axis=1)
            out = pdf[out_cols].copy()
            out["score_sample"] = -np.power(2.0, -mean_path / c_psi)
            yield out
    return score


def forest_sample(df: DataFrame, key_cols: tuple[str, ...] = ("event_id",), num_trees: int = 100, max_samples: int = 256,
                  seed: int = 42, keep: tuple[str, ...] = (), n: int | None = None, oversample: float = 4.0) -> DataFrame:
    """(tree_id, position, keys, ``keep``): per tree the ``max_samples`` rows of the smallest rank, all if fewer.

    A row's rank in a tree is half an MD5 of its key, the seed and the tree pair, so the sample is the
    same on any partitioning and any SQL engine can repeat it; equal ranks are ordered by the keys.
    Keys must identify rows (null: empty text).  A row is copied only to the trees whose rank is
    under a cut that about ``oversample * max_samples`` rows pass; the cut never decides the result, as
    it is widened until every tree has its full sample.  An empty table gives an empty sample.
    """
    keys = list(key_cols)
    columns = list(dict.fromkeys([*keys, *keep]))
    rows = df.select(*columns)
    n = rows.count() if n is None else n
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys], F.lit(str(seed)))
    hashes = F.transform(F.sequence(F.lit(0), F.lit((num_trees - 1) // _RANKS_PER_HASH)),
                         lambda pair: F.md5(F.concat_ws(":", text, pair.cast("string"))))
    halves = F.flatten(F.transform(hashes, lambda h, pair: F.array(*[
        F.struct((pair * _RANKS_PER_HASH + i).alias("tree_id"), F.substring(h, 1 + i * _RANK_DIGITS, _RANK_DIGITS).alias("rank"))
        for i in range(_RANKS_PER_HASH)])))
    full, share = min(max_samples, n), oversample * max_samples / max(n, 1)
    while True:
        # Beyond every hexadecimal number once the whole table is asked for.
        cut = f"{int(share * 16 ** _RANK_DIGITS):0{_RANK_DIGITS}x}" if share < 1 else "g"
        drawn = materialize(rows.withColumn("_at", F.explode(F.filter(
            halves, lambda at: (at["tree_id"] < num_trees) & (at["rank"] < cut)))).select("_at.*", *columns))
        held = drawn.groupBy("tree_id").count().agg(F.count(F.lit(1)).alias("trees"), F.min("count").alias("least")).first()
        if share >= 1 or (held.trees == num_trees and held.least >= full):
            break
        share *= 4
    per_tree = Window.partitionBy("tree_id").orderBy("rank", *keys)
    return (drawn.withColumn("position", F.row_number().over(per_tree)).where(F.col("position") <= max_samples)
            .select("tree_id", "position", *columns))


def isolation_forest(df: DataFrame, features: list[str] | tuple[str, ...] = tuple(ANOMALY_FEATURES),
                     key_cols: tuple[str, ...] = ("event_id",), keep: tuple[str, ...] = ("event_id",),
                     num_trees: int = 100, max_samples: int = 256, contamination: float = 0.05,
                     seed: int = 42, scale: bool = True, exact_threshold: bool = True,
                     oversample: float = 4.0) -> DataFrame:
    """Score every row; adds ``score`` (offset by the contamination cut, < 0 is anomalous),
    ``score_sample`` (−2^(−E[h]/c(psi))) and ``prediction`` (−1 anomaly, 1 normal).

    ``key_cols`` must identify rows uniquely: samples are drawn from their hash, which
    makes the forest independent of partitioning and row order.  Rows are scored from their raw
    features; only the scores are checkpointed, to find the cut.
    """
    features = list(features)
    keep = list(dict.fromkeys([*keep, *key_cols]))
    x_cols = [f"_x{i}" for i in range(len(features))]
    data = df.select(*keep, *[c for c in features if c not in keep]).na.drop(subset=features)
    fit = data.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_samp(f).alias(f) for f in features]).first()
    n = int(fit["n"])
    if n == 0:
        return data.select(*data.columns, *[F.lit(None).cast("double").alias(c) for c in ("score_sample", "score")],
                           F.lit(None).cast("int").alias("prediction"))

    def scaled(f: str) -> F.Column:
        std = fit[f]
        if not scale:
            return F.col(f).cast("double")
        return F.lit(0.0) if not std else F.col(f) / F.lit(float(std))
    vec = data.select(*key_cols, *[scaled(f).alias(x) for f, x in zip(features, x_cols)])
    spark = df.sparkSession
    psi = min(max_samples, n)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    sample = forest_sample(vec, key_cols, num_trees, psi, seed, tuple(x_cols), n, oversample)
    nodes = (sample.groupBy("tree_id")
             .applyInPandas(_tree_builder(max_depth, seed, x_cols), NODE_SCHEMA).collect())
    forest = spark.sparkContext.broadcast(_pack_forest([tuple(r) for r in nodes]))
    out_cols = list(data.columns)
    stds = [fit[f] for f in features] if scale else None

    def score(rows: DataFrame, columns: list[str]) -> DataFrame:
        kind = T.StructType([data.schema[c] for c in columns] + [T.StructField("score_sample", T.DoubleType())])
        return rows.mapInPandas(_scorer(forest, psi, max_depth, columns, features, stds), kind)
    scored = score(data, out_cols)
    if exact_threshold:
        cut = exact_quantile(materialize(score(data.select(*features), [])), "score_sample", contamination)
    else:
        # One aggregate value (a sketch with rank error ≤ 1e-5 · n), applied as a literal.
        cut = scored.agg(F.percentile_approx("score_sample", contamination, 100000)).first()[0]
    decision = F.col("score_sample") - F.lit(cut)
    return scored.withColumn("score", decision).withColumn(
        "prediction", F.when(decision < 0, F.lit(-1)).otherwise(F.lit(1)))


def anomalies(scored: DataFrame) -> DataFrame:
    """Rows labelled anomalous (prediction −1)."""
    return scored.where(F.col("prediction") == -1)


def anomaly_by_feature(scored: DataFrame, features: list[str] | tuple[str, ...] = tuple(ANOMALY_FEATURES),
                       label_col: str = "prediction") -> DataFrame:
    """Per feature and label: rows, min, max, mean (long format via ``unpivot``)."""
    long = scored.unpivot([label_col], list(features), "feature", "value")
    return (long.groupBy("feature", label_col)
            .agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("min"),
                 F.max("value").alias("max"), F.avg("value").alias("mean"))
            .orderBy("feature", label_col))


def feature_series(scored: DataFrame, features: list[str] | tuple[str, ...] = tuple(ANOMALY_FEATURES),
                   width: int = 320, time_col: str = "Time", key_col: str = "event_id",
                   label_col: str = "prediction") -> DataFrame:
    """Line plots of every feature over time, exact at ``width`` pixel columns: per feature, label
    and column the first, last, smallest and largest value and the number of values.

    At most width x features x labels rows, whatever the size.  Rows without time are left out;
    null values are skipped (a column without values has no row); values at one time are ordered
    by key.  All features are aggregated in one pass, with partial results before the shuffle.
    """
    rows = scored.where(F.col(time_col).isNotNull())
    lo, hi = rows.agg(F.min(time_col), F.max(time_col)).first()
    at = F.lit(0) if lo is None else F.call_function("div", (F.col(time_col) - F.lit(lo)) * width, F.lit(hi - lo + 1))

    def points(f: str) -> F.Column:
        value = F.col(f).cast("double")
        place = F.when(value.isNotNull(), F.struct(time_col, key_col))
        return F.struct(F.min_by(value, place).alias("first"), F.max_by(value, place).alias("last"),
                        F.min(value).alias("min"), F.max(value).alias("max"), F.count(value).alias("rows")).alias(f)
    wide = rows.groupBy(label_col, at.cast("int").alias("pixel")).agg(*[points(f) for f in features])
    series = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("p")) for f in features])).alias("s")
    return (wide.select(label_col, "pixel", series).where("s.p.rows > 0")
            .select("s.feature", label_col, "pixel", "s.p.*"))


def kmeans_outliers(df: DataFrame, features: list[str] | tuple[str, ...] = tuple(ANOMALY_FEATURES),
                    keep: tuple[str, ...] = ("event_id",), k: int = 2, seed: int = 1) -> DataFrame:
    """k-means on the raw feature vectors; rows of the smallest cluster are outliers."""
    data = df.select(*keep, *features).na.drop(subset=list(features))
    vec = VectorAssembler(inputCols=list(features), outputCol="features").transform(data)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(vec)
    sizes = model.summary.clusterSizes
    smallest = int(np.argmin(sizes))
    return (model.transform(vec).drop("features")
            .withColumn("is_outlier", F.col("cluster") == smallest))
