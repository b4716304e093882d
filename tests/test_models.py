import numpy as np
from pyspark.sql import functions as F

from strider.operators.activity import (bagged_trees, classification_metrics, hash_split,
                                        metrics_for_depth, poisson_weight, tree_reports)
from strider.operators.anomaly import anomaly_by_feature, average_path_length, build_tree, isolation_forest, kmeans_outliers

SF = "/root/testdata/sf0.001"


def _labelled(spark):
    from strider.operators.clean import clean_motion
    from strider.operators.features import label_motion_join, with_magnitudes
    from strider.sources.bindings import Tables
    t = Tables(spark, SF)
    return with_magnitudes(label_motion_join(t.labels, clean_motion(t.motion)))


def test_metrics_golden(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (1, 1.0), (1, 1.0)], "CoarseLabel int, prediction double")
    r = classification_metrics(df).first()
    assert abs(r.accuracy - 0.75) < 1e-12
    assert abs(r.weighted_precision - 0.8333333333) < 1e-9
    assert abs(r.weighted_recall - 0.75) < 1e-12


def test_hash_split_and_poisson_weights(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    train, test = hash_split(df, ["k"], 0.8, 1234)
    n_train = train.count()
    assert 15500 < n_train < 16500 and n_train + test.count() == 20000
    assert train.repartition(7).count() == n_train
    w = df.select(poisson_weight(["k"], 3).alias("w")).toPandas()["w"].to_numpy()
    assert abs(w.mean() - 1.0) < 0.03 and abs(w.var() - 1.0) < 0.06


def test_tree_reports(spark):
    from strider.schemas import MAGNITUDE_FEATURES
    rep = tree_reports(_labelled(spark), MAGNITUDE_FEATURES, depths=(1, 5), key_cols=("event_id",))
    rows = rep.collect()
    assert [r.Depth for r in rows] == [1, 5]
    for r in rows:
        assert 0.0 <= r.Accuracy <= 1.0 and 0.0 <= r.Precision <= 1.0
    assert rows[1].Accuracy >= rows[0].Accuracy
    assert metrics_for_depth(rep, 5).count() == 1


def test_bagged_trees_deterministic(spark):
    from strider.schemas import AXIS_FEATURES
    df = _labelled(spark)
    a = bagged_trees(df, AXIS_FEATURES, num_trees=3, key_cols=("event_id",), keep=("event_id",))
    b = bagged_trees(df, AXIS_FEATURES, num_trees=3, key_cols=("event_id",), keep=("event_id",))
    assert a.exceptAll(b).count() == 0 and a.count() > 0
    row = a.first()
    votes = [row.prediction_0, row.prediction_1, row.prediction_2]
    assert row.prediction_sum == sum(votes)


def test_isolation_tree_properties():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(256, 3))
    nodes = build_tree(x, rng, 8)
    leaves = [n for n in nodes if n[3] < 0]
    assert len(nodes) <= 511 and len(leaves) == (len(nodes) + 1) // 2
    assert average_path_length([1, 2, 256]).tolist()[:2] == [0.0, 1.0]


def test_isolation_forest_flags_outliers(spark):
    rng = np.random.default_rng(1)
    pts = rng.normal(size=(2000, 3))
    pts[:20] += 12.0                                            # planted outliers
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)],
                               "event_id long, a double, b double, c double")
    scored = isolation_forest(df, ["a", "b", "c"], keep=("event_id", "a", "b", "c"), num_trees=50)
    pdf = scored.toPandas()
    share = (pdf.prediction == -1).mean()
    assert abs(share - 0.05) < 0.002
    assert (pdf.set_index("event_id").loc[list(range(20)), "prediction"] == -1).all()
    again = isolation_forest(df, ["a", "b", "c"], num_trees=50).select("event_id", "score").toPandas()
    assert np.allclose(pdf.sort_values("event_id").score.to_numpy(),
                       again.sort_values("event_id").score.to_numpy())
    summary = anomaly_by_feature(scored, ["a", "b", "c"]).collect()
    assert len(summary) == 6
    outl = kmeans_outliers(df, ["a", "b", "c"]).where(F.col("is_outlier")).count()
    assert 0 < outl <= 1000


def test_model_outputs_do_not_depend_on_partitioning(spark):
    """Recomputed partitions (e.g. after an executor loss) must give the same rows."""
    rng = np.random.default_rng(2)
    pts = rng.normal(size=(1500, 3))
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)],
                               "event_id long, a double, b double, c double")
    a = isolation_forest(df.repartition(3), ["a", "b", "c"], num_trees=20).select("event_id", "score", "prediction")
    b = isolation_forest(df.repartition(11), ["a", "b", "c"], num_trees=20).select("event_id", "score", "prediction")
    assert a.exceptAll(b).count() == 0
    w = [r.w for r in df.repartition(5).select("event_id", poisson_weight(["event_id"], 1).alias("w"))
         .orderBy("event_id").collect()]
    w2 = [r.w for r in df.select("event_id", poisson_weight(["event_id"], 1).alias("w"))
          .orderBy("event_id").collect()]
    assert w == w2


def test_one_pass_metrics_equal_spark_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    from strider.operators.activity import _assemble, fit_tree
    from strider.schemas import MAGNITUDE_FEATURES
    data = _assemble(_labelled(spark), MAGNITUDE_FEATURES)
    train, test = hash_split(data, ["event_id"])
    pred = fit_tree(train, "CoarseLabel", 4).transform(test).cache()
    mine = classification_metrics(pred).first()
    for metric, col in (("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"),
                        ("weightedRecall", "weighted_recall")):
        ev = MulticlassClassificationEvaluator(labelCol="CoarseLabel", predictionCol="prediction",
                                               metricName=metric).evaluate(pred)
        assert abs(ev - mine[col]) < 1e-12, metric
    pred.unpersist()


def test_isolation_forest_approximate_cut(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(3000, 2))
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "event_id long, a double, b double")
    exact = isolation_forest(df, ["a", "b"], num_trees=30).select("event_id", "score_sample", "prediction")
    approx = isolation_forest(df, ["a", "b"], num_trees=30, exact_threshold=False).select("event_id", "score_sample", "prediction")
    e, a = exact.toPandas().sort_values("event_id"), approx.toPandas().sort_values("event_id")
    assert np.allclose(e.score_sample.to_numpy(), a.score_sample.to_numpy())   # same forest
    assert abs((a.prediction == -1).mean() - 0.05) < 0.002
    offset = np.percentile(e.score_sample.to_numpy(), 5)          # the offset of the reference's library
    assert ((e.score_sample - offset) < 0).sum() == (e.prediction == -1).sum()


def test_tree_beats_majority_class(spark):
    from strider.schemas import MAGNITUDE_FEATURES
    df = _labelled(spark)
    majority = df.groupBy("CoarseLabel").count().agg(F.max("count")).first()[0] / df.count()
    rep = tree_reports(df, MAGNITUDE_FEATURES, depths=(5,), key_cols=("event_id",)).first()
    assert rep.Accuracy > majority


def test_vectorised_scoring_equals_naive_traversal():
    import pandas as pd

    from strider.operators.anomaly import _pack_forest, _scorer
    rng = np.random.default_rng(8)
    trees = []
    for t in range(7):
        sample = rng.normal(size=(64, 3))
        trees += [(t, *row) for row in build_tree(sample, np.random.default_rng([1, t]), 6)]
    forest = _pack_forest(trees)

    class Value:                     # stands in for a broadcast variable
        value = forest
    x = rng.normal(size=(300, 3)) * 2
    pdf = pd.DataFrame({"event_id": range(300), **{f"_x{i}": x[:, i] for i in range(3)}})
    scored = next(_scorer(Value, 64, 6, ["event_id"], ["_x0", "_x1", "_x2"])(iter([pdf])))

    by_tree = {}
    for t, node, feat, thr, left, right, path in trees:
        by_tree.setdefault(t, {})[node] = (feat, thr, left, right, path)
    c = average_path_length([64])[0]
    for i in range(300):
        depths = []
        for nodes in by_tree.values():
            n = 0
            while nodes[n][2] >= 0:
                feat, thr, left, right, _ = nodes[n]
                n = left if x[i, feat] <= thr else right
            depths.append(nodes[n][4])
        assert abs(scored.score_sample.iloc[i] - (-2.0 ** (-np.mean(depths) / c))) < 1e-12


def test_leaf_paths_are_depth_plus_expected_remainder():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(256, 4))
    x[:40] = 0.5                                             # duplicated points end in deep leaves
    nodes = {r[0]: r[1:] for r in build_tree(x, np.random.default_rng(11), 8)}
    arrivals: dict[int, list[int]] = {}
    for i in range(len(x)):
        n, depth = 0, 0
        while nodes[n][2] >= 0:
            feat, thr, left, right, _ = nodes[n]
            n = left if x[i, feat] <= thr else right
            depth += 1
        arrivals.setdefault(n, []).append(depth)
    assert sum(len(v) for v in arrivals.values()) == 256
    for leaf, depths in arrivals.items():
        assert len(set(depths)) == 1 and depths[0] <= 8
        assert abs(nodes[leaf][4] - (depths[0] + average_path_length([len(depths)])[0])) < 1e-12
