"""The rows-only (model) registered queries on the smallest tables, with their invariants."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_model_queries_invariants(spark):
    q = entry.queries()
    cleaned = q["clean_motion"](spark, SF).count()

    scored = q["isolation_forest"](spark, SF).toPandas()
    assert len(scored) == cleaned and scored.event_id.is_unique
    assert abs((scored.prediction == -1).mean() - 0.05) < 0.005

    summary = q["anomaly_by_feature"](spark, SF).collect()
    assert len(summary) == 20 and sum(r.rows for r in summary) == 10 * cleaned

    km = q["kmeans_outliers"](spark, SF).toPandas()
    assert len(km) == cleaned and 0 < km.is_outlier.sum() <= cleaned / 2

    metrics = q["tree_metrics"](spark, SF).first()
    assert metrics.Depth == 10 and 0 <= metrics.Accuracy <= 1 and metrics.Tree.startswith("DecisionTree")
    sweep = q["tree_depth_sweep"](spark, SF).collect()
    assert [r.Depth for r in sweep] == [1, 5, 10]

    bagged = q["bagged_trees"](spark, SF).toPandas()
    joined = q["label_motion_join"](spark, SF).count()
    assert 0 < len(bagged) < joined
    votes = bagged[[f"prediction_{i}" for i in range(5)]]
    assert (bagged.prediction_sum == votes.sum(axis=1)).all()

    nxt = q["next_location"](spark, SF).toPandas()
    assert len(nxt) > 0 and nxt.half_hour_interval.between(0, 47).all()
    assert nxt[["Predicted_Latitude", "Predicted_Longitude"]].notna().all().all()
