"""Samples of the isolation forest: exactly k smallest ranks per tree, whatever the cut and partitions."""

import hashlib

from strider.operators.anomaly import forest_sample


def _want(keys, trees, k, seed=42):
    out = set()
    for t in range(trees):
        rank = {x: hashlib.md5(f"{x}:{seed}:{t // 2}".encode()).hexdigest()[16 * (t % 2):][:16] for x in keys}
        out |= {(t, i + 1, x) for i, x in enumerate(sorted(keys, key=lambda x: (rank[x], x))[:k])}
    return out


def _got(sample):
    return {tuple(r) for r in sample.collect()}


def test_smallest_ranks_of_every_tree(spark):
    df = spark.range(700).withColumnRenamed("id", "event_id")
    want = _want(range(700), 5, 20)
    assert _got(forest_sample(df, num_trees=5, max_samples=20)) == want
    assert _got(forest_sample(df.repartition(9), num_trees=5, max_samples=20)) == want


def test_a_cut_too_low_is_widened(spark):
    df = spark.range(400).withColumnRenamed("id", "event_id")
    assert _got(forest_sample(df, num_trees=4, max_samples=30, oversample=0.1)) == _want(range(400), 4, 30)


def test_few_rows_and_none(spark):
    df = spark.range(3).withColumnRenamed("id", "event_id")
    assert _got(forest_sample(df, num_trees=3, max_samples=8)) == _want(range(3), 3, 8)
    assert forest_sample(df.limit(0), num_trees=3, max_samples=8).count() == 0


def test_carries_columns(spark):
    df = spark.createDataFrame([(i, i * 0.5, "x") for i in range(40)], "event_id long, v double, other string")
    sample = forest_sample(df, num_trees=2, max_samples=5, keep=("v",))
    assert sample.columns == ["tree_id", "position", "event_id", "v"]
    assert all(r.v == r.event_id * 0.5 for r in sample.collect())
