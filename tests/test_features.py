import random

import numpy as np

from strider.operators.features import chronological_split, lag_sequences
from strider.operators.quantiles import exact_quantile, histogram, kth_row, kth_smallest


def test_sequences_golden(spark):
    df = spark.createDataFrame([(1, i, i, float(i)) for i in range(13)],
                               "user_id long, event_id long, Time long, x double")
    for block, per_part in ((None, 1), (1 << 20, 1 << 22), (10, 4), (11, 5)):
        out = sorted(lag_sequences(df, ["x"], n=10, block_rows=block, rows_per_partition=per_part).collect(),
                     key=lambda r: r.Time)
        assert [r.Time for r in out] == [10, 11, 12]
        assert [out[0][f"x_lag{j}"] for j in range(10, 0, -1)] == [float(v) for v in range(10)]
        assert [out[2][f"x_lag{j}"] for j in range(10, 0, -1)] == [float(v) for v in range(2, 12)]


def test_blocked_sequences_equal_single_window_with_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    for e in range(3000):
        user = 0 if rnd.random() < 0.6 else rnd.randint(1, 20)      # user 0 is hot
        t = 5000 if rnd.random() < 0.33 else rnd.randint(0, 40) * 1000   # one hot timestamp
        rows.append((user, e, t, rnd.random()))
    df = spark.createDataFrame(rows, "user_id long, event_id long, Time long, x double")
    ref = lag_sequences(df, ["x"], n=4, block_rows=None)
    for block, per_part in ((7, 100), (50, 333), (1000, 1 << 22)):
        got = lag_sequences(df, ["x"], n=4, block_rows=block, rows_per_partition=per_part)
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_kth_smallest_matches_numpy(spark):
    rnd = np.random.default_rng(3)
    vals = np.concatenate([rnd.normal(size=3000), np.full(1500, 0.25), rnd.integers(0, 5, 500)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    s = np.sort(vals)
    for k in (0, 1, 777, 2500, 4999):
        assert kth_smallest(df, "v", k, bins=8) == s[k]
    assert kth_smallest(df, "v", 5000) is None
    for p in (0.05, 0.5, 0.99):
        assert abs(exact_quantile(df, "v", p, bins=16) - np.percentile(vals, 100 * p)) < 1e-12


def test_chronological_split_matches_row_order(spark):
    rnd = random.Random(5)
    rows = [(e, rnd.randint(0, 30)) for e in range(517)]
    df = spark.createDataFrame(rows, "event_id long, Time long")
    got = {r.event_id: r.split for r in chronological_split(df, 0.8).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    k = int(0.8 * len(rows))
    want = {e: ("train" if i < k else "test") for i, (e, _) in enumerate(order)}
    assert got == want
    assert kth_row(df, ["Time", "event_id"], k) == (order[k][1], order[k][0])


def test_histogram_golden(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.1, 0.2, 9.9, 10.0)], "v double")
    h = {r.bin: r["count"] for r in histogram(df, "v", 50).collect()}
    assert len(h) == 50 and h[1] == 2 and h[2] == 1 and h[50] == 2 and sum(h.values()) == 5


def test_zscores_and_half_hour(spark):
    from strider.operators.features import half_hour_features, zscores
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 2.0)], "event_id long, Latitude double, Longitude double")
    z, _ = zscores(df, ("Latitude",), keep=("event_id",))
    assert sorted(r.Latitude_z for r in z.collect()) == [-1.0, 1.0]
    hh = half_hour_features(spark.createDataFrame([(1488328200000,)], "Time long")).first()
    assert (hh.hour, hh.minute, hh.half_hour_interval, hh.day_of_week) == (0, 30, 1, 3)


def test_order_statistics_with_ties_and_small_bands(spark):
    from strider.operators.quantiles import order_statistics
    rnd = random.Random(9)
    rows = [(e, rnd.choice([1, 2, 2, 3, 7, 7, 7, 11]) * 1000 + rnd.randint(0, 3)) for e in range(2000)]
    df = spark.createDataFrame(rows, "event_id long, Time long")
    times = sorted(t for _, t in rows)
    ks = [0, 1, 999, 1000, 1500, 1999]
    n, stats = order_statistics(df, "Time", ks, bins=4)
    assert n == 2000
    for k in ks:
        value, n_less = stats[k]
        assert value == times[k] and n_less == times.index(value)
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    for k in (0, 733, 1999):
        assert kth_row(df, ["Time", "event_id"], k, bins=4) == (order[k][1], order[k][0])


def test_scaling_equals_spark_ml_standard_scaler(spark):
    from strider.operators.clean import clean_motion
    from strider.operators.features import scale_features, scale_features_ml
    from strider.schemas import ANOMALY_FEATURES
    from strider.sources.bindings import Tables
    motion = clean_motion(Tables(spark, "/root/testdata/sf0.001").motion)
    mine = scale_features(motion, ANOMALY_FEATURES, keep=("event_id",)).toPandas().sort_values("event_id")
    ml = scale_features_ml(motion, ANOMALY_FEATURES, keep=("event_id",)).toPandas().sort_values("event_id")
    assert len(mine) == len(ml) > 0
    for c in ANOMALY_FEATURES:
        assert np.allclose(mine[c].to_numpy(), ml[c].to_numpy(), rtol=1e-12, atol=1e-12), c


def test_order_statistics_of_extreme_values(spark):
    from strider.operators.quantiles import order_statistics
    longs = [(1 << 60) + i for i in range(100)] + [-(1 << 63), (1 << 63) - 1] + [5] * 300
    doubles = [float("-inf"), float("inf"), float("inf"), -1.7e308, 1.7e308, 5e-324, 0.0, 1.0, 1.0 + 2 ** -52] + [2.5] * 50
    for kind, values in (("long", longs), ("double", doubles)):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        ranked = sorted(values)
        ks = list(range(0, len(values), 7)) + [len(values) - 1]
        n, got = order_statistics(df, "v", ks, bins=10)
        assert n == len(values)
        assert {k: got[k] for k in ks} == {k: (ranked[k], ranked.index(ranked[k])) for k in ks}


def test_zscores_of_constant_null_and_nan(spark):
    from strider.operators.features import unscale, zscores
    rows = [(1, 1.0, 7.0), (2, 3.0, 7.0), (3, None, 7.0), (4, float("nan"), 7.0)]
    z, fit = zscores(spark.createDataFrame(rows, "event_id long, a double, b double"), ("a", "b"), keep=("event_id",))
    got = {r.event_id: (r.a_z, r.b_z) for r in z.collect()}
    assert got == {1: (-1.0, 0.0), 2: (1.0, 0.0)}
    assert {r[0] for r in z.select(unscale(z["b_z"], fit, "b")).collect()} == {7.0}
