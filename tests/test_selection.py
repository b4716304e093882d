"""Two-scan selection and plot series against plain Python."""

import random

import numpy as np
import pytest

from strider.operators import quantiles as qs
from strider.operators.anomaly import feature_series


@pytest.mark.parametrize("order", ["rising", "falling", "zigzag"])
def test_bracketed_statistics_in_adverse_orders(spark, order):
    rng = random.Random(7)
    values = sorted([rng.gauss(0, 1) for _ in range(30000)] + [0.25] * 9000 + [float("inf")] * 40 + [-1e300] * 40)
    rows = {"rising": values, "falling": values[::-1], "zigzag": [*values[::2], *values[1::2][::-1]]}[order]
    df = spark.createDataFrame([(v,) for v in [*rows, None, float("nan")]], "v double")
    ks = [0, 39, 40, 1000, 17000, 20000, len(values) - 41, len(values) - 1, len(values)]
    n, got = qs.bracketed_statistics(df, "v", ks, bins=16)
    array = np.array(values)
    assert n == len(values)
    assert got == {k: (values[k], int((array < values[k]).sum())) for k in ks if k < n}


def test_bracketed_statistics_of_whole_numbers_and_empty(spark):
    values = [(1 << 60) + i // 3 for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert qs.bracketed_statistics(df, "v", lambda n: [n // 2]) == (2000, {1000: (values[1000], 999)})
    assert qs.bracketed_statistics(df.limit(0), "v", [0]) == (0, {})


def test_missed_bracket_is_selected_anew(spark, monkeypatch):
    df = spark.range(5000).selectExpr("id AS v")
    monkeypatch.setattr(qs, "_brackets", lambda *a: [(10.0, 20.0)])
    assert qs.bracketed_statistics(df, "v", [4, 15, 3000])[1] == {4: (4, 4), 15: (15, 15), 3000: (3000, 3000)}


def test_input_is_read_twice(spark, tmp_path):
    spark.range(20000).selectExpr("CAST(id * 37 % 20011 AS double) AS v").write.parquet(str(tmp_path / "t"))
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        reads.add(1)
        yield from batches
    df = spark.read.parquet(str(tmp_path / "t")).coalesce(1).mapInArrow(seen, "v double")
    n, got = qs.bracketed_statistics(df, "v", [4000, 16000], bins=8)
    assert n == 20000 and len(got) == 2 and reads.value == 2


def test_feature_series_of_odd_rows(spark):
    rows = [(1, 0, 1.0, None, 1), (2, 0, 3.0, None, 1), (3, 5, None, None, 1), (4, 9, 2.0, 7.0, -1), (5, None, 9.0, 9.0, 1)]
    df = spark.createDataFrame(rows, "event_id long, Time long, a double, b double, prediction int")
    got = sorted(map(tuple, feature_series(df, ["a", "b"], width=2).collect()))
    assert got == [("a", -1, 1, 2.0, 2.0, 2.0, 2.0, 1), ("a", 1, 0, 1.0, 3.0, 1.0, 3.0, 2), ("b", -1, 1, 7.0, 7.0, 7.0, 7.0, 1)]
    assert feature_series(df.limit(0), ["a", "b"]).count() == 0
