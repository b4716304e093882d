import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strider.llm import whitening as wh
from strider.llm.queries import QUERIES


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def brute(rows, keep=16):
    """Entries, exact deviations and numpy's components of the distinct vectors."""
    live = [(k, [math.floor(64 * float(np.float32(x))) + 1_000_000 for x in v]) for k, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    distinct = sorted({tuple(v) for _, v in live})
    n, width = len(distinct), len(distinct[0])
    sums = [sum(v[d] for v in distinct) for d in range(width)]
    cov = np.array([[float(Fraction(n * sum(v[i] * v[j] for v in distinct) - sums[i] * sums[j], n * n))
                     for j in range(width)] for i in range(width)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:keep], vectors[:, ::-1][:, :keep]
    deviation = {k: sum((n * x - s) ** 2 for x, s in zip(v, sums)) for k, v in live}
    white = {k: np.array([float(Fraction(n * x - s, n)) for x, s in zip(v, sums)]) @ vectors / np.sqrt(values) for k, v in live}
    return n, deviation, white, values / np.trace(cov)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 200), st.integers(1, 7), st.integers(0, 40), st.integers(0, 999))
def test_cross_products_are_exact(rows, width, bits, seed):
    values = np.random.default_rng(seed).integers(0, 1 << bits, (rows, width), endpoint=True)
    got = wh.cross_products(values)
    big = values.astype(object)
    assert (np.triu(got) == np.triu(big.T @ big)).all()


def test_planes_hold_one_bit_of_sixty_four_rows():
    values = np.array([[5, 0], [2, 0], [1, 8]] * 30)
    planes, names = wh.bit_slices(values)
    assert names == [(0, 0), (0, 1), (0, 2), (1, 3)] and planes.shape == (4, 2)
    for p, (d, b) in zip(planes, names):
        bits = [int(p[r // 64]) >> r % 64 & 1 for r in range(90)]
        assert bits == [int(v) >> b & 1 for v in values[:, d]]


@pytest.mark.parametrize("width", [20, 5])
def test_equals_plain_arithmetic(spark, width):
    rng = np.random.default_rng(width)
    base = rng.normal(size=(300, width)) @ rng.normal(size=(width, width)) / 9
    rows = [(i, [float(x) for x in base[i % 300]]) for i in range(420)]        # 120 copies
    n, deviation, white, share = brute(rows)
    got = wh.whiten(table(spark, rows)).collect()
    keep = min(16, width)
    assert len(got) == 420 * keep and {r.n for r in got} == {n} and n <= 300
    signs = {}
    for r in got:
        assert r.deviation == deviation[r.vec_id]
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9
        want = white[r.vec_id][r.component - 1]
        if abs(want) > 1e-6:
            signs.setdefault(r.component, set()).add(r.whitened * want > 0)
        assert abs(abs(r.whitened) - abs(want)) < 1e-6
    assert all(len(s) == 1 for s in signs.values())
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_odd_rows(spark):
    rows = [(1, [0.1, 0.9]), (2, None), (3, [0.5, None]), (4, [float("nan"), 0.2]), (5, [float("-inf"), 0.2]),
            (None, [0.7, 0.1]), (1, [0.1, 0.9]), (6, [0.3]), (7, [])]
    got = wh.whiten(table(spark, rows)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted(
        (k, c) for k in (0, 1, 1, 6, 7) for c in (1, 2))
    assert {r.n for r in got} == {4}                       # of six rows that take part, shorter ones end in zeros
    assert all(r.whitened is not None for r in got) and got[0].identity_error < 1e-9


def test_no_variance_empty_table_and_clashing_columns(spark):
    got = wh.whiten(table(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect()
    assert len(got) == 4 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None
                                 and r.identity_error is None for r in got)
    line = wh.whiten(table(spark, [(i, [i / 8, i / 4, 0.0]) for i in range(9)])).collect()
    assert {r.component for r in line if r.whitened is None} == {2, 3}
    assert wh.whiten(table(spark, [])).collect() == [] and wh.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    rows = table(spark, [(i, [i / 8, (i * i % 5) / 4]) for i in range(9)])
    more = rows.selectExpr("*", "1 AS x", "2 AS component", "3 AS n", "'a' AS whitened")
    key = lambda r: (r.vec_id, r.component)
    assert sorted(wh.whiten(more).collect(), key=key) == sorted(wh.whiten(rows).collect(), key=key)
    with pytest.raises(Exception, match="too wide|too large"):
        wh.whiten(table(spark, [(1, [1e15, 0.0]), (2, [-1e15, 0.0])])).collect()


def test_deviation_beyond_a_long_is_null(spark):
    wide = float(2 ** 40)
    got = wh.whiten(table(spark, [(1, [wide] * 3), (2, [-wide] * 3), (3, [0.0] * 3)])).collect()
    assert {r.vec_id: r.deviation for r in got}[1] is None and {r.vec_id: r.deviation for r in got}[3] == 0


def test_registered_query_on_whole_table(spark):
    base = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{base}/embeddings.parquet").collect()]
    n, deviation, white, share = brute(rows)
    got = QUERIES["op13_whitening"](spark, base).collect()
    assert len(got) == 16 * len(rows) and {r.n for r in got} == {n}
    assert all(r.deviation == deviation[r.vec_id] for r in got)
    assert all(abs(abs(r.whitened) - abs(white[r.vec_id][r.component - 1])) < 1e-6 for r in got)
