import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strider.llm import hard_negatives as hn


def brute(rows, positives=5, negatives=5, low=80, high=100, scale=256):
    """rows: (vec_id, vector, label, anchor); every pair by plain arithmetic."""
    live = {}
    for key, vector, label, anchor in rows:
        if key is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = [math.floor(scale * x) for x in vector]
        if key not in live or (label, q) < live[key][:2]:
            live[key] = (label, q, bool(anchor))
    out = set()
    for a, (label, q, anchor) in live.items():
        if not anchor:
            continue
        scores = {b: sum(x * y for x, y in zip(q, r[1])) for b, r in live.items() if b != a}
        order = sorted(scores, key=lambda b: (-scores[b], b))
        for p in [b for b in order if live[b][0] == label][:positives]:
            fit = [b for b in order if live[b][0] != label and low * scores[p] <= 100 * scores[b] <= high * scores[p]]
            out |= {(a, p, i + 1, b, scores[p], scores[b]) for i, b in enumerate(fit[:negatives])}
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, anchor boolean").repartition(3)


def mined(*args, **kwargs):
    got = [tuple(r) for r in hn.mine(*args, **kwargs).collect()]
    assert len(got) == len(set(got))
    return set(got)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 9), st.integers(1, 20), st.integers(1, 30), st.data())
def test_lookups_equal_products(rows, anchors, width, data):
    rng = np.random.default_rng(data.draw(st.integers(0, 999)))
    size = 1 << data.draw(st.integers(0, 20))
    x, a = rng.integers(-size, size, (rows, width)), rng.integers(-size, size, (anchors, width))
    planes = hn.planes_for(int(min(x.min(), a.min(), 0)), int(max(x.max(), a.max(), 0)))
    packed, held = hn.pack(x, planes), hn.pack(a, planes)
    assert (hn.unpack(packed)[:, :width] == x).all()
    assert (hn.score(packed, hn.subset_sums(hn.unpack(held), np.int64)) == x @ a.T).all()


def test_subset_sums_by_definition():
    a = np.arange(1, 17).reshape(1, 16)
    sums = hn.subset_sums(a, np.int64)
    for g in range(2):
        for byte in (0, 1, 0b10000001, 255, 0b01010101):
            assert sums[g, byte, 0] == sum(a[0, 8 * g + j] for j in range(8) if byte >> j & 1)


@pytest.mark.parametrize("wave", [4096, 3])
def test_equals_all_pairs(spark, wave):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(4, 12)) / 3
    rows = [(int(i), [float(x) for x in centres[i % 4] * 0.5 + rng.normal(size=12) / 8], int(rng.integers(0, 3)), i % 9 == 0)
            for i in range(400)]
    want = brute([(k, [float(np.float32(x)) for x in v], lab, a) for k, v, lab, a in rows])
    assert want and mined(table(spark, rows), wave=wave) == want


def test_ties_copies_and_odd_rows(spark):
    one = [0.5, 0.25, 0.0]
    rows = [(i, one, i % 2, i % 10 == 0) for i in range(60)]          # every score is equal
    rows += [(100, None, 1, True), (101, [0.5, None, 0.1], 1, True), (102, [0.5, float("nan"), 0.1], 1, True),
             (103, [float("inf"), 0.0, 0.0], 1, True), (None, one, 1, True), (104, one, None, True),
             (0, one, 0, True), (0, [0.5, 0.25, 0.25], 0, True),      # a key three times: the smallest stands
             (105, [0.5], 0, None), (106, [], 1, True), (107, [-0.5, -0.25, 0.0], 1, True)]
    assert mined(table(spark, rows)) == brute(
        [(k, v if v is None or len(v) == 3 else v + [0.0] * (3 - len(v)), lab, a) for k, v, lab, a in rows])


def test_a_label_with_most_rows_and_an_anchor_without_positives(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist(), 5 if i % 4 else 1, i % 50 == 0) for i in range(600)]
    rows.append((900, rng.normal(size=8).tolist(), 77, True))
    want = brute([(k, [float(np.float32(x)) for x in v], lab, a) for k, v, lab, a in rows], 3, 2, 50, 120)
    got = mined(table(spark, rows), 3, 2, 50, 120)
    assert got == want and not any(r[0] == 900 for r in got)


def test_empty_tables_clashing_columns_and_large_entries(spark):
    none = table(spark, [])
    assert hn.mine(none).collect() == [] and hn.mine(none).columns == [c.split()[0] for c in hn.RESULT.split(", ")]
    rows = [(i, [0.1 * i, 0.3], i % 2, i == 4) for i in range(8)]
    assert hn.mine(table(spark, [(*r[:3], False) for r in rows])).collect() == []
    more = table(spark, rows).selectExpr("*", "1 AS score", "2 AS slot", "'x' AS packed", "3 AS rank", "4 AS id")
    assert mined(more) == mined(table(spark, rows)) != set()
    with pytest.raises(Exception, match="fit a long|too large"):
        hn.mine(table(spark, [(1, [1e12, 1.0], 1, True)]))
