"""The histogram tree against a plain recursive one, its ties, odd rows and order independence."""

import random

import pytest
from pyspark.sql import functions as F

from strider.operators.activity import metrics_for_depth
from strider.operators.histogram_tree import best_cuts, depth_sweep, fitted

FEATURES = ("a", "b")
KIND = "k long, a double, b double, y int"


def _rows(n, seed=5):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        a, b = rnd.randrange(40) / 4, rnd.choice([0.0, 1.5, 3.0, 9.0])
        out.append((k, a, b, (2 if a > 6 else 1) if b > 1 else (0 if a < 2 else rnd.randrange(3))))
    return out


def _fit(spark, rows, depth=3, parts=4, **kw):
    df = spark.createDataFrame(rows, KIND).repartition(parts)
    return fitted(df, FEATURES, "y", depth, ("k",), **kw)


def _plain(cells, depth, node=1):
    """node → (feature, cut, rows, label) by trying every cut of every feature."""
    total = sum(n for _, _, n in cells)
    count = lambda part: {y: sum(n for _, l, n in part if l == y) for y in {l for _, l, _ in part}}
    squares = lambda part: sum(v * v for v in count(part).values())
    label = min(count(cells).items(), key=lambda kv: (-kv[1], kv[0]))[0]
    best = None
    for f in range(len(FEATURES)):
        for cut in sorted({c[0][f] for c in cells})[:-1]:
            left, right = [c for c in cells if c[0][f] <= cut], [c for c in cells if c[0][f] > cut]
            score = (squares(left) / sum(c[2] for c in left)) + (squares(right) / sum(c[2] for c in right))
            if best is None or score > best[0]:
                best = (score, f, cut, left, right)
    if not depth or best is None or best[0] - squares(cells) / total <= 1e-9 * total:
        return {node: (-1, 0, total, label)}
    _, f, cut, left, right = best
    return {node: (f, cut, total, label), **_plain(left, depth - 1, 2 * node), **_plain(right, depth - 1, 2 * node + 1)}


@pytest.mark.parametrize("depth", [0, 1, 4])
def test_tree_equals_plain_search(spark, depth):
    model, cells = _fit(spark, _rows(400), depth)
    train = [(tuple(r.bins), r.label, r.n) for r in cells.where("train").collect()]
    found = {i: (model.split[i], model.cut[i], model.rows[i], model.label[i]) for i, n in enumerate(model.rows) if n}
    assert found == _plain(train, depth)


def test_partitioning_and_order_do_not_matter(spark):
    rows = _rows(300)
    assert _fit(spark, rows, parts=3)[0] == _fit(spark, rows[::-1], parts=11)[0]


def test_shallow_trees_are_the_deep_one_cut(spark):
    rows = _rows(400)
    deep, cells = _fit(spark, rows, 4)
    shallow, own = _fit(spark, rows, 2)
    both = depth_sweep(deep, cells, (1, 2, 4))
    assert metrics_for_depth(both, 2).first() == depth_sweep(shallow, own, (2,)).first()
    test = spark.createDataFrame(rows, KIND)
    assert deep.predict(test, 2).exceptAll(shallow.predict(test)).count() == 0


def test_metrics_count_test_rows(spark):
    from strider.operators.activity import classification_metrics, hash_split
    rows = spark.createDataFrame(_rows(500), KIND)
    model, cells = fitted(rows, FEATURES, "y", 3, ("k",))
    want = classification_metrics(model.predict(hash_split(rows, ("k",))[1]), "y").first()
    got = depth_sweep(model, cells, (3,)).first()
    assert (got.Accuracy, got.Recall) == (want.accuracy, pytest.approx(want.weighted_recall))
    assert got.Precision == pytest.approx(want.weighted_precision)


def test_ties_take_the_lowest(spark):
    counts = spark.createDataFrame([(1, f, b, b, 5) for f in (1, 0) for b in (0, 1)], "node int, f int, bin int, label int, n long")
    assert [tuple(r) for r in best_cuts(counts).collect()] == [(1, 0, 0)]


def test_large_counts_stay_exact(spark):
    big = 10 ** 12
    counts = spark.createDataFrame([(1, 0, 0, 0, big), (1, 0, 1, 1, big), (1, 0, 2, 1, 1)], "node int, f int, bin int, label int, n long")
    assert [tuple(r) for r in best_cuts(counts).collect()] == [(1, 0, 0)]


def test_odd_rows_take_no_part(spark):
    rows, odd = _rows(200), [(1000, None, 1.0, 1), (1001, float("nan"), 1.0, 1), (1002, 1.0, float("inf"), 0), (1003, 1.0, 1.0, None)]
    model, cells = _fit(spark, rows + odd)
    assert model == _fit(spark, rows)[0] and cells.agg(F.sum("n")).first()[0] == 200
    assert model.predict(spark.createDataFrame(odd[:2], KIND)).where("prediction IS NULL").count() == 2


def test_empty_constant_and_single_label(spark):
    assert _fit(spark, []) is None
    constant = _fit(spark, [(k, 1.0, 2.0, k % 2) for k in range(50)])[0]
    pure = _fit(spark, [(k, float(k), 2.0, 7) for k in range(50)])[0]
    assert [n for n, c in enumerate(constant.rows) if c] == [n for n, c in enumerate(pure.rows) if c] == [1]
    assert pure.label[1] == 7 and pure.text() == "Predict: 7\n"
    assert pure.nodes(spark).first().feature is None


def test_repeated_rows_are_one_cell(spark):
    model, cells = _fit(spark, [(k, 1.0, 2.0, 0) for k in range(3000)] + _rows(50))
    assert cells.count() < 120 and cells.agg(F.sum("n")).first()[0] == 3050
