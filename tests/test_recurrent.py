import numpy as np
import pytest
from pyspark.sql import functions as F

from strider.operators import recurrent as R
from strider.operators.location import next_location, prediction_error


def sequences(spark, x, y, parts=3):
    rows = [(i, [float(v) for v in a.reshape(-1)], [float(v) for v in b]) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, seq array<double>, target array<double>").repartition(parts)


@pytest.mark.parametrize("steps, inputs, units", [(1, 1, 1), (4, 3, 5), (10, 2, 6)])
def test_gradient_equals_finite_differences(steps, inputs, units):
    rng = np.random.default_rng(steps)
    shape = R.Shape(steps, inputs, units, 2)
    flat = shape.start(1) + rng.normal(size=shape.size()) / 10
    x, y = rng.normal(size=(6, steps, inputs)), rng.normal(size=(6, 2))
    _, grad = R.gradient(shape, flat, x, y)
    for i in range(shape.size()):
        d = np.zeros_like(flat)
        d[i] = 1e-6
        number = (R.gradient(shape, flat + d, x, y)[0] - R.gradient(shape, flat - d, x, y)[0]) / 2e-6
        assert number == pytest.approx(grad[i], abs=2e-6)


@pytest.mark.parametrize("tasks", [2, 100])
def test_tree_of_partial_gradients_equals_one_process(spark, tasks, monkeypatch):
    rng = np.random.default_rng(5)
    shape = R.Shape(5, 2, 4, 2)
    x, y = rng.normal(size=(300, 5, 2)), rng.normal(size=(300, 2))
    loss, grad = R.gradient(shape, shape.start(), x, y)
    rows, got, total = R.total_gradient(sequences(spark, x, y, min(tasks, 40)), shape, shape.start(), tasks)
    assert rows == 300 and got == pytest.approx(loss) and np.allclose(total, grad)


def test_fit_equals_one_process_descent(spark):
    rng = np.random.default_rng(6)
    shape, epochs, batches = R.Shape(3, 1, 3, 2), 2, 3
    x = rng.normal(size=(120, 3, 1))
    y = np.stack([x[:, 0, 0] + x[:, 2, 0], x[:, 1, 0]], axis=1)
    table = sequences(spark, x, y)
    part = dict(table.select("id", F.pmod(F.pmod(F.xxhash64("id"), F.lit(batches * 2)), F.lit(batches))).collect())
    flat, rule = shape.start(), R.Adam(shape.size(), epochs * batches)
    for _ in range(epochs):
        for b in range(batches):
            own = [i for i in range(120) if part[i] == b]
            flat = rule.step(flat, R.gradient(shape, flat, x[own], y[own])[1] / (2 * len(own)))
    for parts in (1, 7):
        got = R.fit(sequences(spark, x, y, parts), shape, ["id"], epochs, batches, tasks=2)
        assert np.allclose(got, flat, atol=1e-9)


def test_descent_learns_and_applies(spark):
    rng = np.random.default_rng(8)
    shape = R.Shape(4, 2, 8, 2)
    x = rng.normal(size=(400, 4, 2))
    y = np.stack([x[:, :, 0].mean(axis=1), x[:, 3, 1]], axis=1)
    history = []
    table = sequences(spark, x, y)
    flat = R.fit(table, shape, ["id"], epochs=12, batches=4, tasks=2, history=history)
    assert history[-1] < 0.35 * history[0]
    got = {r.id: (r.a, r.b) for r in R.apply(table, shape, flat, ["a", "b"]).collect()}
    assert np.allclose([got[i] for i in range(400)], R.predict(shape, flat, x))
    empty = R.apply(table.limit(0), shape, flat, ["a", "b"])
    assert empty.count() == 0 and empty.columns == ["id", "target", "a", "b"]
    assert (R.fit(table.limit(0), shape, ["id"], epochs=1, batches=1, tasks=1) == shape.start()).all()


def positions(spark):
    rows = []
    for user in range(4):
        for i in range(120):
            rows.append((user, i, 1704866400000 + i * 60000, 50.0 + user / 10 + 0.01 * np.sin(i / 3 + user),
                         -0.2 + 0.01 * np.cos(i / 3 + user), float(i) if i % 50 != 7 else None))
    return spark.createDataFrame([(u, u * 1000 + i, t, float(a), float(b), c) for u, i, t, a, b, c in rows],
                                 "user_id long, event_id long, Time long, Latitude double, Longitude double, Altitude double")


def test_next_location_with_extra_inputs(spark):
    table = positions(spark)
    stay = prediction_error(next_location(table, 5, model="stay")).first()
    inputs = ("Altitude", "half_hour_interval", "day_of_week")
    out = next_location(table, 5, model="linear", inputs=inputs)
    lin = prediction_error(out).first()
    assert lin.rows < stay.rows and lin.mean_squared_m < stay.mean_squared_m      # rows without altitude are left out
    recurrent = next_location(table, 5, model="recurrent", inputs=inputs, epochs=4)
    assert recurrent.columns == out.columns and recurrent.count() == lin.rows
    assert {r.half_hour_interval for r in recurrent.collect()} <= set(range(48))
    with pytest.raises(ValueError, match="unknown inputs"):
        next_location(table, 5, inputs=("Speed",))
    with pytest.raises(ValueError, match="unknown model"):
        next_location(table, 5, model="oracle")


def test_stay_is_the_previous_position(spark):
    table = positions(spark)
    got = {r.event_id: r.Predicted_Latitude for r in next_location(table, 3, model="stay").collect()}
    before = {r.event_id + 1: r.Latitude for r in table.collect()}
    assert len(got) == -(-4 * 117 // 5) and all(got[i] == pytest.approx(before[i]) for i in got)


def test_chunks_with_reused_states_add_up():
    rng = np.random.default_rng(9)
    shape = R.Shape(10, 2, 50, 2)
    x = rng.normal(size=(700, 10, 2))
    states = R.States(shape, 512)
    loss, grad = R.gradient(shape, shape.start(), x, x[:, -1])
    parts = [R.gradient(shape, shape.start(), x[at:at + 512], x[at:at + 512, -1], states) for at in (0, 512)]
    assert loss == pytest.approx(sum(p[0] for p in parts)) and np.allclose(grad, parts[0][1] + parts[1][1])


def test_parts_of_a_batch_are_files_of_one_part_each(spark, monkeypatch):
    shape, seen = R.Shape(1, 1, 1, 1), []
    x = np.ones((4000, 1, 1))

    def look(rows, shape, flat, tasks):
        files = rows.select(F.input_file_name().alias("file")).groupBy("file").count().collect()
        seen.append(sorted(r["count"] for r in files))
        return 0, 0.0, np.zeros(shape.size())
    monkeypatch.setattr(R, "total_gradient", look)
    R.fit(sequences(spark, x, x[:, 0]), shape, ["id"], epochs=1, batches=4, tasks=8)
    assert len(seen) == 4 and sum(map(sum, seen)) == 4000
    assert all(len(sizes) == 8 and sizes[-1] < 2 * sizes[0] for sizes in seen)
