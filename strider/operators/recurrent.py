"""A recurrent next-value model fitted by synchronous data-parallel gradient descent.

One layer of long short-term memory cells (sigmoid gates, rectified candidate and output) and a
linear output, squared loss, Adam.  The sequences are written once, dealt to ``batches`` parts
by a key hash.  A step reads one part: every task adds up the gradient of its rows, the
gradients are summed in a tree on the executors, and the driver moves the parameters, whose
size depends on the cell and the inputs only.  An epoch is one pass over all parts, so its cost
is one forward and backward pass over the data on all cores.

A lost executor only repeats its tasks' partial sums; which rows form a step is fixed by their
keys, not by their place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strider.session import dropped, staged_path

# Units and epochs of the model that is matched.
UNITS, EPOCHS = 50, 10
BATCHES, RATE, CLIP, SEED = 16, 0.01, 1.0, 42
#: Rows whose intermediate states a task holds at once; gradients added per task of the tree.
CHUNK, FAN_IN = 512, 32


@dataclass(frozen=True)
class Shape:
    """Sizes that fix the layout of the parameter vector."""
    steps: int
    inputs: int
    units: int
    outputs: int

    def parts(self) -> list[tuple[int, ...]]:
        return [(self.inputs, 4 * self.units), (self.units, 4 * self.units), (4 * self.units,),
                (self.units, self.outputs), (self.outputs,)]

    def size(self) -> int:
        return sum(int(np.prod(p)) for p in self.parts())

    def unpack(self, flat: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for p in self.parts():
            n = int(np.prod(p))
            out.append(flat[at:at + n].reshape(p))
            at += n
        return out

    def start(self, seed: int = SEED) -> np.ndarray:
        """Uniform input and output weights, orthogonal recurrent ones, open forget gates."""
        rng = np.random.default_rng(seed)

        def uniform(shape: tuple[int, int]) -> np.ndarray:
            edge = np.sqrt(6.0 / sum(shape))
            return rng.uniform(-edge, edge, shape)
        wide = np.linalg.qr(rng.normal(size=(4 * self.units, self.units)))[0].T
        bias = np.zeros(4 * self.units)
        bias[self.units:2 * self.units] = 1.0
        parts = [uniform((self.inputs, 4 * self.units)), wide, bias, uniform((self.units, self.outputs)), np.zeros(self.outputs)]
        return np.concatenate([p.reshape(-1) for p in parts])


class States:
    """Gates and states of every step of ``rows`` sequences, one column per sequence, kept for the next chunk."""

    def __init__(self, shape: Shape, rows: int):
        u, s = shape.units, shape.steps
        self.rows = rows
        self.fed = np.zeros((s + 1, u + shape.inputs + 1, rows))        # output before the step, input, 1
        self.fed[:, -1] = 1.0
        self.gates = np.empty((s, 4 * u, rows))                         # input, forget, output, candidate
        self.cell = np.zeros((s + 1, u, rows))
        self.live = np.empty((s, u, rows))
        self.d_gates = np.empty((4 * u, rows))
        self.slope = np.empty((3 * u, rows))
        self.part = np.empty((u, rows))


def _weights(shape: Shape, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the gates in ``States``, weights of a step as one matrix in that order)."""
    wx, wh, b, _, _ = shape.unpack(flat)
    u = shape.units
    order = np.r_[0:2 * u, 3 * u:4 * u, 2 * u:3 * u]
    return order, np.concatenate([wh, wx, b[None]]).T[order]


def _forward(shape: Shape, flat: np.ndarray, x: np.ndarray, states: States) -> np.ndarray:
    """Outputs (outputs, rows) of sequences ``x`` (rows, steps, inputs); ``states`` gets every step."""
    u = shape.units
    weights = _weights(shape, flat)[1]
    weights[:3 * u] *= -1.0                                                   # a sigmoid takes minus its input
    states.fed[:-1, u:-1] = x.transpose(1, 2, 0)
    for t in range(shape.steps):
        gates, after = states.gates[t], states.cell[t + 1]
        np.dot(weights, states.fed[t], out=gates)
        opened, candidate = gates[:3 * u], gates[3 * u:]
        np.minimum(opened, 40.0, out=opened)
        np.exp(opened, out=opened)
        opened += 1.0
        np.reciprocal(opened, out=opened)
        np.maximum(candidate, 0.0, out=candidate)
        np.multiply(opened[u:2 * u], states.cell[t], out=after)
        np.multiply(opened[:u], candidate, out=states.part)
        after += states.part
        np.maximum(after, 0.0, out=states.live[t])
        np.multiply(opened[2 * u:], states.live[t], out=states.fed[t + 1, :u])
    _, _, _, wo, bo = shape.unpack(flat)
    return wo.T @ states.fed[-1, :u] + bo[:, None]


def predict(shape: Shape, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), shape.outputs))
    states = None
    for at in range(0, len(x), CHUNK):
        part = x[at:at + CHUNK]
        if states is None or states.rows != len(part):
            states = States(shape, len(part))
        out[at:at + CHUNK] = _forward(shape, flat, part, states).T
    return out


def gradient(shape: Shape, flat: np.ndarray, x: np.ndarray, y: np.ndarray,
             states: States | None = None) -> tuple[float, np.ndarray]:
    """Sum over rows and outputs of the squared error, and its gradient; ``states`` are reused."""
    if states is None or states.rows != len(x):
        states = States(shape, len(x))
    u = shape.units
    order, weights = _weights(shape, flat)
    wo = shape.unpack(flat)[3]
    back = np.ascontiguousarray(weights[:, :u].T)
    error = _forward(shape, flat, x, states) - y.T
    d_out = error + error
    g_wo, g_bo = states.fed[-1, :u] @ d_out.T, d_out.sum(axis=1)
    d_h, d_c = wo @ d_out, np.zeros((u, len(x)))
    g_weights = np.zeros(weights.shape)
    d_gates, slope, part = states.d_gates, states.slope, states.part
    for t in range(shape.steps - 1, -1, -1):
        gates, live = states.gates[t], states.live[t]
        opened, candidate = gates[:3 * u], gates[3 * u:]
        np.multiply(d_h, opened[2 * u:], out=part)
        part *= live > 0
        d_c += part
        np.multiply(d_c, candidate, out=d_gates[:u])
        np.multiply(d_c, states.cell[t], out=d_gates[u:2 * u])
        np.multiply(d_h, live, out=d_gates[2 * u:3 * u])
        np.subtract(1.0, opened, out=slope)
        slope *= opened
        d_gates[:3 * u] *= slope
        np.multiply(d_c, opened[:u], out=d_gates[3 * u:])
        d_gates[3 * u:] *= candidate > 0
        g_weights += d_gates @ states.fed[t].T
        if t:
            d_h = back @ d_gates
            d_c *= opened[u:2 * u]
    g = np.empty(weights.shape)
    g[order] = g_weights
    parts = (g[:, u:-1].T, g[:, :u].T, g[:, -1], g_wo, g_bo)
    return float((error ** 2).sum()), np.concatenate([p.reshape(-1) for p in parts])


class Adam:
    """Steps with falling rate: half a cosine from ``rate`` to zero over ``steps`` steps."""

    def __init__(self, size: int, steps: int, rate: float = RATE, clip: float = CLIP):
        self.rate, self.steps, self.clip, self.step_no = rate, max(1, steps), clip, 0
        self.mean, self.square = np.zeros(size), np.zeros(size)

    def step(self, flat: np.ndarray, grad: np.ndarray) -> np.ndarray:
        norm = float(np.linalg.norm(grad))
        grad = grad * min(1.0, self.clip / norm) if norm else grad
        rate = self.rate * 0.5 * (1 + np.cos(np.pi * self.step_no / self.steps))
        self.step_no += 1
        self.mean = 0.9 * self.mean + 0.1 * grad
        self.square = 0.999 * self.square + 0.001 * grad * grad
        mean, square = self.mean / (1 - 0.9 ** self.step_no), self.square / (1 - 0.999 ** self.step_no)
        return flat - rate * mean / (np.sqrt(square) + 1e-8)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _partial(shape: Shape, flat: np.ndarray):
    """Per task: (rows, loss, gradient) of its sequences, one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, loss, grad = 0, 0.0, np.zeros(shape.size())
        whole = States(shape, CHUNK)
        for batch in batches:
            x = _matrix(batch.column(0), shape.steps * shape.inputs).reshape(-1, shape.steps, shape.inputs)
            y = _matrix(batch.column(1), shape.outputs)
            for at in range(0, len(x), CHUNK):
                part, own = gradient(shape, flat, x[at:at + CHUNK], y[at:at + CHUNK], whole)
                loss, grad = loss + part, grad + own
            rows += len(x)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([loss]), pa.array([grad])],
                                             names=["rows", "loss", "grad"])
    return run


PARTIAL = "rows long, loss double, grad array<double>"


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, loss, grad = 0, 0.0, None
    for batch in batches:
        for r, part, own in zip(*(c.to_pylist() for c in batch.columns)):
            rows, loss = rows + r, loss + part
            grad = np.array(own) if grad is None else grad + own
    if grad is not None:
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([loss]), pa.array([grad])],
                                         names=["rows", "loss", "grad"])


def total_gradient(sequences: DataFrame, shape: Shape, flat: np.ndarray, tasks: int) -> tuple[int, float, np.ndarray]:
    """(rows, loss, gradient) summed over ``sequences`` (seq, target): a tree of partial sums, so
    that at most ``FAN_IN`` gradients reach the driver or any other task."""
    sums = sequences.select("seq", "target").mapInArrow(_partial(shape, flat), PARTIAL)
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        sums = sums.repartition(tasks).mapInArrow(_added, PARTIAL)
    rows, loss, grad = 0, 0.0, np.zeros(shape.size())
    for r in sums.collect():
        rows, loss, grad = rows + r.rows, loss + r.loss, grad + np.array(r.grad)
    return rows, loss, grad


def fit(sequences: DataFrame, shape: Shape, key_cols: list[str] | tuple[str, ...], epochs: int = EPOCHS,
        batches: int = BATCHES, rate: float = RATE, seed: int = SEED, tasks: int | None = None,
        history: list[float] | None = None) -> np.ndarray:
    """Parameters fitted to ``sequences`` (key_cols, seq array<double>, target array<double>).

    ``tasks`` files per step (default: the cores of the session).  ``history`` gets the mean
    squared error of every epoch.  Without rows the start parameters come back.
    """
    spark = sequences.sparkSession
    tasks = tasks or max(1, spark.sparkContext.defaultParallelism)
    flat, rule = shape.start(seed), Adam(shape.size(), epochs * batches, rate)
    path = staged_path(spark, "sequences")
    part = F.pmod(F.xxhash64(*key_cols), F.lit(batches * tasks))
    dealt = sequences.select("seq", "target", (part % batches).cast("int").alias("batch"), part.alias("_part"))
    try:
        dealt.repartitionById(batches * tasks, F.col("_part").cast("int")).drop("_part").write.partitionBy("batch").parquet(path)
        kind = T.StructType([sequences.schema["seq"], sequences.schema["target"], T.StructField("batch", T.IntegerType())])
        rows = spark.read.schema(kind).parquet(path)
        for _ in range(epochs):
            seen, lost = 0, 0.0
            for b in range(batches):
                n, loss, grad = total_gradient(rows.where(F.col("batch") == b), shape, flat, tasks)
                if n:
                    flat = rule.step(flat, grad / (n * shape.outputs))
                seen, lost = seen + n, lost + loss
            if history is not None:
                history.append(lost / max(1, seen * shape.outputs))
    finally:
        dropped(spark, path)
    return flat


def apply(rows: DataFrame, shape: Shape, flat: np.ndarray, outputs: list[str]) -> DataFrame:
    """``rows`` without ``seq``, with one column per output."""
    keep = [c for c in rows.columns if c != "seq"]
    kind = T.StructType([rows.schema[c] for c in keep] + [T.StructField(o, T.DoubleType()) for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(len(keep)), shape.steps * shape.inputs).reshape(-1, shape.steps, shape.inputs)
            out = predict(shape, flat, x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *[pa.array(out[:, i]) for i in range(len(outputs))]],
                                             names=[*keep, *outputs])
    return rows.select(*keep, "seq").mapInArrow(run, kind)
