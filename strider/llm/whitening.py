"""Embedding whitening from a bit-sliced scatter matrix.

Entries become whole numbers, shifted to start at zero.  A task turns its rows on their side:
for every dimension one word holds one bit of 64 rows.  The product sum of two dimensions is
the sum over their bit planes of 2**(b+c) * popcount(plane_b AND plane_c), exact in whole
numbers.  Only D*(D+1)/2 sums per task leave the executors.  n * sum(xy) - sum(x) * sum(y) is
the covariance times n**2, still whole and free of cancellation; division and ``eigh`` come
last, on one D x D matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strider.llm.common import staged
from strider.llm.vectors import entries, extent, matrix

SCALE, COMPONENTS = 64, 16
#: Rows sliced into planes at once: 2**16 counts fit every sum below.
BLOCK = 1 << 16
#: An eigenvalue under this share of the largest is rounding, not variance.
RANK_SHARE = 1e-12
LIMB = 26
DECIMAL = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitener:
    """Everything a task needs: fixed size, whatever the number of rows."""
    n: int
    low: int                    # smallest scaled entry: the shift of the planes
    sums: tuple                 # per dimension, of entries minus low
    values: np.ndarray          # eigenvalues kept, falling
    vectors: np.ndarray         # (dimensions, components)
    trace: float


def bit_slices(values: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(planes, words) uint64 and each plane's (dimension, bit); empty planes are left out."""
    rows, width = values.shape
    padded = np.zeros((-(-rows // 64) * 64, width), np.int64)
    padded[:rows] = values
    seen = np.bitwise_or.reduce(padded, axis=0) if rows else np.zeros(width, np.int64)
    names = [(d, b) for d in range(width) for b in range(int(seen[d]).bit_length()) if seen[d] >> b & 1]
    planes = np.empty((len(names), len(padded) // 64), np.uint64)
    for i, (d, b) in enumerate(names):
        planes[i] = np.packbits((padded[:, d] >> b & 1).astype(np.uint8), bitorder="little").view(np.uint64)
    return planes, names


def cross_products(values: np.ndarray) -> np.ndarray:
    """Exact upper triangle of values' product sums (object whole numbers), by AND and popcount."""
    width = values.shape[1]
    out = np.zeros((width, width), object)
    for at in range(0, len(values), BLOCK):
        planes, names = bit_slices(values[at:at + BLOCK])
        dims = np.array([d for d, _ in names], np.int64)
        bits = [b for _, b in names]
        small = max(bits, default=0) <= 22
        weights = np.array([1 << b for b in bits], np.int64 if small else object)
        for p, (d, b) in enumerate(names):
            first = int(np.searchsorted(dims, d))
            counts = np.bitwise_count(planes[first:] & planes[p]).sum(axis=1, dtype=np.int64)
            starts = np.flatnonzero(np.diff(dims[first:], prepend=-1))
            line = np.add.reduceat(counts * weights[first:], starts) if small else np.array(
                [sum((counts * weights[first:])[s:e]) for s, e in zip(starts, [*starts[1:], len(counts)])], object)
            out[d, dims[first:][starts]] += line.astype(object) * (1 << b)
    return out


def _rows(vector: str, key: str, width: int, scale: int, rows: DataFrame) -> DataFrame:
    """(vec_id, x): scaled entries as little-endian bytes, of the rows that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, flat, ok = entries(batch.column(1), scale)
            if ok.any():
                data = matrix(sizes[ok], flat, width).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(pa.array(ok)), pa.array([x.tobytes() for x in data], pa.binary())],
                    names=["vec_id", "x"])
    return rows.select(F.col(key).cast("long"), F.col(vector)).mapInArrow(run, "vec_id long, x binary")


def _values(column: pa.Array, width: int, low: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, width) - low


def _scatter(width: int, low: int):
    """Per task: rows, sums and product sums, as (i, j, total); i = -1 for sums, j = -1 for rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
        for values in _gathered(batches, width, low):
            count += len(values)
            sums += np.array([int(x) for x in values.sum(axis=0)], object)
            products += cross_products(values)
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *[-1] * width, *i.tolist()], pa.int32()), pa.array([-1, *range(width), *j.tolist()], pa.int32()),
             pa.array([Decimal(int(x)) for x in (count, *sums, *products[i, j])], DECIMAL)], names=["i", "j", "total"])
    return run


def _gathered(batches: Iterator[pa.RecordBatch], width: int, low: int) -> Iterator[np.ndarray]:
    """Arrow batches put together to about BLOCK rows, so that words are full."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(_values(batch.column(0), width, low))
        if sum(map(len, held)) >= BLOCK:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def covariance(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """(n * products - sums * sums) / n**2, whole up to the division."""
    out = np.empty((len(sums), len(sums)))
    for i, a in enumerate(sums):
        for j in range(i, len(sums)):
            out[i, j] = out[j, i] = (n * products[i, j] - a * sums[j]) / (n * n)
    return out


def fit(distinct: DataFrame, width: int, low: int, components: int = COMPONENTS) -> Whitener:
    """The components of the distinct vectors ``x``."""
    totals = distinct.select("x").mapInArrow(_scatter(width, low), "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(
        F.sum("total").cast("decimal(38,0)").alias("total"))
    found = {(r.i, r.j): int(r.total) for r in totals.collect()}
    n, sums = found[-1, -1], [found[-1, j] for j in range(width)]
    matrix_ = covariance(n, sums, found)
    values, vectors = np.linalg.eigh(matrix_)
    keep = min(components, width)
    return Whitener(n, low, tuple(sums), values[::-1][:keep].copy(), vectors[:, ::-1][:, :keep].copy(), float(np.trace(matrix_)))


def centred(values: np.ndarray, model: Whitener) -> np.ndarray:
    """n * x - S, whole."""
    return values * model.n - np.array(model.sums, np.int64)


def whitened(values: np.ndarray, model: Whitener) -> np.ndarray:
    """(rows, components); NaN where the eigenvalue is no variance."""
    live = model.values > max(model.values[0], 0) * RANK_SHARE
    with np.errstate(divide="ignore", invalid="ignore"):
        out = (centred(values, model) / model.n) @ model.vectors / np.sqrt(np.where(live, model.values, np.nan))
    return out


def identity_error(distinct: DataFrame, width: int, model: Whitener) -> float | None:
    """Largest entry of (covariance of the whitened distinct vectors - identity), measured."""
    live = np.flatnonzero(model.values > max(model.values[0], 0) * RANK_SHARE)
    if not len(live):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(len(live)), np.zeros((len(live), len(live)))
        for batch in batches:
            w = whitened(_values(batch.column(0), width, model.low), model)[:, live]
            sums += w.sum(axis=0)
            products += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(live) * (len(live) + 1))), pa.array(np.concatenate([sums, products.reshape(-1)]))],
            names=["at", "total"])

    rows = distinct.select("x").mapInArrow(run, "at long, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    flat = np.empty(len(live) * (len(live) + 1))
    for r in rows:
        flat[r["at"]] = r.total / model.n
    mean, second = flat[:len(live)], flat[len(live):].reshape(len(live), -1)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(len(live))).max())


def _answer(width: int, model: Whitener, error: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = len(model.values)
        explained = [float(v) / model.trace if model.trace > 0 else None for v in np.maximum(model.values, 0)]
        for batch in batches:
            values = _values(batch.column(1), width, model.low)
            off = centred(values, model)
            high, rest = off >> LIMB, off & (1 << LIMB) - 1
            w = whitened(values, model).reshape(-1)
            rows = len(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(rows), keep))),
                 pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), rows)),
                 *[pa.array(np.repeat(x, keep)) for x in ((high * high).sum(axis=1), (high * rest).sum(axis=1), (rest * rest).sum(axis=1))],
                 pa.array(w, mask=np.isnan(w)), pa.array(explained * rows, pa.float64()),
                 pa.array([error] * (rows * keep), pa.float64())],
                names=["vec_id", "component", "d2", "d1", "d0", "whitened", "explained", "identity_error"])
    return run


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, key: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error per row and component.

    Entries become x = floor(scale * entry); a constant added to every x changes no column.  The components are those of the distinct
    x vectors (each once, however many copies it has); every row that takes part is whitened.
    ``deviation`` is the sum over dimensions of (n*x - S)**2, null where it does not fit a long.

    A null vector or one with a null, NaN or infinite entry: no row.  A null key is a key.  Rows
    that repeat a key or a vector each get their rows.  A shorter vector counts as ending in
    zeros.  Equal eigenvalues: any orthogonal components, the same for all rows.  A component
    without variance has a null ``whitened`` and does not enter ``identity_error``.  Other columns
    are ignored; an empty table gives an empty result.  Entries so wide apart that rows * range
    passes 2**52, or 1,024 dimensions and more: an error.
    """
    spark = rows.sparkSession
    kind = ("vec_id long, component int, d2 long, d1 long, d0 long, whitened double, explained double, identity_error double")
    result = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    count, width, low, high = extent(rows, vector, scale)
    if not count or not width:
        return spark.createDataFrame([], result)
    if count * (high - low + 1) >= 2 ** 52 or width >= 2 ** 10:
        raise ValueError("vector entries are too wide apart for exact deviations")
    table = staged(_rows(vector, key, width, scale, rows), "op13-rows")
    distinct = staged(table.select("x").distinct(), "op13-distinct")
    model = fit(distinct, width, low, components)
    error = identity_error(distinct, width, model)
    # A limb sum is below 2**62; the whole is put together in decimals.
    whole = "decimal(38,0)"
    deviation = (F.col("d2").cast(whole) * F.lit(Decimal(1 << 2 * LIMB)).cast("decimal(16,0)")
                 + F.col("d1").cast(whole) * F.lit(Decimal(2 << LIMB)).cast("decimal(9,0)") + F.col("d0").cast(whole))
    return table.mapInArrow(_answer(width, model, error), kind).select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), deviation.try_cast("long").alias("deviation"),
        "whitened", "explained", "identity_error")
