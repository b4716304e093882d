"""Whole-number vectors out of a list column, for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries beyond this size after scaling have no exact double neighbours left: an error.
LARGEST = 2 ** 52


def entries(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, floor(scale * entry) of all rows in a row, ok) of a list column.

    ``ok`` is false for a null list and for one with a null, NaN or infinite entry; such rows
    have length 0 here.
    """
    ok = column.is_valid().to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    ends = np.cumsum(sizes)
    ok = ok & (bad[ends] == bad[ends - sizes])
    scaled = np.floor(flat[np.repeat(ok, sizes)] * scale)
    if len(scaled) and np.abs(scaled).max() >= LARGEST:
        raise ValueError("vector entries are too large for exact whole numbers")
    return np.where(ok, sizes, 0), scaled.astype(np.int64), ok


def matrix(sizes: np.ndarray, flat: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` entries; a shorter vector counts as ending in zeros."""
    if len(flat) == len(sizes) * width:
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    starts = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(starts, sizes)] = flat
    return out


def extent(rows: DataFrame, vector: str, scale: int) -> tuple[int, int, int, int]:
    """(rows that take part, longest vector, smallest entry, largest entry): one scan."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, flat, ok = entries(batch.column(0), scale)
            if ok.any():
                low, high = (int(flat.min()), int(flat.max())) if len(flat) else (0, 0)
                yield pa.RecordBatch.from_pydict(
                    {"n": [int(ok.sum())], "width": [int(sizes.max())], "low": [low], "high": [high]})

    found = rows.select(vector).mapInArrow(run, "n long, width long, low long, high long").agg(
        F.sum("n"), F.max("width"), F.least(F.min("low"), F.lit(0)), F.greatest(F.max("high"), F.lit(0))).first()
    return tuple(int(x or 0) for x in found)
