"""Token counts by prefix dynamic programming.

``prefix_counts`` stores, for every text, the exact token count after each of its characters
(as one-byte changes).  Questions about truncation and budgets are then sums over stored bytes:
nothing is encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strider.llm.common import slices, text_of
from strider.llm.tokens import vocabulary

def prefix_counts(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key, n_bytes, n_tokens and ``steps`` (binary, int8).

    The count after the first i characters is the sum of the first i steps.  Null text: empty,
    with no steps.  Null and repeated keys pass through.  Other columns are ignored.
    """
    rows = docs.select(F.col(key), text_of(text).alias("_text"), F.octet_length(text_of(text)).cast("long").alias("n_bytes"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocabulary_path)
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                found = [vocab.steps(x) for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), batch.column(2).slice(at, len(texts)),
                     pa.array([n for _, n in found], pa.int64()), pa.array([s for s, _ in found], pa.binary())],
                    names=[key, "n_bytes", "n_tokens", "steps"])

    return rows.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long, steps binary")


def fitting_prefix(steps: str, limit: int) -> Column:
    """Characters of the longest prefix of at most ``limit`` tokens, from stored steps."""
    @F.arrow_udf(LongType())
    def fit(column: pa.Array) -> pa.Array:
        out = []
        for x in column:
            counts = np.cumsum(np.frombuffer(x.as_buffer(), np.int8), dtype=np.int64) if x.is_valid else np.zeros(0)
            inside = np.flatnonzero(counts <= limit)
            out.append(int(inside[-1]) + 1 if len(inside) else 0)
        return pa.array(out, pa.int64())
    return fit(F.col(steps))


def tokens_before(steps: bytes, characters: int) -> int:
    """Token count of the first ``characters`` characters, from stored steps."""
    return int(np.frombuffer(steps, np.int8)[:characters].sum(dtype=np.int64))
