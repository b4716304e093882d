"""Whole texts stored in blocks, for operators that pass over them several times.

The store is a table bucketed by block in the shared folder: grouping or co-grouping by block
reads it without a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strider.llm.common import partitions_for, shared_dir, staged, text_of

#: Bytes of text per block.
BLOCK_BYTES = 4 << 20


def prints(docs: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """(doc_id, h1, h2, n_bytes, sha) of every row; (h1, h2) stands for the text."""
    t = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("t"))
    return staged(t.select("doc_id", F.xxhash64("t").alias("h1"), F.xxhash64("t", F.lit(1)).alias("h2"),
                           F.octet_length("t").cast("long").alias("n_bytes"), F.sha2("t", 256).alias("sha")), name)


def _drop_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose (doc_id, h1, h2) came before in this task go: a hot text leaves a task once."""
    seen: set[tuple] = set()
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
        keep = []
        for k in keys:
            keep.append(k not in seen)
            seen.add(k)
        yield batch.filter(pa.array(keep))


def block_count(spark, total_bytes: int) -> int:
    return partitions_for(spark, total_bytes, BLOCK_BYTES)


def stored(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """``rows`` (doc_id, h1, h2, block, text) as a table bucketed by block."""
    spark = rows.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    kind = "doc_id long, h1 long, h2 long, block long, text string"
    once = rows.select("doc_id", "h1", "h2", "block", "text").mapInArrow(_drop_repeats, kind)
    (once.repartition(blocks, "block").write.bucketBy(blocks, "block").sortBy("block")
     .option("path", f"{shared_dir(spark)}/{table}").saveAsTable(table))
    return spark.table(table)

