"""Small helpers shared by the operators: shared folder, staged tables, skew-safe attach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strider.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key is heavy when it holds at least one row in so many; at most that many keys are heavy.
HEAVY_SHARE = 1000
#: Bytes of text a Python task handles between two output batches.
BATCH_BYTES = 4 << 20
#: Elements that one fold gathers: a fold copies what it has at every step.
FOLD = 256


def text_of(col: str | Column = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def named(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, combine, zero: int = 0, levels: int = 3) -> Column:
    """What ``combine`` (associative, with ``zero``) makes of the elements before each element
    of an array<bigint>; an empty array for an empty one.

    Blocks of FOLD elements are folded, then their totals likewise, so the cost per element is
    bounded up to FOLD ** (levels + 1) elements.
    """
    def fold(block: Column) -> Column:
        begin = F.struct(F.lit(zero).cast("long").alias("at"), F.array().cast("array<bigint>").alias("seen"))
        return F.aggregate(block, begin, lambda acc, v: F.struct(
            combine(acc["at"], v).alias("at"), F.concat(acc["seen"], F.array(acc["at"])).alias("seen")))
    if levels == 1:
        return fold(values)["seen"]

    def blocks(v: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(FOLD))
        return F.transform(at, lambda a: fold(F.slice(v, a + 1, FOLD)))

    def shifted(folded: Column) -> Column:
        bases = running(F.transform(folded, lambda b: b["at"]), combine, zero, levels - 1)
        return F.flatten(F.zip_with(folded, bases, lambda b, base: F.transform(b["seen"], lambda s: combine(base, s))))
    return named(values, lambda v: named(blocks(v), shifted))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: the session's checkpoint folder.

    Only a local session that names none gets a temporary folder of its own.
    """
    found = ensure_checkpoint_dir(spark)
    if found is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="strider-shared-"))
    return found.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: computed once, short
    lineage, and still there when an executor is lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(offset, texts) slices of a text column of about ``limit`` bytes each."""
    sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        done = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        yield at, column.slice(at, end - at).to_pylist()
        at = end


def attach(left: DataFrame, right: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Left join of ``right`` (one row per key, ``size`` = left rows of that key) onto ``left``.

    Keys holding at least 1/1000 of the ``total`` rows are at most 1000 in number: they go by
    broadcast.  Every other key is too small to make a shuffle uneven.
    """
    extra = [c for c in right.columns if c not in keys]
    is_heavy = F.col(size) * HEAVY_SHARE >= F.lit(max(int(total), 1))
    heavy = right.where(is_heavy).withColumn("_heavy", F.lit(True))
    both = left.join(F.broadcast(heavy), keys, "left")
    rest = both.where(F.col("_heavy").isNull()).drop("_heavy", *extra)
    return both.where("_heavy").drop("_heavy").unionByName(
        rest.join(right.where(~is_heavy), keys, "left"))


def partitions_for(spark: SparkSession, total: int, per_partition: int) -> int:
    """So many partitions that each holds about ``per_partition`` of ``total``, and at least
    the session's number of shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // per_partition), 1)
