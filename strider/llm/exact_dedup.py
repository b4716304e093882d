"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every row gets the 64-bit fingerprint and the SHA-256 of its normalised text (JVM side).
2. Input partitions send sorted compressed fingerprints to owners and receive bitmaps.
3. Only rows whose fingerprint came up twice are suspects; their texts alone are shuffled and
   grouped byte by byte, copies being collapsed before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strider.llm.common import attach, lower_ascii, staged, text_of
from strider.llm.exchange import MESSAGE, answered, messages, shared_flags

MARKED = "doc_id string, fp long, sha binary, suspect boolean"
#: Words of the suspect filter: fixed size, so its broadcast is bounded (at most so many rows).
FILTER_WORDS = 1 << 18
#: Blocks per owner: the number of messages is blocks * owners.
BLOCKS_PER_OWNER = 4


def _distinct(fps: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(fps.to_numpy(np.int64).view(np.uint64), return_inverse=True, return_counts=True)


def _send(owners: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        values, _, _ = _distinct(rows["fp"])
        return pd.DataFrame(messages(int(key[0]), values, owners),
                            columns=["block", "owner", "n", "k", "payload"])
    return run


def _receive(key, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    _, where, count = _distinct(rows["fp"])
    out = rows[["doc_id", "fp", "sha"]].copy()
    out["suspect"] = ((count > 1) | shared_flags(answers))[where] if len(rows) else np.zeros(0, bool)
    return out


def _filter_word(fp) -> tuple:
    return F.pmod(fp, F.lit(FILTER_WORDS)), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(fp, 20), F.lit(64)).cast("int"))


def duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (hex).

    Texts are equal when identical after lower-casing A-Z.  The largest ``key`` of a group
    stays.  Null text: empty.  Null key: never the largest unless the whole group has none
    (then keep_id is null and the row counts as kept).  Rows that repeat key and text cannot be told apart: each
    carries the same answer.  Other columns are ignored; an empty table gives an empty result.
    """
    norm = lower_ascii(text_of(text))
    base = docs.select(F.col(key).cast("long").alias("doc_id"), norm.alias("norm"))
    prints = staged(base.select("doc_id", F.xxhash64("norm").alias("fp"),
                                F.unhex(F.sha2("norm", 256)).alias("sha"),
                                F.spark_partition_id().cast("long").alias("block")), "op4-prints")
    n, top = prints.agg(F.count(F.lit(1)), F.max("block")).first()
    owners = max(1, ((top or 0) + 1) // BLOCKS_PER_OWNER)
    sent = prints.select("block", "fp").groupBy("block").applyInPandas(_send(owners), MESSAGE)
    answers = answered(sent, owners)
    # Keys travel through pandas as text: nullable longs would become floats there.
    rows = prints.withColumn("doc_id", F.col("doc_id").cast("string"))
    marked = staged(rows.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_receive, MARKED)
                    .withColumn("doc_id", F.col("doc_id").cast("long")), "op4-marked")

    suspects = marked.where("suspect")
    word, bit = _filter_word(F.col("fp"))
    sieve = suspects.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    wide = base.withColumn("fp", F.xxhash64("norm"))
    word, bit = _filter_word(F.col("fp"))
    groups = staged(
        wide.withColumn("word", word).join(F.broadcast(sieve), "word")
        .where(F.col("bits").bitwiseAND(bit) != 0)
        .groupBy("fp", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("fp", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size"), "op4-groups")
    single = marked.where("not suspect").select(
        "doc_id", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    grouped = attach(suspects.drop("suspect"), groups, ["fp", "sha"], "group_size", n)
    return single.unionByName(grouped.select("doc_id", "sha", "keep_id", "group_size")).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` without the dropped copies; of rows that repeat doc_id and text one stays.

    Whole rows travel as one column, so no column of ``docs`` can clash with the answer's.
    """
    answer = duplicates(docs).where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.sha2(lower_ascii(text_of()), 256).alias("sha"))
    joined = rows.join(answer, rows["id"].eqNullSafe(answer["doc_id"]) & (rows["sha"] == answer["text_sha256"]))
    once = joined.where("n = 1").select("row.*")
    return once.unionByName(joined.where("n > 1").dropDuplicates(["id", "sha"]).select("row.*"))
