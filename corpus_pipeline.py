"""Corpus pipeline: quality classifier, exact dedup, SimHash near-dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and, but for the
last, returns the columns of ``documents``.  Rows without doc_id or text, empty texts, repeated
rows and extra columns pass as each operator's docstring says; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strider.llm import decontaminate, exact_dedup, packing, quality_crf, simhash_dedup
from strider.llm.common import staged
from strider.llm.queries import GOOD_SCORE, RADIUS_BITS, SEQUENCE_TOKENS, SHINGLE_WORDS, VOCABULARY
from strider.sources.bindings import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier does not reject."""
    model = quality_crf.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_crf.accepted(docs, model, GOOD_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest doc_id."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the smallest doc_id."""
    return simhash_dedup.deduplicate(docs, SHINGLE_WORDS, RADIUS_BITS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs, VOCABULARY, capacity=SEQUENCE_TOKENS)


STAGES = [("quality_crf", quality), ("exact_dedup", exact), ("simhash_dedup", near),
          ("decontaminate", decontaminated), ("packing", packed)]

#: A trained classifier, fingerprints of shingles and token ids are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
