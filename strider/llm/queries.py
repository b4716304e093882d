"""Registered queries of the operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strider.llm import (decontaminate, exact_dedup, fingerprints, hard_negatives, packing, pii, preferences,
                         quality_crf, simhash_dedup, substring_dedup, suffix_dedup, token_counts, whitening)
from strider.sources.bindings import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Production parameters.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512
SEQUENCE_TOKENS = 1024
GOOD_SCORE = 0.3
REPEAT_WORDS, REPEAT_BYTES = 35, 50
SHINGLE_WORDS, RADIUS_BITS = 4, 4


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return wrap


SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@register("op4_exact_dedup", f"""
WITH t AS (SELECT doc_id, {SQL_LOWER} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)""")
def op4_exact_dedup(spark, base):
    return exact_dedup.duplicates(read_table(spark, base, "documents"))


@register("op5_token_counts")
def op5_token_counts(spark, base):
    table = token_counts.prefix_counts(read_table(spark, base, "documents"), VOCABULARY)
    return table.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
                        token_counts.fitting_prefix("steps", TOKEN_LIMIT).alias("fit_chars"))


@register("op8_packing")
def op8_packing(spark, base):
    return packing.pack(read_table(spark, base, "documents"), VOCABULARY, capacity=SEQUENCE_TOKENS)


@register("op9_simhash_dedup")
def op9_simhash_dedup(spark, base):
    return simhash_dedup.near_duplicates(read_table(spark, base, "documents"), SHINGLE_WORDS, RADIUS_BITS)


@register("op2_pii")
def op2_pii(spark, base):
    return pii.find(read_table(spark, base, "documents"))


@register("op7_quality_crf")
def op7_quality_crf(spark, base):
    docs = read_table(spark, base, "documents")
    return quality_crf.score(docs, quality_crf.fit(docs, read_table(spark, base, "labels")), GOOD_SCORE)


@register("op6_decontaminate")
def op6_decontaminate(spark, base):
    return decontaminate.contaminated(read_table(spark, base, "documents"), read_table(spark, base, "benchmark"))


@register("op1_preferences", """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
         '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS line
  FROM conversations),
l AS (SELECT conv_id, count(*) AS n, max(pos) FILTER (role = 'assistant') AS last,
             max_by(text, pos) FILTER (role = 'assistant') AS own FROM t GROUP BY conv_id),
k AS (SELECT l.conv_id, l.last, coalesce(d.own, '') AS reply,
             coalesce(l.last + CASE WHEN l.own = coalesce(d.own, '') THEN 1 ELSE 0 END, l.n) AS cut,
             l.own IS NOT NULL AND l.own = coalesce(d.own, '') AS same
      FROM l LEFT JOIN l d ON d.conv_id = xor(l.conv_id, 1) AND d.own IS NOT NULL),
p AS (SELECT t.*, k.cut, k.reply, k.same,
             sum(CASE WHEN pos >= cut THEN length(line) ELSE 0 END)
               OVER (PARTITION BY t.conv_id ORDER BY pos) - length(text) - 1 AS start
      FROM t JOIN k ON t.conv_id IS NOT DISTINCT FROM k.conv_id)
SELECT conv_id AS pair_id, any_value(cut)::BIGINT AS prompt_turns,
       coalesce(string_agg(line, '' ORDER BY pos) FILTER (pos < cut), '') AS prompt,
       coalesce(string_agg(line, '' ORDER BY pos) FILTER (pos >= cut), '') AS chosen,
       CASE WHEN any_value(same) THEN '' ELSE '<|assistant|>' || chr(10) || any_value(reply) || chr(10) END AS rejected,
       coalesce(string_agg(start::BIGINT || ':' || (start + length(text) + 1)::BIGINT, ',' ORDER BY pos)
                FILTER (pos >= cut AND role = 'assistant'), '') AS chosen_mask,
       CASE WHEN any_value(same) THEN '' ELSE '14:' || (15 + length(any_value(reply))) END AS rejected_mask
FROM p GROUP BY conv_id""")
def op1_preferences(spark, base):
    return preferences.preferences(preferences.swapped_replies(read_table(spark, base, "conversations")))


@register("op3_substring_dedup")
def op3_substring_dedup(spark, base):
    return substring_dedup.repeated_words(read_table(spark, base, "documents"), REPEAT_WORDS)


@register("op10_suffix_dedup")
def op10_suffix_dedup(spark, base):
    return suffix_dedup.repeated_bytes(read_table(spark, base, "documents"), REPEAT_BYTES)


@register("op11_fingerprints")
def op11_fingerprints(spark, base):
    return fingerprints.edited_likeness(read_table(spark, base, "documents"))


@register("op12_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM v WHERE vec_id % 100 = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS same,
             list_inner_product(a.q, v.q)::BIGINT AS score
      FROM a JOIN v ON a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5""")
def op12_hard_negatives(spark, base):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, base, "embeddings").withColumn("label", label)
    return hard_negatives.mine(rows.withColumn("anchor", F.col("vec_id") % 100 == 0))


@register("op13_whitening")
def op13_whitening(spark, base):
    return whitening.whiten(read_table(spark, base, "embeddings"))
