"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.llm import (
    chosen_path,
    collocations,
    disclosure,
    importance,
    mixing,
    pieces,
    radix_dedup,
    sentence_spans,
    spelling,
    token_counts,
    token_files,
    topk,
    toxicity,
)
from rostra.llm.common import table
from rostra.runtime import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.token_digest(spark, path)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"))
    return encoded.withColumn("n_pieces", F.size("ids").cast("long"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integers(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.filter("vec_id % 50 = 0"), vectors)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.sanitise(table(spark, sf_dir, "documents")).drop("text")


def op8_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.jaccard_join(table(spark, sf_dir, "documents"))


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.substring_dedup(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


_TOP_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(q.vec, c.vec) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

_EXACT_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM t
"""


def registry() -> dict[str, Query]:
    return {
        "op1_token_files": op1_token_files,
        "op2_toxicity": op2_toxicity,
        "op3_pieces": op3_pieces,
        "op4_topk": op4_topk,
        "op5_mixing": op5_mixing,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_disclosure": op7_disclosure,
        "op8_importance": op8_importance,
        "op9_chosen_path": op9_chosen_path,
        "op10_sentence_spans": op10_sentence_spans,
        "op11_spelling": op11_spelling,
        "op12_token_counts": op12_token_counts,
        "op13_collocations": op13_collocations,
    }


def oracle() -> dict[str, str]:
    return {"op4_topk": _TOP_SQL, "op6_exact_dedup": _EXACT_SQL}
