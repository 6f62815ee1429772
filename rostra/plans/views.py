"""The example tables seen as a corpus, a query batch and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.runtime import spread
from rostra.schemas import DATE, MEMBER, PARTY, SPEECH

# Runs unchanged in Spark and in DuckDB.
SITTING_DATE = (
    "concat(lpad(cast(1 + doc_id % 28 AS varchar(2)), 2, '0'), '/', "
    "lpad(cast(1 + doc_id % 12 AS varchar(2)), 2, '0'), '/', "
    "cast(1989 + doc_id % 32 AS varchar(4)))"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def speeches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with a member, a party, a date and a speech."""
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("source").alias(MEMBER),
        F.expr(SITTING_DATE).alias(DATE),
        F.col("lang").alias(PARTY),
        F.col("text").alias(SPEECH),
    )


def speeches_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a null member, party or speech in some rows."""
    return (
        speeches(spark, sf_dir)
        .withColumn(SPEECH, F.when(F.col(MEMBER) != "src1", F.col(SPEECH)))
        .withColumn(PARTY, F.nullif(F.col(PARTY), F.lit("de")))
        .withColumn(MEMBER, F.nullif(F.col(MEMBER), F.lit("src0")))
    )


def query_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as document vectors with given cluster labels."""
    return spread(table(spark, sf_dir, "embeddings")).select(
        F.col("vec_id").alias("doc_id"),
        F.col("embedding").cast("array<double>").alias("vec"),
        F.col("label").alias("cluster"),
    )


def term_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as term vectors: a vector's name stands for a term."""
    return doc_vectors(spark, sf_dir).select(
        F.concat(F.lit("v"), "doc_id").alias("term"), F.col("vec").alias("comp")
    )
