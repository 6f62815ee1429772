"""The training-data pipeline: each stage works on what the stage before kept.

``run`` writes every stage as Parquet into the shared folder and reads it again for the
next one. Stages but the last return the columns of ``documents``; the last returns one row
per document that is left: doc_id, lang, source, ids (pieces), n_pieces and lossless.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.llm import chosen_path, mixing, pieces, radix_dedup, toxicity
from rostra.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from ``labels``, does not reject."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id."""
    return radix_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of texts linked by similarity the one with the smallest doc_id."""
    return chosen_path.keep_one(docs)


def in_mixed_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix; the files hold them in that order."""
    return mixing.mixed(docs)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document."""
    encoded = pieces.encode(docs, keep=("doc_id", "lang", "source"))
    return encoded.withColumn("n_pieces", F.size("ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("n-gram jaccard join", without_near_copies),
    ("mixing", in_mixed_order),
    ("pieces", as_pieces),
]

# A learned model, sampled paths and sampled pieces have no SQL; tests use a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
