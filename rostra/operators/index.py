"""Postings, vocabulary, document lengths, the inverted catalog and TF-IDF per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.functions.scores import idf_smooth, int_truncate, tf_log
from rostra.functions.text import Preprocess, let, term_counts
from rostra.runtime import dense_row_number, join_vocabulary, materialize
from rostra.schemas import SPEECH

CATALOG_BLOCK_DOCS = 65_536


def _counted(corpus: DataFrame, pre: Preprocess, text: str, keep: tuple[str, ...]) -> DataFrame:
    """One row per document with its term counts; a null text counts as an empty document."""
    terms = pre.terms(F.coalesce(F.col(text), F.lit(" ")))
    return corpus.select("doc_id", *keep, term_counts(terms).alias("_counts"))


def _norm(counts: Column) -> Column:
    zero = F.lit(0).cast("long")
    return F.sqrt(F.aggregate(counts, zero, lambda acc, c: acc + c["tf"] * c["tf"]))


def postings(
    corpus: DataFrame, pre: Preprocess, text: str = SPEECH, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``(doc_id, keep..., norm, term, tf)``, computed row by row without a shuffle.

    Every posting carries the length of its document: neighbours share the value, so it
    costs next to nothing in Parquet and saves the search a join on the document.
    """
    counted = _counted(corpus, pre, text, keep)
    # inline_outer: for plain inline the optimizer adds a filter on the size of the counts,
    # which would compute them a second time below the projection.
    return (
        counted.withColumn("norm", _norm(F.col("_counts")))
        .select("doc_id", *keep, "norm", F.inline_outer("_counts"))
        .where(F.col("term").isNotNull())
    )


def doc_norms(corpus: DataFrame, pre: Preprocess, text: str = SPEECH) -> DataFrame:
    """L2 norm of the term counts per document, 0 for documents without terms."""
    counted = _counted(corpus, pre, text, ())
    return counted.select("doc_id", _norm(F.col("_counts")).alias("norm"))


def doc_freq(postings: DataFrame) -> DataFrame:
    """Documents per term; partial counts leave one row per term and task for the shuffle."""
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def with_term_id(vocab: DataFrame) -> DataFrame:
    """Number the terms from 0 in code-point order."""
    return dense_row_number(vocab, "term_id", [F.col("term")])


def count_of(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery."""
    return df.agg(F.count("*")).scalar()


def corpus_stats(corpus: DataFrame, vocab: DataFrame) -> DataFrame:
    """One row: documents (empty ones included) and terms."""
    return corpus.agg(F.count("*").alias("n_docs")).withColumn("n_terms", count_of(vocab))


def with_idf(vocab: DataFrame, n_docs: Column) -> DataFrame:
    return vocab.withColumn("idf", idf_smooth(n_docs, F.col("df")))


def inverted_catalog(
    postings: DataFrame, vocab: DataFrame, block_docs: int = CATALOG_BLOCK_DOCS
) -> DataFrame:
    """``(term, df, block, postings)`` with the postings of a row ordered by document.

    Every term has a row per range of ``block_docs`` document ids that holds it, so no row
    grows without bound. The document frequency joins those rows, not the postings.
    """
    block = F.floor(F.col("doc_id") / block_docs).cast("long")
    rows = postings.groupBy("term", block.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")
    )
    placed = join_vocabulary(materialize(rows, "catalog-rows"), vocab.select("term", "df"))
    return placed.select("term", "df", "block", "postings")


def block_maxima(sliced: DataFrame) -> DataFrame:
    """``(term, doc_slice, top)``: the most that one occurrence of a query term adds to the
    score of any document of the slice, before the idf."""
    part = tf_log(F.col("tf")) / int_truncate(F.col("norm"))
    return sliced.groupBy("term", "doc_slice").agg(F.max(part).alias("top"))


def catalog_text(postings: Column) -> Column:
    """``doc1,tf1,doc2,tf2,...`` of one catalog row."""
    return F.array_join(
        F.transform(postings, lambda p: F.concat_ws(",", p["doc_id"], p["tf"])), ","
    )


def catalog_lines(catalog: DataFrame) -> DataFrame:
    """The text form ``term,df,block,doc1,tf1,...``, ordered by term and block."""
    return catalog.orderBy("term", "block").select(
        F.concat_ws(",", "term", "df", "block", catalog_text(F.col("postings"))).alias("value")
    )


def catalog_postings(catalog: DataFrame) -> DataFrame:
    """The postings a catalog was made of."""
    return catalog.select("term", F.inline("postings"))


def tfidf_rows(postings: DataFrame, vocab: DataFrame, *columns: str) -> DataFrame:
    """One row per document: ``entries`` with the L2-normalised ``tf * idf`` of its terms.

    ``vocab`` holds ``term, df, idf``; ``columns`` of it go into the entries. One shuffle by
    document after the join, and no group is larger than one document.
    """
    columns = columns or ("term",)
    joined = join_vocabulary(postings.select("doc_id", "term", "tf"), vocab)
    entry = F.struct(*columns, (F.col("tf") * F.col("idf")).alias("weight"))
    packed = joined.groupBy("doc_id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))

    def normalised(norm: Column) -> Column:
        return F.transform(
            "entries",
            lambda e: F.struct(
                *[e[c].alias(c) for c in columns], (e["weight"] / norm).alias("weight")
            ),
        )

    squares = F.aggregate("entries", F.lit(0.0), lambda acc, e: acc + e["weight"] * e["weight"])
    return packed.select("doc_id", let(F.sqrt(squares), normalised).alias("entries"))


def tfidf_docs(postings: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(doc_id, term, weight)``: tf times smooth idf, L2-normalised per document."""
    return tfidf_rows(postings, vocab).select("doc_id", F.inline("entries"))
