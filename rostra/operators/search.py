"""Ranked keyword search for a table of queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rostra.functions.scores import idf_search, int_truncate, page_count, rank_key, tf_log
from rostra.functions.text import Preprocess
from rostra.operators.index import count_of
from rostra.runtime import SPLIT_BYTES, fits_broadcast, heavy_terms, materialize, rank_within
from rostra.schemas import DATE, MEMBER, PAGE_SIZE, SCORE_THRESHOLD, SPEECH
from rostra.sources.tables import DOC_BUCKETS, TERM_BUCKETS, doc_bucket, in_buckets_of, term_bucket

HIT = ["query_id", "doc_id"]
# Slices of the greatest bounds that a page scores before it compares bounds.
FIRST_SLICES = 2
# Postings of one term that a task joins.
POSTINGS_PER_TASK = 1_000_000


def non_empty_queries(queries: DataFrame, text: str = "text") -> DataFrame:
    """Queries without any text ask for nothing."""
    return queries.where(F.length(F.trim(text)) > 0)


def query_words(
    queries: DataFrame, pre: Preprocess, query_id: str = "query_id", text: str = "text"
) -> DataFrame:
    """``(query_id, pos, term)``: the terms of each query in order, repeats included."""
    words = non_empty_queries(queries, text).select(
        F.col(query_id).alias("query_id"),
        F.posexplode_outer(pre.terms(F.col(text))).alias("pos", "term"),
    )
    return words.where(F.col("term").isNotNull())


def query_terms(
    queries: DataFrame, pre: Preprocess, query_id: str = "query_id", text: str = "text"
) -> DataFrame:
    """``(query_id, term, qtf, first_pos)``."""
    return (
        query_words(queries, pre, query_id, text)
        .groupBy("query_id", "term")
        .agg(F.count("*").alias("qtf"), F.min("pos").alias("first_pos"))
    )


def known_terms(terms: DataFrame, vocab: DataFrame) -> DataFrame:
    """Drop the terms that the vocabulary lacks."""
    wanted = terms.select("term").distinct()
    if fits_broadcast(wanted):
        # Cut the vocabulary down first; what is left is no larger than the queries.
        known = vocab.select("term").join(F.broadcast(wanted), "term", "left_semi")
        return terms.join(F.broadcast(known), "term", "left_semi")
    return terms.join(vocab.select("term"), "term", "left_semi")


def query_postings_join(
    terms: DataFrame,
    postings: DataFrame,
    vocab: DataFrame,
    buckets: int = TERM_BUCKETS,
    small: bool | None = None,
    postings_per_task: int = POSTINGS_PER_TASK,
) -> DataFrame:
    """Postings of the query terms.

    A batch of queries of a checked size is broadcast; with postings stored by term bucket
    Spark then reads the buckets of the query terms only. A larger batch is joined by
    shuffle, with frequent terms salted by document, as many times as their document
    frequency asks for. ``buckets`` is the number the
    table was written with; ``small`` passes on a check that was already made.
    """
    if "term_bucket" in postings.columns:
        terms = terms.withColumn("term_bucket", term_bucket(F.col("term"), buckets))
        keys = ["term_bucket", "term"]
    else:
        keys = ["term"]
    if fits_broadcast(terms) if small is None else small:
        return postings.join(F.broadcast(terms), keys).drop("term_bucket")
    salts = F.ceil(F.col("df") / postings_per_task).cast("long").alias("_salts")
    head = F.broadcast(heavy_terms(vocab).select("term", salts))
    number = F.coalesce("_salts", F.lit(1).cast("long"))
    left = postings.join(head, "term", "left").withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id"), number)
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), number - 1))
    right = terms.join(head, "term", "left").withColumn("_salt", every)
    joined = left.drop("_salts").join(right.drop("_salts"), [*keys, "_salt"])
    return joined.drop("_salt", "term_bucket")


def search_hits(
    terms: DataFrame,
    postings: DataFrame,
    vocab: DataFrame,
    total: Column | None = None,
    threshold: float = SCORE_THRESHOLD,
    buckets: int = TERM_BUCKETS,
) -> DataFrame:
    """``(query_id, doc_id, score, first_pos)`` of all documents above the threshold.

    ``total`` is the number the inverse document frequency divides; it defaults to the
    number of terms. ``first_pos`` is the first query position that matched.
    """
    total = count_of(vocab) if total is None else total
    small = fits_broadcast(terms)
    asked = F.broadcast(terms) if small else terms
    known = vocab.select("term", "df").join(asked, "term")  # unknown terms drop out
    weighted = known.withColumn("idf", idf_search(total, F.col("df"))).drop("df")
    # The idf adds 8 bytes to a row, so what fits a broadcast still does.
    matches = query_postings_join(weighted, postings, vocab, buckets, small)
    part = F.col("qtf") * tf_log(F.col("tf")) * F.col("idf")
    return (
        matches.groupBy(*HIT)
        .agg(
            (F.sum(part) / int_truncate(F.first("norm"))).alias("score"),
            F.min("first_pos").alias("first_pos"),
        )
        .where(F.col("score") > threshold)
    )


def _best_first() -> list[Column]:
    return [F.desc(rank_key(F.col("score"))), F.asc("first_pos"), F.asc("doc_id")]


def drop_last_hit(hits: DataFrame) -> DataFrame:
    """Without the lowest-ranked hit of each query, found by an aggregate instead of a sort."""
    place = F.struct(
        (-rank_key(F.col("score"))).alias("s"), F.col("first_pos").alias("p"), "doc_id"
    )
    last = hits.groupBy("query_id").agg(F.max(place)["doc_id"].alias("doc_id"))
    return hits.join(last, HIT, "left_anti")


def rank_search(hits: DataFrame, top_k: int | None = None) -> DataFrame:
    """Number the hits of each query from 1: score descending, first position, document.

    With ``top_k`` each task passes on its best ``top_k`` hits per query only. Without it
    the whole ranking is sorted across the cluster.
    """
    if top_k is None:
        return rank_within(hits, ["query_id"], _best_first(), "rank")
    order = Window.partitionBy("query_id").orderBy(*_best_first())
    ranked = hits.withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= top_k)


def page(hits: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page ``number`` (from 1) of every query."""
    ranked = rank_search(hits, number * size)
    return ranked.where(F.col("rank") > (number - 1) * size)


def _scored_slices(weighted: DataFrame, chosen: DataFrame, sliced: DataFrame) -> DataFrame:
    """Scores of the documents of some ``(query_id, doc_slice)``; other folders are not read."""
    folders = [r[0] for r in chosen.select("doc_slice").distinct().collect()]  # slices at most
    asked = weighted.join(chosen.select("query_id", "doc_slice"), "query_id")
    asked = F.broadcast(asked) if fits_broadcast(asked) else asked
    matches = sliced.where(F.col("doc_slice").isin(folders)).join(asked, ["doc_slice", "term"])
    part = F.col("qtf") * tf_log(F.col("tf")) * F.col("idf")
    return matches.groupBy(*HIT).agg(
        (F.sum(part) / int_truncate(F.first("norm"))).alias("score"),
        F.min("first_pos").alias("first_pos"),
    )


def slice_bounds(weighted: DataFrame, maxima: DataFrame) -> DataFrame:
    """``(query_id, doc_slice, bound)``: no document of the slice scores more."""
    asked = F.broadcast(weighted) if fits_broadcast(weighted) else weighted
    part = F.col("qtf") * F.col("idf") * F.col("top")
    return maxima.join(asked, "term").groupBy("query_id", "doc_slice").agg(F.sum(part).alias("bound"))


def page_by_bounds(
    terms: DataFrame,
    sliced: DataFrame,
    maxima: DataFrame,
    vocab: DataFrame,
    number: int = 1,
    size: int = PAGE_SIZE,
    total: Column | None = None,
    threshold: float = SCORE_THRESHOLD,
    first: int = FIRST_SLICES,
) -> tuple[DataFrame, DataFrame]:
    """Page ``number`` of every query without scoring every document that matches.

    Documents stand in slices, and ``maxima`` bound the score in each. The slices of the
    greatest bounds are scored first; then only those whose bound still reaches the last
    place of the page as it stands. Returns the page as ``page`` does, and
    ``(query_id, n_slices, n_scored)``.
    """
    total = count_of(vocab) if total is None else total
    asked = F.broadcast(terms) if fits_broadcast(terms) else terms
    known = vocab.select("term", "df").join(asked, "term")
    weighted = materialize(known.withColumn("idf", idf_search(total, F.col("df"))).drop("df"), "weighted")
    slack = F.lit(1 + 1e-9)  # sums in another order
    bounds = slice_bounds(weighted, maxima).where(F.col("bound") * slack > threshold)
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "doc_slice")
    bounds = materialize(bounds.withColumn("place", F.row_number().over(order)), "slice-bounds")
    last = number * size

    def best(scored: DataFrame, name: str) -> DataFrame:
        return materialize(rank_search(scored.where(F.col("score") > threshold), last), name, SPLIT_BYTES)

    top = best(_scored_slices(weighted, bounds.where(F.col("place") <= first), sliced), "first-slices")
    reached = top.where(F.col("rank") == last).select("query_id", F.col("score").alias("least"))
    rest = bounds.where(F.col("place") > first).join(reached, "query_id", "left")
    open_slices = F.col("least").isNull() | (F.col("bound") * slack >= F.col("least") - 1e-9)
    rest = materialize(rest.where(open_slices).select("query_id", "doc_slice"), "open-slices")
    if not rest.isEmpty():
        more = _scored_slices(weighted, rest, sliced).where(F.col("score") > threshold)
        top = best(top.drop("rank").unionByName(more), "page")
    late = rest.groupBy("query_id").agg(F.count("*").alias("late"))
    counts = bounds.groupBy("query_id").agg(F.count("*").alias("n_slices")).join(late, "query_id", "left")
    scored = F.least("n_slices", F.lit(first)) + F.coalesce("late", F.lit(0))
    read = counts.select("query_id", "n_slices", scored.cast("long").alias("n_scored"))
    return top.where(F.col("rank") > (number - 1) * size), read


def result_count(hits: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """Hits and pages per query; a query without hits has no row."""
    counted = hits.groupBy("query_id").agg(F.count("*").alias("n_results"))
    return counted.withColumn("n_pages", page_count(F.col("n_results"), size))


def fetch_documents(ranked: DataFrame, corpus: DataFrame, buckets: int = DOC_BUCKETS) -> DataFrame:
    """Name, date and speech of ranked documents, joined after ranking and cutting.

    A corpus stored by ``write_documents`` with so many ``buckets`` is read in the folders
    of the ranked documents only; the folders stand in the plan as literals.
    """
    ranked = materialize(ranked, "ranked")  # the size check and the join both read it
    keys = ["doc_id"]
    if "doc_bucket" in corpus.columns:
        ranked = ranked.withColumn("doc_bucket", doc_bucket(F.col("doc_id"), buckets))
        corpus = in_buckets_of(corpus, ranked)
        keys = ["doc_bucket", "doc_id"]
    docs = corpus.select(*keys, SPEECH, MEMBER, DATE)
    if fits_broadcast(ranked):
        ranked = F.broadcast(ranked)
    return docs.join(ranked, keys).drop("doc_bucket")


def search_results(
    hits: DataFrame,
    corpus: DataFrame,
    number: int = 1,
    size: int = PAGE_SIZE,
    buckets: int = DOC_BUCKETS,
) -> DataFrame:
    """Page ``number`` of every query with its documents, and its hits and pages in all.

    ``hits`` come from ``search_hits`` or, for the latent mode, from ``latent_hits``.
    """
    hits = materialize(hits, "hits")
    shown = page(hits, number, size).join(result_count(hits, size), "query_id")
    return fetch_documents(shown, corpus, buckets).select(
        "query_id", "rank", "doc_id", SPEECH, MEMBER, DATE, "score", "n_results", "n_pages"
    )


def search(
    queries: DataFrame,
    pre: Preprocess,
    postings: DataFrame,
    vocab: DataFrame,
    idf_basis: Column | None = None,
    top_k: int | None = None,
    threshold: float = SCORE_THRESHOLD,
    drop_last: bool = False,
    buckets: int = TERM_BUCKETS,
) -> DataFrame:
    """All ranked hits ``(query_id, rank, doc_id, score)`` for a table of queries.

    ``score = sum over query terms, repeats counted, of (1 + ln tf) * ln(1 + total / df)``
    divided by the truncated length of the document.
    """
    terms = query_terms(queries, pre)
    hits = search_hits(terms, postings, vocab, idf_basis, threshold, buckets)
    if drop_last:
        hits = drop_last_hit(hits)
    return rank_search(hits, top_k).select("query_id", "rank", "doc_id", "score")
