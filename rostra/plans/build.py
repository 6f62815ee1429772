"""Building and storing every table of a corpus."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.functions.text import Preprocess
from rostra.operators import clusters, groups, index, lsa, pairs
from rostra.runtime import SPLIT_BYTES, storing
from rostra.schemas import CLUSTERS, KMEANS_STARTS, MEMBER, PARTY
from rostra.sources.corpus import processed
from rostra.sources.tables import (
    bucket_count,
    slice_count,
    slice_parts,
    write_clusters,
    write_keyed,
    write_keywords,
    write_pairs,
    write_sliced_postings,
    write_table,
    write_term_postings,
)

INDEX_TABLES = ("postings", "term_postings", "vocab", "stats")


@dataclass(frozen=True)
class Tables:
    """Stored tables below one folder."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @property
    def postings(self) -> DataFrame:
        """Postings in document order."""
        return self.read("postings")

    @property
    def term_postings(self) -> DataFrame:
        """Postings by term bucket, for queries."""
        return self.read("term_postings")

    def postings_for(self, terms: DataFrame) -> DataFrame:
        """The layout that reads less: term buckets for few terms, document order for many.

        In document order a task holds all postings of its documents, so their scores are
        summed before the shuffle; in term order most folders are not read at all.
        """
        return self.postings if self.asks_many(terms) else self.term_postings

    def asks_many(self, terms: DataFrame) -> bool:
        """Whether the terms lie in so many buckets that document order reads less."""
        few = self.buckets // 2
        return terms.select("term").distinct().limit(few + 1).count() > few

    @property
    def vocab(self) -> DataFrame:
        """``term, df, idf``."""
        return self.read("vocab")

    @property
    def stats(self) -> DataFrame:
        """``n_docs, n_terms, term_buckets``, one row."""
        return self.read("stats")

    @cached_property
    def buckets(self) -> int:
        """The number of term buckets that ``term_postings`` was written with."""
        return self.stats.first()["term_buckets"]


def build_index(
    corpus: DataFrame,
    pre: Preprocess,
    root: str,
    keep: tuple[str, ...] = (),
    by_term: bool = True,
) -> Tables:
    """Postings, vocabulary and corpus statistics, which all other tables start from.

    The texts are read once; everything later reads the stored postings. ``keep`` columns
    stand in the postings as well. Without ``by_term`` the postings by term bucket, which
    shuffle all postings, are left to ``build_term_postings``.
    """
    tables = Tables(corpus.sparkSession, root)
    write_table(index.postings(corpus, pre, keep=keep), tables.path("postings"))
    n_docs = corpus.count()
    buckets = bucket_count(tables.postings.count())
    vocab = index.with_idf(index.doc_freq(tables.postings), F.lit(n_docs))
    write_keyed(vocab, tables.path("vocab"), "term")
    stats = index.corpus_stats(corpus, tables.vocab)
    write_table(stats.withColumn("term_buckets", F.lit(buckets)), tables.path("stats"))
    if by_term:
        build_term_postings(tables, keep)
    return tables


def build_term_postings(tables: Tables, keep: tuple[str, ...] = ()) -> None:
    """The postings by term bucket, for queries that ask for few terms."""
    write_term_postings(
        tables.postings.drop(*keep),
        tables.path("term_postings"),
        tables.buckets,
        slice_count(tables.stats.first()["n_docs"]),
    )


def build_slices(tables: Tables, n_docs: int) -> None:
    """Postings by document slice and the bounds of every slice, for pages of results."""
    postings = tables.postings.select("doc_id", "norm", "term", "tf")
    with storing(tables.spark, SPLIT_BYTES):
        write_sliced_postings(postings, tables.path("sliced_postings"), slice_parts(n_docs), postings.count())
        write_keyed(
            index.block_maxima(tables.read("sliced_postings")), tables.path("block_maxima"), "term", "doc_slice"
        )


def build_all(
    corpus: DataFrame,
    pre: Preprocess,
    root: str,
    k: int = CLUSTERS,
    starts: int = KMEANS_STARTS,
    **svd,
) -> DataFrame:
    """Write every table of a corpus below ``root``; returns ``(name, n_rows, content)``.

    The texts are cleaned for the postings and for the processed corpus; norms and counts
    per group come from the postings, which carry what they need.
    """
    keep = (MEMBER, PARTY, "year")
    tables = build_index(groups.with_year(corpus), pre, root, keep)
    write_table(processed(corpus, pre), tables.path("processed"))
    norms = tables.postings.groupBy("doc_id").agg(F.first("norm").alias("norm"))
    norms = corpus.select("doc_id").join(norms, "doc_id", "left").fillna({"norm": 0.0})
    write_table(norms, tables.path("norms"))
    catalog = index.inverted_catalog(tables.postings, tables.vocab)
    write_keyed(catalog, tables.path("catalog"), "term", "block")
    write_table(index.tfidf_docs(tables.postings, tables.vocab), tables.path("tfidf"))

    base = tables.postings.groupBy(*keep, "term").agg(F.sum("tf").alias("tf"))
    with storing(tables.spark, SPLIT_BYTES):
        write_table(base, tables.path("group_base"))
    base = tables.read("group_base")
    counts = groups.all_groupings(base)
    write_keywords(groups.top_keywords(counts, tables.vocab), tables.path("keywords"))
    members = groups.group_vectors(groups.group_term_counts(base, "member"), tables.vocab)
    write_table(members, tables.path("member_vectors"))
    similar = pairs.similar_entities(tables.read("member_vectors"))
    write_pairs(similar, tables.path("pairs"))

    model = lsa.lsa_fit(tables.postings, tables.vocab, doc_ids=corpus, **svd)
    lsa.write_lsa(model, tables.root)
    clustered = clusters.kmeans_fit_predict(tables.read("lsa_docs"), k, starts)
    write_clusters(clustered, tables.path("clusters"))
    described = clusters.cluster_terms(tables.read("clusters"), tables.read("lsa_terms"))
    write_table(described, tables.path("cluster_terms"))

    names = [
        *INDEX_TABLES, "processed", "norms", "catalog", "tfidf", "keywords", "member_vectors",
        "pairs", "lsa_docs", "lsa_terms", "clusters", "cluster_terms",
    ]
    return table_sizes(tables, names)


# A number that tells whether a table holds what it should.
CONTENT = {
    "postings": "sum(tf)",
    "term_postings": "sum(tf)",
    "vocab": "sum(idf)",
    "stats": "max(n_docs) + max(n_terms)",
    "processed": "sum(length(speech))",
    "norms": "sum(norm)",
    "catalog": "sum(size(postings))",
    "tfidf": "sum(weight)",
    "keywords": "sum(weight)",
    "member_vectors": "sum(weight)",
    "pairs": "sum(similarity)",
    "lsa_docs": "count(DISTINCT doc_id)",
    "lsa_terms": "count(DISTINCT term)",
    "clusters": "count(DISTINCT cluster)",
    "cluster_terms": "count(DISTINCT cluster)",
}


def table_sizes(tables: Tables, names: list[str]) -> DataFrame:
    """``(name, n_rows, content)``, computed by Spark when the result is read."""
    sizes = None
    for name in names:
        content = F.round(F.expr(CONTENT[name]).cast("double"), 3).alias("content")
        size = tables.read(name).agg(
            F.lit(name).alias("name"), F.count("*").alias("n_rows"), content
        )
        sizes = size if sizes is None else sizes.unionByName(size)
    return sizes
