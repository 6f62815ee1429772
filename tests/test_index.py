import math

import pytest
from pyspark.sql import functions as F

from rostra.operators import index
from rostra.runtime import dense_row_number, join_vocabulary, rank_within


def test_counts_norms_and_idf(corpus, plain, built):
    vocab = {r["term"]: (r["df"], r["idf"]) for r in built.vocab.collect()}
    assert {t: d for t, (d, _) in vocab.items()} == {"budget": 2, "health": 1, "school": 2, "tax": 2}
    assert vocab["health"][1] == pytest.approx(2.098612, abs=1e-6)
    assert vocab["tax"][1] == pytest.approx(1.693147, abs=1e-6)
    norms = {r["doc_id"]: r["norm"] for r in index.doc_norms(corpus, plain).collect()}
    assert norms == pytest.approx({0: math.sqrt(5), 1: math.sqrt(2), 2: 0, 3: math.sqrt(5), 4: 1})
    assert tuple(built.stats.select("n_docs", "n_terms").first()) == (5, 4)


def test_vocabulary_numbers(built):
    rows = index.with_term_id(built.vocab.select("term")).orderBy("term_id").collect()
    assert [(r["term_id"], r["term"]) for r in rows] == [
        (0, "budget"), (1, "health"), (2, "school"), (3, "tax"),
    ]


def test_tfidf_rows_have_unit_length(built):
    weights = index.tfidf_docs(built.postings, built.vocab)
    lengths = weights.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s"))
    rows = lengths.collect()
    assert len(rows) == 4 and all(r["s"] == pytest.approx(1.0) for r in rows)


@pytest.mark.parametrize("block_docs", [65536, 2])
def test_catalog_gives_the_postings_back(built, block_docs):
    catalog = index.inverted_catalog(built.postings, built.vocab, block_docs)
    back = sorted(map(tuple, index.catalog_postings(catalog).select("term", "doc_id", "tf").collect()))
    assert back == sorted(map(tuple, built.postings.select("term", "doc_id", "tf").collect()))
    assert max(len(r["postings"]) for r in catalog.collect()) <= block_docs
    lines = [r["value"] for r in index.catalog_lines(catalog).collect()]
    if block_docs > 5:
        assert lines == ["budget,2,0,0,1,1,1", "health,1,0,4,1", "school,2,0,1,1,3,2", "tax,2,0,0,2,3,1"]
    else:
        assert lines[:1] + lines[1:3] == ["budget,2,0,0,1,1,1", "health,1,2,4,1", "school,2,0,1,1"]


def test_heavy_terms_change_nothing(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 40)).alias("term"),
        F.col("id").alias("doc_id"),
    )
    vocab = facts.groupBy("term").agg(F.count("*").alias("df")).where("term <> 't1'")
    plain = sorted(map(tuple, facts.join(vocab, "term").collect()))
    for heavy in (1, 5, 1000):
        assert sorted(map(tuple, join_vocabulary(facts, vocab, heavy).collect())) == plain


def test_numbering_without_a_window(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("k"))
    rows = dense_row_number(df, "n", [F.col("v")]).collect()
    assert sorted((r["v"], r["n"]) for r in rows) == [(i, i) for i in range(5000)]
    ranked = rank_within(df, ["k"], [F.desc("v")], "rank").collect()
    for k in range(3):
        mine = sorted((r["rank"], -r["v"]) for r in ranked if r["k"] == k)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert [m[1] for m in mine] == sorted(m[1] for m in mine)


def test_row_order_does_not_matter(corpus, plain):
    order = lambda df: sorted(map(tuple, index.postings(df, plain).collect()))
    assert order(corpus) == order(corpus.orderBy(F.desc("doc_id")).repartition(3))
