import pytest
from pyspark.sql import functions as F

from rostra.operators import search


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(7, "tax budget tax unknown"), (8, "  "), (9, "nothing known"), (10, "Health, x")]
    return spark.createDataFrame(rows, "query_id long, text string")


def ranking(df, query=7):
    rows = df.where(F.col("query_id") == query).orderBy("rank").collect()
    return [(r["doc_id"], round(r["score"], 6)) for r in rows]


EXPECTED = [(0, 2.409418), (3, 1.098612), (1, 1.098612)]


@pytest.mark.parametrize("layout", ["postings", "term_postings"])
def test_fixture_ranking(queries, plain, built, layout):
    found = search.search(queries, plain, getattr(built, layout), built.vocab)
    assert ranking(found) == EXPECTED
    assert ranking(found, 10)[0][0] == 4
    assert found.where("query_id in (8, 9)").count() == 0


def test_documents_as_basis_and_last_hit(queries, plain, built):
    by_docs = search.search(queries, plain, built.postings, built.vocab, idf_basis=F.lit(5))
    assert ranking(by_docs) == [(0, 2.747494), (3, 1.252763), (1, 1.252763)]
    short = search.search(queries, plain, built.postings, built.vocab, drop_last=True)
    assert ranking(short) == EXPECTED[:2]


def test_large_batches_are_salted_to_the_same_result(queries, plain, built, monkeypatch):
    monkeypatch.setattr(search, "fits_broadcast", lambda df: False)
    for layout in (built.postings, built.term_postings):
        assert ranking(search.search(queries, plain, layout, built.vocab)) == EXPECTED
    terms = search.query_terms(queries, plain)
    salted = search.query_postings_join(
        terms, built.postings, built.vocab, small=False, postings_per_task=1
    )
    joined = search.query_postings_join(terms, built.postings, built.vocab, small=True)
    key = lambda df: sorted(map(str, df.select("query_id", "term", "doc_id", "tf").collect()))
    assert key(salted) == key(joined)
    known = search.known_terms(terms, built.vocab).collect()
    assert {r["term"] for r in known} == {"tax", "budget", "health"}


def test_whole_ranking_equals_the_window(queries, plain, built):
    whole = search.search(queries, plain, built.postings, built.vocab, top_k=None)
    assert ranking(whole) == EXPECTED


def test_pages_and_counts(queries, plain, built):
    hits = search.search_hits(search.query_terms(queries, plain), built.postings, built.vocab)
    counts = {r["query_id"]: (r["n_results"], r["n_pages"]) for r in search.result_count(hits, 2).collect()}
    assert counts == {7: (3, 2), 10: (1, 1)}
    assert ranking(search.page(hits, 2, 2)) == EXPECTED[2:]


def test_single_queries_read_few_buckets(spark, plain, built):
    one = spark.createDataFrame([(1, "tax")], "query_id long, text string")
    terms = search.query_terms(one, plain)
    assert "term_bucket" in built.postings_for(terms).columns
    found = search.query_postings_join(terms, built.term_postings, built.vocab)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()


def test_documents_are_fetched_in_rank_order(queries, plain, built, corpus):
    top = search.search(queries, plain, built.postings, built.vocab)
    rows = search.fetch_documents(top, corpus).where("query_id = 7").orderBy("rank").collect()
    assert [r["member_name"] for r in rows] == ["A", "C", "B"]


def files_read(df):
    """Files that the scan of a collected result opened."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            total += node.metrics().apply("numFiles").value() if "speech" in node.toString() else 0
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_stored_documents_are_read_by_folder(spark, corpus, queries, plain, built, tmp_path):
    from rostra.sources.tables import write_documents

    path = str(tmp_path / "documents")
    write_documents(corpus, path, 16)
    stored = spark.read.parquet(path)
    hits = search.search_hits(search.query_terms(queries, plain), built.postings, built.vocab)
    found = search.search_results(hits, stored, buckets=16)
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "doc_bucket" in filters and " IN (" in filters
    rows = found.where("query_id = 7").orderBy("rank").collect()
    assert [(r["doc_id"], r["n_results"], r["n_pages"]) for r in rows] == [(0, 3, 1), (3, 3, 1), (1, 3, 1)]
    plain_rows = search.search_results(hits, corpus).where("query_id = 7").orderBy("rank").collect()
    assert plain_rows == rows
    assert search.search_results(hits, stored, number=2, buckets=16).count() == 0


def test_a_fetch_opens_few_files(spark, tmp_path, monkeypatch):
    from rostra.schemas import DATE, MEMBER, PARTY, SPEECH
    from rostra.sources import tables

    path = str(tmp_path / "documents")
    columns = [F.lit("m").alias(MEMBER), F.lit("d").alias(DATE), F.lit("p").alias(PARTY)]
    corpus = spark.range(3000).select(F.col("id").alias("doc_id"), *columns, F.concat(F.lit("text "), "id").alias(SPEECH))
    tables.write_documents(corpus, path, 40)
    stored = spark.read.parquet(path)
    for ids in ([5, 17, 2999], [], list(range(0, 3000, 7))):
        ranked = spark.createDataFrame([(1, i, k + 1) for k, i in enumerate(ids)], "query_id long, doc_id long, rank int")
        for listed in (1000, 0):
            monkeypatch.setattr(tables, "LISTED_IDS", listed)
            found = search.fetch_documents(ranked, stored, 40)
            assert sorted(r["doc_id"] for r in found.collect()) == ids
            assert all(r[SPEECH] == f"text {r['doc_id']}" for r in found.collect())
            if len(ids) < 10:
                assert files_read(search.fetch_documents(ranked, stored, 40)) <= len(ids) * 2
    assert len(stored.inputFiles()) >= 40


def test_pages_by_bounds(spark, plain, tmp_path):
    """Equal to the head of the whole ranking, with most slices left out."""
    import random

    from rostra.plans.build import build_index, build_slices
    from rostra.schemas import DATE, MEMBER, PARTY, SPEECH

    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(600):
        text = " ".join(rng.choices(words, range(60, 0, -1), k=rng.choice([3, 8, 30, 120, 400])))
        rows.append((i, "m", "01/01/1990", "p", text if i % 50 else None))
    rows += [(i, "m", "01/01/1990", "p", "w1 w2 w2") for i in range(600, 640)]  # ties over the page's end
    corpus = spark.createDataFrame(rows, f"doc_id long, {MEMBER} string, {DATE} string, {PARTY} string, {SPEECH} string")
    tables = build_index(corpus, plain, str(tmp_path / "index"))
    build_slices(tables, 640)
    texts = ["w1 w2 w2", "w59", "w0 w0 w3 w58", "unknown", "", "w5 w6 w7 w8 w9"]
    asked = spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")
    terms = search.query_terms(asked, plain)
    hits = search.search_hits(terms, tables.postings, tables.vocab)
    sliced, maxima = tables.read("sliced_postings"), tables.read("block_maxima")
    for number in (1, 3):
        expected = [(r["query_id"], r["rank"], r["doc_id"]) for r in search.page(hits, number).collect()]
        found, read = search.page_by_bounds(terms, sliced, maxima, tables.vocab, number)
        assert sorted((r["query_id"], r["rank"], r["doc_id"]) for r in found.collect()) == sorted(expected)
    found, read = search.page_by_bounds(terms, sliced, maxima, tables.vocab, 1)
    counts = {r["query_id"]: (r["n_slices"], r["n_scored"]) for r in read.collect()}
    assert set(counts) == {0, 1, 2, 5}, counts
    assert all(scored <= slices for slices, scored in counts.values()), counts
    assert sum(scored for _, scored in counts.values()) < 0.9 * sum(slices for slices, _ in counts.values()), counts
    assert search.page_by_bounds(terms.limit(0), sliced, maxima, tables.vocab)[0].count() == 0


def test_index_is_shuffled_by_term_only_for_queries_that_read_it(spark, corpus, plain, tmp_path):
    from pathlib import Path

    from rostra.plans.build import build_index, build_term_postings

    tables = build_index(corpus, plain, str(tmp_path / "index"), by_term=False)
    assert not Path(tables.path("term_postings")).exists()
    assert tables.vocab.count() == 4 and tables.stats.count() == 1
    build_term_postings(tables)
    terms = ["doc_id", "norm", "term", "tf"]
    by_term = sorted(map(tuple, tables.term_postings.select(terms).collect()))
    assert by_term == sorted(map(tuple, tables.postings.select(terms).collect()))
