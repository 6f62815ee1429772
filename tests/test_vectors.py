"""SVD, cosine search and clusters against dense computations."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostra.operators import clusters, index, lsa
from rostra.runtime import materialize


@pytest.fixture(scope="module")
def model_input(spark, plain):
    rng = np.random.default_rng(1)
    words = [f"w{i:03d}" for i in range(120)]
    topics = rng.dirichlet(np.full(120, 0.05), size=6)
    rows = []
    for i in range(300):
        chosen = rng.choice(120, size=rng.integers(5, 40), p=topics[i % 6])
        rows.append((i, " ".join(words[j] for j in chosen)))
    rows.append((300, None))
    texts = spark.createDataFrame(rows, "doc_id long, speech string")
    postings = index.postings(texts, plain).cache()
    vocab = index.with_idf(index.doc_freq(postings), F.lit(301)).cache()
    return texts, postings, vocab


@pytest.fixture(scope="module")
def dense(model_input):
    _, postings, vocab = model_input
    terms = sorted(r["term"] for r in vocab.collect())
    matrix = np.zeros((301, len(terms)))
    for r in index.tfidf_docs(postings, vocab).collect():
        matrix[r["doc_id"], terms.index(r["term"])] = r["weight"]
    return terms, matrix


@pytest.fixture(scope="module")
def model(model_input):
    texts, postings, vocab = model_input
    return lsa.lsa_fit(
        postings, vocab, n_components=8, kept=5, iterations=8, docs_per_block=20, doc_ids=texts
    )


def test_svd_matches_a_dense_one(model, dense):
    terms, matrix = dense
    _, values, right = np.linalg.svd(matrix, full_matrices=False)
    assert model.singular_values == pytest.approx(list(values[:8]), rel=1e-3)
    rows = {r["term"]: r["comp"] for r in model.terms.collect()}
    components = np.array([rows[t] for t in terms]).T
    assert np.abs(components @ components.T - np.eye(8)).max() < 1e-8
    for k in range(5):
        assert abs(components[k] @ right[k]) == pytest.approx(1, abs=1e-3)
        assert components[k][np.abs(components[k]).argmax()] > 0
    docs = {r["doc_id"]: r["vec"] for r in model.docs.collect()}
    assert len(docs) == 301 and docs[300] == [0.0] * 5
    projected = matrix @ components[:5].T
    assert np.abs(projected - np.array([docs[i] for i in range(301)])).max() < 1e-8


def test_few_documents_give_few_components(model_input):
    _, postings, vocab = model_input
    few = postings.where("doc_id < 4")
    small = index.with_idf(index.doc_freq(few), F.lit(4))
    fitted = lsa.lsa_fit(few, small, n_components=10, kept=6)
    assert len(fitted.singular_values) == 4 and fitted.kept == 4
    assert len(fitted.docs.first()["vec"]) == 4


def test_latent_search(spark, plain, model, dense):
    terms, matrix = dense
    text = f"{terms[0]} {terms[5]} {terms[5]} unknown"
    queries = spark.createDataFrame([(1, text), (2, "unknown")], "query_id long, text string")
    folded = {r["query_id"]: r["vec"] for r in lsa.fold_in(queries, plain, model.terms, 5).collect()}
    assert set(folded) == {1}
    docs = {r["doc_id"]: np.array(r["vec"]) for r in model.docs.collect()}
    query = np.array(folded[1])
    cosine = {
        i: float(v @ query / np.linalg.norm(v) / np.linalg.norm(query))
        for i, v in docs.items() if np.linalg.norm(v)
    }
    expected = sorted(
        ((i, c) for i, c in cosine.items() if c > 0.2), key=lambda p: (-round(p[1], 9), p[0])
    )
    cut = lsa.search_lsa(queries, plain, model, top_k=3).orderBy("rank").collect()
    assert [r["doc_id"] for r in cut] == [i for i, _ in expected[:3]]
    dropped = lsa.search_lsa(queries, plain, model, drop_last=True).orderBy("rank").collect()
    assert [r["doc_id"] for r in dropped] == [i for i, _ in expected[:-1]]
    found = lsa.search_lsa(queries, plain, model).orderBy("rank").collect()
    assert [r["doc_id"] for r in found] == [i for i, _ in expected]
    assert [r["score"] for r in found] == pytest.approx([c for _, c in expected])


def test_signs_do_not_matter(model):
    asked = model.docs.select(F.col("doc_id").alias("query_id"), F.col("vec"))
    flipped = model.docs.select("doc_id", F.transform("vec", lambda v, i: F.when(i % 2 == 0, -v).otherwise(v)).alias("vec"))
    turned = flipped.select(F.col("doc_id").alias("query_id"), "vec")
    one = lsa.query_doc_product(asked, model.docs, 0.5, query_bytes=1000)
    other = lsa.query_doc_product(turned, flipped, 0.5)
    key = lambda df: sorted((r["query_id"], r["doc_id"], round(r["score"], 9)) for r in df.collect())
    assert key(one) == key(other)


def test_top_k_within_blocks_is_exact(model):
    asked = model.docs.select(F.col("doc_id").alias("query_id"), F.col("vec"))
    cut = lsa.lsa_rank(lsa.query_doc_product(asked, model.docs, top_k=3), 3)
    whole = lsa.lsa_rank(lsa.query_doc_product(asked, model.docs), 3)
    key = lambda df: sorted((r["query_id"], r["rank"], r["doc_id"]) for r in df.collect())
    assert key(cut) == key(whole)


def brute_silhouette(points, labels):
    distances = np.linalg.norm(points[:, None] - points[None], axis=2) ** 2
    scores = []
    for i, label in enumerate(labels):
        same = (labels == label).sum()
        if same == 1:
            scores.append(0.0)
            continue
        a = distances[i][labels == label].sum() / (same - 1)
        b = min(distances[i][labels == o].mean() for o in set(labels) if o != label)
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


def test_quality_of_given_labels(spark):
    rng = np.random.default_rng(3)
    points = rng.standard_normal((90, 4))
    labels = np.concatenate([[7], np.repeat(0, 60), np.repeat(3, 29)])  # one hot, one single
    rows = [(i, points[i].tolist(), int(labels[i])) for i in range(90)]
    given = spark.createDataFrame(rows, "doc_id long, vec array<double>, cluster int")
    got = clusters.silhouette(given).first()[0]
    assert got == pytest.approx(brute_silhouette(points, labels))
    far = given.withColumn("vec", F.transform("vec", lambda v: v + 1e8))
    assert clusters.silhouette(far).first()[0] == pytest.approx(got, rel=1e-4)
    assert clusters.wcss(far).first()["wcss"] == pytest.approx(clusters.wcss(given).first()["wcss"], rel=1e-4)
    inertia = sum(((points[labels == c] - points[labels == c].mean(0)) ** 2).sum() for c in (0, 3, 7))
    assert clusters.wcss(given).first()["wcss"] == pytest.approx(inertia)


def test_clusters_and_their_terms(model):
    labelled = clusters.kmeans_fit_predict(model.docs, k=6, starts=3).cache()
    assert {r["cluster"] for r in labelled.select("cluster").distinct().collect()} == set(range(6))
    assert labelled.count() == 301
    described = clusters.cluster_terms(labelled, model.terms).collect()
    assert len(described) == 6 * 4
    sweep = {r["k"]: r for r in clusters.k_sweep(model.docs, (1, 3, 6), starts=2).collect()}
    assert sweep[1]["wcss"] > sweep[3]["wcss"] > sweep[6]["wcss"]
    assert sweep[1]["silhouette"] is None and -1 <= sweep[6]["silhouette"] <= 1


def test_top_terms_with_ties(spark):
    rows = [("b", [1.0, 0.5]), ("a", [1.0, -2.0]), ("c", [1.0, 0.7]), ("d", [0.0, 0.7])]
    terms = spark.createDataFrame(rows, "term string, comp array<double>").repartition(3)
    found = clusters.top_terms_per_dim(terms).orderBy("dim", "term_rank").collect()
    assert [(r["dim"], r["term"]) for r in found] == [(0, "a"), (0, "b"), (1, "c"), (1, "d")]


def test_a_term_of_many_blocks_is_summed_in_parts(model_input, monkeypatch):
    texts, postings, vocab = model_input
    few = dict(n_components=4, kept=3, iterations=2, docs_per_block=20)
    whole = lsa.lsa_fit(postings, vocab, **few)
    monkeypatch.setattr(lsa, "_BLOCKS_PER_SUM", 3)
    parts = lsa.lsa_fit(postings, vocab, **few)
    assert parts.singular_values == pytest.approx(whole.singular_values)


def test_blocks_are_cut_by_the_memory_of_their_terms(model_input, monkeypatch):
    """A term in every document, over many blocks: the same values as with few blocks."""
    texts, postings, vocab = model_input
    every = texts.select("doc_id", F.lit("everywhere").alias("term"), F.lit(1).cast("long").alias("tf"))
    more = postings.select("doc_id", "term", "tf").unionByName(every).cache()
    words = index.with_idf(index.doc_freq(more), F.lit(301)).cache()
    few = dict(n_components=4, kept=3, iterations=3)
    whole = lsa.lsa_fit(more, words, **few)
    made = []
    needed_terms = lsa._needed_terms
    monkeypatch.setattr(lsa, "_needed_terms", lambda *a: made.append(needed_terms(*a)) or made[-1])
    monkeypatch.setattr(lsa, "BLOCK_BYTES", 14 * 4 * 60)  # sixty terms of fourteen columns
    cut = lsa.lsa_fit(more, words, **few)
    _, needed, n_blocks = made[0]
    assert n_blocks > 20 and needed.groupBy("block").count().agg(F.max("count")).first()[0] <= 60
    assert needed.where(needed.term_id.isin([r[0] for r in cut.terms.where("term = 'everywhere'").select("term_id").collect()])).count() > 20
    assert cut.singular_values == pytest.approx(whole.singular_values, rel=1e-4)


def test_the_iteration_ends_when_values_rest(spark, monkeypatch):
    rows = [(i, f"t{i % 4}", 1) for i in range(80)] + [(i, "common", 2) for i in range(80)]
    postings = spark.createDataFrame(rows, "doc_id long, term string, tf long")
    vocab = index.with_idf(index.doc_freq(postings), F.lit(80))
    names = []
    monkeypatch.setattr(lsa, "materialize", lambda df, name: names.append(name) or materialize(df, name))
    model = lsa.lsa_fit(postings, vocab, n_components=3, kept=3, iterations=30)
    steps = [n for n in names if n.startswith("basis-")]
    assert 2 < len(steps) < 8 and len(model.singular_values) == 3


def test_documents_meet_one_vector_per_term(spark, model_input):
    """Products of given vectors: terms without or with two vectors, missing numbers."""
    texts, postings, vocab = model_input
    numbered = materialize(index.with_term_id(vocab), "numbered")
    made = numbered.select("term_id", F.array(F.col("term_id") * 0.5, F.lit(-1.0), F.lit(9.0)).alias("comp"))
    none = F.lit(None).cast("double")
    terms = made.where("term_id > 1").unionByName(made.where("term_id = 7")).unionByName(
        numbered.where("term_id = 1").select("term_id", F.array(none, none).alias("comp"))
    )
    only = spark.createDataFrame([(900, 1.0, "w000", 3), (901, 1.0, "w001", 1)], "doc_id long, norm double, term string, tf long")
    more = postings.unionByName(only.select(*postings.columns))
    weights = index.tfidf_docs(more, numbered)
    plain = weights.join(numbered.select("term", "term_id"), "term").join(terms, "term_id").groupBy("doc_id").agg(
        *[F.sum(F.col("weight") * F.get("comp", F.lit(j))).alias(f"c{j}") for j in range(2)]
    )
    expected = {r["doc_id"]: [r["c0"], r["c1"]] for r in plain.collect()}
    found = {r["doc_id"]: r["vec"] for r in lsa.project(more, numbered, terms, 2, docs_per_block=20).collect()}
    assert found.keys() == expected.keys() and 900 not in found and found[901] == [None, None]
    for doc, vec in expected.items():
        assert found[doc] == (vec if None in vec else pytest.approx(vec, abs=1e-9))


def test_project_shuffles_vectors_by_block(model_input):
    """No vector reaches the aggregate of every posting."""
    _, postings, vocab = model_input
    numbered = materialize(index.with_term_id(vocab), "numbered")
    terms = numbered.select("term_id", F.array(F.lit(1.0), F.lit(2.0)).alias("comp"))
    plan = lsa.project(postings, numbered, terms, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Aggregate" not in plan


def test_single_terms_are_merged(spark):
    """Terms of one document stand in one column of their length; their components come back."""
    rows = [(i, f"t{i % 5}", 1 + i % 3) for i in range(40)]
    rows += [(i, f"own{i}-{j}", j) for i in range(0, 40, 2) for j in (1, 2, 2)[: i % 4 + 1]]
    rows = sorted(set(rows))
    postings = spark.createDataFrame(rows, "doc_id long, term string, tf long").cache()
    vocab = index.with_idf(index.doc_freq(postings), F.lit(40)).cache()
    merged, members = lsa._merged(index.tfidf_rows(postings, index.with_term_id(vocab), "term_id", "df"))
    assert members.count() == vocab.where("df = 1").count() > 20
    assert merged.agg(F.sum(F.size("term_ids"))).first()[0] == 40 + 20
    model = lsa.lsa_fit(postings, vocab, n_components=6, kept=6, iterations=12)
    terms = sorted(r["term"] for r in vocab.collect())
    matrix = np.zeros((40, len(terms)))
    for r in index.tfidf_docs(postings, vocab).collect():
        matrix[r["doc_id"], terms.index(r["term"])] = r["weight"]
    comps = {r["term"]: r["comp"] for r in model.terms.collect()}
    components = np.array([comps[t] for t in terms])
    assert np.abs(components.T @ components - np.eye(6)).max() < 1e-8
    assert model.singular_values == pytest.approx(list(np.linalg.svd(matrix)[1][:6]), rel=1e-3)
    docs = {r["doc_id"]: r["vec"] for r in model.docs.collect()}
    assert np.abs(matrix @ components - np.array([docs[i] for i in range(40)])).max() < 1e-8
    wrong = vocab.withColumn("df", F.lit(1).cast("long"))  # of another corpus: nothing may be merged
    kept, none = lsa._merged(index.tfidf_rows(postings, index.with_term_id(wrong), "term_id", "df"))
    assert none is None and kept.agg(F.sum(F.size("term_ids"))).first()[0] == len(rows)


def test_documents_of_the_fit_stay_in_their_blocks(spark):
    """Neighbours share their terms, and no pass shuffles a document; an id may be null."""
    n = 400
    rows = []
    for i in range(n):  # two languages in turns
        own = [1000 * (i % 2) + j for j in range(30)]
        # entries: term_id, df, weight
        rows.append((None if i == 7 else i, [(t, n // 2, 0.1 + 0.8 * (t % 1000 == 0)) for t in own]))
    entries = "array<struct<term_id long, df long, weight double>>"
    split = spark.createDataFrame(rows, f"doc_id long, entries {entries}")
    docs = split.select(
        "doc_id",
        F.col("entries.term_id").alias("term_ids"),
        F.col("entries.weight").alias("weights"),
        *lsa._alike("entries", n),
    )
    stored, needed, n_blocks = lsa._needed_terms(docs, n, 110, 100)
    assert stored.count() == n and stored.where("doc_id IS NULL").count() == 1
    sizes = [r["count"] for r in stored.groupBy("block").count().collect()]
    assert n_blocks == len(sizes) == 4 and set(sizes) == {n // 4}
    _, chance, _ = lsa._hashed_blocks(docs, n, 110, 100)
    assert needed.count() == 4 * 30 and chance.count() == 4 * 60
    pairs = lsa._per_block(stored, needed, None).applyInArrow(lambda d, t: t.slice(0, 0), "block int, term_id long")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan  # that of the terms


def test_a_fit_keeps_the_last_basis_only(spark, monkeypatch):
    """F6-F8: passes that are over, the documents by block and what was shuffled take no room."""
    rows = [(i, f"t{i % 4}", 1) for i in range(80)] + [(i, "common", 2) for i in range(80)]
    postings = spark.createDataFrame(rows, "doc_id long, term string, tf long")
    vocab = index.with_idf(index.doc_freq(postings), F.lit(80))
    stored = {}

    def noted(df, name):
        stored[name] = materialize(df, name)
        return stored[name]

    monkeypatch.setattr(lsa, "materialize", noted)
    model = lsa.lsa_fit(postings, vocab, n_components=3, kept=3, iterations=3)
    files = {name: [Path(f.removeprefix("file:")).exists() for f in table.inputFiles()] for name, table in stored.items()}
    steps = [name for name in stored if name.startswith("basis-")]
    assert len(steps) > 1 and all(files[steps[-1]])
    assert not any(any(files[name]) for name in [*steps[:-1], "tfidf"])
    assert model.terms.count() == 5 and model.docs.count() == 80


def test_all_pairs_of_components_are_looked_at(spark):
    """components 0 and 2 that are not orthogonal show, whatever their distance in number."""
    turned = np.linalg.qr(np.random.default_rng(2).normal(size=(30, 10)))[0]

    def products(matrix):
        rows = [(i, row.tolist()) for i, row in enumerate(matrix)]
        return lsa.component_products(spark.createDataFrame(rows, "term_id long, comp array<double>").repartition(3), 10)

    assert products(turned) == pytest.approx(turned.T @ turned) and lsa.is_orthonormal(products(turned))
    for other in range(1, 10):
        skew = turned.copy()
        skew[:, other] += 1e-3 * skew[:, 0]
        assert not lsa.is_orthonormal(products(skew)), other


def test_documents_without_a_product_must_be_zero(spark):
    """a vector for a document without terms is wrong, and a missing number too."""
    docs = [(0, [1.0, 2.0]), (1, [0.0, 0.0]), (2, [0.5, 0.0]), (3, [1.0, None]), (4, [1.0, 2.1]), (None, [0.0, 0.0])]
    plain = [(0, [1.0, 2.0]), (3, [1.0, 1.0]), (4, [1.0, 2.0])]
    found = lsa.products_wrong(
        spark.createDataFrame(docs, "doc_id long, vec array<double>"),
        spark.createDataFrame(plain, "doc_id long, plain array<double>"),
        2,
    )
    assert sorted(r["doc_id"] for r in found.collect()) == [2, 3, 4]


def test_sums_of_groups_of_all_lengths():
    """F2, F4-F11: long groups by one product, short ones side by side; none for a group without entries."""
    rng = np.random.default_rng(6)
    many = np.concatenate([rng.integers(0, 6, 2500), [0, 63, 64, 65, 20_000]])
    group = np.repeat(np.arange(len(many)), many).astype(np.int32)
    index_, weights = rng.integers(0, 90, len(group)).astype(np.int32), rng.normal(size=len(group)).astype(np.float32)
    dense = rng.normal(size=(90, 5))
    expected = np.zeros((len(many) + 1, 5))
    np.add.at(expected, group, dense[index_] * weights[:, None].astype(float))
    assert lsa._grouped_sums(group, len(many) + 1, index_, weights, dense) == pytest.approx(expected, abs=1e-9)
    assert lsa._grouped_sums(group[:0], 3, index_[:0], weights[:0], dense).tolist() == [[0.0] * 5] * 3
    ids = np.arange(40, dtype=np.int64)
    assert (lsa._start(ids, 30, 3, slice(7, 19)) == lsa._start(ids, 30, 3)[:, 7:19]).all()


def test_a_bucket_of_terms_sums_each_row_once(monkeypatch):
    """F2, F4-F11: what was summed before is not summed again with every batch."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    ids, rows, handled = rng.integers(0, 700, 4000), rng.normal(size=(4000, 6)), []
    summed = lsa._summed
    monkeypatch.setattr(lsa, "_summed", lambda i, r: handled.append(len(i)) or summed(i, r))
    batches = [
        pa.RecordBatch.from_arrays([pa.array(ids[i : i + 300]), lsa._pack(rows[i : i + 300])], names=["term_id", "vec"])
        for i in range(0, 4000, 300)
    ]
    (found,) = lsa._sum_step(6, np.float64)((), iter(batches))
    expected = np.zeros((700, 6))
    np.add.at(expected, ids, rows)
    own = found.column("term_id").to_numpy()
    assert sorted(own) == sorted(set(ids)) and sum(handled) == 4000
    assert lsa._unpack(found.column("vec"), 6) == pytest.approx(expected[own])
    (none,) = lsa._sum_step(6, np.float64)((), iter([]))
    assert none.num_rows == 0
