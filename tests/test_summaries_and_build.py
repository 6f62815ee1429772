from pyspark.sql import functions as F

from rostra.operators import index, summarize
from rostra.plans.build import Tables, build_all


def test_summary_keeps_order_and_budget(spark, plain):
    text = 'Common words here. "Rare zebra quagga". Common words again. Common 3.5 rarer words.'
    others = [(i, "common words here again.") for i in range(1, 20)]
    docs = spark.createDataFrame([(0, text), *others, (20, None)], "doc_id long, speech string")
    vocab = index.with_idf(index.doc_freq(index.postings(docs, plain)), F.lit(21))
    found = {r["doc_id"]: r["summary"] for r in summarize.summarize(docs, plain, vocab).collect()}
    # 13 words allow 8: the two sentences with words no other text has
    assert found[0] == "Rare zebra quagga. Common 3.5 rarer words"
    assert found[1] == "common words here again"  # the only sentence is always kept
    assert set(found) == set(range(20))


def test_own_model_hook(spark):
    docs = spark.createDataFrame([(0, "abc def"), (1, None)], "doc_id long, speech string")
    found = summarize.summarize_with(docs, lambda texts: [t[:3] for t in texts]).collect()
    assert [(r["doc_id"], r["summary"]) for r in found] == [(0, "abc")]


def test_build_writes_every_table(spark, corpus, plain, tmp_path):
    sizes = build_all(
        corpus, plain, str(tmp_path), k=2, starts=2, n_components=3, kept=2, oversamples=2
    )
    counted = {r["name"]: r["n_rows"] for r in sizes.collect()}
    assert counted["postings"] == counted["term_postings"] == counted["tfidf"] == 7
    assert counted["vocab"] == counted["catalog"] == 4
    assert counted["norms"] == counted["lsa_docs"] == counted["clusters"] == 5
    assert counted["pairs"] == 3 and counted["stats"] == 1
    assert Tables(spark, str(tmp_path)).read("keywords").where("grouping = 'party'").count() == 5
