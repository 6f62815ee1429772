import numpy as np
from pyspark.sql import functions as F

from rostra.llm.importance import Hasher, importance, log_ratios


def rows_of():
    rng = np.random.default_rng(1)
    good, bad = [f"g{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad, 40)), "x") for i in range(600)]
    return rows + [(600, None, "n"), (601, "", "n"), (None, "g1 g2", "n"), (5, "g1 g2 g3", "n")]


def test_models_against_plain_counts(spark):
    rows = [(t or "", i % 2 == 0) for i, (_, t, _) in enumerate(rows_of())]
    found = log_ratios(spark.createDataFrame(rows, "text string, target boolean"), 512)
    hasher, counts = Hasher(512), np.zeros((2, 512))
    for text, good in rows:
        for bucket in hasher(text):
            counts[1, bucket] += 1
            counts[0, bucket] += good
    share = (counts + 1) / (counts.sum(1, keepdims=True) + 512)
    assert np.allclose(found, np.log(share[0] / share[1]))


def test_good_texts_are_kept(spark):
    docs = spark.createDataFrame(rows_of(), "doc_id long, text string, place string")
    labels = docs.filter("doc_id % 2 = 0 AND doc_id < 600").select("doc_id", (F.col("doc_id") % 3 > 0).cast("int").alias("quality"))
    found = importance(docs, labels).collect()
    assert len(found) == docs.count()
    assert sorted(r.place for r in found) == list(range(1, len(found) + 1))
    kept = {r.doc_id for r in found if r.kept}
    good = {i for i in range(600) if i % 3}
    assert len(kept & good) >= 0.97 * len(good)
    order = [r.draw_key for r in sorted(found, key=lambda r: r.place)]
    assert order == sorted(order, reverse=True)
    weights = {r.doc_id: r.log_weight for r in found}
    assert weights[600] == weights[601] == 0
    again = importance(docs.repartition(5), labels).collect()
    assert {(r.doc_id, round(r.draw_key, 9)) for r in again} == {(r.doc_id, round(r.draw_key, 9)) for r in found}
    assert importance(docs, labels, k=10).filter("kept").count() == 10
    assert importance(docs.limit(0), labels).count() == 0
    assert importance(docs, labels.limit(0)).filter("log_weight <> 0").count() == 0
