import numpy as np
import pytest

from rostra.llm import topk
from rostra.llm.topk import integers, top_k


def brute(rows, k=5, every=50):
    usable = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        usable.setdefault(i, []).append([int(np.floor(256 * float(np.float32(x)))) for x in v])
    found = set()
    for q in usable:
        if q % every:
            continue
        for query in usable[q]:
            scores = {
                (-sum(a * b for a, b in zip(query, v)), i)
                for i, vs in usable.items()
                for v in vs
                if i != q and len(v) == len(query)
            }
            found |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])}
    return found


@pytest.mark.parametrize("segment", [4096, 64])
def test_against_brute_force(spark, monkeypatch, segment):
    rng = np.random.default_rng(segment)
    centres = rng.normal(size=(5, 16))
    rows = [(i, (centres[i % 5] + 0.3 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(i, rows[3][1]) for i in range(700, 800)]  # many equal vectors
    rows += [(900, None), (950, [1.0, None] + [0.0] * 14), (1000, [float("nan")] * 16), (1050, [])]
    rows += [(1100, [0.5, -0.5]), (1101, [1.0, 1.0]), (None, rows[0][1]), rows[50]]
    vectors = integers(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).repartition(3)
    monkeypatch.setattr(topk, "SEGMENT", segment)
    found = top_k(vectors.filter("vec_id % 50 = 0"), vectors)
    assert {tuple(r) for r in found.collect()} == brute(rows)


def test_several_passes_and_empty(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    vectors = integers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    monkeypatch.setattr(topk, "QUERY_BYTES", 200)
    found = top_k(vectors.filter("vec_id % 50 = 0"), vectors)
    assert {tuple(r) for r in found.collect()} == brute(rows)
    assert top_k(vectors.limit(0), vectors).count() == 0
    assert top_k(vectors.filter("vec_id % 50 = 0"), vectors.limit(0)).count() == 0


@pytest.mark.parametrize("dims,spread", [(3, 0.05), (16, 0.3), (64, 1.0)])
def test_bounds_close_without_whole_products(dims, spread):
    """Nothing is computed for rows outside: the rows left open are few, and hold the best."""
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(20, dims))
    vectors = np.floor(256 * (centres[np.arange(3000) % 20] + spread * rng.normal(size=(3000, dims)))).astype(np.int64)
    ids = rng.permutation(3000).astype(np.int64)
    segment = topk.Segment(ids, vectors)
    queries, own = vectors[:60].astype(float), ids[:60]
    found, depths = segment.candidates(queries, own, 5, np.full(60, -np.inf))
    for i, rows in enumerate(found):
        scores = segment.vectors @ queries[i].astype(np.int64)
        scores[segment.ids == own[i]] = np.iinfo(np.int64).min
        assert set(np.flatnonzero(scores > np.sort(scores)[-5])) <= set(rows.tolist())
        assert len(rows) <= 20 and 5 <= len(rows)
    assert depths.max() <= 1 and (depths.mean() < 0.7 or dims == 64)


def test_clashing_columns(spark):
    rows = [(i, [0.1 * i, -0.2], "x", 5, 1.0) for i in range(120)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, vec string, dims int, score double")
    vectors = integers(docs)
    found = top_k(vectors.filter("vec_id % 50 = 0"), vectors)
    assert {tuple(r) for r in found.collect()} == brute([r[:2] for r in rows])
