import random

import numpy as np
import pytest

from rostra.llm.chosen_path import classes, elements, jaccard_join, keep_one, runs_for


def brute(rows):
    sets = {d: set(elements(t or "", 5).tolist()) for d, t in rows}
    linked = {
        (a, b)
        for a in sets
        for b in sets
        if a != b and sets[a] and sets[b]
        and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    }
    label = {d: d for d in sets}
    while True:
        new = {d: min([label[d]] + [label[b] for a, b in linked if a == d]) for d in sets}
        if new == label:
            break
        label = new
    return {d: (label[d], sum(a == d for a, _ in linked)) for d in sets}


def corpus(seed, groups=12, hot=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, lead = [], rng.choices(vocabulary, k=12)
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(30, 120))
        for _ in range(hot if g == 0 else rng.randint(1, 4)):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append(" ".join(words if g % 2 else lead + words))
    rows += ["", None, "one", "one two", "one", "?! ...", "?! ..."]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("small_bucket", [128, 8])
def test_against_brute_force(spark, small_bucket):
    rows = corpus(small_bucket)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join(docs, small_bucket=small_bucket).collect()
    expected = brute(rows)
    assert len(found) == len(rows)
    links = sum(n for _, n in expected.values())
    assert {r.doc_id: r.class_id for r in found} == {d: c for d, (c, _) in expected.items()}
    got = sum(r.n_links for r in found)
    assert all(r.n_links <= expected[r.doc_id][1] for r in found)
    assert got >= 0.99 * links
    kept = {r.doc_id for r in keep_one(docs, small_bucket=small_bucket).collect()}
    assert kept == {c for c, _ in expected.values()}


def test_runs():
    assert runs_for(0.8, 0.999) > runs_for(0.8, 0.9)


def test_classes_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 99)]
    found = classes(spark.createDataFrame(edges, "id long, other long")).collect()
    assert {r.id: r.class_id for r in found} == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def test_defined_cases(spark):
    text = " ".join(f"v{i}" for i in range(30))
    rows = [(1, text, 0, "a"), (1, text, 0, "a"), (None, text, 1, "b"), (2, text + " x", 2, "c"), (3, "", 3, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, path string")
    found = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join(docs).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    assert keep_one(docs).count() == 4
    assert jaccard_join(docs.limit(0)).count() == 0


def test_elements():
    assert len(elements("A b c d e f", 5)) == 2
    assert np.array_equal(elements("a B, c", 5), elements("A b c", 5))


def test_an_id_with_several_texts(spark):
    near = " ".join(f"n{i}" for i in range(40))
    texts = [" ".join(f"t{k}x{i}" for i in range(40)) for k in range(4)]
    rows = [(1, near), (5, near + " end"), (5, texts[0]), (6, texts[1]), (6, texts[1] + " end"), (7, texts[2]), (7, texts[3]), (8, texts[3] + " end"), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard_join(docs).collect())
    assert found == [(1, 1, 1), (5, 1, 1), (5, 5, 0), (6, 6, 1), (6, 6, 1), (7, 7, 0), (7, 7, 1), (8, 7, 1), (8, 8, 0)]
    kept = {(r.doc_id, r.text) for r in keep_one(docs).collect()}
    always = {(1, near), (5, texts[0]), (7, texts[2]), (7, texts[3]), (8, "")}
    assert kept - always in ({(6, texts[1])}, {(6, texts[1] + " end")}) and always <= kept


def test_a_worker_holds_the_sets_of_a_megabyte(monkeypatch):
    import pyarrow as pa

    from rostra.llm import chosen_path

    run, _ = chosen_path._signatures(5, 0.8, 3)
    texts = [f"word{i} and others {i} follow here " * 600 for i in range(200)]
    batch = pa.record_batch({"doc_id": range(200), "text_key": range(200), "text": texts})
    found = list(run(iter([batch])))
    assert sum(b.num_rows for b in found) == 200
    most = max(b.num_rows for b in found) * max(map(len, texts))
    assert most < 1_200_000
