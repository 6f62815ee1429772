import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from rostra.llm.pieces import SPACE, Lattices, Sampler, decode, encode, words

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sampler():
    return Sampler(MODEL, 1, 1.0)


def segmentations(word, weight):
    """All segmentations with their weights, by plain recursion."""
    if not word:
        return {(): 1.0}
    found = {}
    for n in range(1, len(word) + 1):
        if word[:n] in weight:
            for rest, w in segmentations(word[n:], weight).items():
                found[(word[:n], *rest)] = weight[word[:n]] * w
    return found


def test_draws_follow_the_weights(sampler):
    word = SPACE + "then"
    vocabulary = sampler.vocabulary
    weight = {t: float(np.exp(vocabulary.weight[i])) for t, i in vocabulary.ids.items()}
    expected = segmentations(word, weight)
    total = sum(expected.values())
    n = 40_000
    drawn = sampler.sample(list(range(n)), [" then"] * n)
    names = {i: p for p, i in vocabulary.ids.items()}
    found = Counter(tuple(names[i] for i in ids.tolist()) for ids in drawn)
    assert set(found) <= set(expected)
    for pieces, weight in expected.items():
        assert abs(found[pieces] / n - weight / total) < 0.015


@pytest.mark.parametrize("seed", range(3))
def test_every_text_comes_back(sampler, seed):
    rng = random.Random(seed)
    letters = [" ", "  ", "a", "the", "ing", "é", "日", "▁", "\0", "\n", "\t", "😀", "\x1f", "Ω", ".", "1"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 20))) for _ in range(400)]
    texts += ["", " ", "▁", "x" * 30_000, "日" * 5000]
    for ids, text in zip(sampler.sample(list(range(len(texts))), texts), texts):
        assert sampler.decode(ids) == text


def test_words_join_to_the_text():
    for text in ("", " ", "a b", " a  b ", "a\n b", "a"):
        assert "".join(words(text)).replace(SPACE, " ") == text


def test_same_row_same_pieces(spark):
    rows = [(i, f"some words of row {i} are here", "x") for i in range(50)] + [(7, None, None), (None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    one = {tuple(r) for r in encode(docs.coalesce(1)).select("doc_id", "ids", "lossless").collect() for r in [(r[0], tuple(r[1]), r[2])]}
    many = {(r[0], tuple(r[1]), r[2]) for r in encode(docs.repartition(7)).select("doc_id", "ids", "lossless").collect()}
    assert one == many and all(x[2] for x in one)
    other = {(r[0], tuple(r[1])) for r in encode(docs, seed=2).select("doc_id", "ids").collect()}
    assert other != {x[:2] for x in one}
    back = decode(encode(docs)).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((r[0] or -1, r[1] or "") for r in rows)
    assert encode(docs.limit(0)).count() == 0


def test_long_rows_keep_memory_small(sampler):
    ids = sampler.sample([1], [" ".join(["word"] * 200_000)])[0]
    assert isinstance(ids, np.ndarray) and len(ids) >= 200_000


def test_lattices_hold_half_a_megabyte_of_text(monkeypatch):
    """All words of a batch are filtered together, so a batch bounds the memory of a worker."""
    from rostra.llm import pieces

    sizes = []

    class Noting(Sampler):
        def sample(self, keys, texts):
            sizes.append(sum(map(len, texts)))
            return super().sample(keys, texts)

    monkeypatch.setattr(pieces, "Sampler", Noting)
    texts = [f"word{i} " * 1000 for i in range(200)]
    batch = pa.record_batch({"doc_id": range(200), "_key": range(200), "_text": texts})
    found = pa.Table.from_batches(pieces._encode(MODEL, 1, 1.0)(iter([batch])))
    assert found.num_rows == 200 and all(found.column("lossless").to_pylist())
    assert max(sizes) < 600_000


def test_edges_lie_by_place(sampler):
    """Filtering goes place by place over edges that lie side by side: nothing is sorted or gathered."""
    cut = [SPACE + "a", "then", SPACE + "日x", "b"]
    lattices = Lattices(sampler.vocabulary, cut)
    firsts, sizes = len(cut), [len(w) for w in cut]
    order = np.argsort(-np.array(sizes), kind="stable").tolist()
    # the last node of a word: all first letters, then all second ones, longer words before
    expected = []
    for i, size in enumerate(sizes):
        before = sum(sum(s > place for s in sizes) for place in range(size - 1))
        expected.append(before + [w for w in order if sizes[w] >= size].index(i))
    assert lattices.last.tolist() == expected
    assert (lattices.goes[: lattices.first[firsts]] == -1).all()
    weight = {t: float(np.exp(sampler.vocabulary.weight[i])) for t, i in sampler.vocabulary.ids.items()}
    plain = segmentations("then", weight)
    whole = sum(w for p, w in plain.items() if len(p) == 1) / sum(plain.values())
    node = lattices.last[1]
    assert abs(lattices.total[lattices.first[node]] - node - whole) < 1e-9
