import random

import pytest

from rostra.llm.sentence_spans import sentences, spans, substring_dedup


def brute(rows, least):
    """The same by a dictionary of span texts."""
    first, found = {}, []
    for doc, text in sorted((d, t or "") for d, t in rows):
        parts = sentences(text)
        words = [p.lower().split() for p in parts]
        own = set()
        for a in range(len(parts)):
            for b in range(a + 1, len(parts) + 1):
                if not words[a] or not words[b - 1]:
                    continue
                n = sum(map(len, words[a:b]))
                if n >= least and (n - len(words[a]) < least or n - len(words[b - 1]) < least):
                    own.add((a, b))
        for a, b in sorted(own):
            key = tuple(" ".join(w) for w in words[a:b] if w)
            found.append((key, doc, a, b))
            first[key] = min(first.get(key, (doc, a)), (doc, a))
    gone = {}
    for key, doc, a, b in found:
        if (doc, a) > first[key]:
            gone.setdefault(doc, set()).update(range(a, b))
    return {
        doc: "".join(p for i, p in enumerate(sentences(text or "")) if i not in gone.get(doc, ()))
        for doc, text in rows
    }


def test_sentences_join_to_the_text():
    for text in ("", "a", "A b. C d!\n\nE", "\n\n", "x. ", "3.5 is. no"):
        assert "".join(sentences(text)) == text


def test_span_lengths():
    assert spans(["a b. ", "c d. ", "e f. "], 100) == []
    assert {(a, b) for _, a, b in spans(["a b. ", "c d. ", "e f. "], 3)} == {(0, 2), (1, 3)}


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) + ". " for _ in range(8)]
    rows = [(i, "".join(rng.choices(pool, k=rng.randint(0, 9)))) for i in range(40)] + [(40, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text or "" for r in substring_dedup(docs, 8).collect()}
    assert found == brute(rows, 8)


def test_defined_cases(spark):
    passage = "One two three four five. Six seven eight nine ten. "
    rows = [
        (2, "Own words here. " + passage, "x", 1),
        (1, passage + "Rest of it.", "y", 2),
        (3, None, "z", 3),
        (None, passage, "n", 4),
        (4, passage + passage, "w", 5),
        (5, "", None, 6),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h1 string, start int")
    found = {r.doc_id: (r.text, r.removed) for r in substring_dedup(docs, 10).collect()}
    assert found[1] == (passage + "Rest of it.", [])
    assert found[2] == ("Own words here. ", [1, 2])
    assert found[3] == (None, [])
    assert found[None] == (passage, [])
    assert found[4] == ("", [0, 1, 2, 3])
    assert found[5] == ("", [])
    assert substring_dedup(docs.limit(0), 10).count() == 0


def test_an_id_with_several_texts(spark):
    passage = "One two three four five. Six seven eight nine ten. "
    own = "Own a b c d e f g. Own h i j k l m n. "
    rows = [(1, passage), (2, "A b. C d. E f. " + passage + own), (2, "Short one. "), (2, own + "End of it. ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.text) for r in substring_dedup(docs, 10).collect())
    head = "A b. C d. E f. "
    kept_in_one = [(1, passage), (2, head), (2, own + "End of it. "), (2, "Short one. ")]
    kept_in_other = [(1, passage), (2, head + own), (2, "End of it. "), (2, "Short one. ")]
    assert found in (sorted(kept_in_one), sorted(kept_in_other))


def test_short_runs_and_long_sentences(spark):
    run = "Every visitor signs the book first. The porter keeps all the keys. "
    line = " ".join(f"w{i}" for i in range(20)) + ". "
    long = " ".join(f"v{i}" for i in range(45)) + ". "
    texts = [run + "One ending here. ", "Another beginning here. " + run, line + "A b. ", "C d. " + line, long + "E f. ", "G h. " + long]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.removed for r in substring_dedup(docs).collect()}
    assert found == {0: [], 1: [1, 2], 2: [], 3: [], 4: [], 5: [1]}


def test_spans_are_of_two_sentences():
    rng = random.Random(7)
    for _ in range(300):
        parts = [" ".join("a" * rng.choice([0, 1, 3, 9, 14])) + ". " * rng.randint(0, 1) for _ in range(6)]
        n = [len(p.split()) for p in parts]
        expected = {(a, a + 1) for a in range(6) if n[a] >= 14}
        for a in range(6):
            for b in range(a + 2, 7):
                inner = [(c, d) for c, d in ((a + 1, b), (a, b - 1)) if sum(x > 0 for x in n[c:d]) > 1 and sum(n[c:d]) >= 12]
                several = sum(x > 0 for x in n[a:b]) > 1 and sum(n[a:b]) >= 12
                if n[a] and n[b - 1] and several and len(inner) < 2:
                    expected.add((a, b))
        assert {(a, b) for _, a, b in spans(parts, 12, 14)} == expected


@pytest.mark.parametrize("text", ["." * 1_000_000, "a." * 500_000, "!? " * 300_000, "word " * 200_000, "\n" * 1_000_000, "7" * 1_000_000])
def test_very_long_runs(text):
    import time

    begin = time.time()
    parts = sentences(text)
    assert "".join(parts) == text
    assert time.time() - begin < 5
