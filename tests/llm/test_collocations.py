import random
import re
from collections import Counter

import pytest

from rostra.llm import collocations
from rostra.llm.collocations import collocations as mine


def brute(rows, threshold, reported):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower):
            words = [w for w in re.split(r"[ \t]", piece) if w]
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= threshold}
    scored = {}
    for (lang, p), a in candidates.items():
        score, _, l, r = min(
            (2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
            for k in range(1, len(p))
        )
        scored[lang, p] = (score, a, l, r)
    gone = {
        (lang, p[i : i + size])
        for (lang, p), longer in candidates.items()
        for size in range(2, len(p))
        for i in range(len(p) - size + 1)
        if 100 * longer >= 80 * candidates[lang, p[i : i + size]]
    }
    found = set()
    for lang in n:
        best = sorted(
            (-s, -a, " ".join(p).encode(), l, r)
            for (own, p), (s, a, l, r) in scored.items()
            if own == lang and (own, p) not in gone
        )
        for rank, (s, a, phrase, l, r) in enumerate(best[:reported], 1):
            found.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -s))
    return found


def corpus(seed, n=250):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "État", "\x00x", "ß", "b", "new", "york", "city", "hall", "rare", "日", "-", "c"]
    weights = [9, 3, 8, 7, 5, 2, 3, 5, 4, 4, 3, 3, 1, 2, 2, 4]
    fixed = ["new york city hall", "of the city", "a a a a a", "New York", "b of the b"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choices(words, weights)[0] for _ in range(rng.randint(0, 30))]
        text = "".join(p + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ", "!?"]) for p in parts)
        rows.append((rng.choice(["en", "en", "fr", None, "und", ""]), text))
    return rows + [("en", None), ("en", ""), (None, "..."), ("de", "one"), rows[0], rows[0]]


@pytest.mark.parametrize("shards,noted_bytes", [(1, 1 << 20), (3, 1 << 20), (2, 0)])
def test_against_brute_force(spark, monkeypatch, shards, noted_bytes):
    monkeypatch.setattr(collocations, "NOTED_BYTES", noted_bytes)
    monkeypatch.setattr(collocations, "WORDS_PER_COUNT", 500)
    rows = corpus(shards)
    docs = spark.createDataFrame([(i, lang, t, "k", 1) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, word string, n int")
    found = [tuple(r) for r in mine(docs.repartition(3), shards, 20, 25).collect()]
    expected = brute(rows, 20, 25)
    assert len(found) == len(expected) and set(found) == expected
    assert len({len(r[2].split(" ")) for r in found}) == 3


def test_phrases_activated_in_every_cycle(spark):
    """Rare phrases reach the threshold in the last shard only, so lengths start late."""
    rows = [("en", "one two three four five. " + f"x{i} y{i}") for i in range(30)] + [("en", "two three")] * 5
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert {tuple(r) for r in mine(docs, 2).collect()} == brute(rows, 30, 2000)


def test_sharing_keys_is_noticed(spark, monkeypatch):
    rows = corpus(9, 60)
    monkeypatch.setattr(collocations, "LISTED", 1)
    seeds = []
    monkeypatch.setattr(collocations._Scan, "clash", lambda self: seeds.append(self.seed) or self.seed < 1)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert {tuple(r) for r in mine(docs, 1, 10).collect()} == brute(rows, 10, 2000)
    assert seeds == [0, 1]


def test_long_texts_and_empty(spark):
    rows = [("en", "a b c " * 100_000), ("en", "x" * 1_000_000), ("en", "." * 1_000_000), ("en", " " * 1_000_000)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert {tuple(r) for r in mine(docs, 1).collect()} == brute(rows, 30, 2000)
    assert mine(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert mine(spark.createDataFrame([("en", None), (None, " . ")], "lang string, text string")).count() == 0


def test_words_come_once_per_shard_however_many_batches(spark):
    """Else the rows that spell phrases grow with the batches times the words."""
    rows = [("en", f"new york city hall w{i % 7}") for i in range(200)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(20)
    scan = collocations._Scan(docs, 0, 2, 30)
    scan.run()
    words = scan.words().collect()
    assert len(words) <= 2 * 11
    assert sum(r["n"] for r in words) == 1000
    assert {(r["lang"], r["word"]) for r in words} == {("en", w) for t in rows for w in t[1].split()}
