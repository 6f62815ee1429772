import random

import pytest
from pyspark.sql import functions as F

from rostra.llm.common import held_out
from rostra.llm.toxicity import Lexicon, Reader, keep_clean, toxicity


def distance(a, b):
    """Inserted, deleted, replaced and swapped letters between two words."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@pytest.fixture(scope="module")
def lexicon():
    return Lexicon({"scum": (0, 40), "idiot": (0, 50), "worthless": (1, 60), "vex*": (0, 30)}, 1000, 100)


def test_automaton_against_distances():
    rng = random.Random(1)
    entries = ["idiot", "worthless", "scum", "bad", "vexat*", "wort*", "idiotic"]
    lexicon = Lexicon({e: (0, 40) for e in entries}, 1000, 100)
    allowed = {"idiot": 1, "worthless": 2, "scum": 1, "bad": 0, "vexat*": 1, "wort*": 0, "idiotic": 1}
    several = 0
    for _ in range(5000):
        word = list(rng.choice(entries).removesuffix("*") + rng.choice(["", "", "ion", "s"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            if rng.random() < 0.4 and at + 1 < len(word):
                word[at], word[at + 1] = word[at + 1], word[at]
            else:
                word[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "i", "o", "1"])
        word = "".join(word)
        within = []
        for e in entries:
            parts = [word[:n] for n in range(len(word) + 1)] if e.endswith("*") else [word]
            least = min(distance(p, e.removesuffix("*")) for p in parts)
            if word and allowed[e] and least <= allowed[e]:
                within.append((least, e))
        found = lexicon.near(word)
        assert (found is not None) == bool(within), word
        if found:
            assert found[1] == min(within)[0]
            assert (found[1], found[0]) in within
            several += found[1] > 0
    assert several > 500


def test_kept_states_do_not_change_matches(monkeypatch):
    from rostra.llm import toxicity as module

    words = ["idoit", "worhtless", "csum", "suc", "table", "vexed", "wrothles", "scums"] * 3
    plain = Lexicon({"scum": (0, 40), "idiot": (0, 50), "worthless": (1, 60), "vexed*": (0, 30)}, 1000, 100)
    expected = [plain.near(w) for w in words]
    monkeypatch.setattr(module, "REMEMBERED", 3)
    few = Lexicon(plain.entries, 1000, 100)
    assert [few.near(w) for w in words] == expected and expected[0] == ("idiot", 1)


def test_matches(lexicon):
    assert lexicon.match("idiot") == ("idiot", 1.0)
    assert lexicon.match("vexation") == ("vex*", 1.0)
    assert lexicon.match("idiots")[0] == "idiot" and lexicon.match("idiots")[1] < 1
    assert lexicon.match("1diot")[0] == "idiot"
    assert lexicon.match("scam")[0] == "scum" and lexicon.match("patriot") is None
    for word in ("diiot", "scvm", "scmu", "idoit"):
        assert lexicon.match(word)[0] in ("idiot", "scum")
    assert lexicon.match("iditos") is None  # a swap and a letter more
    assert lexicon.weight("idiot") > lexicon.weight("idiot", 1) > 0


def test_quotations_count_less(lexicon):
    reader = Reader(lexicon)
    plain = reader.features("you are an idiot and a fool of that kind")
    quoted = reader.features('you are an "idiot" and a fool of that kind')
    said = reader.features("he called me an idiot and a fool of that kind")
    together = reader.features("you idiot and worthless scum of that kind")
    assert plain[0] > quoted[0] and plain[0] > said[0] and quoted[4] > 0 == plain[4]
    assert together[0] > plain[0]
    for n in (100, 400, 5000):  # a quotation of any length
        long = reader.features('he wrote it: "' + "word " * n + 'idiot" and that')
        assert long[4] > 0 and long[0] < plain[0]
    assert reader.features("") == reader.features("nothing here") == [0.0] * 6


def rows_of(n=600):
    rng = random.Random(5)
    clean, bad = [f"word{i}" for i in range(300)], ["grobian", "lumpenkerl", "tropfnase"]
    rows = []
    for i in range(n):
        toxic = i % 7 == 0
        words = rng.choices(clean, k=30)
        if toxic:
            for _ in range(3):
                words[rng.randrange(30)] = rng.choice(bad)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_rows_are_told_apart(spark):
    rows = rows_of()
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t, _ in rows], "doc_id long, text string, toxic string, score double")
    extra = spark.createDataFrame([(900, None, "x", 0.1), (901, "", "x", 0.1), (902, "a lumpenkerI here, grobiann and grobian", "x", 0.1), (None, "word1", "x", 0.1), (3, rows[3][1], "x", 0.1)], docs.schema)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    every = docs.unionByName(extra)
    found = toxicity(every, labels).collect()
    assert len(found) == every.count()
    by = {r.doc_id: r for r in found}
    held = [i for i, _, _ in rows if by[i].held_out]
    assert 60 < len(held) < 180
    assert all(by[i].predicted == y for i, _, y in rows if i in held)
    assert by[900].score == by[901].score == by[None].score < 0.5 and by[902].predicted == 1
    kept = keep_clean(every, labels)
    assert kept.columns == every.columns and kept.count() == every.count() - sum(r.predicted for r in found)
    none = toxicity(docs, labels.filter("toxic = 0")).agg(F.max("score")).first()[0]
    assert none == 0 and toxicity(docs.limit(0), labels).count() == 0


def test_held_out_rule(spark):
    import zlib

    found = spark.range(50).select(F.col("id").alias("doc_id"), held_out("id").alias("h"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.collect())


@pytest.mark.parametrize("text", ["7" * 1_000_000, "." * 1_000_000, '"' * 1_000_000, "'" * 1_000_000, "idiot" * 200_000, "a'" * 500_000, '"idiot' * 150_000, "idiot " * 150_000])
def test_very_long_texts(lexicon, text):
    import time

    begin = time.time()
    Reader(lexicon).features(text)
    assert time.time() - begin < 5


def test_clashing_columns_and_no_rows(spark):
    rows = rows_of(200)
    names = "doc_id long, text string, _score double, _body string, held_out string, predicted int"
    docs = spark.createDataFrame([(i, t, 0.9, "b", "h", 1) for i, t, _ in rows], names)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    kept = keep_clean(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < 200
    assert {r["_score"] for r in kept.collect()} == {0.9}
    assert keep_clean(docs.limit(0), labels).count() == 0 and toxicity(docs.limit(0), labels).count() == 0
