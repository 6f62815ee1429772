import hashlib
import random
import re

import pytest

from rostra.llm.radix_dedup import drop_exact_copies, exact_groups


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(norm(text), []).append(doc)
    found = {}
    for doc, text in rows:
        ids = groups[norm(text)]
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(norm(text).encode()).hexdigest()
        found[doc, sha] = (keep, len(ids), keep == doc)
    return found


def corpus(seed):
    rng = random.Random(seed)
    stems = ["", "a", "ab " * 40, "x" * 64, "x" * 65, "é" * 700, "long " * 3000, "\t\n", " "]
    rows = []
    for i in range(150):
        stem = rng.choice(stems)
        rows.append((i, stem + rng.choice(["", "", "1", "2", "\n", " \t"])))
    return [*rows, (200, None), (201, ""), (202, None)]


@pytest.mark.parametrize("first_digit", [64, 1])
def test_against_brute_force(spark, first_digit, monkeypatch):
    from rostra.llm import radix_dedup

    monkeypatch.setattr(radix_dedup.duplicate_members, "__defaults__", ("doc_id", "text", first_digit))
    rows = corpus(first_digit)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = exact_groups(docs).collect()
    assert {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in found} == brute(rows)
    assert len(found) == len(rows)
    kept = sorted(r.doc_id for r in drop_exact_copies(docs).collect())
    assert kept == sorted(d for (d, _), (_, _, k) in brute(rows).items() if k)


def test_defined_cases(spark):
    rows = [(1, "a  b", "p", 0), (1, "a b", "p", 0), (2, "a\tb", None, 1), (None, "a b", "q", 2), (None, "z", "q", 3), (3, "z z", "r", 4), (3, "other", "r", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id string, gid int")
    found = {(r.doc_id, r.text_sha256): r for r in exact_groups(docs).collect()}
    assert len(found) == 6 and exact_groups(docs).count() == len(rows)
    sha = hashlib.sha256(b"a b").hexdigest()
    assert (found[1, sha].group_size, found[1, sha].kept) == (4, True)
    assert (found[2, sha].keep_id, found[2, sha].kept, found[None, sha].kept) == (1, False, False)
    out = drop_exact_copies(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, [r.doc_id for r in out.collect()])) == ["1", "3", "3", "None"]
    assert exact_groups(docs.limit(0)).count() == 0 and drop_exact_copies(docs.limit(0)).count() == 0


def test_unlisted_rows_and_long_texts(spark, monkeypatch):
    """Above the size of the prefilter the joins take all rows; the result is the same."""
    from rostra.llm import radix_dedup

    long = "word " * 300_000
    rows = [(5, long), (3, long), (4, long + "x"), (None, "b"), (None, "b"), (None, "c"), (9, "d" * 1_000_000), (8, "d" * 1_000_000)]
    docs = spark.createDataFrame([(d, t, "s", "m") for d, t in rows], "doc_id long, text string, sha string, `_mark` string")
    for most in (32 << 20, 0):
        monkeypatch.setattr(radix_dedup, "PREFILTER_BYTES", most)
        kept = drop_exact_copies(docs)
        assert kept.columns == docs.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "8", "None", "None"]
        found = exact_groups(docs).collect()
        assert len(found) == len(rows)
        assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found} == {
            (5, 3, 2, False), (3, 3, 2, True), (4, 4, 1, True), (None, None, 2, True), (None, None, 1, True),
            (9, 8, 2, False), (8, 8, 2, True),
        }
