import hashlib
import math
import random
import re
import time
from collections import Counter

import pytest

from rostra.llm import disclosure
from rostra.llm.disclosure import base_spans, emails, revealing_terms, sanitise


def plain(text):
    """The patterns as they are stated."""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c in "0123456789"]
        total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.findall("[0-9]", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], disclosure.KINDS.index(s[0])))


@pytest.mark.parametrize("seed", range(4))
def test_patterns(seed):
    rng = random.Random(seed)
    parts = ["@", "a", "b.c", ".", "-", "1", "25", "255", "256", "0", " ", "+", "(", ")", "4111 1111 1111 1111", "a@b.co", "é", "٣", "1.2.3.4", "+49 30 123456", "%", "_", "\n"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert base_spans(text) == plain(text), text
    assert emails("a@b@c.d e") == [("email", 2, 7)]


def docs_of(spark):
    rng = random.Random(3)
    filler = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(300):
        rows.append((i, " ".join(rng.choices(filler, k=30)), "x"))
    for i in range(300, 306):  # a nickname beside one address, in different contexts
        rows.append((i, " ".join(rng.choices(filler, k=10)) + " zorro mail z@example.com " + " ".join(rng.choices(filler, k=10)), "x"))
    for i in range(306, 318):  # a word beside two addresses
        rows.append((i, " ".join(rng.choices(filler, k=9)) + f" desk {'ab'[i % 2]}@example.com " + rng.choice(filler), "x"))
    rows += [(400, "zorro was here", "y"), (401, None, "y"), (402, "", None), (None, "+49 30 1234567", "z"), (5, "1.2.3.4", "r")]
    return spark.createDataFrame(rows, "doc_id long, text string, term string")


def test_terms_and_texts(spark):
    docs = docs_of(spark)
    listed = revealing_terms(docs)
    terms = {r.term: r.action for r in listed.collect()}
    assert terms == {"zorro": "", "mail": "", "desk": "[email]"}
    found = sanitise(docs, listed).collect()
    assert len(found) == docs.count()
    by = {r.doc_id: r for r in found}
    assert by[400].spans == "term:0:5" and by[400].text == " was here" and by[400].n_term == 1
    assert by[401].spans == "" and by[402].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[None].text == "[phone]"
    assert "[email]" in by[300].text and "zorro" not in by[300].text
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in found:
        if r.doc_id not in (5,):
            base = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(texts[r.doc_id] or ""))
            assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()


def plain_terms(texts):
    """Words and their actions, counted document by document."""
    n_term, n_entity, n_both, contexts = Counter(), Counter(), Counter(), {}
    for text in texts:
        n_term.update(set(re.findall(r"\w+", text.lower())))
        base, near = plain(text), {}
        free = [m for m in re.finditer(r"\w+", text) if all(m.end() <= a or m.start() >= b for _, a, b in base)]
        for kind, a, b in base:
            raw = text[a:b].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", text[a:b])
            names = [f"{kind}:{raw}"]
            if kind == "email":
                names += ["local:" + raw.split("@")[0], "domain:" + raw.split("@")[1]]
            elif kind == "ip":
                names.append("net:" + raw.rsplit(".", 1)[0])
            else:
                names.append(f"class-{kind}:" + raw[: {"card": 6, "phone": 5}[kind]])
            before = [m[0].lower() for m in free if m.start() < a][-6:]
            after = [m[0].lower() for m in free if m.start() >= a][:6]
            for name in names:
                for w in {*before, *after}:
                    if len(w) >= 3 and not w.isdigit():
                        near.setdefault(name, {})[w] = (*before, *after)
                near.setdefault(name, {})
        for name, words in near.items():
            n_entity[name] += 1
            for w, context in words.items():
                n_both[name, w] += 1
                contexts.setdefault((name, w), set()).add(context)
    found = {}
    for (e, w), both in n_both.items():
        own = math.log2(len(texts) / n_entity[e])
        bits = math.log2(both * len(texts) / (n_term[w] * n_entity[e]))
        if own > 0 and bits >= 0.8 * own - 1e-9 and both >= 0.5 * n_term[w] and len(contexts[e, w]) >= 2:
            found.setdefault(w, set()).add(e)
    full = {w: {e for e in es if e.split(":")[0] in disclosure.KINDS} for w, es in found.items()}
    return {w: "" if len(full[w]) == 1 else "[]" for w in found}


@pytest.mark.parametrize("seed", range(3))
def test_terms_against_plain_counts(spark, seed):
    rng = random.Random(seed)
    people = [("ann", "ann@a.com"), ("bob", "bob@b.org"), ("cy", "+49 30 1234567"), ("dee", "4111 1111 1111 1111"), ("eve", "10.0.0.7"), ("fay", "fay@a.com")]
    texts = ["", "contact ann"]
    for _ in range(250):
        words = rng.choices([f"w{i}" for i in range(80)] + ["contact", "mail"], k=rng.randint(3, 25))
        if rng.random() < 0.4:
            name, value = rng.choice(people[: rng.choice([1, 6])])
            words.insert(rng.randrange(len(words)), f"{rng.choice(['nick' + name, 'the', name * 2])} {value}")
        texts.append(" ".join(words))
    texts += [texts[5]] * 4
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.term: re.sub("[a-z]", "", r.action) for r in revealing_terms(docs.repartition(3)).collect()}
    assert found == plain_terms(texts) and len(found) > 2


@pytest.mark.parametrize("text", ["7" * 1_000_000, "." * 1_000_000, "1." * 500_000, "a" * 1_000_000, "@" * 1_000_000, "a@" * 500_000, "+1 " * 300_000, "4 " * 500_000, "a.b" * 300_000])
def test_very_long_runs(text):
    begin = time.time()
    base_spans(text)
    assert time.time() - begin < 5


def test_long_word_lists_give_the_same(spark, monkeypatch):
    docs = docs_of(spark)
    key = lambda r: (str(r.doc_id), r.spans, r.text)
    listed = revealing_terms(docs)
    expected = sorted(map(key, sanitise(docs, listed).collect()))
    monkeypatch.setattr(disclosure, "PART_BYTES", 70)
    assert sorted(map(key, sanitise(docs, listed).collect())) == expected
    assert sanitise(docs.limit(0)).count() == 0
