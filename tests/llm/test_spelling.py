import random
import zlib
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import queries
from rostra.llm import spelling
from rostra.llm.spelling import spelling_groups


def letters(text):
    runs, run = [], ""
    for c in text + " ":
        if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
            run += c
        elif run:
            runs.append(run)
            run = ""
    return runs


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in letters(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    found = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return found


def variants(rng, word):
    i = rng.randrange(len(word))
    letter = rng.choice("abcxyzéÀß÷")
    return rng.choice([word, word, word[:i] + word[i + 1 :], word[:i] + letter + word[i:], word[:i] + letter + word[i + 1 :]])


def corpus(seed, n=90):
    rng = random.Random(seed)
    stems = ["Walking", "walking", "aabbaab", "aaaaaaa", "straße", "Ünder", "letters", "table", "tables", "house"]
    stems += ["".join(rng.choices("abc", k=rng.randint(4, 7))) for _ in range(30)]
    rows = [
        (i, " ".join(variants(rng, rng.choice(stems)) + rng.choice(["", ",", "1", "-"]) for _ in range(60)))
        for i in range(n)
    ]
    return rows + [(None, rows[0][1]), (None, None), (3, rows[4][1]), (5, ""), (5, ""), (6, "12 ,.")]


# The whole result in SQL. It is no registered counterpart, because its column of optional
# integers has another type in either engine's data frames.
SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{5,}')) AS raw
  FROM documents
), counted AS (
  SELECT id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM runs GROUP BY ALL
), coded AS (
  SELECT run, c, flatten(list_transform(range(1, length(id || ':' || run) + 1),
      lambda i: CASE WHEN unicode(substr(id || ':' || run, i, 1)) < 128
                     THEN [unicode(substr(id || ':' || run, i, 1))::BIGINT]
                     ELSE [195, unicode(substr(id || ':' || run, i, 1))::BIGINT - 64] END)) AS bytes
  FROM counted
), hashed AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295, bytes),
      lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) AS h
  FROM coded, crc_table
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, CAST(sum(c) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING sum(c) >= 3 AND length(word) >= 5
), places AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), masks AS (
  SELECT word, n, substr(word, 1, i - 1) || '?' || substr(word, i + 1) AS mask FROM places
), shorter AS (
  SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS short FROM places
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM masks a JOIN masks b ON a.mask = b.mask AND a.word <> b.word
  UNION ALL SELECT s.word, s.n, w.word, w.n FROM shorter s JOIN words w ON s.short = w.word
  UNION ALL SELECT w.word, w.n, s.word, s.n FROM shorter s JOIN words w ON s.short = w.word
), best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n
  FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
), formed AS (
  SELECT word, CASE WHEN other_n >= 2 * n THEN other END AS form, n,
         coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS place FROM formed
  UNION ALL SELECT walk.word, f.form FROM walk JOIN formed f ON f.word = walk.place WHERE f.form IS NOT NULL
)
SELECT formed.word, formed.form, walk.place AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN walk USING (word) JOIN formed last ON last.word = walk.place WHERE last.form IS NULL
"""


@pytest.mark.parametrize("seed,part_blocks,filter_bytes", [(1, 8192, None), (2, 1, 128), (3, 2, 1)])
def test_against_brute_force(spark, monkeypatch, seed, part_blocks, filter_bytes):
    monkeypatch.setattr(spelling, "PART_BLOCKS", part_blocks)
    if filter_bytes:
        monkeypatch.setattr(spelling, "FILTER_BYTES", filter_bytes)
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, "w", 1) for d, t in rows], "doc_id long, text string, word string, n int")
    found = [tuple(r) for r in spelling_groups(docs.repartition(5)).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows)
    assert any(r[1] and r[1] != r[2] for r in found)  # some chains


def test_several_passes_are_bounded():
    passes = spelling._passes({5: 20_000, 6: 1, 9: 100_000}, 4 * spelling.PART_BLOCKS * 64)
    assert all(sum(parts for *_, parts in p) <= 4 for p in passes) and len(passes) == 5


def test_very_long_words(spark):
    long = "ab" * 100_000
    texts = [long, long, long, long + "c", long + "c", long + "c", long[:-1] + "x", "x" * 1_000_000]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    found = {(len(r.word), r.n, r.n_near) for r in spelling_groups(docs).collect()}
    assert found == {(200_000, 3, 1), (200_001, 3, 1)}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_groups(docs).count() == 0
    assert spelling_groups(spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")).count() == 0


def test_whole_table_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    found = [tuple(r) for r in queries()["op11_spelling"](spark, folder).collect()]
    expected = duckdb.sql(SQL).fetchall()
    assert len(found) == len(expected) > 100 and set(found) == set(expected)
