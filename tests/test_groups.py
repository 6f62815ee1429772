import pytest
from pyspark.sql import functions as F

from rostra.operators import catalog, groups, pairs
from rostra.operators.groups import GROUPINGS


@pytest.fixture(scope="module")
def base(corpus, plain):
    return groups.group_base(corpus, plain)


@pytest.fixture(scope="module")
def found(corpus, plain, built):
    return groups.keywords(corpus, plain, built.vocab).cache()


def of(df, grouping, entity, year=None):
    same = (F.col("grouping") == grouping) & (F.col("entity") == entity)
    rows = df.where(same & F.col("year").eqNullSafe(F.lit(year))).orderBy("rank").collect()
    return [(r["term"], round(r["weight"], 6)) for r in rows]


def test_fixture_keywords(found):
    assert of(found, "member", "A") == [("tax", 0.894427), ("budget", 0.447214)]
    assert of(found, "member", "B") == [("health", 0.659118), ("budget", 0.531772), ("school", 0.531772)]
    assert of(found, "member", "C") == [("school", 0.894427), ("tax", 0.447214)]
    assert of(found, "party", "P1") == of(found, "member", "A")
    assert of(found, "member_year", "B", 1990) == [("budget", 0.707107), ("school", 0.707107)]
    assert of(found, "year", "1990", 1990) == [("school", 0.904534), ("budget", 0.301511), ("tax", 0.301511)]
    assert of(found, "member_year", "A", 1990) == []
    assert {r["entity"] for r in found.where("grouping = 'party'").collect()} == {"P1", "P2"}


def test_padding(corpus, plain, built):
    padded = groups.keywords(corpus, plain, built.vocab, pad=True)
    assert of(padded, "member", "A") == [("tax", 0.894427), ("budget", 0.447214), ("health", 0), ("school", 0)]
    assert of(padded, "year", "1991", 1991) == [("health", 1), ("budget", 0), ("school", 0), ("tax", 0)]


def test_one_pass_equals_five(base):
    together = sorted(map(str, groups.all_groupings(base).collect()))
    single = [r for name in GROUPINGS for r in groups.group_term_counts(base, name).collect()]
    assert together == sorted(map(str, single))


def test_lookup_options_and_profile(corpus, found):
    years = catalog.entity_years(corpus, "member")
    options = catalog.period_options(years)
    labels = [r["label"] for r in options.where("entity = 'B'").orderBy("position").collect()]
    assert labels == ["1990-1991", "1990", "1991"]
    answers = catalog.keyword_lookup(options, found)
    all_time = answers.where("entity = 'B' AND label = '1990-1991'").orderBy("rank").collect()
    assert [(r["term"], r["weight"]) for r in all_time] == [("health", 0.66), ("budget", 0.53), ("school", 0.53)]
    names = [r["entity"] for r in catalog.entity_options(corpus, "party").collect()]
    assert names == ["P1", "P2"]
    assert catalog.entity_years(corpus, "member").where("entity = 'Z'").count() == 0
    profile = catalog.entity_profile(found, "member")
    assert profile.where("entity = 'B'").count() == 6


def test_fixture_pairs(base, built):
    vectors = groups.group_vectors(groups.group_term_counts(base, "member"), built.vocab)
    rows = pairs.similar_entities(vectors).collect()
    got = {(r["entity_a"], r["entity_b"]): round(r["similarity"], 6) for r in rows}
    assert got == {("B", "C"): 0.475632, ("A", "C"): 0.4, ("A", "B"): 0.237816}
    top = pairs.top_pairs(pairs.similar_entities(vectors), 1).first()
    assert (top["entity_a"], top["entity_b"], top["similarity_rounded"]) == ("B", "C", 0.48)


def test_hot_entity_and_hot_term_pairs_match_brute_force(spark):
    """More entities than a block; one term that all share."""
    import numpy as np

    rng = np.random.default_rng(5)
    n, terms = 600, 40
    matrix = rng.random((n, terms)) * (rng.random((n, terms)) < 0.1)
    matrix[:, 0] = 0.3
    matrix[0] = rng.random(terms)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    rows = [
        (f"e{i:04d}", f"t{j}", float(matrix[i, j]))
        for i in range(n) for j in range(terms) if matrix[i, j]
    ]
    vectors = spark.createDataFrame(rows, "entity string, term string, weight double")
    found, numbers = pairs.entity_similarities(vectors)
    names = {r["no"]: int(r["entity"][1:]) for r in numbers.collect()}
    expected = matrix @ matrix.T
    got = found.collect()
    assert len(got) == n * (n - 1) // 2
    worst = max(abs(expected[names[r["no_a"]], names[r["no_b"]]] - r["similarity"]) for r in got)
    assert worst < 1e-12
    assert all(names[r["no_a"]] < names[r["no_b"]] for r in got)


def unit_rows(matrix):
    import numpy as np

    matrix = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    n, terms = matrix.shape
    rows = [
        (f"e{i:04d}", f"t{j}", float(matrix[i, j]))
        for i in range(n) for j in range(terms) if matrix[i, j]
    ]
    return matrix, rows


@pytest.mark.parametrize("entries", [4_000_000, 500, 30])
def test_best_pairs_by_bounds(spark, monkeypatch, entries):
    """Topics in the order of names, a term in all entities: most pairs of blocks are left out."""
    import numpy as np

    monkeypatch.setattr(pairs, "BLOCK", 32)
    monkeypatch.setattr(pairs, "ENTRIES_PER_BLOCK", entries)
    monkeypatch.setattr(pairs, "FIRST_WAVE", 1)
    rng = np.random.default_rng(entries)
    n, topics = 300, 15
    matrix = np.zeros((n, topics * 8 + 1))
    for i in range(n):
        topic = i * topics // n
        matrix[i, topic * 8 : topic * 8 + 8] = rng.random(8)
    matrix[:, -1] = 0.1
    matrix[170] = rng.random(matrix.shape[1])  # an entity with all terms
    matrix[250] = matrix[20]  # equal entities in far blocks
    matrix[251] = matrix[20]
    matrix, rows = unit_rows(matrix)
    vectors = spark.createDataFrame(rows, "entity string, term string, weight double").repartition(3)
    best, numbers, multiplied = pairs.best_pairs(vectors, 10)
    found = sorted((-round(r["similarity"], 9), r["no_a"], r["no_b"]) for r in best.collect())
    dots = matrix @ matrix.T
    expected = sorted((-round(dots[i, j], 9), i, j) for i in range(n) for j in range(i + 1, n))[:10]
    assert [f[1:] for f in found] == [e[1:] for e in expected]
    assert [f[0] for f in found] == pytest.approx([e[0] for e in expected])
    assert numbers.count() == n
    if entries == 4_000_000:  # ten blocks of 32
        assert multiplied < 40 < 55
    if entries == 500:  # blocks of four
        assert multiplied < 1500 < 75 * 76 // 2


def test_tasks_of_products_hold_few_weights(spark, monkeypatch):
    """a task holds a bounded part of two blocks, and of a block and the maxima of a group."""
    import numpy as np

    held = []
    products = pairs._products

    def noted(left, right, found, slices, *rest):
        for side in (left, right):
            sizes = side.groupBy("block", "slice").agg(F.sum(F.size("entries")).alias("n"))
            held.append((slices, sizes.agg(F.max("n")).first()[0]))
        return products(left, right, found, slices, *rest)

    monkeypatch.setattr(pairs, "_products", noted)
    rng = np.random.default_rng(4)
    matrix, rows = unit_rows(rng.random((12, 400)))
    vectors = spark.createDataFrame(rows, "entity string, term string, weight double")
    monkeypatch.setattr(pairs, "ENTRIES_PER_BLOCK", 1200)  # blocks of three
    monkeypatch.setattr(pairs, "ENTRIES_PER_TASK", 100)
    best = pairs.best_pairs(vectors, 9)[0].collect()
    assert len(held) >= 4 and all(slices >= 12 and n < 200 for slices, n in held)
    dots = matrix @ matrix.T
    expected = sorted(((-dots[i, j], i, j) for i in range(12) for j in range(i + 1, 12)))[:9]
    assert [(r["no_a"], r["no_b"]) for r in best] == [e[1:] for e in expected]
    assert [r["similarity"] for r in best] == pytest.approx([-e[0] for e in expected])
    found, _ = pairs.entity_similarities(vectors)
    assert found.count() == 66


def test_products_are_dealt_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 2)
    rows = [(f"e{i}", f"t{j}", 0.5) for i in range(7) for j in range(4)]
    vectors = spark.createDataFrame(rows, "entity string, term string, weight double")
    found, _ = pairs.entity_similarities(vectors)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "(term#" not in "".join(line for line in plan.splitlines() if "Join" in line)
    assert found.count() == 21 and found.where("abs(similarity - 1) < 1e-9").count() == 21
    assert pairs.similar_entities(vectors.limit(0)).count() == 0


def test_groupings_shuffle_the_base_once(spark, corpus, plain):
    """Counts of all groupings are summed, and meet the vocabulary, where the rows of a term are."""
    base = groups.group_base(corpus, plain).localCheckpoint()
    vocab = spark.createDataFrame([("tax", 1.0), ("school", 2.0)], "term string, idf double")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = groups._weighted(groups.all_groupings(base), vocab)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert plan.count("Exchange hashpartitioning(") == 2 and "Expand" not in plan and "SortMergeJoin" not in plan
