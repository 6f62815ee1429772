"""What a task sorts or sums does not grow with the tables, and no layout is built unasked."""

import pytest

from rostra.operators import groups
from rostra.plans import queries
from rostra.runtime import SPLIT_BYTES, materialize
from rostra.sources import tables

WORDS = [f"word{chr(97 + i)}" for i in range(24)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = [(i, " ".join(WORDS[i % 5 : i % 5 + 9 + i % 7]), "en", f"src{i % 3}", 9) for i in range(40)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.write.parquet(f"{path}/documents.parquet")
    asked = [(0, " ".join(WORDS)), (1, "worda wordb wordb")]
    spark.createDataFrame(asked, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_many_terms_need_no_postings_by_term(spark, folder, monkeypatch):
    """the postings of many terms are joined as they lie, by document."""

    def unasked(*_):
        raise AssertionError("postings by term were built")

    monkeypatch.setattr(queries, "stored_by_term", unasked)
    found = queries.registry()["query_postings_join"](spark, folder).collect()
    terms = {r["term"] for r in found if r["query_id"] == 1}
    assert len(found) > 100 and len(terms) == 2
    assert {r["qtf"] for r in found if r["query_id"] == 1} == {1, 2}


@pytest.mark.parametrize("name", ["member", "member_year"])
def test_groupings_scan_bounded_splits(spark, folder, monkeypatch, name):
    """F31, F32: a task of both heavy scans reads a bounded split, at any size of the table."""
    splits = {}

    def noted(df, kind, split_bytes=None):
        splits[kind] = split_bytes
        return materialize(df, kind, split_bytes)

    monkeypatch.setattr(queries, "materialize", noted)
    monkeypatch.setattr(queries, "_stored", {})
    found = queries.registry()[f"group_by_{name}"](spark, folder)
    assert splits == {"group-base": SPLIT_BYTES, f"by-{name}": SPLIT_BYTES}
    base = queries.stored_group_base(spark, folder)
    plain = groups.group_term_counts(base, name)
    columns = ["entity", "term", "tf"]
    assert found.select(columns).exceptAll(plain.select(columns)).isEmpty() and found.count() == plain.count()


def test_groupings_take_more_tasks_for_more_rows(spark, folder, monkeypatch):
    """the rows that a task multiplies by the groupings are bounded."""
    base = queries.stored_group_base(spark, folder)
    few = groups.all_groupings(base)
    monkeypatch.setattr(groups, "_ROWS_PER_TASK", 20)
    many = groups.all_groupings(base)
    assert few.rdd.getNumPartitions() <= 4 < base.count() // 20 <= many.rdd.getNumPartitions()
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


def test_sliced_postings_take_more_tasks_for_more_rows(spark, tmp_path, monkeypatch):
    """the postings that a task sorts into slices are bounded."""
    rows = [(d, 2.0, w, 1) for d in range(20) for w in WORDS]
    postings = spark.createDataFrame(rows, "doc_id long, norm double, term string, tf long")
    monkeypatch.setattr(tables, "_POSTINGS_PER_TASK", 30)
    tables.write_sliced_postings(postings, str(tmp_path / "sliced"), 1, len(rows))
    stored = spark.read.parquet(str(tmp_path / "sliced"))
    assert stored.count() == len(rows) and len(stored.inputFiles()) > 8
