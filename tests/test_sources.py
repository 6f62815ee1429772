from pyspark.sql import functions as F

from rostra.runtime import materialize
from rostra.sources import corpus as sources
from rostra.sources import tables

HEADER = "member_name,sitting_date,political_party,speech\n"


def write(folder, name, lines):
    (folder / name).write_text(HEADER + "\n".join(lines) + "\n", encoding="utf-8")


def test_scan_and_ids_follow_the_files(spark, tmp_path):
    # the second file is larger, so its splits come first in the scan
    write(tmp_path, "a.csv", ['A,01/01/1990,P,"one, two"', "B,02/01/1990,,three"])
    write(tmp_path, "b.csv", [f'C,03/01/1990,Q,"number {i} ""said"", {"x" * 50}"' for i in range(500)])
    scan = sources.corpus_scan(spark, str(tmp_path), 4)
    rows = sources.assign_doc_id(scan).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == list(range(502))
    assert rows[0]["speech"] == "one, two" and rows[1]["political_party"] is None
    assert [r["speech"].split()[1] for r in rows[2:]] == [str(i) for i in range(500)]
    assert rows[2]["speech"].startswith('number 0 "said", x')


def test_ids_over_many_splits(spark, tmp_path):
    write(tmp_path, "a.csv", [f"A,01/01/1990,P,speech {i}" for i in range(2000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        scan = sources.corpus_scan(spark, str(tmp_path), 4)
        assert scan.rdd.getNumPartitions() > 4
        rows = sources.assign_doc_id(scan).orderBy("doc_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r["doc_id"], r["speech"]) for r in rows] == [(i, f"speech {i}") for i in range(2000)]


def test_only_counts_are_stored(spark, tmp_path, monkeypatch):
    lines = [f"A,01/01/1990,P,speech {i}" for i in range(300)]
    write(tmp_path, "a.csv", lines[:150] + ["", "   ", ""] + lines[150:])
    stored = []
    monkeypatch.setattr(
        sources, "materialize", lambda df, name: stored.append(materialize(df, name)) or stored[-1]
    )
    scan = sources.corpus_scan(spark, str(tmp_path), 4).where("speech IS NOT NULL")
    rows = sources.assign_doc_id(sources.corpus_scan(spark, str(tmp_path), 4))
    found = [r["speech"] for r in rows.orderBy("doc_id").collect()]
    assert [f for f in found if f and f.strip()] == [f"speech {i}" for i in range(300)]
    assert [r["doc_id"] for r in rows.orderBy("doc_id").collect()] == list(range(len(found)))
    assert [df.columns for df in stored] == [["_file", "_block", "_n"]] and scan.count() == 300


def test_other_splits_in_the_second_pass(spark, tmp_path):
    """Larger splits number alike; smaller ones end the job."""
    write(tmp_path, "a.csv", [f"A,01/01/1990,P,speech {i}" for i in range(2000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        rows = sources.assign_doc_id(sources.corpus_scan(spark, str(tmp_path), 4))
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert [r["doc_id"] for r in rows.orderBy("doc_id").collect()] == list(range(2000))
        rows = sources.assign_doc_id(sources.corpus_scan(spark, str(tmp_path), 4))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
        try:
            assert [r["doc_id"] for r in rows.orderBy("doc_id").collect()] == list(range(2000))
        except Exception as error:
            assert "changed while it was numbered" in str(error)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quotes_are_kept_on_request(spark, tmp_path):
    write(tmp_path, "a.csv", ['A,01/01/1990,P,"one, two"', 'B,02/01/1990,"Q, R",three  '])
    write(tmp_path, "b.csv", ["C,03/01/1990,P,four"])
    rows = sources.corpus_scan_quoted(spark, str(tmp_path), 4).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == [0, 1, 2]
    assert [r["speech"] for r in rows] == ['"one, two"', "three", "four"]
    assert rows[1]["political_party"] == '"Q, R"'


def test_comma_rule_counts_the_quotes_that_follow(spark):
    df = spark.createDataFrame([('a,"b,c",d',), ('a,b"c,d',), ("a,,",)], "v string")
    fields = [r[0] for r in df.select(sources.split_outside_quotes(F.col("v"))).collect()]
    assert fields == [["a", '"b,c"', "d"], ['a,b"c', "d"], ["a", "", ""]]


def test_limits_columns_and_nulls(corpus, plain):
    assert sources.row_limit(corpus, -1).count() == 5
    assert [r["doc_id"] for r in sources.row_limit(corpus, 3).orderBy("doc_id").collect()] == [0, 1]
    assert sources.drop_null_speech(corpus).count() == 4
    assert sources.fill_null_speech(corpus).where("speech = ' '").count() == 1
    assert sources.drop_null_keys(corpus, "political_party").count() == 4
    assert sources.keep_first_n_columns(corpus, 2).columns == [
        "doc_id", "member_name", "sitting_date", "speech",
    ]


def test_keyed_table_lookup_is_pushed_down(spark, tmp_path):
    rows = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("entity"), "id")
    tables.write_keyed(rows, str(tmp_path / "t"), "entity")
    found = tables.point_lookup(spark.read.parquet(str(tmp_path / "t")), "entity", "k77")
    assert [r["id"] for r in found.collect()] == [77]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(entity,k77)" in plan


def test_speech_is_the_last_field(spark, tmp_path):
    write(tmp_path, "a.csv", ['A,01/01/1990,P,extra,"the ""speech"", all"', "B,02/01/1990,,"])
    rows = sources.corpus_scan(spark, str(tmp_path), 4).collect()
    assert [tuple(r) for r in rows] == [("A", "01/01/1990", "P", 'the "speech", all'), ("B", "02/01/1990", None, None)]
