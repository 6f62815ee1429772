import os
import time

from pyspark.sql import functions as F

from rostra import runtime


def test_scratch_is_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runtime, "scratch_dir", lambda spark: str(tmp_path))
    table = runtime.materialize(spark.range(5).toDF("id"), "rows")
    assert table.count() == 5 and os.listdir(tmp_path)
    runtime.drop_scratch(spark)
    assert os.listdir(tmp_path) == []


def test_a_stored_table_leaves_no_shuffle_behind(spark, tmp_path, monkeypatch):
    """F6-F8: the shuffle files of a job that wrote a table go when it ends."""
    monkeypatch.setattr(runtime, "scratch_dir", lambda spark: str(tmp_path))
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllFiles().mkString("\n").split("\n")
        return {f for f in found if "shuffle_" in f}

    before, set_before = shuffled(), spark.conf.get(runtime._CLEANUP)
    rows = spark.range(2000).selectExpr("id % 7 AS k", "id").groupBy("k").agg(F.sum("id").alias("n"))
    table = runtime.materialize(rows.orderBy("n"), "sums", split_bytes=1 << 20)
    for _ in range(50):
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and table.count() == 7
    assert spark.conf.get(runtime._CLEANUP) == set_before and spark.conf.get(runtime._SPLIT) == "134217728b"
