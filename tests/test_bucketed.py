"""Salts by measured size, tables in buckets of their keys, and changes between two lists."""
import os
import re
from statistics import median

import pytest
from pyspark.sql import functions as F

from coldspot.operators import sessions as SE
from coldspot.operators import skew
from coldspot.operators.unused import list_changes
from coldspot.sources import bucketed as BK
from conftest import rows
from test_skew import _inputs, conf

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}


def _two_hot(spark, n=30000):
    """One file holds a third of the log, another a thirtieth."""
    traces, contents = _inputs(spark, n)
    number = F.substring("filename", 2, 9).cast("int")
    return traces.withColumn("filename", F.when((F.col("filename") != "hot") & (number % 20 == 1), "f1").otherwise(F.col("filename"))), contents


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sizes_of_large_keys_by_sketch(spark):
    traces, _ = _two_hot(spark)
    exact = {r["filename"]: r["count"] for r in traces.groupBy("filename").count().collect()}
    got = {r["_hot"]: r["_rows"] for r in skew.key_sizes(traces, "filename", 500).collect()}
    assert set(got) == {k for k, n in exact.items() if n >= 500} == {"hot", "f1"}
    assert all(abs(n - exact[k]) <= 0.05 * exact[k] for k, n in got.items())
    halves = [skew.key_sizes(traces.where(F.col("timeentryunix") % 2 == i), "filename", 100) for i in (0, 1)]
    assert {r["_hot"]: r["_rows"] for r in skew.merged_sizes(*halves).collect()}["hot"] == exact["hot"]
    assert skew.key_sizes(traces.limit(0), "filename", 1).count() == 0
    assert skew.key_sizes(traces.withColumn("filename", F.lit(None).cast("string")), "filename", 1).count() == 0
    # rows are not exchanged: the only exchange merges the tasks' sketches
    with conf(spark, NO_BROADCAST):
        assert re.findall(r"Exchange (\w+)", _plan(skew.key_sizes(traces, "filename", 500))) == ["SinglePartition"]


def test_measured_salts_are_exact_and_even(spark):
    traces, contents = _two_hot(spark)
    plain = rows(SE.build_sessions(traces, contents))
    sizes = skew.key_sizes(traces, "filename", 200)
    with conf(spark, NO_BROADCAST):
        assert rows(SE.build_sessions(traces, contents, file_sizes=sizes, rows_per_salt=100)) == plain
        # one list row per file: the rows of a task of the join are the log's rows
        one = contents.select("child_name").distinct()
        joined = skew.measured_join(traces, one, "filename", "child_name", sizes, ("uuid", "timeentryunix"), 100)
        tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 30000 and len(tasks) == 8 and max(tasks) <= 2 * median(tasks)
        unsalted = traces.join(one, traces.filename == one.child_name).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in unsalted) > 2 * median(r["count"] for r in unsalted)
    # copies of the list's rows follow the size of the key
    made = {r["_hot"]: -(-r["_rows"] // 100) for r in sizes.collect()}
    assert made["hot"] == 100 and made["f1"] < 20


@pytest.mark.parametrize("copartitioned", [False, True])
def test_wrong_sizes_never_change_the_result(spark, copartitioned):
    traces, contents = _inputs(spark, 3000)
    plain = rows(SE.build_sessions(traces, contents))
    wrong = spark.createDataFrame([("hot", 900), ("hot", 3), ("absent", 10**6), (None, 500), ("f1", -5), ("f2", None)], "_hot string, _rows long")
    assert rows(SE.build_sessions(traces, contents, file_sizes=wrong, rows_per_salt=50, copartitioned=copartitioned)) == plain
    none = wrong.limit(0)
    assert rows(SE.build_sessions(traces, contents, file_sizes=none, rows_per_salt=50, copartitioned=copartitioned)) == plain


def test_bucketed_file_list_is_not_exchanged(spark, tmp_dir):
    traces, contents = _two_hot(spark, 6000)
    traces = traces.unionByName(traces.limit(3).withColumn("filename", F.lit(None).cast("string")))
    plain = rows(SE.build_sessions(traces, contents))
    root = os.path.join(tmp_dir, "list")
    BK.write_bucketed(contents, root, ["child_name"], 8)
    files = BK.read_bucketed(spark, root)
    traces.write.parquet(os.path.join(tmp_dir, "log"))
    log = spark.read.parquet(os.path.join(tmp_dir, "log"))
    sizes = skew.key_sizes(log, "filename", 200)
    with conf(spark, NO_BROADCAST):
        whole = SE.build_sessions(log, files)
        split = SE.build_sessions(log, files, file_sizes=sizes, rows_per_salt=100, copartitioned=True)
        assert rows(whole) == plain and rows(split) == plain
        keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", _plan(whole))
        assert len([k for k in keys if "filename" in k]) == 1 and not [k for k in keys if "child_name" in k]
        # split: the list is exchanged for hot files only, by file and salt
        keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", _plan(split))
        assert [("child_name" in k, "_salt_s" in k) for k in keys if "child_name" in k] == [(True, True)]
        assert re.search(r"SortMergeJoin", _plan(split)) and "Cartesian" not in _plan(split)


def test_a_failed_bucketed_write_is_never_seen(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    df = spark.range(100).selectExpr("cast(id % 7 as string) as k", "id")
    with pytest.raises(FileNotFoundError):
        BK.read_bucketed(spark, root)
    assert BK.write_bucketed(df, root, ["k"], 4) == 1
    before = rows(BK.read_bucketed(spark, root))
    broken = df.select("k", F.expr("if(id = 50, raise_error('stop'), id)").cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        BK.write_bucketed(broken, root, ["k"], 4)
    assert rows(BK.read_bucketed(spark, root)) == before == rows(df)
    # the next write replaces what the failed one left; another session knows no entry
    assert BK.write_bucketed(df.where("id < 10"), root, ["k"], 4) == 2
    spark.sql(f"DROP TABLE {BK._entry(BK.version_folder(root, 2))}")
    again = BK.read_bucketed(spark, root)
    assert rows(again) == rows(df.where("id < 10"))
    with conf(spark, NO_BROADCAST | {"spark.sql.shuffle.partitions": "4"}):
        assert "Exchange" not in _plan(again.groupBy("k").count())
    empty = os.path.join(tmp_dir, "empty")
    BK.write_bucketed(df.limit(0), empty, ["k"], 4)
    assert BK.read_bucketed(spark, empty).count() == 0


def test_changes_between_two_lists(spark, tmp_dir):
    schema = "scope string, name string, bytes long, created_at long, age_days int"
    old = spark.createDataFrame([("a", "x", 1, 0, 9), ("a", "y", None, 0, 9), ("b", "x", 3, 0, 9)], schema)
    new = spark.createDataFrame([("a", "y", 5, 0, 10), ("b", "x", 3, 0, 10), ("c", "z", 7, 0, 1), (None, "n", 8, 0, 1)], schema)
    want = [("a", "x", "left", 1, None), ("a", "y", "still", None, 5), ("b", "x", "still", 3, 3), ("c", "z", "entered", None, 7),
            (None, "n", "entered", None, 8)]
    assert rows(list_changes(old, new)) == sorted(want, key=repr)
    for name, df in (("old", old), ("new", new)):
        BK.write_bucketed(df, os.path.join(tmp_dir, name), ["scope", "name"], 8)
    with conf(spark, NO_BROADCAST):
        stored = list_changes(*[BK.read_bucketed(spark, os.path.join(tmp_dir, n)) for n in ("old", "new")])
        assert rows(stored) == sorted(want, key=repr)
        assert "Exchange" not in _plan(stored) and "SortMergeJoin" in _plan(stored)
    assert [r["change"] for r in list_changes(old.limit(0), old).collect()] == ["entered"] * 3
    assert list_changes(old.limit(0), old.limit(0)).count() == 0
