"""Skew: one file holds a third of all reads. The pre-aggregated session plan
stays exact and AQE splits the hot partition of the file-name join."""
import contextlib

from pyspark.sql import functions as F

from coldspot.operators import sessions as SE
from conftest import rows

SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _inputs(spark, n=30000):
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0
    traces = ids.select(
        (F.col("id") * 1.0).alias("timeentryunix"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("f"), (F.col("id") % 500).cast("string")))
        .alias("filename"),
        F.lit("get").alias("eventtype"),
        F.concat(F.lit("u"), (F.col("id") % 4000).cast("string")).alias("uuid"))
    files = spark.range(500).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("child_name"))
    files = files.unionByName(spark.range(1).select(F.lit("hot").alias("child_name")))
    contents = files.select(F.lit("data1").alias("scope"),
                            F.concat(F.lit("data1.d"), F.col("child_name")).alias("name"),
                            "child_name", F.lit("D").alias("did_type"), F.lit("F").alias("child_type"))
    # The hot file also belongs to 40 datasets (M:N on the hot key).
    extra = spark.range(40).select(F.lit("data1").alias("scope"),
                                   F.concat(F.lit("data1.x"), F.col("id").cast("string")).alias("name"),
                                   F.lit("hot").alias("child_name"), F.lit("D").alias("did_type"),
                                   F.lit("F").alias("child_type"))
    return traces, contents.unionByName(extra)


def test_hot_file_split_and_exact(spark):
    with conf(spark, SKEW_CONF):
        traces, contents = _inputs(spark)
        sess = SE.build_sessions(traces, contents)
        got = rows(sess)
        final_plan = sess._jdf.queryExecution().executedPlan().toString()
        naive = (SE.read_accesses(traces, contents).groupBy("scope", "name", "uuid")
                 .agg(F.count(F.lit(1)).alias("fileops"), F.max("timeentryunix").alias("timeentryunix")))
        assert got == rows(naive.select(*sess.columns))
    assert "skew=true" in final_plan
    # 41 datasets hold the hot file; each sees every user of it.
    hot_users = traces.filter("filename = 'hot'").select("uuid").distinct().count()
    assert sess.filter(F.col("name").startswith("data1.x")).count() == 40 * hot_users


def test_explicit_salting_is_exact_and_spreads_the_hot_file(spark):
    from coldspot.operators.skew import hot_keys
    traces, contents = _inputs(spark)
    plain = rows(SE.build_sessions(traces, contents))
    auto = SE.build_sessions(traces, contents, salt_buckets=8, hot_file_rows=1000)
    assert rows(auto) == plain
    given = spark.createDataFrame([("hot",)], "f string")
    assert rows(SE.build_sessions(traces, contents, salt_buckets=8, hot_files=given)) == plain
    # Only the hot file is detected; its rows land on all 8 salts.
    per_file = traces.groupBy("filename", "uuid").count()
    assert [r._hot for r in hot_keys(per_file, "filename", 1000).collect()] == ["hot"]
    p = auto._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in p and "Generate explode" in p


def test_hot_list_with_repeats_and_nulls(spark):
    traces, contents = _inputs(spark, 3000)
    plain = rows(SE.build_sessions(traces, contents))
    given = spark.createDataFrame([("hot",), ("hot",), (None,), ("f1",)], "f string")
    assert rows(SE.build_sessions(traces, contents, salt_buckets=8, hot_files=given)) == plain


def test_null_users_of_a_hot_file_are_spread(spark):
    from coldspot.operators.skew import salted_join
    n = 800
    big = spark.range(n).select(F.lit("hot").alias("filename"), F.lit(None).cast("string").alias("uuid"),
                                F.col("id").cast("double").alias("t"))
    small = spark.createDataFrame([("hot", "x")], "child_name string, name string")
    hot = spark.createDataFrame([("hot",)], "f string")
    joined = salted_join(big, small, "filename", "child_name", hot, 8, ("uuid", "t"))
    assert joined.count() == n
    salts = big.select(F.pmod(F.xxhash64("uuid", "t"), F.lit(8)).alias("s")).groupBy("s").count().collect()
    assert len(salts) == 8 and max(r["count"] for r in salts) < n / 4


def test_long_hot_list_salts_every_key(spark):
    from coldspot.operators.skew import salted_join
    traces, contents = _inputs(spark, 2000)
    hot = traces.select("filename").distinct()
    plain = traces.join(contents, traces.filename == contents.child_name)
    salted = salted_join(traces, contents, "filename", "child_name", hot, 4, ("uuid", "timeentryunix"), broadcast_keys=3)
    assert rows(salted) == rows(plain)
    assert "Broadcast" not in salted._jdf.queryExecution().optimizedPlan().toString()


def test_pre_aggregation_gives_the_same_sessions(spark):
    traces, contents = _inputs(spark, 3000)
    assert rows(SE.build_sessions(traces, contents, pre_aggregate=True)) == rows(SE.build_sessions(traces, contents))
