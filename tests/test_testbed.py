"""Reports on the driver's tables: FIXTURES.md counts, properties, entry smoke."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from coldspot import registry as RG
from coldspot.operators import unused as U
from coldspot.operators import volume as V
from coldspot.plans import reports as R
from coldspot.sources import testbed as TB
from conftest import SF_SMALL

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def small(spark):
    cat = TB.catalogue(spark, SF_SMALL)
    return cat, R.sessions(cat)


def test_fixture_counts_sf0001(spark, small):
    cat, sess = small
    assert cat.dids.count() == 1500
    assert cat.contents.count() == 6000 and cat.dslocks.count() == 6000
    assert cat.traces.count() == 1000 and cat.rses.count() == 10
    assert sess.count() == 108
    assert R.primary(cat).count() == 2023
    assert R.unused_datasets(sess, cat, TB.REPORT_DATE).count() == 839


def test_bin_volumes_sum_to_dataset_volume(spark, small):
    cat, sess = small
    periods = RG.PERIODS
    bins = R.popularity_bins(sess, cat, periods)
    assert bins.count() == 17 * len(periods.labels)
    per_period = {r.period: r.v for r in bins.groupBy("period").agg(F.sum("volume").alias("v")).collect()}
    total = R.primary(cat).agg(F.sum("bytes")).first()[0]
    assert set(per_period.values()) == {total}


def test_same_datasets_in_every_period(spark, small):
    cat, sess = small
    cuts = {"w": RG.WEEK_CUTOFF, "3": RG.THREE_MONTHS, "inf": None}
    vol = V.dataset_volume_periods(R.primary(cat), V.period_access_counts(sess, cuts), cuts)
    sets = [frozenset((r.scope, r.name) for r in vol.filter(vol.period == p).collect()) for p in cuts]
    assert sets[0] == sets[1] == sets[2]


def test_unused_are_the_zero_count_datasets(spark, small):
    cat, sess = small
    unused = R.unused_datasets(sess, cat, TB.REPORT_DATE)
    zero = R.volume_alltime(sess, cat).filter("op_events = 0")
    assert unused.select("scope", "name").exceptAll(zero.select("scope", "name")).count() == 0
    assert unused.count() == zero.count()


def test_top_plus_other_equals_full(spark, small):
    cat, sess = small
    unused = R.unused_datasets(sess, cat, TB.REPORT_DATE, sort=False)
    a = R.unused_topn(unused, TB.REPORT_DATE, 3).agg(F.sum("volume")).first()[0]
    b = R.unused_full_stats(unused, TB.REPORT_DATE).agg(F.sum("volume")).first()[0]
    c = unused.agg(F.sum(F.coalesce("bytes", F.lit(0)))).first()[0]
    assert a == b == c


def test_fixture_histograms_sf001(spark):
    """Datasets per access bin at sf0.01 (FIXTURES.md table)."""
    cat = TB.catalogue(spark, SF01)
    sess = R.sessions(cat)
    expected = {
        RG.WEEK_CUTOFF: [9358, 40, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0],
        RG.THREE_MONTHS: [8915, 372, 107, 4, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0],
        RG.PERIODS.cutoffs["06"]: [8458, 694, 210, 27, 8, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0],
        RG.PERIODS.cutoffs["09"]: [7999, 1039, 298, 40, 16, 6, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0],
        RG.TWELVE_MONTHS: [7570, 1391, 353, 52, 17, 12, 2, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0],
        None: [0, 8809, 457, 65, 24, 21, 9, 7, 3, 2, 1, 0, 0, 0, 0, 0, 0],
    }
    prim = R.primary(cat)
    for cut, counts in expected.items():
        vol = V.dataset_volume(prim, V.access_counts(sess, cut), cut)
        got = {r.b: r.n for r in vol.groupBy(F.least("op_events", F.lit(15)).alias("b"))
               .agg(F.count(F.lit(1)).alias("n")).collect()}
        assert [got.get(b, 0) for b in range(-1, 16)] == counts, cut
    hist = {r.access_num: r.volume for r in R.popularity(sess, cat, None).collect()}
    assert hist[0] == 627_163_000_000 and hist[1] == 35_556_000_000


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["bin", "label", "vol_03", "vol_06", "vol_09", "vol_12", "vol_infinity"]
    assert df.count() == 17


def test_every_report_query_has_oracle_sql():
    assert set(RG.QUERIES) == set(RG.oracle_sql()) <= set(E.oracle_sql())


def test_ranked_columns_equal_the_named_ones(spark, small):
    cat, sess = small
    cube = U.unused_cube(R.unused_datasets(sess, cat, TB.REPORT_DATE, sort=False))
    named = R.topn_of_cube(cube, TB.REPORT_DATE, 4, wide=True)
    ranked = R.unused_topn_ranked(cube, TB.REPORT_DATE, 4)
    assert [c for c in ranked.columns if c[0] == "c" and c[1:].isdigit()] == ["c01", "c02", "c03", "c04"]
    assert [tuple(r[c] for c in ranked.columns if not (c[0] == "i" and c[1:].isdigit())) for r in ranked.collect()] == [
        tuple(r) for r in named.collect()]
    assert [ranked.first()[f"i{n:02d}"] for n in range(1, 5)] == named.columns[2:-1]
    many = R.unused_topn_ranked(cube, TB.REPORT_DATE, 60).first()
    assert many["i60"] is None and many["c60"] == 0


def test_unused_topn_wide_matches_long_form(spark):
    wide = R.unused_topn(RG._unused(spark, SF_SMALL), TB.REPORT_DATE, RG.TOP_N, wide=True)
    long_form = RG.q_unused_topn_other(spark, SF_SMALL)
    cols = [c for c in wide.columns if c not in ("created_at", "age_days")]
    assert cols[-1] == "other"
    total_wide = wide.select(sum(F.col(f"`{c}`") for c in cols).alias("t")).agg(F.sum("t")).first()[0]
    assert total_wide == long_form.agg(F.sum("volume")).first()[0]
    assert wide.count() == long_form.select("created_at").distinct().count()


def test_unused_topn_unit(spark, small):
    cat, sess = small
    cube = U.unused_cube(R.unused_datasets(sess, cat, TB.REPORT_DATE, sort=False))
    top = U.top_idents(U.ident_totals(cube), 5)
    assert [r["rank"] for r in top.collect()] == [1, 2, 3, 4, 5]


def test_register_views_for_sql(spark, small):
    cat, sess = small
    names = R.register_views(cat, sess, prefix="cs_")
    assert names[-1] == "cs_sessions"
    n = spark.sql("SELECT count(*) AS n FROM cs_sessions s JOIN cs_dids d USING (scope, name)").first().n
    assert n == sess.join(cat.dids, ["scope", "name"]).count()


def test_normalise_columns(spark):
    from coldspot.functions.columns import normalise_columns
    df = spark.createDataFrame([(1, "a")], "CREATED_AT long, `Mixed Name` string")
    assert normalise_columns(df).columns == ["created_at", "mixed name"]
    assert normalise_columns(df, ["CREATED_AT"]).columns == ["created_at"]


def test_checkpoint_folder_must_be_set_on_a_cluster():
    from types import SimpleNamespace

    import pytest
    from coldspot.session import checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077",
                         getConf=lambda: SimpleNamespace(get=lambda *a: None))
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError):
        checkpoint_dir(fake)


def test_input_bytes_and_clear_scratch(spark, tmp_dir, monkeypatch):
    import os
    from coldspot import session
    monkeypatch.setattr(session, "_SCRATCH", [])
    for name in ("a", "b"):
        os.makedirs(os.path.join(tmp_dir, name))
        with open(os.path.join(tmp_dir, name, "f"), "w") as f:
            f.write("x" * 100)
    assert session.input_bytes(spark, os.path.join(tmp_dir, "*")) == 200
    assert session.input_bytes(spark, os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "none")) == 100
    path = session.scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert session.clear_scratch(spark) == 1 and session.clear_scratch(spark) == 0
    assert session.input_bytes(spark, path) == 0


def test_size_shuffles(spark):
    from coldspot.session import size_shuffles
    old = spark.conf.get("spark.sql.shuffle.partitions")
    old_adv = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        assert size_shuffles(spark, 10 * (256 << 20)) == max(10, spark.sparkContext.defaultParallelism)
        assert size_shuffles(spark, 100 << 40) == 409_600  # 256 MB at any size
        assert size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old_adv)


BOUNDED = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")


def test_bound_tasks_follows_the_input_and_never_lowers(spark):
    from coldspot.session import TASK_BYTES, bound_tasks
    old = {k: spark.conf.get(k) for k in BOUNDED}
    try:
        assert bound_tasks(spark, 1) == int(old[BOUNDED[0]])
        assert bound_tasks(spark, 500 * TASK_BYTES) == 500 == bound_tasks(spark, 1)
        assert spark.conf.get(BOUNDED[1]).rstrip("b") == str(TASK_BYTES)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_catalogue_bounds_the_shuffles(spark, tmp_dir, monkeypatch):
    """Shuffle partitions follow the rows of the tables, also when the catalogue is kept."""
    import shutil

    for t in ("orders", "lineitem", "supplier", "events"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{tmp_dir}/{t}.parquet")
    old = {k: spark.conf.get(k) for k in BOUNDED}
    monkeypatch.setattr(TB, "ROW_BYTES", 1 << 16)
    try:
        n = spark.read.parquet(f"{tmp_dir}/lineitem.parquet").count() + spark.read.parquet(f"{tmp_dir}/events.parquet").count()
        want = -(-n * (1 << 16) // (16 << 20))
        assert want > int(old[BOUNDED[0]])
        for _ in range(2):
            TB.catalogue(spark, tmp_dir)
            assert spark.conf.get(BOUNDED[0]) == str(want)
            spark.conf.set(BOUNDED[0], old[BOUNDED[0]])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_derivation_deals_rows_by_key(spark):
    """No round-robin deal (which sorts the rows of the reading task), and line items are
    exchanged once."""
    for df in TB.derived(spark, SF_SMALL, 5).__dict__.values():
        assert "RoundRobin" not in df._jdf.queryExecution().executedPlan().toString()
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = TB.contents(spark, SF_SMALL, 5)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_reports_are_dealt_into_the_bounded_partitions(spark, tmp_dir, monkeypatch):
    """The exchanges of the reports take the partition count that follows the rows."""
    import re
    import shutil

    from coldspot import registry as R

    for t in ("orders", "lineitem", "supplier", "events"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{tmp_dir}/{t}.parquet")
    old = {k: spark.conf.get(k) for k in BOUNDED}
    monkeypatch.setattr(TB, "ROW_BYTES", 1 << 16)
    try:
        for q in (R.q_sessions, R.q_unused_cube, R.q_unused_list, R.q_popularity_union, R.q_popularity_bins,
                  R.q_dataset_volume_alltime):
            plan = q(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
            dealt = set(re.findall(r"Exchange hashpartitioning\([^)]*, (\d+)\)", plan))
            assert dealt == {spark.conf.get(BOUNDED[0])} and int(*dealt) > int(old[BOUNDED[0]])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_reports_join_partitions_to_less_than_they_are_dealt_into(spark):
    """The count comes from the most that rows can take; what AQE joins stays at half of it, also
    when the catalogue is kept."""
    from coldspot.session import JOINED_BYTES, TASK_BYTES, bound_tasks
    old = {k: spark.conf.get(k) for k in BOUNDED}
    try:
        assert 2 * JOINED_BYTES <= TASK_BYTES
        assert bound_tasks(spark, 500 * TASK_BYTES, joined_bytes=JOINED_BYTES) == 500
        for _ in range(2):
            spark.conf.set(BOUNDED[1], "64m")
            TB.catalogue(spark, SF_SMALL)
            assert spark.conf.get(BOUNDED[1]).rstrip("b") == str(JOINED_BYTES)
            assert spark.conf.get(BOUNDED[2]).rstrip("b") == str(2 * JOINED_BYTES)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


SCANS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")


def test_bound_tasks_splits_scans(spark, tmp_dir):
    """A task that deals rows to many partitions holds what it reads, so what a task reads is
    bounded as well, also when the catalogue is kept; a smaller setting stays."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    from coldspot.session import TASK_BYTES, bound_tasks

    old = {k: spark.conf.get(k, None) for k in BOUNDED + SCANS}
    path = f"{tmp_dir}/rows.parquet"
    pq.write_table(pa.table({"k": list(range(100_000))}), path, row_group_size=5_000)
    try:
        for k, v in zip(SCANS, ("128MB", "1", "0")):
            spark.conf.set(k, v)
        assert spark.read.parquet(path).rdd.getNumPartitions() == 1
        bound_tasks(spark, 1, task_bytes=1 << 16)
        split = spark.read.parquet(path)
        assert split.rdd.getNumPartitions() == -(-os.path.getsize(path) // (1 << 16)) > 1
        assert split.distinct().count() == 100_000
        bound_tasks(spark, 1)
        assert spark.conf.get(SCANS[0]) == str(1 << 16)
        for _ in range(2):
            spark.conf.set(SCANS[0], "128MB")
            TB.catalogue(spark, SF_SMALL)
            assert spark.conf.get(SCANS[0]) == str(TASK_BYTES)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
