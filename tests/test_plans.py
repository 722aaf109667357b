"""Plan shape: pushdown into the parquet scans, pruning, broadcast, one pass."""
import contextlib
import io
import re

import pytest

from coldspot import registry as RG
from coldspot.plans import reports as R
from coldspot.sources import testbed as TB
from conftest import SF_SMALL


def plan(df) -> str:
    """The formatted physical plan (node list plus per-node details)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def scans(p: str, table: str) -> list[str]:
    """Detail blocks of the parquet scans of the test-bed table ``table``."""
    blocks = [b for b in p.split("\n\n") if re.match(r"\(\d+\) Scan parquet", b.strip())]
    return [b for b in blocks if re.search(rf"/{table}\]", b)]


@pytest.fixture(scope="module")
def cat(spark):
    return TB.catalogue(spark, SF_SMALL)


def test_session_filters_reach_the_scans(spark, cat):
    p = plan(R.sessions(cat))
    (tr,) = scans(p, "traces")
    assert "IsNotNull(filename)" in tr and "IsNotNull(eventtype)" in tr
    assert "IsNotNull(timeentryunix)" in tr and "StringStartsWith(eventtype,get)" in tr
    (co,) = scans(p, "contents")
    assert "StringStartsWith(scope,data)" in co and "EqualTo(did_type,D)" in co
    assert re.search(r"ReadSchema: struct<scope:string,name:string,child_name:string,did_type:string,child_type:string>", co)


def test_primary_prunes_and_broadcasts_endpoints(spark, cat):
    p = plan(R.primary(cat))
    (di,) = scans(p, "dids")
    assert "IsNull(transient)" in di and "Not(StringContains(name,_sub))" in di
    (rs,) = scans(p, "rses")
    assert "StringContains(rse,DATADISK)" in rs
    assert "BroadcastExchange" in p
    (dl,) = scans(p, "dslocks")
    # The dataset predicates are inferred onto the replica side of the join.
    assert "StringStartsWith(scope,data)" in dl


def test_all_periods_read_sessions_once(spark, cat):
    sess = R.sessions(cat)
    one = plan(R.popularity_periods(sess, cat, RG.PERIODS))
    assert len(scans(one, "traces")) == 1 and len(scans(one, "dslocks")) == 1
    five = [plan(df) for df in R.popularity_periods_separately(sess, cat, RG.PERIODS)]
    assert sum(len(scans(p, "traces")) for p in five) == 5


def test_no_python_udf_in_report_plans(spark, cat):
    sess = R.sessions(cat)
    for df in (R.popularity_pivot(sess, cat, RG.PERIODS),
               R.unused_datasets(sess, cat, TB.REPORT_DATE)):
        p = plan(df)
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_topn_report_reads_its_input_once(spark):
    p = plan(RG.q_unused_topn_report(spark, SF_SMALL))
    # The full statistics are checkpointed: no scan of the catalogue remains.
    assert not scans(p, "traces") and not scans(p, "dslocks")


def test_one_pass_report_stays_in_codegen(spark, cat):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = R.popularity_periods(R.sessions(cat), cat, RG.PERIODS)._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    # '*(n)' marks operators inside a whole-stage codegen stage.
    assert re.search(r"\*\(\d+\) Generate stack", p)
    assert re.search(r"\*\(\d+\) SortMergeJoin .*LeftOuter", p)


def _exchanges(df) -> int:
    return len(re.findall(r"\(\d+\) Exchange\n", plan(df)))


def test_one_exchange_per_large_table(spark, cat):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        # The log by file name, the file list by child name, then the roll-up.
        assert _exchanges(R.sessions(cat)) == 3
        # Locks and endpoints by endpoint id, replicas and catalogue by dataset; no more for the aggregate.
        assert _exchanges(R.primary(cat)) == 4
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # With the endpoints broadcast the locks are exchanged once.
    assert _exchanges(R.primary(cat)) <= 2
