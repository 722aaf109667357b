"""The daily run over files in the source layout (JSON log, parquet dumps)."""
import os

from coldspot import registry as RG
from coldspot import schemas as S
from coldspot.plans import daily as D
from coldspot.plans import reports as R
from coldspot.sources import readers as RD
from coldspot.sources import testbed as TB
from conftest import SF_SMALL, rows


def test_daily_run_matches_the_reports(spark, tmp_dir):
    cat = TB.catalogue(spark, SF_SMALL, written=False)
    traces = os.path.join(tmp_dir, "traces")
    TB.traces_source(cat.traces).write.json(traces)
    dumps = {}
    for t in ("contents", "dids", "rses", "dslocks"):
        dumps[t] = os.path.join(tmp_dir, "dumps", t)
        TB.upper_case(getattr(cat, t)).write.parquet(dumps[t])
    out = os.path.join(tmp_dir, "out")
    paths = D.run_daily(spark, traces, dumps, out, TB.REPORT_DATE, fmt="parquet")
    # A rerun of the same load and date replaces what it wrote.
    D.run_daily(spark, traces, dumps, out, TB.REPORT_DATE, fmt="parquet")

    def stored(name, schema):
        return RD.read_dated(spark, paths[name], TB.REPORT_DATE, schema)

    written = TB.catalogue(spark, SF_SMALL)
    sess = R.sessions(written)
    assert rows(D.stored_sessions(spark, paths["sessions"])) == rows(sess)
    bins = stored("popularity", S.BINS_SCHEMA)
    want = R.popularity_bins(sess, written, RG.PERIODS)
    assert rows(bins, "period", "bin", "volume") == rows(want, "period", "bin", "volume")
    pivot = R.popularity_pivot(sess, written, RG.PERIODS)
    assert rows(stored("matrix", pivot.schema)) == rows(pivot)
    volumes = stored("period_volumes", RG.q_period_volume_sum(spark, SF_SMALL).schema)
    assert rows(volumes, "period", "volume", "month") == rows(RG.q_period_volume_sum(spark, SF_SMALL), "period", "volume", "month")
    full = stored("full_stats", S.FULL_STATS_SCHEMA)
    assert rows(full) == rows(RG.q_unused_full_stats(spark, SF_SMALL))
    assert rows(stored("unused", S.UNUSED_SCHEMA)) == rows(RG.q_unused_list(spark, SF_SMALL))
    assert rows(stored("topn", S.FULL_STATS_SCHEMA)) == rows(R.unused_topn(RG.q_unused_list(spark, SF_SMALL), TB.REPORT_DATE))
    report = stored("topn_report", S.TOPN_REPORT_SCHEMA)
    assert rows(report) == rows(RG.q_unused_topn_report(spark, SF_SMALL))
    # CSV publications read back with the report readers.
    assert rows(RD.read_full_monthly(spark, paths["full_monthly_csv"])) == rows(full)
    wide = spark.read.option("header", True).csv(paths["topn_wide_csv"])
    assert wide.columns[:2] == ["Created at", "Age (days)"] and wide.columns[-1] == "other"
    # The session settings are as before.
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_daily_run_bounds_its_tasks(spark, tmp_dir, monkeypatch):
    """Shuffles are dealt into partitions of 16 MB while it runs, and as before behind it."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    before = [spark.conf.get(k) for k in keys]
    seen = []
    monkeypatch.setattr(D, "_run", lambda s, *rest: seen.extend(s.conf.get(k) for k in keys) or {})
    monkeypatch.setattr(D, "input_bytes", lambda s, *paths: 300 * (16 << 20))
    D.run_daily(spark, "t", {"contents": "c"}, tmp_dir, TB.REPORT_DATE, fmt="parquet")
    assert seen[0] == "300" and seen[1].rstrip("b") == str(16 << 20)
    assert [spark.conf.get(k) for k in keys] == before


def test_daily_run_splits_its_scans(spark, tmp_dir, monkeypatch):
    """What a task reads is bounded while it runs, and as before behind it."""
    key = "spark.sql.files.maxPartitionBytes"
    kept = spark.conf.get(key, None)
    seen = []
    monkeypatch.setattr(D, "_run", lambda s, *rest: seen.append(s.conf.get(key)) or {})
    monkeypatch.setattr(D, "input_bytes", lambda s, *paths: 1)
    try:
        for before in (None, "64MB"):
            spark.conf.set(key, before) if before else spark.conf.unset(key)
            D.run_daily(spark, "t", {"contents": "c"}, tmp_dir, TB.REPORT_DATE, fmt="parquet")
            assert spark.conf.get(key, None) == before
        assert seen == [str(16 << 20)] * 2
    finally:
        spark.conf.set(key, kept) if kept else spark.conf.unset(key)
