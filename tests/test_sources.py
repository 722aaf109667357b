"""Sources and sinks: S1-S6, S8-S13 (file round trips in a fresh folder)."""
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from coldspot import schemas as S
from coldspot.sources import readers as RD
from coldspot.sources import writers as WR
from conftest import rows


def test_read_traces_declared_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "traces.2024-01-01.json")
    with open(path, "w") as f:
        f.write(json.dumps({"traceTimeentryUnix": 1.5, "eventType": "get", "filename": "f1",
                            "uuid": "u", "localSite": "X", "unknownField": 1}) + "\n")
        f.write(json.dumps({"traceTimeentryUnix": 2.5, "eventtype": "lower-case: not matched"}) + "\n")
    df = RD.read_traces(spark, os.path.join(tmp_dir, "traces.2024-01-01*"))
    assert df.columns[0] == "timeentryunix" and "localsite" in df.columns and len(df.columns) == 14
    got = rows(df, "timeentryunix", "eventtype", "localsite")
    assert got == [(1.5, "get", "X"), (2.5, None, None)]


def test_read_snapshot_lower_cases(spark, tmp_dir):
    spark.createDataFrame([(1, "A_DATADISK", "x")], "ID long, RSE string, OTHER string") \
        .write.parquet(os.path.join(tmp_dir, "rses"))
    df = RD.read_snapshot(spark, os.path.join(tmp_dir, "rses"), ["id", "rse"], fmt="parquet")
    assert df.columns == ["id", "rse"] and df.first().rse == "A_DATADISK"
    df2 = RD.read_snapshot(spark, os.path.join(tmp_dir, "rses"), ["ID", "RSE"], fmt="parquet")
    assert df2.columns == ["id", "rse"]


def test_sessions_tsv_round_trip_empty_uuid_becomes_null(spark, tmp_dir):
    s = spark.createDataFrame([("d", "d.a", "", 2, 1.5), ("d", "d.a", "u", 1, 2.5)], S.SESSION_SCHEMA)
    WR.write_sessions(s, os.path.join(tmp_dir, "s"), fmt="tsv")
    back = RD.read_sessions(spark, os.path.join(tmp_dir, "s"), fmt="tsv")
    assert rows(back) == sorted([("d", "d.a", None, 2, 1.5), ("d", "d.a", "u", 1, 2.5)], key=repr)
    WR.write_sessions(s, os.path.join(tmp_dir, "p"))
    assert rows(RD.read_sessions(spark, os.path.join(tmp_dir, "p"))) == rows(s)


def test_period_volumes_partitioned_and_files(spark, tmp_dir):
    bins = spark.createDataFrame([("03", -1, 5), ("03", 0, 6), ("infinity", 0, 11)],
                                 "period string, bin long, volume long")
    WR.write_popularity(bins.select("bin", "volume", "period"), os.path.join(tmp_dir, "pop"))
    assert {"period=03", "period=infinity"} <= set(os.listdir(os.path.join(tmp_dir, "pop")))
    back = RD.read_period_volumes(spark, os.path.join(tmp_dir, "pop"))
    assert rows(back, "period", "bin", "volume") == [("03", "-1", 5), ("03", "0", 6), ("infinity", "0", 11)]
    files = os.path.join(tmp_dir, "files")
    os.makedirs(files)
    for label, lines in (("03", "-1,5\n0,6\n"), ("infinity", "0,11\n")):
        with open(os.path.join(files, f"{label}.csv"), "w") as f:
            f.write(lines)
    back2 = RD.read_period_volumes(spark, files, layout="files")
    assert rows(back2, "period", "bin", "volume") == [("03", "-1", 5), ("03", "0", 6), ("infinity", "0", 11)]


def test_empty_files_raise(spark, tmp_dir):
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    open(os.path.join(empty, "03.csv"), "w").close()
    with pytest.raises(ValueError):
        RD.read_period_volumes(spark, empty, layout="files")
    with pytest.raises(ValueError):
        RD.read_full_monthly(spark, empty)


def test_full_monthly_comment_and_header(spark, tmp_dir):
    path = os.path.join(tmp_dir, "full_monthly.csv")
    with open(path, "w") as f:
        f.write("# Column names in the next line\n")
        f.write("Created at,Age (days),Project/datatype,Volume\n")
        f.write("2024-01-01,31,data1*AOD*,100\n2023-12-01,62,mc1*log*,7\n")
    df = RD.read_full_monthly(spark, path)
    assert rows(df) == [(dt.date(2023, 12, 1), 62, "mc1*log*", 7), (dt.date(2024, 1, 1), 31, "data1*AOD*", 100)]


def test_write_stats_header_round_trip(spark, tmp_dir):
    full = spark.createDataFrame([(dt.date(2024, 1, 1), 31, "a*", 3)], S.FULL_STATS_SCHEMA)
    WR.write_stats(full, os.path.join(tmp_dir, "stats"))
    part = [p for p in os.listdir(os.path.join(tmp_dir, "stats")) if p.endswith(".csv")][0]
    with open(os.path.join(tmp_dir, "stats", part)) as f:
        assert f.readline().strip() == "Created at,Age (days),Project/datatype,Volume"
    assert rows(RD.read_full_monthly(spark, os.path.join(tmp_dir, "stats"))) == rows(full)
    with pytest.raises(ValueError):
        WR.write_stats(full.select("ident"), os.path.join(tmp_dir, "bad"))


def test_unused_list_reader_skips_comments_and_header(spark, tmp_dir):
    path = os.path.join(tmp_dir, "list.tsv")
    with open(path, "w") as f:
        f.write("scope\tname\tbytes\tcreated_at\tage_days\n# a comment\n")
        f.write("d\td.1.s.m.AOD\t\t100\t3\n")
    got = [tuple(r) for r in RD.read_unused_list(spark, path).collect()]
    assert got == [("d", "d.1.s.m.AOD", None, 100, 3)]


def test_unused_partitions_and_latest_snapshot(spark, tmp_dir):
    path = os.path.join(tmp_dir, "unused")
    lst = spark.createDataFrame([("d", "a", 1, 2, 3)], S.UNUSED_SCHEMA)
    WR.write_unused(lst, path, "2024-01-01")
    WR.write_unused(lst.withColumn("age_days", F.lit(9)), path, "2024-02-01")
    WR.write_unused(lst.withColumn("age_days", F.lit(10)), path, "2024-02-01")  # rerun replaces
    df = RD.read_unused_list(spark, path)
    assert df.count() == 2
    latest = RD.latest_snapshot(df)
    assert [(r.age_days, str(r.report_date)) for r in latest.collect()] == [(10, "2024-02-01")]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


DAYS = ("scope string, name string, uuid string, fileops long, timeentryunix double, trace_date date")


def test_a_load_with_late_events_keeps_stored_sessions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sessions")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    first = [("d", f"n{i}", "u", 1, 1.0, one) for i in range(100)]
    WR.write_load(spark.createDataFrame(first, DAYS), path, "2024-01-01")
    # The second log holds one late event of day 1, of a stored session.
    second = spark.createDataFrame([("d", "n0", "u", 2, 9.0, one), ("d", "b", "u", 1, 2.0, two)], DAYS)
    for _ in range(2):  # a rerun replaces the load and nothing else
        WR.write_load(second, path, "2024-01-02")
        back = RD.read_session_loads(spark, path)
        assert back.filter(F.col("trace_date") == one).count() == 100
        assert rows(back.filter("name in ('n0', 'n1', 'b')"), "name", "fileops", "timeentryunix") == [
            ("b", 1, 2.0), ("n0", 3, 9.0), ("n1", 1, 1.0)]
    # A rerun of a load that holds fewer days leaves none of its old rows.
    WR.write_load(second.filter("name = 'b'"), path, "2024-01-02")
    assert rows(RD.read_session_loads(spark, path).filter("name = 'n0'"), "fileops") == [(1,)]


def test_reruns_leave_nothing_of_the_date_behind(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bins")
    bins = spark.createDataFrame([(0, 5, "03"), (0, 6, "06"), (0, 7, "infinity")], S.BINS_SCHEMA)
    WR.write_dated(bins, path, "2024-02-01", extra_partitions=("period",))
    WR.write_dated(bins, path, "2024-03-01", extra_partitions=("period",))
    WR.write_dated(bins.filter("period <> 'infinity'"), path, "2024-02-01", extra_partitions=("period",))
    back = RD.read_dated(spark, path, "2024-02-01", S.BINS_SCHEMA)
    assert rows(back, "period", "volume") == [("03", 5), ("06", 6)]  # labels stay text
    assert RD.read_dated(spark, path, "2024-03-01", S.BINS_SCHEMA).count() == 3
    unused = os.path.join(tmp_dir, "unused")
    lst = spark.createDataFrame([("d", "a", 1, 2, 3)], S.UNUSED_SCHEMA)
    for fmt in ("parquet", "tsv"):
        WR.write_unused(lst, f"{unused}-{fmt}", "2024-02-01", fmt)
        WR.write_unused(lst.limit(0), f"{unused}-{fmt}", "2024-02-01", fmt)
    assert RD.read_dated(spark, f"{unused}-parquet", "2024-02-01", S.UNUSED_SCHEMA).count() == 0
    assert RD.read_unused_list(spark, f"{unused}-tsv/report_date=2024-02-01").count() == 0


def test_stats_comment_line_is_read_back(spark, tmp_dir):
    full = spark.createDataFrame([(dt.date(2024, 1, 1), 31, "a,b*", 3), (dt.date(2023, 1, 1), 396, 'q"x*', 4)],
                                 S.FULL_STATS_SCHEMA)
    path = os.path.join(tmp_dir, "stats")
    WR.write_stats(full, path, comment="Column names in the next line")
    part = [p for p in os.listdir(path) if p.startswith("part")][0]
    with open(os.path.join(path, part)) as f:
        assert f.read().split("\n")[:2] == ["# Column names in the next line", "Created at,Age (days),Project/datatype,Volume"]
    assert rows(RD.read_full_monthly(spark, path)) == rows(full)


def test_avro_without_package_explains(spark, tmp_dir):
    # Without the spark-avro package the reader names it; with the package an
    # empty folder fails for another reason.
    try:
        RD.read_snapshot(spark, tmp_dir, ["id"], fmt="avro")
    except RuntimeError as exc:
        assert "spark-avro" in str(exc)
    except Exception:  # noqa: BLE001
        pass


def test_write_topn_wide_header(spark, tmp_dir):
    wide = spark.createDataFrame([(dt.date(2024, 1, 1), 31, 5, 7)],
                                 "created_at date, age_days int, `log` long, other long")
    WR.write_topn_wide(wide, os.path.join(tmp_dir, "wide"))
    part = [p for p in os.listdir(os.path.join(tmp_dir, "wide")) if p.endswith(".csv")][0]
    with open(os.path.join(tmp_dir, "wide", part)) as f:
        assert f.readline().strip() == "Created at,Age (days),log,other"
