"""Valid traces, dataset files, read events, sessions, union."""
from pyspark.sql import functions as F

from coldspot import schemas as S
from coldspot.operators import sessions as SE
from conftest import rows

TRACE_SCHEMA = "timeentryunix double, filename string, eventtype string, uuid string"
CONTENTS_SCHEMA = "scope string, name string, child_name string, did_type string, child_type string"


def _traces(spark):
    return spark.createDataFrame([
        (100.0, "f1", "get", "u1"),
        (150.0, "f1", "get", "u1"),        # same session, later
        (120.0, "f1", "get_sm_a", "u2"),   # get.* matches
        (130.0, "f2", "download", ""),     # empty uuid -> null session id
        (140.0, "f2", "download", None),   # null uuid, same session as above
        (160.0, "f2", "downloadx", "u3"),  # not a read event
        (170.0, "f2", "put", "u3"),        # not a read event
        (None, "f1", "get", "u4"),         # no time
        (180.0, None, "get", "u4"),        # no file name
        (190.0, "f1", None, "u4"),         # no event type
        (200.0, "f3", "get", "u5"),        # file of datasets outside the scopes
        (210.0, "f4", "get", "u6"),        # link is C/F: not a dataset file
        (220.0, "f5", "get", "u7"),        # link is D/D: not a file
    ], TRACE_SCHEMA)


def _contents(spark):
    return spark.createDataFrame([
        ("data1", "data1.a", "f1", "D", "F"),
        ("mc1", "mc1.b", "f1", "D", "F"),     # the same file in a second dataset
        ("data1", "data1.a", "f2", "D", "F"),
        ("ms1", "ms1.c", "f3", "D", "F"),     # 'ms' scope: only in the literal list
        ("user.x", "user.x.d", "f3", "D", "F"),
        ("data1", "data1.e", "f4", "C", "F"),
        ("data1", "data1.g", "f5", "D", "D"),
    ], CONTENTS_SCHEMA)


def test_valid_traces_drops_missing_fields(spark):
    assert SE.valid_traces(_traces(spark)).count() == 10


def test_dataset_files(spark):
    got = rows(SE.dataset_files(_contents(spark)), "name", "child_name")
    assert got == sorted([("data1.a", "f1"), ("mc1.b", "f1"), ("data1.a", "f2"),
                          ("ms1.c", "f3"), ("user.x.d", "f3")], key=repr)


def test_sessions_by_hand(spark):
    got = rows(SE.build_sessions(_traces(spark), _contents(spark)),
               "scope", "name", "uuid", "fileops", "timeentryunix")
    expected = [
        ("data1", "data1.a", "u1", 2, 150.0),
        ("data1", "data1.a", "u2", 1, 120.0),
        ("data1", "data1.a", None, 2, 140.0),  # '' and NULL merged
        ("mc1", "mc1.b", "u1", 2, 150.0),      # file counted for each dataset
        ("mc1", "mc1.b", "u2", 1, 120.0),
    ]
    assert got == sorted(expected, key=repr)


def test_literal_scope_list_keeps_ms(spark):
    got = SE.build_sessions(_traces(spark), _contents(spark), S.LITERAL_SESSION_SCOPE_PREFIXES)
    names = {r.name for r in got.collect()}
    assert names == {"data1.a", "ms1.c"}


def test_preaggregated_sessions_equal_join_then_group(spark):
    """The pre-aggregated plan equals grouping the joined event rows."""
    t, c = _traces(spark), _contents(spark)
    naive = (SE.read_accesses(t, c).groupBy("scope", "name", "uuid")
             .agg(F.count(F.lit(1)).alias("fileops"), F.max("timeentryunix").alias("timeentryunix")))
    assert rows(SE.build_sessions(t, c)) == rows(naive.select(*SE.build_sessions(t, c).columns))


def test_sessions_by_day_split_at_midnight(spark):
    t = spark.createDataFrame([(86399.0, "f1", "get", "u1"), (86400.0, "f1", "get", "u1")],
                              TRACE_SCHEMA)
    got = rows(SE.build_sessions(t, _contents(spark), by_day=True).filter("scope = 'data1'"),
               "trace_date", "fileops")
    assert [str(d) for d, _ in got] == ["1970-01-01", "1970-01-02"]


def test_union_counts_duplicates_twice_unless_regrouped(spark):
    s = SE.build_sessions(_traces(spark), _contents(spark))
    assert SE.union_sessions(s, s).count() == 2 * s.count()
    merged = SE.union_sessions(s, s, regroup=True)
    assert merged.count() == s.count()
    assert {r.fileops for r in merged.filter("uuid = 'u1'").collect()} == {4}


def test_sorted_sessions(spark):
    s = SE.build_sessions(_traces(spark), _contents(spark), sort=True)
    ts = [r.timeentryunix for r in s.collect()]
    assert ts == sorted(ts)
