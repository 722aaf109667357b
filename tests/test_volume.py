"""Dataset volume: P6-P12, J2-J4b, A2-A5, A8, H21."""
import pytest

from coldspot.operators import volume as V
from conftest import rows

DIDS = "created_at long, scope string, name string, transient int"
RSES = "id long, rse string"
LOCKS = "rse_id long, scope string, name string, bytes long"
SESS = "scope string, name string, uuid string, fileops long, timeentryunix double"


def _dids(spark):
    return spark.createDataFrame([
        (1_000_000, "data1", "data1.a", None),
        (2_000_000, "data1", "data1.a", None),   # duplicate did: min wins
        (5_000_000, "mc1", "mc1.b", None),
        (9_000_000, "valid1", "valid1.c", None),
        (None, "data1", "data1.n", None),        # null creation time
        (1_000_000, "data1", "data1.t", 1),      # transient
        (1_000_000, "data1", "data1.x_sub01", None),  # sub dataset
        (1_000_000, "user.x", "user.x.y", None),      # scope off the list
    ], DIDS)


def _rses(spark):
    return spark.createDataFrame([(1, "A_DATADISK"), (2, "B_DATADISK_SUFFIX"), (3, "C_TAPE")], RSES)


def _locks(spark):
    return spark.createDataFrame([
        (1, "data1", "data1.a", 10), (1, "data1", "data1.a", 30),   # two locks, one endpoint
        (2, "data1", "data1.a", 5),                                  # second endpoint
        (3, "data1", "data1.a", 1000),                               # tape: ignored
        (9, "data1", "data1.a", 2000),                               # unknown endpoint
        (1, "mc1", "mc1.b", 7), (1, "valid1", "valid1.c", 11), (2, "data1", "data1.n", 13),
        (1, "data1", "data1.t", 17), (1, "data1", "data1.x_sub01", 19),
        (1, "user.x", "user.x.y", 23),
    ], LOCKS)


def _primary(spark):
    return V.primary_datadisk(V.live_datasets(_dids(spark)), V.disk_replicas(_locks(spark), _rses(spark)))


def test_live_datasets(spark):
    got = rows(V.live_datasets(_dids(spark)), "name", "created_at")
    assert got == sorted([("data1.a", 1000.0), ("data1.a", 2000.0), ("mc1.b", 5000.0),
                          ("valid1.c", 9000.0), ("data1.n", None)], key=repr)


def test_disk_endpoints_contains_datadisk(spark):
    assert {r.rse for r in V.disk_endpoints(_rses(spark)).collect()} == {"A_DATADISK", "B_DATADISK_SUFFIX"}


def test_primary_datadisk(spark):
    got = rows(_primary(spark), "name", "rse", "bytes", "created_at")
    assert got == sorted([
        ("data1.a", "A_DATADISK", 30, 1000.0),
        ("data1.a", "B_DATADISK_SUFFIX", 5, 1000.0),
        ("mc1.b", "A_DATADISK", 7, 5000.0),
        ("valid1.c", "A_DATADISK", 11, 9000.0),
        ("data1.n", "B_DATADISK_SUFFIX", 13, None),
    ], key=repr)


def test_primary_without_broadcast_is_the_same(spark):
    want = rows(_primary(spark))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        assert rows(_primary(spark)) == want
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _sessions(spark):
    return spark.createDataFrame([
        ("data1", "data1.a", "u1", 1, 3000.0),   # equal to the cutoff: excluded
        ("data1", "data1.a", "u2", 1, 3500.0),
        ("data1", "data1.a", "u3", 1, 3600.0),
        ("mc1", "mc1.b", None, 2, 4000.0),        # only a null-uuid session after the cutoff
        ("valid1", "valid1.c", "u1", 1, 100.0),   # before the cutoff only
    ], SESS)


CUT = 3000.0


def test_access_counts_strict_cutoff(spark):
    got = rows(V.access_counts(_sessions(spark), CUT), "name", "op_events")
    assert got == [("data1.a", 2), ("mc1.b", 0)]


def test_access_counts_without_cutoff(spark):
    got = rows(V.access_counts(_sessions(spark), None), "name", "op_events")
    assert got == [("data1.a", 3), ("mc1.b", 0), ("valid1.c", 1)]


def test_dataset_volume_three_way_default(spark):
    vol = V.dataset_volume(_primary(spark), V.access_counts(_sessions(spark), CUT), CUT)
    got = rows(vol, "name", "op_events", "bytes")
    assert got == [
        ("data1.a", 2, 35),      # bytes summed over both disk endpoints
        ("data1.n", 0, 13),      # null creation time -> 0
        ("mc1.b", 0, 7),         # null-uuid sessions only: 0, never -1
        ("valid1.c", 0, 11),     # created after the cutoff, no session in the period
    ]
    vol2 = V.dataset_volume(_primary(spark), V.access_counts(_sessions(spark), 6000.0), 6000.0)
    got2 = dict(rows(vol2, "name", "op_events"))
    assert got2 == {"data1.a": -1, "data1.n": 0, "mc1.b": -1, "valid1.c": 0}


def test_dataset_volume_alltime(spark):
    vol = V.dataset_volume_alltime(_primary(spark), V.access_counts(_sessions(spark), None))
    got = rows(vol, "name", "op_events", "bytes", "created_at")
    assert got == [("data1.a", 3, 35, 1000.0), ("data1.n", 0, 13, None),
                   ("mc1.b", 0, 7, 5000.0), ("valid1.c", 1, 11, 9000.0)]


@pytest.mark.parametrize("cuts", [
    {"a": 3000.0, "b": None, "c": 6000.0, "d": 50.0},
    {"x": 3500.0},
])
def test_one_pass_equals_per_period(spark, cuts):
    prim, sess = _primary(spark), _sessions(spark)
    one = V.dataset_volume_periods(prim, V.period_access_counts(sess, cuts), cuts)
    for label, cut in cuts.items():
        single = V.dataset_volume(prim, V.access_counts(sess, cut), cut)
        assert rows(one.filter(one.period == label), "name", "op_events", "bytes") == \
            rows(single, "name", "op_events", "bytes"), label


def test_day_partitions_pruned_by_cutoff(spark, tmp_dir):
    import os
    from coldspot.sources import writers as WR
    from coldspot.operators import sessions as SE
    traces = spark.createDataFrame(
        [(d * 86400.0 + 60, "f1", "get", f"u{d}") for d in range(10)],
        "timeentryunix double, filename string, eventtype string, uuid string")
    contents = spark.createDataFrame([("data1", "data1.a", "f1", "D", "F")],
                                     "scope string, name string, child_name string, did_type string, child_type string")
    path = os.path.join(tmp_dir, "sessions")
    WR.write_load(SE.build_sessions(traces, contents, by_day=True), path, "a")
    from coldspot.sources import readers as RD
    stored = RD.read_session_loads(spark, path)
    cut = 7 * 86400.0 + 30        # passes days 7, 8, 9 only
    counts = V.access_counts(stored, cut)
    assert rows(counts, "name", "op_events") == [("data1.a", 3)]
    assert rows(V.access_counts(stored, None), "name", "op_events") == [("data1.a", 10)]
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        counts.explain("formatted")
    assert "PartitionFilters: [isnotnull(trace_date" in buf.getvalue()
    assert "1970-01-08" in buf.getvalue()
    one = V.period_access_counts(stored, {"a": cut, "b": 8 * 86400.0})
    assert rows(one, "_u0", "_u1") == [(3, 2)]
