"""Random small inputs against a plain-Python evaluation of the report
semantics (join on file name, sessions, cutoff, three-way default, sums)."""
import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from coldspot.operators import sessions as SE
from coldspot.operators import volume as V
from coldspot.operators.histogram import access_histogram

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

trace = st.tuples(
    st.one_of(st.none(), st.sampled_from([10.0, 20.0, 30.0, 40.0])),
    st.one_of(st.none(), st.sampled_from(["f0", "f1", "f2"])),
    st.one_of(st.none(), st.sampled_from(["get", "get_x", "download", "put", "downloadx"])),
    st.one_of(st.none(), st.sampled_from(["", "u0", "u1"])),
)
link = st.tuples(st.sampled_from(["data1", "mc1", "ms1", "user"]), st.sampled_from(["a", "b"]),
                 st.sampled_from(["f0", "f1", "f2"]), st.sampled_from(["D", "C"]), st.sampled_from(["F", "D"]))


def py_sessions(traces, contents, prefixes=("data", "mc", "valid")):
    out = defaultdict(lambda: [0, None])
    for ts, fn, et, uu in traces:
        if fn is None or et is None or ts is None or not re.match(r"^(get.*|download)$", et):
            continue
        for sc, nm, ch, dt, ct in contents:
            if ch == fn and dt == "D" and ct == "F" and sc.startswith(prefixes):
                key = (sc, nm, uu or None)
                out[key][0] += 1
                out[key][1] = ts if out[key][1] is None else max(out[key][1], ts)
    return sorted(((*k, v[0], v[1]) for k, v in out.items()), key=repr)


@SETTINGS
@given(st.lists(trace, max_size=25), st.lists(link, max_size=10))
def test_sessions_brute_force(spark, traces, links):
    contents = [(sc, f"{sc}.{nm}", ch, dt, ct) for sc, nm, ch, dt, ct in links]
    t = spark.createDataFrame(traces, "timeentryunix double, filename string, eventtype string, uuid string")
    c = spark.createDataFrame(contents, "scope string, name string, child_name string, did_type string, child_type string")
    got = sorted((tuple(r) for r in SE.build_sessions(t, c).select(
        "scope", "name", "uuid", "fileops", "timeentryunix").collect()), key=repr)
    assert got == py_sessions(traces, contents)


session = st.tuples(st.sampled_from(["d.a", "d.b", "d.c"]), st.one_of(st.none(), st.sampled_from(["u0", "u1"])),
                    st.sampled_from([5.0, 15.0, 25.0]))
did = st.tuples(st.one_of(st.none(), st.sampled_from([0, 10000, 20000])), st.sampled_from(["d.a", "d.b", "d.c", "d.d"]))
lock = st.tuples(st.sampled_from(["1", "2", "3"]), st.sampled_from(["d.a", "d.b", "d.c", "d.d"]),
                 st.integers(min_value=1, max_value=50))
RSES = [("1", "A_DATADISK"), ("2", "B_DATADISK"), ("3", "C_TAPE")]


def py_histogram(sessions, dids, locks, cutoff):
    counts = {}
    for nm, uu, ts in sessions:
        if (ts > cutoff) if cutoff else ts is not None:
            counts[nm] = counts.get(nm, 0) + (uu is not None)
    disk = {i for i, r in RSES if "DATADISK" in r}
    rse_of = dict(RSES)
    prim = {}
    for ms, nm in dids:
        for rid, lnm, b in locks:
            if lnm == nm and rid in disk:
                k = (nm, rse_of[rid])
                c = None if ms is None else ms / 1000
                pb, pc = prim.get(k, (None, None))
                prim[k] = (b if pb is None else max(pb, b),
                           c if pc is None else (pc if c is None else min(pc, c)))
    per_ds = {}
    for (nm, _), (b, c) in prim.items():
        if nm in counts:
            op = counts[nm]
        else:
            op = -1 if (c is not None and c < (cutoff or 0)) else 0
        o, s = per_ds.get(nm, (None, 0))
        per_ds[nm] = (op if o is None else max(o, op), s + b)
    hist = defaultdict(int)
    for op, b in per_ds.values():
        hist[op] += b
    return sorted(hist.items())


@SETTINGS
@given(st.lists(session, max_size=12), st.lists(did, min_size=1, max_size=6),
       st.lists(lock, max_size=10), st.sampled_from([None, 0, 10.0, 20.0]))
def test_popularity_brute_force(spark, sessions, dids, locks, cutoff):
    s = spark.createDataFrame([("d", nm, uu, 1, ts) for nm, uu, ts in sessions],
                              "scope string, name string, uuid string, fileops long, timeentryunix double")
    d = spark.createDataFrame([(ms, "d", nm, None) for ms, nm in dids],
                              "created_at long, scope string, name string, transient int")
    r = spark.createDataFrame(RSES, "id string, rse string")
    lk = spark.createDataFrame([(rid, "d", nm, b) for rid, nm, b in locks],
                               "rse_id string, scope string, name string, bytes long")
    prim = V.primary_datadisk(V.live_datasets(d, ("d",)), V.disk_replicas(lk, r))
    got = [tuple(x) for x in access_histogram(V.dataset_volume(prim, V.access_counts(s, cutoff), cutoff)).collect()]
    assert got == py_histogram(sessions, dids, locks, cutoff)
    one = V.dataset_volume_periods(prim, V.period_access_counts(s, {"p": cutoff}), {"p": cutoff})
    got_one = [tuple(x)[1:] for x in access_histogram(one, by_period=True).collect()]
    assert got_one == got


# ---------------------------------------------------------------------------
# Unused statistics: cube -> ident totals -> top-N + other, full stats
# ---------------------------------------------------------------------------
import datetime as _dt  # noqa: E402

from coldspot.operators import unused as U  # noqa: E402

REPORT = "2024-02-01"
unused_row = st.tuples(
    st.sampled_from(["p1", "p2", "p3"]),
    st.sampled_from(["AOD", "log", "HITS", None]),          # None: name without a 5th part
    st.one_of(st.none(), st.integers(min_value=0, max_value=9)),
    st.sampled_from([_dt.date(2023, 11, 30), _dt.date(2023, 12, 1), _dt.date(2024, 1, 15), _dt.date(2024, 1, 31)]),
)


def py_unused_stats(items, n):
    cube = defaultdict(int)
    for name, size, day in items:
        parts = name.split(".")
        dtype = parts[4].split("_")[0] if len(parts) >= 5 else "unknown"
        cube[(parts[0], dtype, day)] += size or 0
    merged = lambda p, d: "log" if d == "log" else f"{p}*{d}*"
    totals = defaultdict(int)
    for (p, d, _), sz in cube.items():
        totals[merged(p, d)] += sz
    top = [k for k, _ in sorted(totals.items(), key=lambda kv: (-kv[1], kv[0]))[:n]]
    report = _dt.date.fromisoformat(REPORT)
    other, full = defaultdict(int), defaultdict(int)
    for (p, d, day), sz in cube.items():
        month = day.replace(day=1)
        key = merged(p, d) if merged(p, d) in top else "other"
        other[(month, (report - month).days, key)] += sz
        full[(month, (report - month).days, f"{p}*{d}*")] += sz
    as_rows = lambda dd: sorted(((*k, v) for k, v in dd.items()), key=repr)
    return top, as_rows(other), as_rows(full)


@SETTINGS
@given(st.lists(unused_row, min_size=1, max_size=15), st.integers(min_value=1, max_value=4))
def test_unused_statistics_brute_force(spark, rows_, n):
    items = []
    for i, (proj, dtype, size, day) in enumerate(rows_):
        name = f"{proj}.{i}.s.m.{dtype}_r1" if dtype else f"{proj}.{i}"
        items.append((name, size, day))
    epoch = _dt.date(1970, 1, 1)
    df = spark.createDataFrame(
        [("s", name, size, (day - epoch).days * 86400 + 3600, 0) for name, size, day in items],
        "scope string, name string, bytes long, created_at long, age_days int")
    cube = U.unused_cube(df)
    top = U.top_idents(U.ident_totals(cube), n)
    e_top, e_other, e_full = py_unused_stats(items, n)
    assert [r.ident for r in top.orderBy("rank").collect()] == e_top
    got_other = sorted((tuple(r) for r in U.topn_other(cube, top, REPORT).collect()), key=repr)
    assert got_other == e_other
    got_full = sorted((tuple(r) for r in U.full_stats(cube, REPORT).collect()), key=repr)
    assert got_full == e_full
