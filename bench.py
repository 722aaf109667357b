"""Benchmark of the headline reports.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8) and prints one JSON line:

  {"metric": "reports_total_sec", "value": N, "unit": "sec",
   "queries": {"name": sec, ...}, "sf": 0.1}

Every query is executed in full with the ``noop`` sink (all rows computed,
nothing collected). The test-bed catalogue is derived from the driver tables
and written once to the shared checkpoint folder before timing (as the
catalogue dumps are files in production). Each query runs once untimed
(JIT and code-generation warm-up; reported as ``cold``), then three timed
runs; the reported time is their median (``runs`` keeps all three).
``value`` is the sum over the headline queries of the medians; the
reference's form of the period report (five independent jobs) is timed as
``popularity_five_jobs`` beside the one-pass form for comparison, and
``all_reports`` is the end-to-end run with the sessions and the per-dataset
disk volume written once to the shared checkpoint folder and read back by
every report.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from coldspot import registry as RG  # noqa: E402
from coldspot.operators import sqlreports as Q  # noqa: E402
from coldspot.plans import reports as R  # noqa: E402
from coldspot.session import local_session, scratch_path  # noqa: E402
from coldspot.sources import readers as RD  # noqa: E402
from coldspot.sources import testbed as TB  # noqa: E402
from coldspot.sources import writers as WR  # noqa: E402

HEADLINE = [
    "sessions", "popularity_report", "popularity_all_periods", "popularity_pivot",
    "unused_list", "unused_full_stats", "unused_topn_other", "unused_topn_report",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def all_reports(spark, sf_dir: str) -> None:
    """Sessions and the per-dataset disk volume written once to the shared
    folder, then every report from them (the daily run's flow)."""
    cat = TB.catalogue(spark, sf_dir)
    path = scratch_path(spark, "bench-sessions")
    WR.write_sessions(R.sessions(cat), path)
    sess = RD.read_sessions(spark, path)
    ppath = scratch_path(spark, "bench-primary")
    R.primary(cat).write.parquet(ppath)
    prim = spark.read.parquet(ppath)
    run(R.popularity_pivot(sess, cat, RG.PERIODS, prim=prim))
    unused = R.unused_datasets(sess, cat, TB.REPORT_DATE, prim=prim)
    upath = scratch_path(spark, "bench-unused")
    WR.write_unused(unused, upath, TB.REPORT_DATE, fmt="parquet")
    stored = RD.latest_snapshot(spark.read.parquet(upath)).drop("report_date")
    full = R.unused_full_stats(stored, TB.REPORT_DATE)
    run(R.unused_topn(stored, TB.REPORT_DATE, RG.TOP_N))
    run(Q.unused_topn_report(full, 10, 11, "TB"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app_name="coldspot-bench")
    queries = RG.QUERIES
    t_cat = timed(lambda: TB.catalogue(spark, sf_dir))

    def five_jobs():
        cat = TB.catalogue(spark, sf_dir)
        sess = R.sessions(cat)
        for df in R.popularity_periods_separately(sess, cat, RG.PERIODS):
            run(df)

    jobs = {name: (lambda n=name: run(queries[n](spark, sf_dir))) for name in HEADLINE}
    jobs["popularity_five_jobs"] = five_jobs
    jobs["all_reports"] = lambda: all_reports(spark, sf_dir)

    cold = {name: timed(fn) for name, fn in jobs.items()}
    runs = {name: [] for name in jobs}
    for _ in range(3):
        for name, fn in jobs.items():
            runs[name].append(timed(fn))
    times = {name: sorted(r)[1] for name, r in runs.items()}

    total = round(sum(times[n] for n in HEADLINE), 3)
    print(json.dumps({"metric": "reports_total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf,
                      "cold": cold, "cold_total_sec": round(sum(cold[n] for n in HEADLINE), 3),
                      "runs": runs, "catalogue_write_sec": t_cat}))


if __name__ == "__main__":
    main()
