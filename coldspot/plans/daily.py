"""The daily run: one Spark application from the day's access log and the
catalogue dumps to every report, each in a folder of its date.

1. the sessions of the log are one load of the kept session state (``state``); a
   rerun replaces that load, and late events of other days join their sessions.
   Only the buckets of the load's datasets are read and rewritten;
2. the per-dataset disk volume (replicas x endpoints x catalogue) and the
   per-dataset access counts of every period, from the state's index, are written
   once;
3. from these two tables: the popularity bins, their matrix and the volume per
   bin and period, and the never-used list;
4. the cube of never-used datasets, once, and from it the full statistics, the
   TOP-N tables and the TOP-N report.

Every step publishes a table (``sources.publish``: all of it or nothing) and the
next step reads it back with its declared schema, so lineage never grows past one
step, and a run that fails leaves the tables of the run before.

A session is one ``(scope, name, uuid)`` over all stored days and loads, as in
the registered reports.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldspot import schemas as S
from coldspot.operators import histogram as H
from coldspot.operators import sqlreports as Q
from coldspot.operators import unused as U
from coldspot.plans import reports as R
from coldspot.plans import state as ST
from coldspot.session import SPLIT_BYTES, TASK_BYTES, bound_tasks, input_bytes, tune
from coldspot.sources import readers as RD
from coldspot.sources import writers as WR
from coldspot.sources.catalogue import Catalogue
from coldspot.sources.publish import commit, last_commit, version_folder

SNAPSHOT_COLUMNS = {
    "contents": S.CONTENTS_COLUMNS,
    "dids": S.DIDS_COLUMNS,
    "rses": S.RSES_COLUMNS,
    "dslocks": S.DSLOCKS_COLUMNS,
}


def read_catalogue(spark: SparkSession, traces_path: str | Sequence[str],
                   dumps: Mapping[str, str], fmt: str = "avro") -> Catalogue:
    """The access log (JSON lines) and the four dumps (``fmt``)."""
    snaps = {t: RD.read_snapshot(spark, dumps[t], cols, fmt) for t, cols in SNAPSHOT_COLUMNS.items()}
    return Catalogue(traces=RD.read_traces(spark, traces_path), **snaps)


def stored_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Every stored session: ``scope, name, uuid`` over all days and loads."""
    return ST.read_state(spark, path)


def run_daily(spark: SparkSession, traces_path: str | Sequence[str], dumps: Mapping[str, str],
              out_root: str, report_date: str | _dt.date, fmt: str = "avro",
              months: Sequence[int] = S.DEFAULT_PERIOD_MONTHS,
              top_n: int = S.DEFAULT_TOP_N, grain: str = "month",
              csv: bool = True, load: str | None = None,
              report_top_n: int = 10, last_months: int = 11, unit: str | int = "TB",
              buckets: int = ST.BUCKETS) -> dict[str, str]:
    """Run every report for ``report_date``; returns the output paths.

    ``load`` names the log that is read (default: the report date); running a
    load again replaces it. With ``csv`` the full statistics and the wide
    TOP-N table are also published as CSV with the report headers, one folder
    per date (``full_monthly/<date>``, ``topn_wide/<date>``); the paths returned
    are those of the published version. Shuffles are sized from the bytes of the
    log, the dumps and the kept state, for as long as this runs. ``buckets`` is
    the number of buckets of a new session state."""
    tune(spark)
    kept = {k: spark.conf.get(k, None) for k in
            ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", SPLIT_BYTES)}
    bound_tasks(spark, max(input_bytes(spark, p) for p in (
        traces_path, *dumps.values(), f"{out_root.rstrip('/')}/sessions")), TASK_BYTES)
    try:
        return _run(spark, traces_path, dumps, out_root.rstrip("/"), report_date, fmt, months, top_n,
                    grain, csv, str(load or report_date), report_top_n, last_months, unit, buckets)
    finally:
        for key, value in kept.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _run(spark, traces_path, dumps, root, report_date, fmt, months, top_n, grain, csv, load,
         report_top_n, last_months, unit, buckets):
    paths = {k: f"{root}/{k}" for k in (
        "sessions", "primary", "counts", "popularity", "matrix", "period_volumes", "unused", "cube",
        "full_stats", "topn", "topn_report")}
    cat = read_catalogue(spark, traces_path, dumps, fmt)

    def step(name: str, df: DataFrame, schema: T.StructType | None = None, partitions=()) -> DataFrame:
        WR.publish_dated(df, paths[name], report_date, extra_partitions=partitions)
        return RD.read_dated(spark, paths[name], report_date, schema or df.schema)

    def publish_csv(name: str, write) -> None:
        folder = f"{root}/{name}/{report_date}"
        number = last_commit(spark, folder)[0] + 1
        write(version_folder(folder, number))
        commit(spark, folder, number, {"versions": [number]})
        paths[f"{name}_csv"] = version_folder(folder, number)

    # 1. Sessions of this log, as one load.
    ST.merge_load(R.sessions(cat), paths["sessions"], load, buckets)
    sessions = stored_sessions(spark, paths["sessions"])

    # 2. Disk volume and access counts per dataset.
    prim = step("primary", R.primary(cat), S.PRIMARY_SCHEMA)
    periods = R.Periods.of_months(report_date, months)
    every = R.Periods.of_months(report_date, [*months, *([] if 0 in months else [0])])
    counts = step("counts", ST.indexed_counts(spark, paths["sessions"], every.cutoffs))
    infinity = every.labels.index(S.INFINITY_LABEL)
    alltime = counts.filter(F.col(f"_n{infinity}") > 0).select(
        S.SCOPE, S.NAME, F.col(f"_u{infinity}").alias(S.OP_EVENTS))

    # 3. Popularity and the never-used list.
    bins = step("popularity", R.popularity_bins(sessions, cat, periods, prim=prim, counts=counts),
                S.BINS_SCHEMA, (S.PERIOD,))
    step("matrix", H.pivot_periods(bins, periods.labels))
    step("period_volumes", Q.period_volume_sum(H.period_volume_table(bins)))
    unused = step("unused", R.unused_datasets(sessions, cat, report_date, sort=False, prim=prim,
                                              counts=alltime), S.UNUSED_SCHEMA)

    # 4. Statistics from the cube.
    cube = step("cube", U.unused_cube(unused), S.CUBE_SCHEMA)
    full = step("full_stats", U.full_stats(cube, report_date, grain), S.FULL_STATS_SCHEMA)
    step("topn", R.topn_of_cube(cube, report_date, top_n, grain), S.FULL_STATS_SCHEMA)
    step("topn_report", Q.unused_topn_report(full, report_top_n, last_months, unit, materialise=False))

    if csv:
        publish_csv("full_monthly", lambda path: WR.write_stats(
            full.orderBy(F.desc(S.CREATED_AT), F.desc(S.IDENT)), path, comment="Column names in the next line"))
        publish_csv("topn_wide", lambda path: WR.write_topn_wide(
            R.topn_of_cube(cube, report_date, top_n, grain, wide=True), path))
    return paths
