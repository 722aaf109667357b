"""The reports, each one Spark plan from the catalogue tables to the result.

W1 ``sessions``              access sessions from the access log
W2 ``popularity``            volume by access count for one cutoff
W3 ``popularity_periods``    the same for every period in one pass, binned
                             (-1..15, dense) and as a bin x period matrix
W4 ``unused_datasets``       the never-used list
W5 ``unused_statistics``     cube, full statistics, TOP-N + other (long/wide)
W6/W7                        the notebook SQL reports (``operators.sqlreports``)

Periods are given in months (0 = infinity) and anchored at midnight UTC of
``report_date``: the cutoff of m months is ``midnight - m*30 days``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from coldspot import schemas as S
from coldspot.functions.columns import period_cutoff, period_label
from coldspot.operators import histogram as H
from coldspot.operators import sessions as SE
from coldspot.operators import unused as U
from coldspot.operators import volume as V
from coldspot.plans.sizing import cut_lineage
from coldspot.sources.catalogue import Catalogue


# --------------------------------------------------------------------------
# W1
# --------------------------------------------------------------------------
def sessions(cat: Catalogue, scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES,
             sort: bool = False) -> DataFrame:
    return SE.build_sessions(cat.traces, cat.contents, scope_prefixes, sort=sort)


def sessions_by_day(cat: Catalogue,
                    scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES) -> DataFrame:
    """Sessions keyed by ``trace_date`` as well (daily runs; S13)."""
    return SE.build_sessions(cat.traces, cat.contents, scope_prefixes, by_day=True)


# --------------------------------------------------------------------------
# Shared: per-dataset volume on disk endpoints
# --------------------------------------------------------------------------
def primary(cat: Catalogue, scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES) -> DataFrame:
    return V.primary_datadisk(V.live_datasets(cat.dids, scope_prefixes),
                              V.disk_replicas(cat.dslocks, cat.rses))


# --------------------------------------------------------------------------
# W2
# --------------------------------------------------------------------------
def popularity(sess: DataFrame, cat: Catalogue, cutoff: float | None,
               scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES) -> DataFrame:
    """``access_num, volume`` for sessions after ``cutoff`` (epoch seconds;
    None or 0 = all time)."""
    vol = V.dataset_volume(primary(cat, scope_prefixes), V.access_counts(sess, cutoff), cutoff)
    return H.access_histogram(vol)


# --------------------------------------------------------------------------
# W3
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class Periods:
    labels: list[str]
    cutoffs: dict[str, float | None]

    @classmethod
    def of_months(cls, report_date: str | _dt.date,
                  months: Sequence[int] = S.DEFAULT_PERIOD_MONTHS) -> "Periods":
        labels = [period_label(m) for m in months]
        return cls(labels, {period_label(m): period_cutoff(report_date, m) for m in months})


def popularity_periods(sess: DataFrame, cat: Catalogue, periods: Periods,
                       scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES,
                       prim: DataFrame | None = None,
                       counts: DataFrame | None = None) -> DataFrame:
    """``period, access_num, volume`` for every period, one pass.
    ``prim`` and ``counts`` are a stored ``primary`` table and the stored
    counts of the same periods, to reuse (else they are computed)."""
    counts = counts if counts is not None else V.period_access_counts(sess, periods.cutoffs)
    prim = prim if prim is not None else primary(cat, scope_prefixes)
    vol = V.dataset_volume_periods(prim, counts, periods.cutoffs)
    return H.access_histogram(vol, by_period=True)


def popularity_periods_separately(sess: DataFrame, cat: Catalogue, periods: Periods,
                                  scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES
                                  ) -> list[DataFrame]:
    """The reference's form: one independent plan per period (for comparison)."""
    return [popularity(sess, cat, periods.cutoffs[p], scope_prefixes) for p in periods.labels]


def popularity_bins(sess: DataFrame, cat: Catalogue, periods: Periods,
                    scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES,
                    prim: DataFrame | None = None,
                    counts: DataFrame | None = None) -> DataFrame:
    """``period, bin, volume``: bins -1..15 per period, dense."""
    return H.dense_bins(popularity_periods(sess, cat, periods, scope_prefixes, prim, counts),
                        periods.labels)


def popularity_pivot(sess: DataFrame, cat: Catalogue, periods: Periods,
                     scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES,
                     prim: DataFrame | None = None) -> DataFrame:
    """``bin, label, vol_<period>...``."""
    return H.pivot_periods(popularity_bins(sess, cat, periods, scope_prefixes, prim),
                           periods.labels)


# --------------------------------------------------------------------------
# W4
# --------------------------------------------------------------------------
def volume_alltime(sess: DataFrame, cat: Catalogue,
                   scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES,
                   prim: DataFrame | None = None,
                   counts: DataFrame | None = None) -> DataFrame:
    """``counts`` are stored all-time access counts to reuse."""
    prim = prim if prim is not None else primary(cat, scope_prefixes)
    return V.dataset_volume_alltime(prim, counts if counts is not None else V.access_counts(sess, None))


def unused_datasets(sess: DataFrame, cat: Catalogue, report_date: str | _dt.date,
                    scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES,
                    sort: bool = True, prim: DataFrame | None = None,
                    counts: DataFrame | None = None) -> DataFrame:
    return U.unused_list(volume_alltime(sess, cat, scope_prefixes, prim, counts), report_date, sort=sort)


# --------------------------------------------------------------------------
# W5
# --------------------------------------------------------------------------
def unused_full_stats(unused: DataFrame, report_date: str | _dt.date,
                      grain: str = "month", malformed: str = "unknown") -> DataFrame:
    return U.full_stats(U.unused_cube(unused, malformed), report_date, grain)


def unused_topn(unused: DataFrame, report_date: str | _dt.date, n: int = S.DEFAULT_TOP_N,
                grain: str = "month", malformed: str = "unknown",
                wide: bool = False, materialise: bool = True) -> DataFrame:
    """TOP-N + other by creation bin; long form, or wide (one column per
    top ident in rank order, then ``other``).

    The cube feeds both the ranking and the binning; with ``materialise`` it
    is written once to the shared checkpoint folder (it is an aggregate, far
    smaller than the never-used list) so the list is computed once."""
    cube = U.unused_cube(unused, malformed)
    if materialise:
        cube = cut_lineage(cube)
    return topn_of_cube(cube, report_date, n, grain, wide)


def topn_of_cube(cube: DataFrame, report_date: str | _dt.date, n: int = S.DEFAULT_TOP_N,
                 grain: str = "month", wide: bool = False) -> DataFrame:
    """TOP-N + other from a cube that is read from files."""
    top = U.top_idents(U.ident_totals(cube, merge_log=True), n)
    long_form = U.topn_other(cube, top, report_date, grain, merge_log=True)
    return U.topn_wide(long_form, top) if wide else long_form


def unused_topn_ranked(cube: DataFrame, report_date: str | _dt.date, n: int = S.DEFAULT_TOP_N,
                       grain: str = "month") -> DataFrame:
    """The wide TOP-N table with fixed column names ``c01..cNN, other``: the
    column of rank r holds the volume of the r-th ident, named in ``ident``
    columns ``i01..iNN`` of every row (NULL and 0 when there are fewer)."""
    top = U.top_idents(U.ident_totals(cube, merge_log=True), n)
    return U.topn_ranked(U.topn_other(cube, top, report_date, grain, merge_log=True), top, n)


# --------------------------------------------------------------------------
# Named tables for SQL users
# --------------------------------------------------------------------------
def register_views(cat: Catalogue, sessions_df: DataFrame | None = None,
                   prefix: str = "") -> list[str]:
    """Register the catalogue (and sessions) as temporary views
    ``<prefix>traces``, ``<prefix>contents``, ... so reports can also be written
    in Spark SQL. Returns the view names."""
    names = []
    for field in ("traces", "contents", "dids", "rses", "dslocks"):
        name = f"{prefix}{field}"
        getattr(cat, field).createOrReplaceTempView(name)
        names.append(name)
    if sessions_df is not None:
        sessions_df.createOrReplaceTempView(f"{prefix}sessions")
        names.append(f"{prefix}sessions")
    return names
