"""The notebook reports on stored statistics.

Form parameters are arguments. The reports are written as DataFrame plans; use
``plans.reports.register_views`` to query the same tables in Spark SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot import schemas as S
from coldspot.functions.columns import unit_divisor
from coldspot.operators.unused import top_idents
from coldspot.plans.sizing import cut_lineage


def unused_topn_report(report: DataFrame, top_n: int = 10, last_months: int = 11,
                       unit: str | int = "TB", materialise: bool = True) -> DataFrame:
    """``created_at, ident, size`` of the ``top_n`` idents by total volume (ties by
    ident), for bins younger than the newest bin + ``last_months`` * 31 days, size
    in ``unit`` ('TB', 'PB' or a divisor), newest first. ``report`` is the full
    monthly stats (``created_at, age_days, ident, volume``).

    The report is read three times (rows, ranking, least age). With
    ``materialise`` it is written once to the shared folder first, which starts a
    job; pass a report read from files with ``materialise=False``."""
    if materialise:
        report = cut_lineage(report)
    totals = report.groupBy(S.IDENT).agg(F.sum(S.VOLUME).alias(S.SIZE))
    largest = F.broadcast(top_idents(totals, int(top_n)).select(S.IDENT))  # top_n rows
    youngest = report.select(F.min(S.AGE_DAYS)).scalar()
    window = int(last_months) * S.NOTEBOOK_MONTH_DAYS
    return (report.filter(F.col(S.AGE_DAYS) < youngest + window)
            .join(largest, S.IDENT, "left_semi")
            .select(S.CREATED_AT, S.IDENT, (F.col(S.VOLUME) / unit_divisor(unit)).alias(S.SIZE))
            .orderBy(F.desc(S.CREATED_AT)))


def period_volume_sum(volumes: DataFrame) -> DataFrame:
    """``period, volume, month``: volume per bin and period file."""
    keys = [S.PERIOD, "month"]
    return volumes.groupBy(*keys).agg(F.sum(S.VOLUME).alias(S.VOLUME)).select(S.PERIOD, S.VOLUME, "month")
