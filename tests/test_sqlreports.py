"""W6 TOP-N report: J5, J6, A14, A15, P14, P16, F13, O7, O8."""
import datetime as dt

import pytest

from coldspot import schemas as S
from coldspot.operators.sqlreports import unused_topn_report

REPORT = "created_at date, age_days int, ident string, volume long"


def _report(spark):
    d = dt.date
    return spark.createDataFrame([
        (d(2024, 1, 1), 31, "a*", 3 * S.TERABYTE),
        (d(2023, 12, 1), 62, "a*", S.TERABYTE),
        (d(2023, 10, 1), 31 + 3 * 31, "a*", 5 * S.TERABYTE),     # exactly min + 3*31: excluded
        (d(2024, 1, 1), 31, "b*", 2 * S.TERABYTE),
        (d(2023, 11, 1), 92, "c*", S.TERABYTE // 2),
    ], REPORT)


def test_topn_last_months(spark):
    got = [tuple(r) for r in unused_topn_report(_report(spark), top_n=2, last_months=3).collect()]
    assert got[0][0] >= got[-1][0]  # newest first
    assert sorted(got, key=repr) == sorted([
        (dt.date(2024, 1, 1), "a*", 3.0), (dt.date(2023, 12, 1), "a*", 1.0),
        (dt.date(2024, 1, 1), "b*", 2.0)], key=repr)


@pytest.mark.parametrize("unit,div", [("TB", S.TERABYTE), ("PB", S.PETABYTE), (1000, 1000)])
def test_units(spark, unit, div):
    got = unused_topn_report(_report(spark), top_n=1, last_months=12, unit=unit)
    assert sorted(r.size for r in got.collect()) == sorted(
        [3 * S.TERABYTE / div, S.TERABYTE / div, 5 * S.TERABYTE / div])


def test_plan_uses_semi_join_and_subquery(spark):
    plan = unused_topn_report(_report(spark), 2, 3)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "Subquery" in plan
