"""Histograms: A6, A7, R2, R3, O2, O4."""
from pyspark.sql import functions as F

from coldspot.operators import histogram as H
from conftest import rows


def _hist(spark):
    return spark.createDataFrame([
        ("03", -1, 1), ("03", 0, 2), ("03", 14, 3), ("03", 15, 4), ("03", 16, 5), ("03", 100, 6),
        ("infinity", 0, 7),
    ], "period string, access_num long, volume long")


def test_access_histogram_sorted(spark):
    vol = spark.createDataFrame([("a", 3, 10), ("b", 3, 5), ("c", -1, 1)],
                                "name string, op_events long, bytes long")
    got = [tuple(r) for r in H.access_histogram(vol).collect()]
    assert got == [(-1, 1), (3, 15)]


def test_dense_bins_fold_and_fill(spark):
    bins = H.dense_bins(_hist(spark), ["03", "infinity"])
    got = {(r.period, r.bin): r.volume for r in bins.collect()}
    assert len(got) == 34
    assert got[("03", -1)] == 1 and got[("03", 0)] == 2 and got[("03", 14)] == 3
    assert got[("03", 15)] == 4 + 5 + 6
    assert got[("03", 5)] == 0 and got[("infinity", -1)] == 0 and got[("infinity", 0)] == 7
    assert [r.bin for r in bins.filter("period = '03'").collect()] == list(range(-1, 16))


def test_pivot_labels(spark):
    piv = H.pivot_periods(H.dense_bins(_hist(spark), ["03", "infinity"]), ["03", "infinity"])
    assert piv.columns == ["bin", "label", "vol_03", "vol_infinity"]
    got = {r.bin: (r.label, r.vol_03, r.vol_infinity) for r in piv.collect()}
    assert got[-1] == ("0 (older X)", 1, 0)
    assert got[0] == ("0 (younger X)", 2, 7)
    assert got[15] == ("> 14", 15, 0)
    assert got[7] == ("7", 0, 0)


def test_period_volume_sum(spark):
    from coldspot.operators.sqlreports import period_volume_sum
    bins = H.dense_bins(_hist(spark), ["03", "infinity"])
    got = rows(period_volume_sum(H.period_volume_table(bins)).filter(F.col("month") == "03"),
               "period", "volume")
    assert ("15", 15) in got and len(got) == 17
