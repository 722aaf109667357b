"""Volume by number of accesses.

All inputs here are per-dataset rows; the histograms reduce them to a handful
of rows with partial (map-side) aggregation, so no step holds more than
``periods x distinct counts`` rows after the first exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldspot import schemas as S
from coldspot.functions.columns import bin_label, capped_bin


def access_histogram(volume: DataFrame, by_period: bool = False, sort: bool = True) -> DataFrame:
    """``access_num, volume``: bytes summed per access count.
    With ``by_period`` the input carries a ``period`` column and so does the
    output."""
    keys = [S.PERIOD, S.OP_EVENTS] if by_period else [S.OP_EVENTS]
    out = (volume.groupBy(*keys).agg(F.sum(S.BYTES).alias(S.VOLUME))
           .withColumnRenamed(S.OP_EVENTS, S.ACCESS_NUM))
    if sort:
        out = out.orderBy(*([S.PERIOD] if by_period else []), S.ACCESS_NUM)
    return out


def bin_spine(spark: SparkSession, periods: Sequence[str],
              low: int = S.BIN_LOW, cap: int = S.BIN_CAP) -> DataFrame:
    """Every ``(period, bin)`` pair, bins ``low..cap``; generated, no join."""
    width = cap - low + 1
    labels = F.array(*[F.lit(p) for p in periods])
    return spark.range(len(periods) * width).select(
        F.element_at(labels, (F.col("id") / width).cast("int") + 1).alias(S.PERIOD),
        ((F.col("id") % width) + low).cast("long").alias(S.BIN))


def dense_bins(hist: DataFrame, periods: Sequence[str],
               low: int = S.BIN_LOW, cap: int = S.BIN_CAP) -> DataFrame:
    """``period, bin, volume`` with every bin ``low..cap`` present (zero when
    empty); counts of ``cap`` or more fold into ``cap`` (A7, O4).

    ``hist`` is ``period, access_num, volume``.
    """
    binned = (hist.groupBy(S.PERIOD, capped_bin(S.ACCESS_NUM, cap).cast("long").alias(S.BIN))
              .agg(F.sum(S.VOLUME).alias(S.VOLUME)))
    spine = bin_spine(hist.sparkSession, periods, low, cap)
    # At most len(periods) * (cap - low + 1) rows: a bounded broadcast.
    return (spine.join(F.broadcast(binned), [S.PERIOD, S.BIN], "left")
            .select(S.PERIOD, S.BIN,
                    F.coalesce(F.col(S.VOLUME), F.lit(0).cast("long")).alias(S.VOLUME))
            .orderBy(S.PERIOD, S.BIN))


def pivot_column(period: str) -> str:
    return f"vol_{period}"


def pivot_periods(bins: DataFrame, periods: Sequence[str]) -> DataFrame:
    """Bin x period matrix of volumes with bin labels (R2, R3):
    ``bin, label, vol_<period>...``; the period list is given, not collected."""
    wide = (bins.groupBy(S.BIN).pivot(S.PERIOD, list(periods))
            .agg(F.sum(S.VOLUME)))
    cols = [F.coalesce(F.col(f"`{p}`"), F.lit(0).cast("long")).alias(pivot_column(p))
            for p in periods]
    return (wide.select(S.BIN, bin_label(S.BIN).alias("label"), *cols)
            .orderBy(S.BIN))


def period_volume_table(bins: DataFrame) -> DataFrame:
    """The notebook's ``volumes`` table from binned periods: ``period`` is the
    bin as text, ``month`` the period label."""
    return bins.select(F.col(S.BIN).cast("string").alias(S.PERIOD), S.VOLUME,
                       F.col(S.PERIOD).alias("month"))
