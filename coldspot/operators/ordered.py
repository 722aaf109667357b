"""Order as a value: a global row number without a single-partition window.

``row_number() OVER (ORDER BY ...)`` sends every row through one task. Here the rows are dealt
into sorted ranges (in the shared checkpoint folder, so that reading a range again gives the
same rows), the ranges are counted, and a row's number is its place in its range plus the rows
of the ranges before: one count per partition goes to the driver.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldspot.plans.sizing import cut_lineage

# monotonically_increasing_id holds the place within the partition in its lower 33 bits.
_PLACE = (1 << 33) - 1


def with_row_number(df: DataFrame, *order: str | Column, name: str = "row_number") -> DataFrame:
    """``df`` with the number (from 1) of each row in the order of ``order``. Rows equal in all
    of these columns are numbered in any order, so name columns that tell them apart; further
    columns also split the range of a first column that a third of the rows share. An empty
    frame gives no rows."""
    ranged = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    part = F.spark_partition_id()
    counts = sorted((r["part"], r["count"]) for r in ranged.groupBy(part.alias("part")).count().collect())
    before = list(accumulate((n for _, n in counts), initial=0))
    starts = df.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(counts, before)], "_part int, _before long")
    placed = ranged.select("*", part.alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("_place"))
    # One row per partition.
    return placed.join(F.broadcast(starts), "_part").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_place") + 1).alias(name))
