"""Never-used datasets and their statistics.

The never-used list has one row per dataset and can be as large as the
catalogue. Everything after it is a map-side-combined aggregate down to
``(project, datatype, day)`` cells, then to ``(bin, ident)``; the TOP-N list is
a ``limit`` (``TakeOrderedAndProject``), so it is bounded by ``n`` and is the
only thing broadcast or collected (for the wide layout's column names).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldspot import schemas as S
from coldspot.functions.columns import (
    age_in_days, datatype_of, day_of_epoch, ident_of, project_of, report_midnight, truncate_day,
)


def unused_list(volume_alltime: DataFrame, report_date: str | _dt.date,
                sort: bool = True) -> DataFrame:
    """Datasets never accessed: ``scope, name, bytes, created_at, age_days``
    (P13, F10, O3). The age counts whole days (truncated) up to the end of
    the report day."""
    end = report_midnight(report_date) + S.DAY_SECONDS
    out = (volume_alltime.filter(F.col(S.OP_EVENTS) == 0)
           .select(S.SCOPE, S.NAME, S.BYTES,
                   F.col(S.CREATED_AT).cast("long").alias(S.CREATED_AT),
                   ((F.lit(end) - F.col(S.CREATED_AT)) / S.DAY_SECONDS).cast("int")
                   .alias(S.AGE_DAYS)))
    return out.orderBy(S.SCOPE, S.NAME) if sort else out


def list_changes(older: DataFrame, newer: DataFrame) -> DataFrame:
    """What changed between the never-used lists of two dates: ``scope, name, change,
    bytes_before, bytes_now`` with ``change`` one of ``entered`` (only on the newer list),
    ``left`` (only on the older one) and ``still``. Names are unique on a list; rows without
    scope or name equal no other row.

    Lists stored in equal buckets of (scope, name) (``bucketed.write_bucketed``) are merged
    bucket by bucket, without an exchange."""
    key = [S.SCOPE, S.NAME]
    o = older.select(*key, F.col(S.BYTES).alias("bytes_before"), F.lit(True).alias("_before"))
    n = newer.select(*key, F.col(S.BYTES).alias("bytes_now"), F.lit(True).alias("_now"))
    change = F.when(F.col("_before").isNull(), "entered").when(F.col("_now").isNull(), "left").otherwise("still")
    return o.join(n, key, "full").select(*key, change.alias("change"), "bytes_before", "bytes_now")


def unused_cube(unused: DataFrame, malformed: str = "unknown") -> DataFrame:
    """Count and size of never-used datasets by ``project, datatype,
    created_day`` (A9; size of a missing ``bytes`` is 0)."""
    cells = unused.select(
        project_of(S.NAME).alias(S.PROJECT),
        datatype_of(S.NAME, malformed).alias(S.DATATYPE),
        day_of_epoch(F.col(S.CREATED_AT)).alias(S.CREATED_DAY),
        F.coalesce(F.col(S.BYTES), F.lit(0).cast("long")).alias(S.SIZE),
    )
    if malformed == "drop":
        cells = cells.filter(F.col(S.DATATYPE).isNotNull())
    return (cells.groupBy(S.PROJECT, S.DATATYPE, S.CREATED_DAY)
            .agg(F.count(F.lit(1)).alias(S.N_DATASETS), F.sum(S.SIZE).alias(S.SIZE)))


def ident_totals(cube: DataFrame, merge_log: bool = True) -> DataFrame:
    """Size per ``project*datatype*`` ident; with ``merge_log`` every ``log``
    datatype is one ident ``log`` (A10)."""
    return (cube.select(ident_of(S.PROJECT, S.DATATYPE, merge_log).alias(S.IDENT), S.SIZE)
            .groupBy(S.IDENT).agg(F.sum(S.SIZE).alias(S.SIZE)))


def top_idents(totals: DataFrame, n: int = S.DEFAULT_TOP_N) -> DataFrame:
    """The ``n`` largest idents, ties broken by ident: ``rank, ident, size``
    (O5). The ranking window sees only the ``n`` rows of the limit."""
    top = totals.orderBy(F.desc(S.SIZE), F.asc(S.IDENT)).limit(n)
    w = Window.orderBy(F.desc(S.SIZE), F.asc(S.IDENT))
    return top.select(F.row_number().over(w).cast("long").alias("rank"), S.IDENT, S.SIZE)


def _binned(cube: DataFrame, grain: str, merge_log: bool) -> DataFrame:
    return cube.select(truncate_day(S.CREATED_DAY, grain).alias(S.CREATED_AT),
                       ident_of(S.PROJECT, S.DATATYPE, merge_log).alias(S.IDENT), S.SIZE)


def topn_other(cube: DataFrame, top: DataFrame, report_date: str | _dt.date,
               grain: str = "month", merge_log: bool = True) -> DataFrame:
    """Size per creation bin and ident, idents outside the top list merged into
    ``other``: ``created_at, age_days, ident, volume`` (A11)."""
    marks = F.broadcast(top.select(S.IDENT, F.lit(True).alias("_top")))  # n rows
    rows = _binned(cube, grain, merge_log)
    return (rows.join(marks, S.IDENT, "left")
            .select(S.CREATED_AT,
                    F.when(F.col("_top"), F.col(S.IDENT)).otherwise(F.lit(S.OTHER_IDENT))
                    .alias(S.IDENT), S.SIZE)
            .groupBy(S.CREATED_AT, S.IDENT).agg(F.sum(S.SIZE).alias(S.VOLUME))
            .select(S.CREATED_AT, age_in_days(report_date, S.CREATED_AT).alias(S.AGE_DAYS),
                    S.IDENT, S.VOLUME))


def topn_wide(long_form: DataFrame, top: DataFrame) -> DataFrame:
    """One row per creation bin, one column per top ident in rank order, then
    ``other``; missing cells are 0 (R1). The column list is the ``top`` frame,
    at most N rows, collected."""
    idents = [r[S.IDENT] for r in top.orderBy("rank").select(S.IDENT).collect()]
    values = idents + [S.OTHER_IDENT]
    wide = (long_form.groupBy(S.CREATED_AT, S.AGE_DAYS).pivot(S.IDENT, values)
            .agg(F.sum(S.VOLUME)))
    wide = wide.select(S.CREATED_AT, S.AGE_DAYS,
                       *[F.coalesce(F.col(f"`{v}`"), F.lit(0).cast("long")).alias(v)
                         for v in values])
    return wide.orderBy(F.desc(S.CREATED_AT))


def topn_ranked(long_form: DataFrame, top: DataFrame, n: int) -> DataFrame:
    """The wide layout with one column per rank: ``created_at, age_days,
    i01..iNN, c01..cNN, other``; nothing is collected."""
    numbers = [f"{r:02d}" for r in range(1, n + 1)]
    ranked = long_form.join(F.broadcast(top.select(S.IDENT, "rank")), S.IDENT, "left")  # n rows
    volume = lambda condition: F.coalesce(F.sum(F.when(condition, F.col(S.VOLUME))), F.lit(0)).cast("long")
    cells = [volume(F.col("rank") == int(r)).alias(f"c{r}") for r in numbers]
    names = top.agg(*[F.max(F.when(F.col("rank") == int(r), F.col(S.IDENT))).alias(f"i{r}") for r in numbers])
    wide = ranked.groupBy(S.CREATED_AT, S.AGE_DAYS).agg(
        *cells, volume((F.col(S.IDENT) == S.OTHER_IDENT) & F.col("rank").isNull()).alias(S.OTHER_IDENT))
    one = F.lit(1)  # the names are a single row
    return (wide.withColumn("_one", one).join(F.broadcast(names.withColumn("_one", one)), "_one")
            .select(S.CREATED_AT, S.AGE_DAYS, *[f"i{r}" for r in numbers], *[f"c{r}" for r in numbers], S.OTHER_IDENT)
            .orderBy(F.desc(S.CREATED_AT)))


def full_stats(cube: DataFrame, report_date: str | _dt.date, grain: str = "month") -> DataFrame:
    """Size per creation bin and ``project*datatype*`` ident (no ``log``
    merge): ``created_at, age_days, ident, volume``, newest first (A12, O6)."""
    return (_binned(cube, grain, merge_log=False)
            .groupBy(S.CREATED_AT, S.IDENT).agg(F.sum(S.SIZE).alias(S.VOLUME))
            .select(S.CREATED_AT, age_in_days(report_date, S.CREATED_AT).alias(S.AGE_DAYS),
                    S.IDENT, S.VOLUME)
            .orderBy(F.desc(S.CREATED_AT), F.desc(S.IDENT)))
