"""Writers of sessions and reports.

Report tables lie in one folder per report date, sessions in one folder per
load; a rerun replaces that folder as a whole and nothing else.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot import schemas as S
from coldspot.sources.publish import publish


def _text(df: DataFrame, sep: str):
    return df.write.option("header", True).option("sep", sep).format("csv")


def write_sessions(df: DataFrame, path: str, fmt: str = "parquet",
                   partition_by: str | None = None) -> None:
    """Sessions (S9): parquet by default, ``fmt='tsv'`` for tab-separated
    text with a header."""
    w = _text(df, "\t") if fmt == "tsv" else df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.mode("overwrite").save(path)


def write_popularity(df: DataFrame, path: str, header: bool = False) -> None:
    """Per-period report rows (S10) as comma CSV, one ``period=<label>``
    folder per period, written in one job."""
    (df.write.option("header", header).format("csv").partitionBy(S.PERIOD)
     .mode("overwrite").save(path))


def write_dated(df: DataFrame, path: str, report_date: str | _dt.date, fmt: str = "parquet",
                extra_partitions: Sequence[str] = ()) -> None:
    """A report of one report date, in its own folder ``report_date=<date>``
    (with ``extra_partitions`` below it). A rerun replaces the whole folder, so
    nothing of an earlier run of that date stays, even if the rerun has fewer
    partitions or no rows."""
    w = _text(df, "\t") if fmt == "tsv" else df.write.format(fmt)
    if extra_partitions:
        w = w.partitionBy(*extra_partitions)
    (w.option("partitionOverwriteMode", "static").mode("overwrite")
     .save(f"{path.rstrip('/')}/{S.REPORT_DATE}={report_date}"))


def publish_dated(df: DataFrame, path: str, report_date: str | _dt.date, fmt: str = "parquet",
                  extra_partitions: Sequence[str] = ()) -> None:
    """As ``write_dated``, but a reader (``readers.read_dated``) sees the date's report before
    or after this write, never a part of it, and a failed write changes nothing."""
    publish(df, f"{path.rstrip('/')}/{S.REPORT_DATE}={report_date}", extra_partitions, fmt)


def write_unused(df: DataFrame, path: str, report_date: str | _dt.date,
                 fmt: str = "tsv") -> None:
    """Never-used list of one report date (S11): replaces only that date's
    partition."""
    write_dated(df, path, report_date, fmt)


def write_stats(df: DataFrame, path: str, header: Sequence[str] | None = S.FULL_STATS_HEADER,
                comment: str | None = None) -> None:
    """Statistics table as comma CSV with a header (S12): ``header`` names the
    columns in order (default: the full statistics' report names); ``None``
    keeps the frame's names (e.g. the wide TOP-N layout).

    ``comment`` puts a line ``# <comment>`` on top, as ``read_full_monthly``
    skips it. The table is then written as one text file (a report of creation
    bins by ident is small)."""
    header = list(df.columns) if header is None else list(header)
    if len(header) != len(df.columns):
        raise ValueError(f"header has {len(header)} names for {len(df.columns)} columns")
    renamed = df.select(*[F.col(c).alias(h) for c, h in zip(df.columns, header)])
    if comment is None:
        renamed.write.option("header", True).format("csv").mode("overwrite").save(path)
        return
    line = F.to_csv(F.struct(*[F.col(f"`{h}`") for h in header]))
    first = df.sparkSession.createDataFrame(
        [(0, f"# {comment}"), (1, ",".join(header))], "_order long, value string")
    body = renamed.select((F.monotonically_increasing_id() + 2).alias("_order"), line.alias("value"))
    (first.unionAll(body).coalesce(1).sortWithinPartitions("_order").select("value")
     .write.mode("overwrite").text(path))


def write_topn_wide(df: DataFrame, path: str) -> None:
    """Wide TOP-N table as CSV with the report's header: ``Created at, Age
    (days)``, then the ident columns in rank order and ``other``."""
    write_stats(df, path, header=list(S.FULL_STATS_HEADER[:2]) + df.columns[2:])


def write_load(df: DataFrame, path: str, load: str, partition_col: str = S.TRACE_DATE,
               fmt: str = "parquet") -> None:
    """The rows of one load (a day's log, a run, a micro-batch) in the folder
    ``load=<load>``, partitioned by ``partition_col`` below it (S13). A rerun
    of the load replaces exactly that load's rows; rows that other loads hold
    of the same day stay. Rows are dealt by ``partition_col`` first: a day is
    one file, or a few if it is large, whatever the number of tasks."""
    (df.hint("rebalance", partition_col).write.format(fmt).partitionBy(partition_col).option("partitionOverwriteMode", "static")
     .mode("overwrite").save(f"{path.rstrip('/')}/{S.LOAD}={load}"))
