"""Access sessions from the raw access log.

A session is one ``(scope, name, uuid)`` group of read events on files of a
dataset; it keeps the number of file operations and the latest event time.

Plan at scale: the access log is the largest input, and its (file, user) pairs
hardly repeat (a session spans the files of a dataset), so reducing it before
the join would only ship it twice. It is shuffled once, by file name, to meet
the file list (AQE splits a hot file), and the joined rows are rolled up to
``(scope, name, uuid)`` with map-side combination. For logs that do repeat,
``pre_aggregate=True`` first reduces them to one row per ``(filename, uuid)``;
counts and maxima are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot import schemas as S
from coldspot.functions.columns import day_of_epoch, is_read_event, starts_with_any
from coldspot.operators.skew import ROWS_PER_SALT, hot_keys, measured_join, salted_join


def valid_traces(traces: DataFrame) -> DataFrame:
    """Trace rows with a file name, an event type and a time (P2). Written as
    three ``isNotNull`` filters so that each reaches the parquet scan."""
    return traces.filter(F.col(S.FILENAME).isNotNull() & F.col(S.EVENTTYPE).isNotNull()
                         & F.col(S.TIMEENTRYUNIX).isNotNull())


def dataset_files(contents: DataFrame) -> DataFrame:
    """Dataset -> file links: ``did_type='D' AND child_type='F'``."""
    return (contents
            .filter((F.col(S.DID_TYPE) == S.DATASET_DID_TYPE)
                    & (F.col(S.CHILD_TYPE) == S.FILE_CHILD_TYPE))
            .select(S.SCOPE, S.NAME, S.CHILD_NAME))


def _clean_uuid() -> F.Column:
    # An empty and a missing uuid cannot be told apart after a text round
    # trip; both mean "no session id".
    return F.nullif(F.col(S.UUID), F.lit("")).alias(S.UUID)


def read_accesses(traces: DataFrame, contents: DataFrame,
                  scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES) -> DataFrame:
    """Read events joined to the datasets holding the file.

    The join key is the file name only: a file in k datasets counts once for
    each of them.
    """
    t = (valid_traces(traces)
         .filter(is_read_event(S.EVENTTYPE))
         .select(S.FILENAME, S.EVENTTYPE, _clean_uuid(), S.TIMEENTRYUNIX))
    files = dataset_files(contents).filter(starts_with_any(S.SCOPE, scope_prefixes))
    return (t.join(files, t[S.FILENAME] == files[S.CHILD_NAME])
            .select(S.SCOPE, S.NAME, S.EVENTTYPE, S.UUID, S.TIMEENTRYUNIX))


def build_sessions(traces: DataFrame, contents: DataFrame,
                   scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES,
                   sort: bool = False, by_day: bool = False, pre_aggregate: bool = False,
                   salt_buckets: int = 0, hot_file_rows: int | None = None,
                   hot_files: DataFrame | None = None, file_sizes: DataFrame | None = None,
                   rows_per_salt: int = ROWS_PER_SALT, copartitioned: bool = False) -> DataFrame:
    """Sessions ``scope, name, uuid, fileops, timeentryunix`` (W1: A1 over J1).

    ``by_day=True`` adds ``trace_date`` (UTC day of the event) to the session
    key; such a table is stored by load and ``trace_date``
    (``writers.write_load``) and regrouped when read.

    ``sort=True`` orders by time as the reference's output does; nothing
    downstream needs the order, so stored sessions are left unsorted.

    Hot files: by default AQE splits a skewed file-name join at run time.
    With ``salt_buckets > 1`` the split is explicit (``operators.skew``): the
    hot files are ``hot_files`` (first column; repeats and nulls are harmless,
    e.g. from the previous day) or, with ``hot_file_rows``, every file with at
    least that many rows (found by an extra aggregation over the log).
    ``file_sizes`` (``skew.key_sizes`` of this or earlier logs) gives each hot
    file salts by its own size instead; ``copartitioned=True`` says that
    ``contents`` is stored in buckets of the file name
    (``bucketed.write_bucketed``), so only its hot files are exchanged.
    Results are equal.
    """
    day_key = [S.TRACE_DATE] if by_day else []
    day = [day_of_epoch(S.TIMEENTRYUNIX).alias(S.TRACE_DATE)] if by_day else []
    events = (valid_traces(traces).filter(is_read_event(S.EVENTTYPE))
              .select(*day, S.FILENAME, _clean_uuid(), S.TIMEENTRYUNIX))
    if pre_aggregate:
        events = (events.groupBy(*day_key, S.FILENAME, S.UUID)
                  .agg(F.count(F.lit(1)).alias("_n"), F.max(S.TIMEENTRYUNIX).alias(S.TIMEENTRYUNIX)))
    files = dataset_files(contents).filter(starts_with_any(S.SCOPE, scope_prefixes))
    hot = None
    if salt_buckets > 1:
        hot = hot_files if hot_files is not None else (
            hot_keys(events, S.FILENAME, hot_file_rows) if hot_file_rows else None)
    spread = (S.UUID, S.TIMEENTRYUNIX)
    if file_sizes is not None:
        joined = measured_join(events, files, S.FILENAME, S.CHILD_NAME, file_sizes, spread, rows_per_salt, copartitioned)
    else:
        joined = salted_join(events, files, S.FILENAME, S.CHILD_NAME, hot, salt_buckets, spread)
    operations = F.sum("_n") if pre_aggregate else F.count(F.lit(1))
    sessions = (joined.groupBy(*day_key, S.SCOPE, S.NAME, S.UUID)
                .agg(operations.alias(S.FILEOPS), F.max(S.TIMEENTRYUNIX).alias(S.TIMEENTRYUNIX)))
    if sort:
        sessions = sessions.orderBy(S.TIMEENTRYUNIX)
    return sessions


def union_sessions(*frames: DataFrame, regroup: bool = False) -> DataFrame:
    """Bag union of session tables (U1): a session present in two inputs
    counts twice. ``regroup=True`` merges such duplicates instead."""
    if not frames:
        raise ValueError("union_sessions needs at least one frame")
    cols = [S.SCOPE, S.NAME, S.UUID, S.FILEOPS, S.TIMEENTRYUNIX]
    out = frames[0].select(*cols)
    for f in frames[1:]:
        out = out.unionByName(f.select(*cols))
    if regroup:
        out = (out.groupBy(S.SCOPE, S.NAME, S.UUID)
               .agg(F.sum(S.FILEOPS).alias(S.FILEOPS),
                    F.max(S.TIMEENTRYUNIX).alias(S.TIMEENTRYUNIX)))
    return out
