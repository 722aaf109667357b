"""Kept session state: sessions of all loads, merged one load at a time, and an index that
answers any look-back period (U1, A3, A8, P10).

The state is dealt into buckets by dataset. Merging a load reads and rewrites only the buckets
that its datasets fall into; all others stay the files they are, so a run's cost follows the
load and the datasets it touches, not the days that are stored. Per write there are, by bucket:

* ``load``: the load's own sessions, kept so that a load can be replayed;
* ``sessions``: ``scope, name, uuid, fileops, timeentryunix`` over all loads;
* ``days``: per dataset and UTC day of the sessions' latest access, how many there are
  (``n``) and how many have a uuid (``u``);
* ``times``: the same by exact time, sorted by day. A period needs it for the one day its
  cutoff falls into, and row groups of other days are skipped.

A commit (``sources.publish``) names the write that holds each bucket and each load, so a merge
is seen as a whole or not at all. Replaying a load computes the buckets of its old and its new
rows again from the kept loads, which is exact though a maximum cannot be taken back.

A bucket is not one task: sessions are grouped by their whole key, and the writes are
rebalanced, which splits a bucket that a hot dataset fills.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldspot import schemas as S
from coldspot.functions.columns import day_of_epoch
from coldspot.sources.publish import _children, commit, last_commit, version_folder

BUCKET = "bucket"
BUCKETS = 256
DAY, WITH_UUID, ALL = "day", "u", "n"

DAYS_SCHEMA = S.columns("scope string, name string, day date, u long, n long")
TIMES_SCHEMA = S.columns("scope string, name string, day date, timeentryunix double, u long, n long")


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(S.SCOPE, S.NAME), F.lit(buckets)).cast("int"))


def _write(df: DataFrame, path: str, sort: tuple[str, ...] = ()) -> None:
    df = df.hint("rebalance", BUCKET)
    if sort:
        df = df.sortWithinPartitions(BUCKET, *sort)
    df.write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def _buckets_in(spark: SparkSession, folder: str) -> set[str]:
    return {n for n in _children(spark, folder) if n.startswith(f"{BUCKET}=")}


def _read(spark: SparkSession, schema: T.StructType, folders: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _part(spark: SparkSession, root: str, kind: str, schema: T.StructType, content: dict, only: set[str] | None = None) -> DataFrame:
    names = content.get("buckets", {})
    return _read(spark, schema, [f"{version_folder(root, v)}/{kind}/{b}" for b, v in sorted(names.items())
                                 if only is None or b in only])


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy(S.SCOPE, S.NAME, S.UUID).agg(
        F.sum(S.FILEOPS).alias(S.FILEOPS), F.max(S.TIMEENTRYUNIX).alias(S.TIMEENTRYUNIX))


def merge_load(sessions: DataFrame, root: str, load: str, buckets: int = BUCKETS) -> dict:
    """Merge the sessions (``scope, name, uuid, fileops, timeentryunix``) of a load into the
    state at ``root``. A load that is there already is replaced. ``buckets`` counts for a new
    state only. Returns what the write did: ``number``, ``touched`` buckets and ``read``, the
    folders that it read."""
    spark, root, load = sessions.sparkSession, root.rstrip("/"), str(load)
    number, content = last_commit(spark, root)
    number += 1
    buckets = content.get("of", buckets)
    base = version_folder(root, number)
    columns = S.SESSION_SCHEMA.fieldNames()
    _write(_bucketed(sessions.select(*columns), buckets), f"{base}/load")
    own = _buckets_in(spark, f"{base}/load")
    touched = set(own)
    loads = dict(content.get("loads", {}))
    held = dict(content.get("buckets", {}))
    if load in loads:
        touched |= _buckets_in(spark, f"{version_folder(root, loads[load])}/load")
        others = [f"{version_folder(root, v)}/load" for name, v in sorted(loads.items()) if name != load]
        folders = [f"{f}/{b}" for f in others for b in sorted(_buckets_in(spark, f) & touched)]
    else:
        folders = [f"{version_folder(root, held[b])}/sessions/{b}" for b in sorted(touched & set(held))]
    folders += [f"{base}/load/{b}" for b in sorted(own)]
    merged = _grouped(_read(spark, S.SESSION_SCHEMA, folders))
    _write(_bucketed(merged, buckets), f"{base}/sessions")
    made = _buckets_in(spark, f"{base}/sessions")
    # The index of the touched buckets, from the rows just written.
    rows = _read(spark, S.SESSION_SCHEMA, [f"{base}/sessions/{b}" for b in sorted(made)]).where(F.col(S.TIMEENTRYUNIX).isNotNull())
    times = rows.groupBy(S.SCOPE, S.NAME, S.TIMEENTRYUNIX).agg(
        F.count(S.UUID).alias(WITH_UUID), F.count(F.lit(1)).alias(ALL)).withColumn(DAY, day_of_epoch(S.TIMEENTRYUNIX))
    _write(_bucketed(times, buckets).select(*TIMES_SCHEMA.fieldNames(), BUCKET), f"{base}/times", (DAY, S.SCOPE, S.NAME))
    written = _read(spark, TIMES_SCHEMA, [f"{base}/times/{b}" for b in sorted(_buckets_in(spark, f"{base}/times"))])
    days = written.groupBy(S.SCOPE, S.NAME, DAY).agg(F.sum(WITH_UUID).alias(WITH_UUID), F.sum(ALL).alias(ALL))
    _write(_bucketed(days, buckets), f"{base}/days")
    for b in touched:
        held.pop(b, None)
    held.update({b: number for b in made})
    loads[load] = number
    commit(spark, root, number, {"of": buckets, "loads": loads, "buckets": held, "at": int(time.time())})
    return {"number": number, "touched": sorted(touched), "read": folders}


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """Sessions over all loads: one row per ``scope, name, uuid``; nothing is regrouped."""
    root = root.rstrip("/")
    return _part(spark, root, "sessions", S.SESSION_SCHEMA, last_commit(spark, root)[1])


def indexed_counts(spark: SparkSession, root: str, cutoffs: Mapping[str, float | None]) -> DataFrame:
    """Access counts per dataset for any cutoffs, from the index only: ``scope, name`` and per
    period i ``_u<i>`` (sessions with a uuid later than the cutoff) and ``_n<i>`` (all of them),
    as ``operators.volume.period_access_counts`` gives from sessions. A cutoff of None or 0
    counts every session that has a time."""
    root = root.rstrip("/")
    content = last_commit(spark, root)[1]
    cuts = list(cutoffs.values())
    first_day = {c: int(c // S.DAY_SECONDS) for c in cuts if c}

    def date(day: int) -> F.Column:
        return F.date_from_unix_date(F.lit(day))

    days = _part(spark, root, "days", DAYS_SCHEMA, content)
    if all(cuts):  # no day before the earliest cutoff counts
        days = days.where(F.col(DAY) > date(min(first_day.values())))
    whole = days.select(S.SCOPE, S.NAME, *[
        F.when(F.col(DAY) > date(first_day[c]) if c else F.col(DAY).isNotNull(), F.col(col)).alias(f"_{col}{i}")
        for i, c in enumerate(cuts) for col in (WITH_UUID, ALL)])
    rest = whole.limit(0)
    if first_day:
        day_list = sorted(set(first_day.values()))
        times = _part(spark, root, "times", TIMES_SCHEMA, content).where(F.col(DAY).isin([date(d) for d in day_list]))
        rest = times.select(S.SCOPE, S.NAME, *[
            F.when((F.col(DAY) == date(first_day[c])) & (F.col(S.TIMEENTRYUNIX) > float(c)) if c else F.lit(False),
                   F.col(col)).alias(f"_{col}{i}")
            for i, c in enumerate(cuts) for col in (WITH_UUID, ALL)])
    return whole.unionAll(rest).groupBy(S.SCOPE, S.NAME).agg(*[
        F.coalesce(F.sum(f"_{col}{i}"), F.lit(0).cast("long")).alias(f"_{col}{i}")
        for i in range(len(cuts)) for col in (WITH_UUID, ALL)]).where(
        " OR ".join(f"_{ALL}{i} > 0" for i in range(len(cuts))))
