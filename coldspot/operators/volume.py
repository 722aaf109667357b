"""Dataset volume and access counts.

Plan at scale. Every table is reduced to one row per key before it is
shuffled for a join:

* replicas:  ``dslocks`` filtered by the disk endpoints (broadcast by Spark if
  their bytes are below ``spark.sql.autoBroadcastJoinThreshold``, else a
  shuffle join), then shuffled once by ``(scope, name)``;
* catalogue: ``dids`` reduced to one row per ``(scope, name)``;
* sessions:  reduced to one row per ``(scope, name)`` with the access counts
  of every period in one pass (conditional counts).

The joins and the final per-dataset aggregate then all run on the
``(scope, name)`` hash partitioning, with no further exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot import schemas as S
from coldspot.functions.columns import starts_with_any


def live_datasets(dids: DataFrame,
                  scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES) -> DataFrame:
    """Non-transient, non-sub datasets of the reported scopes, creation time
    in epoch seconds (P6, P8)."""
    return (dids
            .filter(F.col(S.TRANSIENT).isNull()
                    & ~F.col(S.NAME).contains(S.SUB_DATASET_MARK)
                    & starts_with_any(S.SCOPE, scope_prefixes))
            .select((F.col(S.CREATED_AT) / 1000).cast("double").alias(S.CREATED_AT),
                    S.SCOPE, S.NAME))


def disk_endpoints(rses: DataFrame) -> DataFrame:
    """Endpoints whose name contains ``DATADISK``."""
    return (rses.select(F.col(S.ID).cast("string").alias(S.ID), S.RSE)
            .filter(F.col(S.RSE).contains(S.DISK_ENDPOINT_MARK)))


def disk_replicas(dslocks: DataFrame, rses: DataFrame) -> DataFrame:
    """Dataset replicas on disk endpoints: ``bytes, scope, name, rse``.

    No hint: Spark broadcasts the endpoints if their size in bytes is within
    ``spark.sql.autoBroadcastJoinThreshold`` (by statistics when planning, by
    measured size under AQE) and shuffles both sides otherwise.
    """
    endpoints = disk_endpoints(rses)
    locks = dslocks.select(F.col(S.RSE_ID).cast("string").alias(S.RSE_ID),
                           S.SCOPE, S.NAME, F.col(S.BYTES).cast("long").alias(S.BYTES))
    return (locks.join(endpoints, locks[S.RSE_ID] == endpoints[S.ID])
            .select(S.BYTES, S.SCOPE, S.NAME, S.RSE))


def primary_datadisk(live: DataFrame, replicas: DataFrame) -> DataFrame:
    """One row per dataset and disk endpoint: ``scope, name, rse, bytes,
    created_at`` = max bytes, min creation time (J3, A2).

    The catalogue is reduced to one row per dataset (min over its rows), and
    the replicas meet it on ``(scope, name)``. The aggregate by ``(scope, name,
    rse)`` runs on that partitioning: each side is exchanged once.
    """
    created = live.groupBy(S.SCOPE, S.NAME).agg(F.min(S.CREATED_AT).alias(S.CREATED_AT))
    return (replicas.join(created, [S.SCOPE, S.NAME])
            .groupBy(S.SCOPE, S.NAME, S.RSE)
            .agg(F.max(S.BYTES).alias(S.BYTES), F.min(S.CREATED_AT).alias(S.CREATED_AT)))


def _passes(cutoff: float | None) -> F.Column:
    """Session time passes the cutoff: strict ``>``; no cutoff (None or 0)
    means any non-null time (P10)."""
    ts = F.col(S.TIMEENTRYUNIX)
    return ts > F.lit(cutoff) if cutoff else ts.isNotNull()


def _prune_days(sessions: DataFrame, cutoff: float | None) -> DataFrame:
    """On sessions stored by ``trace_date`` (daily runs), a session passing the
    cutoff lies on or after the cutoff's UTC day: that partition filter is
    implied by the exact filter and lets the scan skip older days."""
    if not cutoff or S.TRACE_DATE not in sessions.columns:
        return sessions
    first_day = F.date_from_unix_date(F.lit(int(cutoff // S.DAY_SECONDS)))
    return sessions.filter(F.col(S.TRACE_DATE) >= first_day)


def access_counts(sessions: DataFrame, cutoff: float | None = None) -> DataFrame:
    """Sessions with a uuid per dataset, among sessions passing the cutoff (A3).

    A dataset appears when at least one session passes, even if none of them
    has a uuid (its count is then 0).
    """
    return (_prune_days(sessions, cutoff).filter(_passes(cutoff))
            .groupBy(S.SCOPE, S.NAME)
            .agg(F.count(S.UUID).alias(S.OP_EVENTS)))


def _no_access_value(cutoff: float | None) -> F.Column:
    """-1 when created before the cutoff, else 0; NULL creation time -> 0
    (P11). Without a cutoff the comparison is with 0, as in the reference."""
    return F.when(F.col(S.CREATED_AT) < F.lit(float(cutoff or 0)), F.lit(-1)).otherwise(F.lit(0))


def dataset_volume(primary: DataFrame, counts: DataFrame, cutoff: float | None) -> DataFrame:
    """Per dataset: access count of the period and bytes summed over disk
    endpoints: ``scope, name, op_events, bytes`` (J4, A4, P11)."""
    j = primary.join(counts, [S.SCOPE, S.NAME], "left")
    op = (F.when(F.col(S.OP_EVENTS).isNull(), _no_access_value(cutoff))
          .otherwise(F.col(S.OP_EVENTS)))
    return (j.groupBy(S.SCOPE, S.NAME)
            .agg(F.max(op).cast("long").alias(S.OP_EVENTS), F.sum(S.BYTES).alias(S.BYTES)))


def dataset_volume_alltime(primary: DataFrame, counts: DataFrame) -> DataFrame:
    """Per dataset over all time: ``scope, name, op_events, bytes,
    created_at``; no session -> 0 (J4b, A5, P12)."""
    j = primary.join(counts, [S.SCOPE, S.NAME], "left")
    return (j.groupBy(S.SCOPE, S.NAME)
            .agg(F.max(F.coalesce(F.col(S.OP_EVENTS), F.lit(0))).cast("long").alias(S.OP_EVENTS),
                 F.sum(S.BYTES).alias(S.BYTES),
                 F.min(S.CREATED_AT).alias(S.CREATED_AT)))


def period_access_counts(sessions: DataFrame,
                         cutoffs: Mapping[str, float | None]) -> DataFrame:
    """Access counts of every period in one pass over the sessions.

    Per period ``i``: ``u_i`` = sessions with a uuid passing the cutoff and
    ``n_i`` = sessions passing it. ``n_i = 0`` means "no session in the
    period" (the -1/0 branch); ``n_i > 0, u_i = 0`` is a real count of 0.
    """
    aggs = []
    for i, cut in enumerate(cutoffs.values()):
        passes = _passes(cut)
        aggs.append(F.count(F.when(passes, F.col(S.UUID))).alias(f"_u{i}"))
        aggs.append(F.count(F.when(passes, F.lit(1))).alias(f"_n{i}"))
    # Only sessions passing some cutoff matter; with an infinite period that
    # is every session with a time, otherwise days before the earliest cutoff
    # are pruned.
    cuts = list(cutoffs.values())
    if all(cuts):
        sessions = _prune_days(sessions, min(cuts))
    return sessions.groupBy(S.SCOPE, S.NAME).agg(*aggs)


def dataset_volume_periods(primary: DataFrame, counts: DataFrame,
                           cutoffs: Mapping[str, float | None]) -> DataFrame:
    """``period, scope, name, op_events, bytes`` for every period: one join
    and one per-dataset aggregate, then the periods are unpivoted."""
    j = primary.join(counts, [S.SCOPE, S.NAME], "left")
    aggs = []
    for i, cut in enumerate(cutoffs.values()):
        n, u = F.coalesce(F.col(f"_n{i}"), F.lit(0)), F.col(f"_u{i}")
        op = F.when(n == 0, _no_access_value(cut)).otherwise(u)
        aggs.append(F.max(op).cast("long").alias(f"_op{i}"))
    wide = j.groupBy(S.SCOPE, S.NAME).agg(F.sum(S.BYTES).alias(S.BYTES), *aggs)
    labels = list(cutoffs.keys())
    stacked = F.stack(F.lit(len(labels)),
                      *[x for i, lab in enumerate(labels) for x in (F.lit(lab), F.col(f"_op{i}"))])
    return wide.select(stacked.alias(S.PERIOD, S.OP_EVENTS), S.SCOPE, S.NAME, S.BYTES)
