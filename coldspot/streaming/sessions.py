"""Incremental session ingest with Structured Streaming.

The reference preprocesses each new day of the access log in a batch run. As a
stream, every micro-batch of new log files goes through the same batch plan
(``operators.sessions.build_sessions`` by day, where AQE splits hot files) and
is written as one load of the stored sessions, named after the batch. A batch
that is replayed after a failure overwrites its own load, so the result is
exactly once. ``readers.read_session_loads`` regroups the loads.

There is no streaming state and no watermark: an event counts whenever its
file arrives, and days still open are part of the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from coldspot import schemas as S
from coldspot.functions.columns import normalise_columns
from coldspot.operators.sessions import build_sessions
from coldspot.sources.writers import write_load


def read_trace_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                      ) -> DataFrame:
    """Streaming read of the access log with the declared schema; columns as
    the batch reader gives them."""
    reader = spark.readStream.schema(S.TRACE_SOURCE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.json(path)
    return normalise_columns(raw.withColumnRenamed(raw.columns[0], S.TIMEENTRYUNIX))


def start_daily_sessions(traces: DataFrame, contents: DataFrame, out_path: str, checkpoint: str,
                         scope_prefixes: Sequence[str] = S.DEFAULT_SCOPE_PREFIXES,
                         stream: str = "stream", available_now: bool = True,
                         processing_time: str | None = None, **options) -> StreamingQuery:
    """Write the sessions of each micro-batch of ``traces`` to ``out_path`` as
    the load ``<stream>-<batch>``; two streams into one table need different
    names. ``options`` go to ``build_sessions`` (e.g. ``hot_files`` of the
    previous day with ``salt_buckets``).

    ``available_now`` processes what has arrived and stops (a scheduled daily
    run); otherwise a ``processing_time`` trigger keeps it running."""

    def one_batch(batch: DataFrame, number: int) -> None:
        write_load(build_sessions(batch, contents, scope_prefixes, by_day=True, **options),
                   out_path, f"{stream}-{number}")

    writer = traces.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one_batch)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
