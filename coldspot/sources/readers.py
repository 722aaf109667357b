"""Readers of the access log, the catalogue dumps and the report files.

Every reader declares its schema (no inference) and returns lower-case
columns. Paths may be globs or folders; folders written partitioned (by
``trace_date``, ``period``, ``report_date``) are pruned by filters on those
columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldspot import schemas as S
from coldspot.functions.columns import normalise_columns
from coldspot.sources.publish import last_commit, read_published


def read_traces(spark: SparkSession, path: str | Sequence[str],
                schema: T.StructType = S.TRACE_SOURCE_SCHEMA) -> DataFrame:
    """Access log as JSON lines with the declared 14-field schema.
    ``traceTimeentryUnix`` becomes ``timeentryunix``, other names are
    lower-cased."""
    raw = spark.read.schema(schema).json(path)
    return normalise_columns(raw.withColumnRenamed(schema.fieldNames()[0], S.TIMEENTRYUNIX))


CORRUPT = "_corrupt_record"


def read_checked_traces(spark: SparkSession, path: str | Sequence[str], broken_path: str, load: str,
                        max_broken: float = 0.01, schema: T.StructType = S.TRACE_SOURCE_SCHEMA) -> DataFrame:
    """Access log as ``read_traces`` gives it, without the lines that are no JSON objects of
    the declared types. Those are counted: the lines go, as they are, to the folder
    ``load=<load>`` of ``broken_path`` (replaced as a whole by a rerun), and if they are more
    than the share ``max_broken`` of all lines, the load fails with their number. Empty lines
    are no lines. The check is one scan of the log before the one that reads it. Every field of
    a line is parsed for both, whichever columns are read: what is broken does not depend on
    them."""
    checked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text([path] if isinstance(path, str) else list(path)).where(F.trim("value") != "")
    parsed = lines.select(F.col("value").alias("line"), F.from_json("value", checked, options).alias("e"))
    is_broken = F.col(f"e.{CORRUPT}").isNotNull() | F.col("e").isNull()
    folder = f"{broken_path.rstrip('/')}/{S.LOAD}={load}"
    seen = Observation()
    (parsed.select("line", is_broken.alias("broken"))
     .observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if("broken").alias("broken"))
     .where("broken").select("line").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder))
    counts = seen.get
    if counts["broken"] > max_broken * counts["lines"]:
        raise ValueError(f"{load}: {counts['broken']} of {counts['lines']} log lines are broken; see {folder}")
    good = parsed.where(~is_broken).select(*[F.col(f"e.{name}").alias(name) for name in schema.fieldNames()])
    return normalise_columns(good.withColumnRenamed(schema.fieldNames()[0], S.TIMEENTRYUNIX))


def read_snapshot(spark: SparkSession, path: str, columns: Sequence[str],
                  fmt: str = "avro") -> DataFrame:
    """One catalogue dump (``contents``, ``dids``, ``rses``, ``dslocks``) with
    ``columns`` projected and lower-cased (S2, P1). ``fmt`` is any Spark
    source: ``avro`` needs the spark-avro package on the classpath."""
    try:
        df = spark.read.format(fmt).load(path)
    except Exception as exc:  # noqa: BLE001 - re-raised with the remedy
        if fmt == "avro" and "avro" in str(exc).lower():
            raise RuntimeError(
                "reading Avro dumps needs the spark-avro package on the classpath "
                "(--packages org.apache.spark:spark-avro_2.13:<spark version>); "
                "or convert the dumps and pass fmt='parquet'") from exc
        raise
    return normalise_columns(df, columns)


def read_sessions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored sessions (S3): parquet, or tab-separated text with a header."""
    if fmt == "tsv":
        return (spark.read.schema(S.SESSION_SCHEMA).option("header", True)
                .option("sep", "\t").csv(path))
    return spark.read.schema(S.SESSION_SCHEMA).format(fmt).load(path)


def read_session_loads(spark: SparkSession, path: str) -> DataFrame:
    """Sessions stored by ``writers.write_load``, one row per trace day and
    session however many loads hold a part of it: ``trace_date, scope, name,
    uuid, fileops, timeentryunix``. Filters on ``trace_date`` prune folders."""
    schema = T.StructType(S.SESSION_SCHEMA.fields + [
        T.StructField(S.LOAD, T.StringType(), True), T.StructField(S.TRACE_DATE, T.DateType(), True)])
    return (spark.read.schema(schema).parquet(path)
            .groupBy(S.TRACE_DATE, S.SCOPE, S.NAME, S.UUID)
            .agg(F.sum(S.FILEOPS).alias(S.FILEOPS), F.max(S.TIMEENTRYUNIX).alias(S.TIMEENTRYUNIX)))


def read_dated(spark: SparkSession, path: str, report_date, schema: T.StructType) -> DataFrame:
    """A stored report of one date (``writers.publish_dated``: its newest published
    version; or ``writers.write_dated``) with its declared schema: types and labels
    (``03``) do not depend on what is stored."""
    folder = f"{path.rstrip('/')}/{S.REPORT_DATE}={report_date}"
    if last_commit(spark, folder)[0]:
        return read_published(spark, folder, schema)
    return spark.read.schema(schema).parquet(folder)


def _non_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what}: files exist but are empty")
    return df


def read_period_volumes(spark: SparkSession, path: str, layout: str = "partitioned",
                        require_rows: bool = True) -> DataFrame:
    """Binned volumes of every period as ``bin, volume, period``.

    ``layout='partitioned'``: one ``period=<label>`` folder per period (as
    ``write_popularity`` writes). ``layout='files'``: one headerless
    ``<label>.csv`` file per period, the label taken from the file name.
    """
    if layout == "partitioned":
        schema = T.StructType(S.PERIOD_VOLUME_SCHEMA.fields
                              + [T.StructField(S.PERIOD, T.StringType(), True)])
        df = spark.read.schema(schema).option("header", False).csv(path)
    elif layout == "files":
        df = (spark.read.schema(S.PERIOD_VOLUME_SCHEMA).option("header", False).csv(path)
              .select(S.BIN, S.VOLUME,
                      F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)\.csv$", 1)
                      .alias(S.PERIOD)))
    else:
        raise ValueError(f"layout must be 'partitioned' or 'files', not {layout!r}")
    return _non_empty(df, path) if require_rows else df


def read_full_monthly(spark: SparkSession, path: str, require_rows: bool = True) -> DataFrame:
    """Full statistics CSV: optional ``#`` comment line, then a header.
    Columns: ``created_at, age_days, ident, volume``."""
    df = (spark.read.schema(S.FULL_STATS_SCHEMA).option("header", True)
          .option("comment", "#").csv(path))
    return _non_empty(df, path) if require_rows else df


def read_unused_list(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Never-used list as tab-separated text; ``#`` lines are skipped."""
    return (spark.read.schema(S.UNUSED_SCHEMA).option("header", header)
            .option("comment", "#").option("sep", "\t").csv(path))


def latest_snapshot(df: DataFrame, column: str = S.REPORT_DATE) -> DataFrame:
    """Rows of the newest ``column`` value (S8). On a table partitioned by
    ``column`` the scalar subquery becomes a partition filter."""
    newest = df.select(F.max(column)).scalar()
    return df.filter(F.col(column) == newest)
