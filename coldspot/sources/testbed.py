"""Catalogue tables derived from the driver's TPC-H-like test tables.

The reports need an access log and four catalogue snapshots. The test data has
neither, so the logical tables are derived from ``orders``, ``lineitem``,
``supplier`` and ``events`` by fixed rules (one dataset per order, one file
per line item, one endpoint per supplier, one trace per event). The same
rules are written twice: as Spark DataFrames here, and as DuckDB SQL common
table expressions (``ORACLE_CTES``) for the oracle comparison.

Every derived table grows with its source table, so every report built on them
grows with the test scale.
"""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldspot import schemas as S
from coldspot.functions.columns import epoch_seconds
from coldspot.sources.catalogue import Catalogue

# ---------------------------------------------------------------------------
# Fixed values of the derivation rules
# ---------------------------------------------------------------------------
# Report date of the test bed. Events lie in January 2024; each is moved back by
# up to TRACE_SPREAD_DAYS, so every period of the reports holds other sessions.
REPORT_DATE = "2024-02-01"
TRACE_SPREAD_DAYS = 600
# Every HOT_EVERY-th event reads one hot file; of the others the even ones read
# the file given by their value, and the odd ones come in pairs of equal file
# and user, on files that grow with the events.
HOT_EVERY = 10
HOT_FILE = "f9"
# Orders whose dataset name has too few dotted parts.
MALFORMED_EVERY = 29
# Scope of a dataset by order priority; any other priority -> "user.test".
PRIORITY_SCOPES = (
    ("1-URGENT", "data16_13TeV"),
    ("2-HIGH", "mc15_13TeV"),
    ("3-MEDIUM", "valid1"),
    ("4-NOT SPECIFIED", "data15_13TeV"),
)
OTHER_SCOPE = "user.test"
# Datatype of a dataset by order key modulo 4.
DATATYPES = ("AOD", "log", "DAOD", "HITS")
# Shift of order dates into the recent past: 2001-08-01 -> 2024-01-31.
CREATED_SHIFT_DAYS = 8218
# Event type -> trace event type; any other -> "upload".
EVENT_TYPES = (("view", "get"), ("click", "get_sm"), ("purchase", "download"), ("signup", "put"))
OTHER_EVENT_TYPE = "upload"


# Columns of the driver tables that the derivation reads, declared so that no
# schema-inference job runs and only these columns are scanned.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_returnflag string",
    "supplier": "s_suppkey bigint, s_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}

TABLE_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}
# Bytes that a line item or event takes, at most, when it is shuffled (compressed).
ROW_BYTES = 32


def _read(spark: SparkSession, sf_dir: str, table: str, spread: int | None = None) -> DataFrame:
    """A driver table. ``spread`` deals its rows over that many partitions by
    key first: each driver table is one file of one row group, so without it the
    derivation of a table runs in a single task. Joins on the key then take the
    rows as they lie; a round-robin deal would sort all rows of the reading task
    and be followed by another exchange."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    schema = TABLE_SCHEMAS.get(table)
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.repartition(spread, TABLE_KEYS[table]) if spread else df


def _scope(priority: F.Column) -> F.Column:
    scope = F.lit(OTHER_SCOPE)
    for p, sc in reversed(PRIORITY_SCOPES):
        scope = F.when(priority == p, F.lit(sc)).otherwise(scope)
    return scope


def _name(k: F.Column, scope: F.Column) -> F.Column:
    datatype = F.lit(DATATYPES[-1])
    for i, d in reversed(list(enumerate(DATATYPES[:-1]))):
        datatype = F.when(k % 4 == i, F.lit(d)).otherwise(datatype)
    head = F.concat(F.translate(scope, ".", "_"), F.lit("."), F.lpad(k.cast("string"), 8, "0"))
    return F.when(k % MALFORMED_EVERY == 0, head).otherwise(F.concat(
        head, F.lit(".stream.merge."),
        datatype, F.lit("_r"), (k % 5).cast("string"),
        F.when(k % 11 == 0, F.lit("_sub01")).otherwise(F.lit("")),
    ))


def _datasets(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    """One dataset per order: k, scope, name, created_at (ms), transient."""
    orders = _read(spark, sf_dir, "orders", spread)
    k = F.col("o_orderkey")
    scope = _scope(F.col("o_orderpriority"))
    created_ms = (epoch_seconds("o_orderdate", orders.schema["o_orderdate"].dataType) * 1000
                  + F.lit(CREATED_SHIFT_DAYS * 86400000)).cast("long")
    return orders.select(
        k.alias("k"),
        scope.alias(S.SCOPE),
        _name(k, scope).alias(S.NAME),
        created_ms.alias(S.CREATED_AT),
        F.when(k % 13 == 0, F.lit(1)).alias(S.TRANSIENT),
    )


def _line_datasets(spark: SparkSession, sf_dir: str, columns: list[str],
                   spread: int | None = None) -> DataFrame:
    """Line items with the scope and name of their order's dataset. The order
    side carries only (key, priority); names are formed after the join."""
    li = _read(spark, sf_dir, "lineitem", spread).select("l_orderkey", *columns)
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    k = F.col("l_orderkey")
    scope = _scope(F.col("o_orderpriority"))
    return j.select(*columns, "l_orderkey", scope.alias(S.SCOPE), _name(k, scope).alias(S.NAME))


def dids(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    return _datasets(spark, sf_dir, spread).select(S.CREATED_AT, S.SCOPE, S.NAME, S.TRANSIENT)


def contents(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    j = _line_datasets(spark, sf_dir, ["l_linenumber", "l_returnflag"], spread)
    return j.select(
        S.SCOPE, S.NAME,
        F.concat(F.lit("f"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string"))
        .alias(S.CHILD_NAME),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 6), F.lit("C"))
        .otherwise(F.lit("D")).alias(S.DID_TYPE),
        F.when(F.col("l_linenumber") == 7, F.lit("D")).otherwise(F.lit("F")).alias(S.CHILD_TYPE),
    )


def dslocks(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    j = _line_datasets(spark, sf_dir, ["l_suppkey", "l_quantity"], spread)
    return j.select(
        F.col("l_suppkey").cast("string").alias(S.RSE_ID),
        S.SCOPE, S.NAME,
        (F.col("l_quantity").cast("long") * 1000000).alias(S.BYTES),
    )


def rses(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = _read(spark, sf_dir, "supplier")
    return sup.select(
        F.col("s_suppkey").cast("string").alias(S.ID),
        F.concat(F.col("s_name"),
                 F.when(F.col("s_suppkey") % 3 == 0, F.lit("_TAPE")).otherwise(F.lit("_DATADISK")))
        .alias(S.RSE),
    )


def traces(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    ev = _read(spark, sf_dir, "events", spread)
    etype = F.lit(OTHER_EVENT_TYPE)
    for src, dst in reversed(EVENT_TYPES):
        etype = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(etype)
    e = F.col("event_id")
    text = lambda prefix, number: F.concat(F.lit(prefix), number.cast("string"))
    pair = F.floor(e / 4).cast("long")
    paired = (e % 2 == 1) & (e % HOT_EVERY != 0)
    file = (F.when(e % 23 == 0, F.lit(None).cast("string"))
            .when(e % HOT_EVERY == 0, F.lit(HOT_FILE))
            .when(paired, text("f", pair * 8 + 1 + pair % 7))
            .otherwise(text("f", F.floor(F.col("value") * 32).cast("long"))))
    user = (F.when(e % 17 == 0, F.lit(None).cast("string"))
            .when(paired, text("p", pair)).otherwise(text("u", F.col("user_id"))))
    moved = ((e * 7919) % TRACE_SPREAD_DAYS) * S.DAY_SECONDS
    time = (epoch_seconds("ts", ev.schema["ts"].dataType) - moved).cast("double")
    return ev.select(
        time.alias(S.TIMEENTRYUNIX), (time - 60).alias("timestart"), (time + e % 600).alias("timeend"),
        text("d", e % 1000).alias("dataset"), file.alias(S.FILENAME), text("h", F.col("user_id") % 50).alias("hostname"),
        F.when(e % 2 == 0, F.lit("data")).otherwise(F.lit("mc")).alias(S.SCOPE), text("SITE-", e % 7).alias("localsite"),
        text("SITE-", e % 11).alias("remotesite"), text("10.0.0.", e % 256).alias("ip"), etype.alias(S.EVENTTYPE),
        F.when(e % 5 == 0, F.lit("FAILED")).otherwise(F.lit("DONE")).alias("clientstate"), user.alias(S.UUID),
        text("/CN=", F.col("user_id")).alias("usrdn"),
    )


_CATALOGUES: dict[tuple, tuple[SparkSession, Catalogue, int]] = {}


def derived(spark: SparkSession, sf_dir: str, spread: int | None = None) -> Catalogue:
    """The five derived tables as lazy plans over the driver tables."""
    return Catalogue(
        traces=traces(spark, sf_dir, spread),
        contents=contents(spark, sf_dir, spread),
        dids=dids(spark, sf_dir, spread),
        rses=rses(spark, sf_dir),
        dslocks=dslocks(spark, sf_dir, spread),
    )


def shuffle_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Expected bytes of the largest shuffles: row counts come from the files' footers."""
    return ROW_BYTES * sum(_read(spark, sf_dir, t).count() for t in ("lineitem", "events"))


def materialise(spark: SparkSession, cat: Catalogue) -> Catalogue:
    """Write every table once to parquet below the shared checkpoint folder
    and read it back, as the catalogue dumps exist in production: the reports
    then scan files (pushdown, pruning, parallel splits) instead of
    re-deriving the tables in every plan."""
    from coldspot.session import scratch_path

    base = scratch_path(spark, "testbed")
    out = {}
    for f in fields(cat):
        path = f"{base}/{f.name}"
        getattr(cat, f.name).write.mode("overwrite").parquet(path)
        out[f.name] = spark.read.parquet(path)
    return Catalogue(**out)


def catalogue(spark: SparkSession, sf_dir: str, written: bool = True) -> Catalogue:
    """The five tables derived from ``sf_dir``; with ``written`` (default)
    as parquet tables written once per session and folder, as long as the
    folder's files stay the same; the session's shuffles are bounded by their size."""
    from coldspot.session import JOINED_BYTES, bound_tasks, fingerprint

    key = (id(spark), sf_dir.rstrip("/"), written, fingerprint(spark, sf_dir))
    hit = _CATALOGUES.get(key)
    if hit is not None and hit[0] is spark:
        if written:
            bound_tasks(spark, hit[2], joined_bytes=JOINED_BYTES)
        return hit[1]
    expected = 0
    if written:
        expected = shuffle_bytes(spark, sf_dir)
        parts = bound_tasks(spark, expected, joined_bytes=JOINED_BYTES)
        cat = materialise(spark, derived(spark, sf_dir, max(parts, spark.sparkContext.defaultParallelism)))
    else:
        cat = derived(spark, sf_dir)
    _CATALOGUES[key] = (spark, cat, expected)
    return cat


# ---------------------------------------------------------------------------
# Source spelling: the same tables as the dumps and the access log spell them
# ---------------------------------------------------------------------------
def traces_source(t: DataFrame) -> DataFrame:
    """Trace rows with the access log's field names (JSON lines)."""
    return t.select(*[F.col(S.TIMEENTRYUNIX if name == "traceTimeentryUnix" else name.lower()).alias(name)
                      for name in S.TRACE_SOURCE_SCHEMA.fieldNames()])


def upper_case(df: DataFrame) -> DataFrame:
    """Snapshot columns in the dumps' upper-case spelling."""
    return df.select(*[F.col(c).alias(c.upper()) for c in df.columns])


# ---------------------------------------------------------------------------
# The same derivation as DuckDB SQL (oracle side)
# ---------------------------------------------------------------------------
def _scope_case() -> str:
    whens = " ".join(f"WHEN '{p}' THEN '{s}'" for p, s in PRIORITY_SCOPES)
    return f"CASE o_orderpriority {whens} ELSE '{OTHER_SCOPE}' END"


def _datatype_case(k: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DATATYPES))
    return f"CASE {k} % 4 {whens} END"


def _event_case() -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EVENT_TYPES)
    return f"CASE event_type {whens} ELSE '{OTHER_EVENT_TYPE}' END"


ORACLE_CTES = f"""
tb_ds0 AS (
  SELECT o_orderkey AS k, {_scope_case()} AS scope, o_orderdate FROM orders
),
tb_ds AS (
  SELECT k, scope,
    replace(scope, '.', '_') || '.' || lpad(CAST(k AS VARCHAR), 8, '0')
      || CASE WHEN k % {MALFORMED_EVERY} = 0 THEN '' ELSE '.stream.merge.'
      || ({_datatype_case('k')}) || '_r' || CAST(k % 5 AS VARCHAR)
      || CASE WHEN k % 11 = 0 THEN '_sub01' ELSE '' END END AS name,
    CAST(floor(epoch(o_orderdate)) AS BIGINT) * 1000 + CAST({CREATED_SHIFT_DAYS} AS BIGINT) * 86400000 AS created_at,
    CASE WHEN k % 13 = 0 THEN 1 END AS transient
  FROM tb_ds0
),
dids AS (SELECT created_at, scope, name, transient FROM tb_ds),
contents AS (
  SELECT d.scope, d.name,
    'f' || CAST(l.l_orderkey * 8 + l.l_linenumber AS VARCHAR) AS child_name,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 6 THEN 'C' ELSE 'D' END AS did_type,
    CASE WHEN l.l_linenumber = 7 THEN 'D' ELSE 'F' END AS child_type
  FROM lineitem l JOIN tb_ds d ON l.l_orderkey = d.k
),
dslocks AS (
  SELECT CAST(l.l_suppkey AS VARCHAR) AS rse_id, d.scope, d.name,
    CAST(l.l_quantity AS BIGINT) * 1000000 AS bytes
  FROM lineitem l JOIN tb_ds d ON l.l_orderkey = d.k
),
rses AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id,
    s_name || CASE WHEN s_suppkey % 3 = 0 THEN '_TAPE' ELSE '_DATADISK' END AS rse
  FROM supplier
),
tb_events AS (
  SELECT *, CAST(CAST(floor(epoch(ts)) AS BIGINT) - (event_id * 7919 % {TRACE_SPREAD_DAYS}) * {S.DAY_SECONDS} AS DOUBLE) AS t,
    event_id // 4 AS pair, event_id % 2 = 1 AND event_id % {HOT_EVERY} <> 0 AS paired FROM events
),
traces AS (
  SELECT t AS timeentryunix, t - 60 AS timestart, t + event_id % 600 AS timeend,
    'd' || CAST(event_id % 1000 AS VARCHAR) AS dataset,
    CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % {HOT_EVERY} = 0 THEN '{HOT_FILE}'
         WHEN paired THEN 'f' || CAST(pair * 8 + 1 + pair % 7 AS VARCHAR)
         ELSE 'f' || CAST(CAST(floor(value * 32) AS BIGINT) AS VARCHAR) END AS filename,
    'h' || CAST(user_id % 50 AS VARCHAR) AS hostname, CASE WHEN event_id % 2 = 0 THEN 'data' ELSE 'mc' END AS scope,
    'SITE-' || CAST(event_id % 7 AS VARCHAR) AS localsite, 'SITE-' || CAST(event_id % 11 AS VARCHAR) AS remotesite,
    '10.0.0.' || CAST(event_id % 256 AS VARCHAR) AS ip, {_event_case()} AS eventtype,
    CASE WHEN event_id % 5 = 0 THEN 'FAILED' ELSE 'DONE' END AS clientstate,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN paired THEN 'p' || CAST(pair AS VARCHAR)
         ELSE 'u' || CAST(user_id AS VARCHAR) END AS uuid,
    '/CN=' || CAST(user_id AS VARCHAR) AS usrdn
  FROM tb_events
)"""
