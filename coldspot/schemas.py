"""Column names, declared schemas and fixed values of the popularity reports.

Vocabulary used throughout the package:

* dataset        = ``(scope, name)``;
* file           = ``child_name`` of a ``contents`` row with ``did_type='D'``
                   and ``child_type='F'``;
* access session = one ``(scope, name, uuid)`` group of read events; its time
                   is the latest event of the group;
* access count   = number of sessions with a non-null ``uuid`` whose time
                   passes the cutoff of a period;
* bin -1 / 0     = no session in the period, dataset created before / at or
                   after the cutoff.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names (lower case everywhere after the sources): fixed values, the
# names of the dumps and the reports
# ---------------------------------------------------------------------------
SCOPE = "scope"
NAME = "name"
UUID = "uuid"
FILENAME = "filename"
EVENTTYPE = "eventtype"
TIMEENTRYUNIX = "timeentryunix"
FILEOPS = "fileops"
CHILD_NAME = "child_name"
DID_TYPE = "did_type"
CHILD_TYPE = "child_type"
CREATED_AT = "created_at"
TRANSIENT = "transient"
ID = "id"
RSE = "rse"
RSE_ID = "rse_id"
BYTES = "bytes"
OP_EVENTS = "op_events"
ACCESS_NUM = "access_num"
VOLUME = "volume"
PERIOD = "period"
BIN = "bin"
AGE_DAYS = "age_days"
PROJECT = "project"
DATATYPE = "datatype"
IDENT = "ident"
N_DATASETS = "n_datasets"
CREATED_DAY = "created_day"
SIZE = "size"
REPORT_DATE = "report_date"
TRACE_DATE = "trace_date"
LOAD = "load"

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results
# ---------------------------------------------------------------------------
# Seconds in a day.
DAY_SECONDS = 86400
# A report "month" is 30 days; the notebook's last-N-months filter uses 31.
REPORT_MONTH_DAYS = 30
NOTEBOOK_MONTH_DAYS = 31
# Periods of the popularity report in months; 0 means infinity.
DEFAULT_PERIOD_MONTHS = (3, 6, 9, 12, 0)
INFINITY_LABEL = "infinity"
# Scope prefixes of datasets that are reported on (see README: one list is
# used for both the session filter and the dataset filter).
DEFAULT_SCOPE_PREFIXES = ("data", "mc", "valid")
# Scope prefixes literally written in the session preprocessing step.
LITERAL_SESSION_SCOPE_PREFIXES = ("data", "ms", "valid")
# Event types that count as a read: "get..." or exactly "download".
READ_EVENT_PATTERN = "^(get.*|download)$"
# Marker of sub-datasets excluded from the catalogue.
SUB_DATASET_MARK = "_sub"
# Marker of disk endpoints (unanchored match, i.e. "contains").
DISK_ENDPOINT_MARK = "DATADISK"
# contents rows that link a dataset to a file.
DATASET_DID_TYPE = "D"
FILE_CHILD_TYPE = "F"
# Histogram bins: -1 .. 15, counts of 15 or more fold into 15.
BIN_LOW = -1
BIN_CAP = 15
BIN_LABEL_OLDER = "0 (older X)"
BIN_LABEL_YOUNGER = "0 (younger X)"
BIN_LABEL_CAP = "> 14"
# Unused statistics.
LOG_DATATYPE = "log"
OTHER_IDENT = "other"
UNKNOWN_DATATYPE = "unknown"
DEFAULT_TOP_N = 20
# Size units of the TOP-N report.
TERABYTE = 1099511627776
PETABYTE = 1125899906842624

# ---------------------------------------------------------------------------
# Declared schemas
# ---------------------------------------------------------------------------
# Raw access log (JSON lines). Field names keep the source spelling; the JSON
# reader matches them case-sensitively.
def columns(ddl: str) -> T.StructType:
    """A schema of nullable columns from ``"name type, name type"`` (usable before a
    session exists)."""
    types = {"string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(),
             "int": T.IntegerType(), "date": T.DateType()}
    return T.StructType([T.StructField(name, types[kind]) for name, kind in map(str.split, ddl.split(","))])


# The fields of the log as it spells them.
TRACE_SOURCE_SCHEMA = columns("""
    traceTimeentryUnix double, timeStart double, timeEnd double, dataset string, filename string,
    hostname string, scope string, localSite string, remoteSite string, ip string,
    eventType string, clientState string, uuid string, usrdn string""")

# Access sessions as stored between the preprocessing and the reports.
SESSION_SCHEMA = T.StructType([
    T.StructField(SCOPE, T.StringType(), True),
    T.StructField(NAME, T.StringType(), True),
    T.StructField(UUID, T.StringType(), True),
    T.StructField(FILEOPS, T.LongType(), False),
    T.StructField(TIMEENTRYUNIX, T.DoubleType(), True),
])

# Catalogue snapshot columns as they appear in the dumps (upper case).
CONTENTS_COLUMNS = ("SCOPE", "NAME", "CHILD_NAME", "DID_TYPE", "CHILD_TYPE")
DIDS_COLUMNS = ("CREATED_AT", "SCOPE", "NAME", "TRANSIENT")
RSES_COLUMNS = ("ID", "RSE")
DSLOCKS_COLUMNS = ("RSE_ID", "SCOPE", "NAME", "BYTES")

# Period volumes after binning: headerless "bin,volume" per period file.
PERIOD_VOLUME_SCHEMA = T.StructType([
    T.StructField(BIN, T.StringType(), True),
    T.StructField(VOLUME, T.LongType(), True),
])

# Never-used list.
UNUSED_SCHEMA = T.StructType([
    T.StructField(SCOPE, T.StringType(), True),
    T.StructField(NAME, T.StringType(), True),
    T.StructField(BYTES, T.LongType(), True),
    T.StructField(CREATED_AT, T.LongType(), True),
    T.StructField(AGE_DAYS, T.IntegerType(), True),
])

# Full monthly statistics ("Created at, Age (days), Project/datatype, Volume").
FULL_STATS_SCHEMA = T.StructType([
    T.StructField(CREATED_AT, T.DateType(), True),
    T.StructField(AGE_DAYS, T.IntegerType(), True),
    T.StructField(IDENT, T.StringType(), True),
    T.StructField(VOLUME, T.LongType(), True),
])
FULL_STATS_HEADER = ("Created at", "Age (days)", "Project/datatype", "Volume")

# Stored report tables (read back with these types).
PRIMARY_SCHEMA = columns("scope string, name string, rse string, bytes long, created_at double")
BINS_SCHEMA = columns("bin long, volume long, period string")
TOPN_REPORT_SCHEMA = columns("created_at date, ident string, size double")
CUBE_SCHEMA = columns("project string, datatype string, created_day date, n_datasets long, size long")
