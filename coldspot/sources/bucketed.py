"""Tables stored in buckets of their keys (published as ``sources.publish`` does).

A join or grouping on the keys takes such a table as it lies: only the other side is
exchanged, and two tables of equal buckets meet without any exchange. Choose at least
``spark.sql.shuffle.partitions`` buckets; with fewer, Spark prefers to exchange both sides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from coldspot.sources.publish import commit, last_commit, version_folder


def _entry(path: str) -> str:
    """Name of the session catalogue's entry for a folder."""
    return "bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write_bucketed(df: DataFrame, root: str, keys: Sequence[str], buckets: int) -> int:
    """Write ``df`` as the table's next version, one sorted file per bucket of ``keys``, and
    publish it; returns its number. A failed write is never seen by readers."""
    spark, root, keys = df.sparkSession, root.rstrip("/"), list(keys)
    number = last_commit(spark, root)[0] + 1
    path = version_folder(root, number)
    # The entry is external: dropping it leaves the files alone.
    spark.sql(f"DROP TABLE IF EXISTS {_entry(path)}")
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).mode("overwrite").saveAsTable(_entry(path)))
    commit(spark, root, number, {"versions": [number], "keys": keys, "buckets": buckets, "schema": df.schema.json()})
    return number


def read_bucketed(spark: SparkSession, root: str) -> DataFrame:
    """The newest published version, with its buckets known to the planner; any session may
    read it, not only the one that wrote it."""
    import json

    root = root.rstrip("/")
    number, content = last_commit(spark, root)
    if not number:
        raise FileNotFoundError(f"{root}: nothing has been published")
    path = version_folder(root, number)
    if not spark.catalog.tableExists(_entry(path)):
        schema = T.StructType.fromJson(json.loads(content["schema"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(f"`{k}`" for k in content["keys"])
        location = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {_entry(path)} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {content['buckets']} BUCKETS LOCATION '{location}'")
    return spark.table(_entry(path))
