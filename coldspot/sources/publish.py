"""Publishing tables so that a failed write never shows.

A table's folder holds a subfolder per write (``v=<number>``) and a folder ``_commits`` with
one small file per published write, which says which subfolders make up the table. The file
is written under another name and renamed once all data are there: readers see the table as
it was or as it is, never a part. One writer at a time; a second one that ends with the same
number fails instead of overwriting.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from coldspot.session import _filesystem

COMMITS = "_commits"


def _children(spark: SparkSession, path: str) -> list[str]:
    p, fs = _filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def last_commit(spark: SparkSession, root: str) -> tuple[int, dict]:
    """(number, content) of the newest published write; (0, {}) if there is none."""
    names = [n for n in _children(spark, f"{root}/{COMMITS}") if n.isdigit()]
    if not names:
        return 0, {}
    p, fs = _filesystem(spark, f"{root}/{COMMITS}/{names[-1]}")
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(names[-1]), json.loads(text)


def commit(spark: SparkSession, root: str, number: int, content: dict) -> None:
    """Publish write ``number``; an error if it is published already."""
    final, fs = _filesystem(spark, f"{root}/{COMMITS}/{number:012d}")
    hidden, _ = _filesystem(spark, f"{root}/{COMMITS}/.{number:012d}.writing")
    if fs.exists(final):
        raise RuntimeError(f"{root}: write {number} is published already")
    stream = fs.create(hidden, True)
    stream.writeBytes(json.dumps(content))  # ASCII
    stream.close()
    if not fs.rename(hidden, final):
        raise RuntimeError(f"{root}: write {number} could not be published")


def version_folder(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/v={number:012d}"


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Write ``df`` as the table's next version and publish it; returns its number. What a
    failed write left under that number is replaced."""
    spark, root = df.sparkSession, root.rstrip("/")
    number = last_commit(spark, root)[0] + 1
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "static").mode("overwrite").save(version_folder(root, number))
    commit(spark, root, number, {"versions": [number]})
    return number


def read_published(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The newest published version of a table, with its declared schema."""
    number, _ = last_commit(spark, root.rstrip("/"))
    if not number:
        raise FileNotFoundError(f"{root}: nothing has been published")
    return spark.read.schema(schema).format(fmt).load(version_folder(root, number))


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete versions of ``publish`` but the newest ``keep`` published ones (readers of these
    go on). Returns how many were deleted."""
    newest, root = last_commit(spark, root.rstrip("/"))[0], root.rstrip("/")
    gone = 0
    for name in _children(spark, root):
        if name.startswith("v=") and int(name[2:]) <= newest - keep:
            p, fs = _filesystem(spark, f"{root}/{name}")
            gone += fs.delete(p, True)
    return gone
