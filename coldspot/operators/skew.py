"""Explicit splitting of hot join keys (salting), exact by construction.

AQE's skew join splits oversized shuffle partitions at run time in batch
queries. This module does the same deterministically where that is not
wanted to depend on run-time thresholds (a known hot key): rows of the large
side whose key is hot get a salt in ``0..buckets-1`` derived from other
columns, and the rows of the other side with that key are replicated once per
salt. Every pair of matching rows still meets exactly once, so the join
result is unchanged; only its distribution over tasks changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot.plans.sizing import cut_lineage, row_count_at_most

SALT = "_salt"
HOT = "_hot"
# A list of hot keys up to this many rows is broadcast to mark the hot rows.
BROADCAST_KEYS = 100_000
ROWS = "_rows"
SALTS = "_salts"
# Keys that the sketch of key sizes follows, and rows of a hot key that one salt takes.
KEYS_TRACKED = 10_000
ROWS_PER_SALT = 1_000_000


def hot_keys(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Keys of ``df`` with at least ``min_rows`` rows, as a one-column frame
    ``_hot``, however many there are. Computed once (one aggregation, written
    to the shared checkpoint folder)."""
    return cut_lineage(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                       .filter(F.col("_n") >= min_rows).select(F.col(key).alias(HOT)))


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                hot: DataFrame | None, buckets: int, spread_by: Sequence[str],
                broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Inner join ``big.big_key = small.small_key`` with hot keys split over
    ``buckets`` salts. ``hot`` has the hot keys in its first column; repeated
    and null keys in it have no effect. The hash of ``spread_by``, columns of
    ``big`` that tell the rows of one key apart (null in some of them is
    fine), picks the salt. The output has the columns of both inputs.

    A hot list of at most ``broadcast_keys`` rows is broadcast. A longer one
    is not joined at all, as that join would be skewed by the hot keys
    themselves: every key is salted instead."""
    if hot is None or buckets <= 1:
        return big.join(small, big[big_key] == small[small_key])
    hot = hot.select(F.col(hot.columns[0]).alias(HOT)).filter(F.col(HOT).isNotNull()).distinct()
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(buckets)).cast("int")
    salts = F.sequence(F.lit(0), F.lit(buckets - 1))
    if row_count_at_most(hot, broadcast_keys):
        marks = F.broadcast(hot)  # counted above
        b = (big.join(marks, big[big_key] == marks[HOT], "left")
             .withColumn(SALT, F.when(F.col(HOT).isNotNull(), salt).otherwise(F.lit(0))).drop(HOT))
        s = (small.join(marks, small[small_key] == marks[HOT], "left")
             .withColumn(SALT + "_s", F.explode(F.when(F.col(HOT).isNotNull(), salts).otherwise(F.array(F.lit(0)))))
             .drop(HOT))
    else:
        b = big.withColumn(SALT, salt)
        s = small.withColumn(SALT + "_s", F.explode(salts))
    return (b.join(s, (b[big_key] == s[small_key]) & (b[SALT] == s[SALT + "_s"]))
            .drop(SALT, SALT + "_s"))


def key_sizes(df: DataFrame, key: str, min_rows: int, tracked: int = KEYS_TRACKED) -> DataFrame:
    """Large keys of ``df`` and their rows, ``_hot, _rows``, from a frequent-items sketch:
    each task keeps at most ``tracked`` keys, and only these sketches are merged, so no row of
    ``df`` is exchanged and one column of it is read. Sizes are estimates (off by a few rows in
    ``tracked``), which is enough to place rows; null is no key."""
    top = df.filter(F.col(key).isNotNull()).agg(
        F.call_function("approx_top_k", F.col(key), F.lit(max(1, tracked // 10)), F.lit(tracked)).alias("top"))
    return (top.select(F.inline("top")).filter(F.col("count") >= min_rows)
            .select(F.col("item").alias(HOT), F.col("count").alias(ROWS)))


def merged_sizes(*sizes: DataFrame) -> DataFrame:
    """Key sizes of several loads added up."""
    out = sizes[0].select(HOT, ROWS)
    for more in sizes[1:]:
        out = out.unionAll(more.select(HOT, ROWS))
    return out.groupBy(HOT).agg(F.sum(ROWS).alias(ROWS))


def measured_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, sizes: DataFrame,
                  spread_by: Sequence[str], rows_per_salt: int = ROWS_PER_SALT, copartitioned: bool = False) -> DataFrame:
    """Inner join ``big.big_key = small.small_key`` where each hot key has as many salts as its
    size asks for: ``ceil(rows / rows_per_salt)``, so a key of 100 times the rows is split 100
    times as finely, and its rows of ``small`` are copied no more often than that. ``sizes`` are
    ``_hot, _rows`` (``key_sizes``); wrong, repeated, missing or null keys in it change where
    rows go, never the result. Of a longer list the ``BROADCAST_KEYS`` largest keys count.

    ``copartitioned``: ``small`` is stored in buckets of ``small_key``. Only the hot keys' rows
    of it are then copied and exchanged; all other keys meet it in its buckets, and ``big`` is
    read once for each of the two."""
    marks = (sizes.filter(F.col(HOT).isNotNull()).groupBy(HOT).agg(F.max(ROWS).alias(ROWS))
             .select(HOT, F.ceil(F.col(ROWS) / F.lit(rows_per_salt)).cast("int").alias(SALTS), ROWS)
             .filter(F.col(SALTS) > 1).orderBy(F.desc(ROWS), HOT).limit(BROADCAST_KEYS).select(HOT, SALTS))
    marks = F.broadcast(marks)  # limited above
    how = "inner" if copartitioned else "left"
    salts = F.coalesce(SALTS, F.lit(1))
    b = (big.join(marks, big[big_key] == marks[HOT], how)
         .withColumn(SALT, F.pmod(F.xxhash64(*spread_by), salts).cast("int")).drop(HOT, SALTS))
    s = (small.join(marks, small[small_key] == marks[HOT], how)
         .withColumn(SALT + "_s", F.explode(F.sequence(F.lit(0), salts - 1))).drop(HOT, SALTS))
    joined = b.join(s, (b[big_key] == s[small_key]) & (b[SALT] == s[SALT + "_s"])).drop(SALT, SALT + "_s")
    if not copartitioned:
        return joined
    rest = big.join(marks, big[big_key] == marks[HOT], "left_anti")
    return rest.join(small, rest[big_key] == small[small_key]).unionByName(joined)
