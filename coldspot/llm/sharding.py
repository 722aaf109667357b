"""Sharding (operator 4): proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; rank r of n becomes the
fraction (2r - 1) / 2n. Ordering all rows by fraction interleaves the sources in proportion,
and cutting that order into equal runs gives shards whose row counts differ by at most one
(law ``rows``) and whose mixture of sources follows that of all rows.

Neither ranking nor ordering gathers a source or the table in one task: rows are dealt into
buckets by leading digits (of the hash, then of the fraction, both uniform by construction),
numbered inside their bucket, and moved up by the number of rows in earlier buckets. Fully equal
rows, which share a hash, are counted first and take a run of numbers each, so that a bucket
holds different rows only. Only ids and numbers are shuffled, never texts. The number of buckets grows with the rows.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coldspot.llm.common import stored

SHARDS = 16
SEED = "17"
BUCKET_ROWS = 2048
LAW = "rows"
RUN_ROWS = 4096  # equal rows written out by one step


def _bucket_rows(rows: int) -> int:
    """Rows of a bucket: the square root of the rows for large tables, so that neither the
    rows of a bucket nor the number of buckets gets large."""
    return max(BUCKET_ROWS, isqrt(rows))


def _digit_buckets(rows: int) -> int:
    """Hexadecimal digits whose combinations give buckets of at most that many rows."""
    digits = 1
    while rows > _bucket_rows(rows) * 16 ** digits:
        digits += 1
    return digits


def _before(rows: DataFrame, groups: list[str], bucket: str) -> DataFrame:
    """Per group and bucket: rows in earlier buckets of the group, and rows of the group."""
    counts = rows.groupBy(*groups, bucket).agg(F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy(*groups)
    return counts.select(
        *groups, bucket,
        (F.sum("_n").over(whole.orderBy(bucket)) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("_all"))


def _written_out(counted: DataFrame) -> DataFrame:
    """``_n`` rows for each row, numbered in ``_i`` from ``_i`` + 1 on. Runs of ``RUN_ROWS`` are
    dealt over the tasks before they become rows."""
    last = F.col("_n") - 1
    single = counted.where("_n <= %d" % RUN_ROWS).withColumn("_run", F.lit(0).cast("long"))
    many = counted.where("_n > %d" % RUN_ROWS).withColumn(
        "_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / RUN_ROWS)))).repartition("_h", "_run")
    first = F.col("_run") * RUN_ROWS
    step = F.sequence(first + 1, F.least(first + RUN_ROWS, F.col("_n")))
    return single.unionByName(many).withColumn("_k", F.explode(step)).withColumn("_i", F.col("_i") + F.col("_k")).drop("_k", "_run", "_n")


def shard(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, source) per document row.

    Null texts have size 1 and the crc32 of nothing (0); a null source is a source of its
    own. Equal texts are no groups for this method: copies are ranked like other rows.
    Rows that tie in hash (a repeated doc_id) are ordered by doc_id, crc and size; fully
    equal rows are interchangeable. Fewer rows than shards leave shards without rows; an
    empty table gives no rows. Other columns are ignored."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source")).select(
        "doc_id", "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                       F.coalesce(text, F.lit(""))).cast("binary")).alias("_h"))
    # The narrow rows are used several times: written once, so that texts are read once.
    rows = stored(rows, "shard-rows")
    total = rows.count()
    digits = _digit_buckets(total)

    # Rank within the source. Null sources compare as a value of their own.
    rows = rows.withColumn("_s", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))).withColumn(
        "_b", F.substring("_h", 1, digits))
    different = rows.groupBy("_s", "_b", "_h", "doc_id", "text_crc32", "size", "source").agg(F.count(F.lit(1)).alias("_n"))
    until = F.sum("_n").over(W.partitionBy("_s", "_b").orderBy("_h", "doc_id", "text_crc32", "size")
                             .rowsBetween(W.unboundedPreceding, 0))
    ranked = (_written_out(different.withColumn("_i", until - F.col("_n"))).join(_before(rows, ["_s"], "_b"), ["_s", "_b"])
              .withColumn("_f", (2 * (F.col("_before") + F.col("_i")) - 1) / (2 * F.col("_all")))
              .drop("_b", "_i", "_before", "_all"))

    ranked = stored(ranked, "shard-ranks")

    # Place in the order by fraction.
    buckets = max(1, -(-total // _bucket_rows(total)))
    ranked = ranked.withColumn("_b", F.least(F.floor(F.col("_f") * buckets), F.lit(buckets - 1)).cast("long")).withColumn("_g", F.lit(0))
    inside = F.row_number().over(W.partitionBy("_b").orderBy("_f", "_s", "_h", "doc_id", "text_crc32", "size"))
    placed = ranked.withColumn("_i", inside).join(_before(ranked, ["_g"], "_b").drop("_g"), "_b")
    n = max(1, total)
    placed = placed.withColumn("_p", F.col("_before") + F.col("_i") - 1).withColumn(
        "shard", F.expr(f"cast(_p * {shards} div {n} as int)"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        F.expr(f"_p - (shard * {n}L + {shards - 1}) div {shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source")


# crc32 of the UTF-8 bytes of ``t`` in DuckDB: four bits at a time over the table of the
# reflected polynomial. The sixteen numbers are fixed values.
_CRC32 = """
xor(4294967295::UBIGINT, list_reduce(
  flatten(list_transform(regexp_extract_all(hex(encode(t)), '..'),
    lambda x: [strpos('123456789ABCDEF', x[2])::UBIGINT, strpos('123456789ABCDEF', x[1])::UBIGINT])),
  lambda c, h: xor(c >> 4, ([0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
    3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108
    ]::UBIGINT[])[(xor(c, h) & 15)::INT + 1]),
  4294967295::UBIGINT))"""


def oracle_sql(shards: int = SHARDS, seed: str = SEED) -> str:
    return f"""
WITH rows AS (
  SELECT doc_id, source, coalesce(text, '') AS t, coalesce('s' || source, '') AS s FROM documents),
hashed AS (
  SELECT doc_id, source, s, (octet_length(encode(t)) + 1)::BIGINT AS size, ({_CRC32})::BIGINT AS text_crc32,
         md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || t) AS h FROM rows),
ranked AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY s ORDER BY h, doc_id, text_crc32, size) - 1)
            / (2 * count(*) OVER (PARTITION BY s)) AS f FROM hashed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY f, s, h, doc_id, text_crc32, size) - 1 AS p, count(*) OVER () AS n FROM ranked)
SELECT doc_id, size, text_crc32, '{LAW}' AS law, (p * {shards} // n)::INT AS shard,
       p - ((p * {shards} // n) * n + {shards - 1}) // {shards} AS slot, NULL::INT AS grown_shard, source
FROM placed
"""
