"""Exact top-k search (operator 10): exhaustive term-at-a-time accumulation.

Vectors are whole numbers per component (term). The queries are held as sparse rows; a task
turns each batch of candidates into postings, one column per term, and for every term
scatters query weight times posting into a dense array of scores. Partition selection cuts
each query's scores to the k best of the batch, ties to the smaller id; the batches' best
are merged by a window over query_id.

Every query meets every candidate once, in a grid of cells: queries and candidates are dealt
into blocks by hash, each side is copied to the blocks of the other, and a cell is one group
of a cogrouped shuffle. The blocks are counted so that a cell holds about ``QUERY_TERMS`` and
``CANDIDATE_TERMS`` numbers, whatever the size of the table or of its vectors; nothing but two
counts reaches the driver and nothing is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coldspot.llm.common import importable

QUERY_TERMS = 1 << 20  # numbers of a block of queries, about
CANDIDATE_TERMS = 1 << 22  # numbers of a block of candidates, about
SMALLEST_BLOCK = 512  # candidates; more blocks than memory asks for are made for idle cores
MOST_TASKS = 20_000  # a task takes several cells beyond
CANDIDATES = 4096  # scored at once
TILE = 32  # queries scored at once: their dense scores stay in the processor's cache


def quantise(vectors: DataFrame, id_col: str, vector_col: str, factor: int = 256) -> DataFrame:
    """(vec_id, terms): floor(factor * x) of each component. Rows whose id or vector is null,
    or whose vector holds a null or non-finite component, are left out."""
    x = F.col(vector_col).cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return (vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, finite))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * factor)).alias("terms")))


class QueryTile:
    """A few sparse query rows, stored by term: for each term the queries that have it and
    their weights."""

    def __init__(self, ids: list[int], rows: list[list[int]]):
        self.ids = np.asarray(ids, np.int64)
        self.terms = []
        for term in range(max(map(len, rows), default=0)):
            held = [(i, r[term]) for i, r in enumerate(rows) if term < len(r) and r[term]]
            self.terms.append((np.array([i for i, _ in held], np.int64), np.array([v for _, v in held], np.int64)))


def tiles(ids: list[int], rows: list[list[int]]) -> list[QueryTile]:
    return [QueryTile(ids[i:i + TILE], rows[i:i + TILE]) for i in range(0, len(ids), TILE)]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores (all, if fewer), ties to the smaller id; ``ids``
    ascend."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[:k - len(above)]])


def accumulate(block: list[QueryTile], ids: np.ndarray, flat: np.ndarray, ends: np.ndarray, k: int):
    """Best candidates of one batch for each query: arrays (query_id, vec_id, score)."""
    order = np.argsort(ids, kind="stable")
    starts, sizes = (ends[:-1])[order], np.diff(ends)[order]
    ids = ids[order]
    postings = []  # of each term: the candidates that have it and their values
    for term in range(int(sizes.max(initial=0))):
        has = np.flatnonzero(sizes > term)
        postings.append((has, flat[starts[has] + term]))
    made = []
    for tile in block:
        scores = np.zeros((len(tile.ids), len(ids)), np.int64)
        product = np.empty_like(scores)
        for (queries, weights), (has, values) in zip(tile.terms, postings):
            if len(queries) == len(tile.ids) and len(has) == len(ids):
                np.multiply(weights[:, None], values[None, :], out=product)
                scores += product
            elif len(queries) and len(has):
                scores[np.ix_(queries, has)] += weights[:, None] * values[None, :]
        for q, query in enumerate(tile.ids):
            own = np.searchsorted(ids, [query, query + 1])  # the query's own row
            row = np.delete(scores[q], np.s_[own[0]:own[1]]) if own[0] < own[1] else scores[q]
            others = np.delete(ids, np.s_[own[0]:own[1]]) if own[0] < own[1] else ids
            at = best(row, others, k)
            made.append((np.full(len(at), query), others[at], row[at]))
    return tuple(np.concatenate(c) for c in zip(*made))


def merged(parts: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """The k best rows of each query among arrays (query_id, vec_id, score)."""
    query, other, score = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((other, -score, query))
    query, other, score = query[order], other[order], score[order]
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
    return query[place < k], other[place < k], score[place < k]


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of lists."""
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
    return lists.values.to_numpy(zero_copy_only=False), np.asarray(lists.offsets).astype(np.int64)


def _cell(queries: pa.Table, vectors: pa.Table, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Scores one block of queries against one block of candidates."""
    if not queries.num_rows or not vectors.num_rows:
        return
    block = tiles(queries["vec_id"].to_pylist(), queries["terms"].to_pylist())
    flat, offsets = _lists(vectors["terms"])
    ids = vectors["vec_id"].to_numpy()
    kept: list[tuple[np.ndarray, ...]] = []
    for start in range(0, len(ids), CANDIDATES):
        part = slice(start, start + CANDIDATES)
        found = accumulate(block, ids[part], flat, offsets[start:start + CANDIDATES + 1], k)
        kept = [merged([*kept, found], k)]
    yield from kept


def _sides(queries: DataFrame, vectors: DataFrame) -> tuple[int, int]:
    """Blocks of queries and of candidates."""
    size = F.sum(F.size("terms").cast("long"))
    of = lambda side: side.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    (_, asked), (rows, held) = of(queries), of(vectors)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, ceil(asked / QUERY_TERMS))
    return blocks, max(1, ceil(held / CANDIDATE_TERMS), min(ceil(cores / blocks), ceil(rows / SMALLEST_BLOCK)))


def search(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k highest inner products among
    ``vectors`` (both as ``quantise`` gives them), rank from 1, ties to the smaller vec_id.

    A vector with the query's id is its own row and no candidate. A vec_id that repeats
    among the queries counts once, with the vector that sorts first; repeated candidates
    are candidates each. Vectors of different lengths meet in the terms both have. Fewer
    than k candidates give fewer rows; no queries or candidates give none.

    Equal rows are counted before they are dealt and at most k of each go on, since no more
    can be among the k best; so no block grows with them."""
    importable(vectors.sparkSession)
    across, down = _sides(queries, vectors)
    queries = queries.groupBy("vec_id").agg(F.min("terms").alias("terms"))
    vectors = vectors.groupBy("vec_id", "terms").agg(F.count(F.lit(1)).alias("_n"))
    vectors = vectors.withColumn("_n", F.explode(F.sequence(F.lit(1), F.least("_n", F.lit(k)).cast("int")))).drop("_n")

    def dealt(side: DataFrame, key: list[str], own: str, blocks: int, other: str, copies: int) -> DataFrame:
        return side.select(
            F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other), "vec_id", "terms"
        ).repartition(min(across * down, MOST_TASKS), "_q", "_c")

    asked = dealt(queries, ["vec_id"], "_q", across, "_c", down)
    held = dealt(vectors, ["vec_id", "terms"], "_c", down, "_q", across)

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        parts = list(_cell(asked, held, k)) or [(np.zeros(0, np.int64),) * 3]
        return pa.table([pa.array(c, pa.int64()) for c in parts[0]], names)

    found = asked.groupBy("_q", "_c").cogroup(held.groupBy("_q", "_c")).applyInArrow(
        run, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS terms FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.terms, c.terms), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
