"""MinHash near-duplicates (operator 7): chosen-path set similarity join.

1. Every whole text becomes its set of word 5-gram hashes, a set fingerprint, and minwise
   tokens: one 64-bit token per tree and a sketch of ``SKETCH`` one-byte tokens.
2. Documents of equal sets form a class; only its smallest doc_id goes on. A group of exact
   copies is one row from here, however large.
3. Each tree sends a class to the node of its own minwise token. A node of at most
   ``NODE_ROWS`` classes is compared exhaustively by sketch. Every class of a larger node
   goes on to the children given by ``BRANCHES`` further sketch tokens, chosen by the node,
   if that lowers the number of comparisons (to ``WORTH`` of them); this repeats until it
   does not, or until ``MAX_DEPTH``. A node that is still larger is dealt into blocks; each
   is compared like a node, and then every block with every other (see 4), so no class is
   left out.
4. Links are confirmed in rounds, so that few sets are shipped. First a node names for each
   class only its best partner (by sketch) of a lower rank, a fixed random order of the ids;
   of all trees the best one stays: at most one link for a class, and no cycles, whatever the
   size of its group. Then the further candidates of classes that are not connected yet: all
   similar pairs of a node of up to ``ALL_PAIRS`` classes, a maximum spanning forest of a
   larger one. At last, of nodes of more than two classes and of those dealt into blocks, all
   similar pairs that the confirmed links do not connect, block against block. A pair within
   a component adds nothing to it, so no link that counts is lost, and there is no cap. For
   this last round the classes of such nodes get a second sketch of ``WIDE`` tokens, which
   tells the pairs of a family that is alike but not linked without reading their texts.
5. Candidate links are confirmed on the full sets, made again from the texts.
6. Connected components of the confirmed links by minimum labels with pointer jumping, on
   tables in the shared folder; nothing of all documents reaches the driver.

The number of trees follows from the target recall at the threshold: a tree finds a pair
of similarity s with probability s, and at least 0.88 s if its node has to branch, so the
chance to miss a pair in all trees is at most (1 - 0.88 s) ** trees. A pair at the
threshold is also missed, in all trees alike, if the estimate of its one sketch is more
than ``SLACK`` too low: a chance of 6.7e-5 (binomial), less for pairs above it.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot.llm.common import map_texts, stored
from coldspot.plans.sizing import row_count_at_most

SHINGLE = 5
PERCENT = 75
MISS = 1e-6  # chance that no tree finds a link at the threshold
SKETCH = 128
SLACK = 0.15  # estimated similarity may be lower than the threshold by this: four deviations
WIDE = 2048  # one-byte tokens of the second sketch, of classes that are in doubt
WIDE_SLACK = 0.039  # four deviations of its estimate
NODE_ROWS = 4096
ALL_PAIRS = 12
BRANCHES = 2
MAX_DEPTH = 8
WORTH = 0.75  # a node branches if its children have at most this share of its comparisons
FEW = 200_000  # ids (8 bytes each) that are broadcast to filter the texts, after a count
SEED = 20240917

BLOCK_BYTES = 4 << 20  # of a text that are hashed at a time (at least one word)


def trees_for(percent: int = PERCENT, miss: float = MISS) -> int:
    return max(1, ceil(log(miss) / log(1 - 0.88 * percent / 100)))


def _mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (wraps around)."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


# White space of words: space and U+0009..U+000D, single bytes in UTF-8.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
# A random number for each byte; A-Z have those of a-z, blanks none.
_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_BYTE[65:91] = _BYTE[97:123]
_BYTE[_BLANK] = 0


@lru_cache(maxsize=4)
def _places(n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _place(n: int) -> np.ndarray:
    """A random odd number for each of at least ``n`` places in a word."""
    return _places(1024) if n <= 1024 else _places(1 << n.bit_length())


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, A-Z lower-cased: sums over a word of the
    products of a number for the byte and one for its place."""
    made = []
    whole = np.frombuffer(data, np.uint8)
    at = 0
    while at < len(whole):
        stop = min(len(whole), at + BLOCK_BYTES)
        if stop < len(whole):  # on to the end of the word
            rest = _BLANK[whole[stop:stop + BLOCK_BYTES]]
            while not rest.any() and stop + len(rest) < len(whole):
                stop += len(rest)
                rest = _BLANK[whole[stop:stop + BLOCK_BYTES]]
            stop += int(rest.argmax()) if rest.any() else len(rest)
        data = whole[at:stop]
        letter = ~_BLANK[data]
        first = np.flatnonzero(letter[1:] > letter[:-1]) + 1
        if letter[0]:
            first = np.concatenate([[0], first])
        if len(first):
            spans = np.diff(np.append(first, len(data)))  # a word and the blanks behind it
            within = np.arange(first[0], len(data))
            within -= np.repeat(first, spans)
            sums = _place(int(spans.max()))[within]
            sums *= _BYTE[data[first[0]:]]  # blanks count nothing
            made.append(_mixed(np.add.reduceat(sums, first - first[0])))
        at = stop
    return np.concatenate(made) if made else np.zeros(0, np.uint64)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word ``size``-grams of a text. Words are cut at
    space and U+0009..U+000D after lower-casing A-Z; fewer words than ``size`` make one
    shingle, no words none."""
    h = word_hashes(text.encode("utf-8")) if text else np.zeros(0, np.uint64)
    if not len(h):
        return h
    n = max(1, len(h) - size + 1)
    made = np.full(n, np.uint64(min(len(h), size)))
    for j in range(min(size, len(h))):
        made *= np.uint64(0x9E3779B97F4A7C15)
        made += h[j:j + n]
    return np.unique(_mixed(made))


def _constants(trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends: of 64 bits for the trees, of 32 for the sketch."""
    rng = np.random.default_rng(SEED)
    wide, narrow = (rng.integers(0, high, (2, n), dtype=np.uint64) for high, n in ((1 << 63, trees), (1 << 31, SKETCH)))
    wide[0], narrow[0] = wide[0] * np.uint64(2) + np.uint64(1), narrow[0] * np.uint64(2) + np.uint64(1)
    return wide, narrow.astype(np.uint32)


@lru_cache(maxsize=1)
def _wide() -> np.ndarray:
    """Multipliers and addends of the second sketch."""
    made = np.random.default_rng(SEED + 1).integers(0, 1 << 31, (2, WIDE), dtype=np.uint64)
    made[0] = made[0] * np.uint64(2) + np.uint64(1)
    return made.astype(np.uint32)


def tokens(s: np.ndarray, functions: np.ndarray) -> bytes:
    """One byte for the least value of each 32-bit function over a set."""
    return _mixed(minwise((s >> np.uint64(32)).astype(np.uint32), functions).astype(np.uint64)).astype(np.uint8).tobytes()


def minwise(s: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """The least value of each hash function (rows multipliers, addends) over the values."""
    kind = functions.dtype
    mul, add = functions[0][:, None], functions[1][:, None]
    low = np.full(functions.shape[1], np.iinfo(kind).max, kind)
    room = np.empty((functions.shape[1], 256), kind)
    for i in range(0, len(s), 256):  # bounded memory for very long texts
        h = s[i:i + 256]
        made = room[:, :len(h)]
        np.multiply(mul, h, out=made)
        np.add(made, add, out=made)
        np.minimum(low, made.min(axis=1), out=low)
    return low


SIGNATURE_SCHEMA = "doc_id long, n_shingles long, fp1 long, fp2 long, trees array<long>, sketch binary"


def signatures(docs: DataFrame, trees: int, size: int = SHINGLE) -> DataFrame:
    wide, narrow = _constants(trees)
    salt = np.arange(1, trees + 1).astype(np.uint64)

    def run(part, texts):
        n, fp, keys, sketches = [], [], [], []
        for text in texts:
            s = shingles(text, size)
            n.append(len(s))
            fp.append(np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64))
            keys.append(_mixed(_mixed(minwise(s, wide)) + salt).astype(np.int64))
            sketches.append(tokens(s, narrow))
        both = np.array(fp).reshape(-1, 2)
        edges = np.arange(len(texts) + 1, dtype=np.int32) * trees
        return {"doc_id": part.column(0), "n_shingles": n, "fp1": both[:, 0], "fp2": both[:, 1],
                "trees": pa.ListArray.from_arrays(edges, pa.array(np.concatenate(keys))),
                "sketch": pa.array(sketches, pa.binary())}

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SIGNATURE_SCHEMA)


def estimate(sketches: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Estimated similarity of one sketch to others (chance agreement taken out)."""
    same = (sketches == sketch).mean(axis=1)
    return (same - 1 / 256) / (1 - 1 / 256)


def may_link(sizes: np.ndarray, size: int, percent: int) -> np.ndarray:
    """Whether sets of these sizes can reach ``percent`` with a set of ``size``."""
    return (sizes * percent <= size * 100) & (size * percent <= sizes * 100)


def similar_pairs(sizes: np.ndarray, sketches: np.ndarray, least: float, percent: int):
    """All pairs of rows whose estimated similarity reaches ``least``: arrays (a, b)."""
    a, b = [], []
    for i in range(len(sizes) - 1):
        ok = may_link(sizes[i + 1:], sizes[i], percent) & (estimate(sketches[i + 1:], sketches[i]) >= least)
        hit = np.flatnonzero(ok) + i + 1
        a.append(np.full(len(hit), i))
        b.append(hit)
    return np.concatenate(a or [np.zeros(0, int)]), np.concatenate(b or [np.zeros(0, int)])


def rank(ids: np.ndarray) -> np.ndarray:
    """A fixed random order of ids."""
    return _mixed(ids.astype(np.uint64) + np.uint64(SEED))


def best_lower(order: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, least: float, percent: int):
    """For every row with one, its best estimated partner among the rows before it in
    ``order``: arrays (row, partner, estimate)."""
    rows, partners, values = [], [], []
    sizes, sketches = sizes[order], sketches[order]
    for i in range(1, len(order)):
        near = np.where(may_link(sizes[:i], sizes[i], percent), estimate(sketches[:i], sketches[i]), -1.0)
        j = int(near.argmax())
        if near[j] >= least:
            rows.append(order[i])
            partners.append(order[j])
            values.append(near[j])
    return np.array(rows, np.int64), np.array(partners, np.int64), np.array(values)


def spanning_forest(sizes: np.ndarray, sketches: np.ndarray, least: float, percent: int) -> np.ndarray:
    """Edges (a, b) of a maximum spanning forest over the pairs whose estimated similarity
    reaches ``least``, grown edge by edge (Prim), so memory is linear in the rows."""
    n = len(sizes)
    best, via, out = np.full(n, -1.0), np.full(n, -1), np.zeros(n, bool)
    made = []
    for _ in range(n):
        u = int(np.where(out, -2.0, best).argmax())
        if via[u] >= 0:
            made.append((int(via[u]), u))
        out[u] = True
        near = np.where(may_link(sizes, sizes[u], percent), estimate(sketches, sketches[u]), -1.0)
        better = (near >= least) & (near > best) & ~out
        best[better], via[better] = near[better], u
    return np.array(made, np.int64).reshape(-1, 2)


# What a node gives: the best lower partner b of a class a (its estimate in millionths as
# key), a further candidate a < b, or a member (the node as key, a the class, b the block).
LOWER, FURTHER, MEMBER = 0, 1, 2
ROW_SCHEMA = "kind int, key long, a long, b long, n_shingles long, sketch binary"


def _compare_nodes(members: DataFrame, percent: int) -> DataFrame:
    """Members (key, part, big, id, n_shingles, sketch), sorted by key and part in their
    partition: rows of ``ROW_SCHEMA``. Members are given of nodes of more than two classes
    and of those dealt into blocks (big)."""
    least = max(0.0, percent / 100 - SLACK)
    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
                        ("n_shingles", pa.int64()), ("sketch", pa.binary())])

    def node(key, part, big, ids, sizes, raw):
        sketches = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), SKETCH)
        rows, partners, values = best_lower(np.argsort(rank(ids), kind="stable"), sizes, sketches, least, percent)
        for u, v, near in zip(ids[rows].tolist(), ids[partners].tolist(), values.tolist()):
            yield LOWER, int(near * 1e6), u, v, None, None
        if len(ids) > 2 or big:
            if len(ids) > ALL_PAIRS:
                a, b = spanning_forest(sizes, sketches, least, percent).T
            else:
                a, b = similar_pairs(sizes, sketches, least, percent)
            x, y = ids[a], ids[b]
            for u, v in zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist()):
                yield FURTHER, key, u, v, None, None
            for i in range(len(ids)):
                yield MEMBER, key, int(ids[i]), part, int(sizes[i]), raw[i]

    def run(batches):
        rows: list[tuple] = []
        held: list[tuple] = []

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            return made

        def close():
            if len(held) > 1 or held and held[0][2]:
                key, part, big = held[0][:3]
                rows.extend(node(key, part, big, np.array([h[3] for h in held], np.int64),
                                 np.array([h[4] for h in held], np.int64), [h[5] for h in held]))
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:2] != held[0][:2]:
                    close()
                    if len(rows) >= 5000:
                        yield flush()
                held.append(row)
        close()
        if rows:
            yield flush()

    return members.mapInArrow(run, ROW_SCHEMA)


def _unconnected_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Members (key, lo, hi, part, id, n_shingles, sketch, component, wide) of two blocks,
    sorted by key, lo and hi in their partition: all pairs (a < b) of one class of each block
    (of one block, if lo = hi) that are of different components and similar by both sketches
    (by one, where a class has no second)."""
    least, least_wide = max(0.0, percent / 100 - SLACK), max(0.0, percent / 100 - WIDE_SLACK)

    def partners(held):
        """(id, ids of partners) of the rows outside of the most frequent component."""
        part, ids, sizes, component = (np.array([h[k] for h in held], np.int64) for k in (3, 4, 5, 7))
        sketches = np.frombuffer(b"".join(h[6] for h in held), np.uint8).reshape(len(held), SKETCH)
        known = np.array([h[8] is not None for h in held])
        wide = np.frombuffer(b"".join(h[8] or bytes(WIDE) for h in held), np.uint8).reshape(len(held), WIDE)
        names, number = np.unique(component, return_inverse=True)
        outside = number != np.bincount(number).argmax()
        within = held[0][1] == held[0][2]
        later = np.arange(len(held))
        for i in np.flatnonzero(outside):
            # A pair of two rows outside is met at the first of them.
            ok = (component != component[i]) & (~outside | (later > i)) & may_link(sizes, sizes[i], percent)
            if not within:
                ok &= part != part[i]
            near = np.flatnonzero(ok)
            near = near[estimate(sketches[near], sketches[i]) >= least]
            if known[i]:
                near = near[~known[near] | (estimate(wide[near], wide[i]) >= least_wide)]
            if len(near):
                yield np.full(len(near), ids[i]), ids[near]

    def run(batches):
        held: list[tuple] = []
        made: list[tuple] = []

        def flush():
            x, y = (np.concatenate(c) for c in zip(*made))
            made.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

        def close():
            for pair in partners(held) if held else ():
                made.append(pair)
                if sum(len(x) for x, _ in made) >= 5000:
                    yield flush()
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:3] != held[0][:3]:
                    yield from close()
                held.append(row)
        yield from close()
        if made:
            yield flush()

    return members.mapInArrow(run, "a long, b long")


def candidate_links(classes: DataFrame, percent: int = PERCENT, node_rows: int = NODE_ROWS,
                    max_depth: int = MAX_DEPTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of classes (id, n_shingles, trees, sketch): for each class with candidates one link to
    its best lower partner (a, b), further candidate links (a < b), and the members
    (key, part, id, n_shingles, sketch) of nodes whose pairs these do not all hold.

    A depth is a table of (key, id); sketches are joined only to classes that share a node."""
    sketches = classes.select("id", "n_shingles", "sketch")
    rows = stored(classes.select("id", F.explode("trees").alias("key")), "rows")
    made = None
    for depth in range(max_depth + 1):
        sizes = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
        children = None
        large = sizes.where(F.col("size") > node_rows)
        if depth < max_depth and not large.isEmpty():
            held = rows.hint("merge").join(large, "key").hint("merge").join(sketches.select("id", "sketch"), "id").select(
                "key", "size", "id", "sketch", F.explode(F.sequence(F.lit(1), F.lit(BRANCHES))).alias("branch"))
            place = F.pmod(F.xxhash64("key", "branch"), F.lit(SKETCH)).cast("int")
            branches = stored(held.select("key", "size", "id", F.xxhash64(
                "key", "branch", F.substring("sketch", place + 1, F.lit(1))).alias("child")), "branches")
            work = branches.groupBy("key", "size", "child").agg(F.count(F.lit(1)).cast("double").alias("n")).groupBy(
                "key", "size").agg(F.sum(F.col("n") * F.col("n")).alias("work"))
            split = stored(work.where(F.col("work") <= WORTH * F.col("size") * F.col("size")).select("key"), "split-nodes")
            if not split.isEmpty():
                children = stored(branches.hint("merge").join(split, "key").select("id", F.col("child").alias("key")), "rows")
                sizes = sizes.hint("merge").join(split, "key", "left_anti")
        members = rows.hint("merge").join(sizes, "key").hint("merge").join(sketches, "id").select(
            "key",
            F.when(F.col("size") > node_rows,
                   F.pmod(F.xxhash64("id", "key"), F.ceil(F.col("size") / node_rows))).otherwise(0).cast("int").alias("part"),
            (F.col("size") > node_rows).alias("big"), "id", "n_shingles", "sketch")
        some = stored(_compare_nodes(members.repartition("key", "part").sortWithinPartitions("key", "part", "id"), percent),
                      f"nodes-{depth}")
        made = some if made is None else made.unionAll(some)
        if children is None:
            break
        rows = children
    # Of the trees' best lower partners of a class the best (ties: the smallest id).
    lower = made.where(F.col("kind") == LOWER).groupBy("a").agg(F.max(F.struct("key", (-F.col("b")).alias("b"))).alias("m"))
    listed = made.where(F.col("kind") == MEMBER).select(
        "key", F.col("b").cast("int").alias("part"), F.col("a").alias("id"), "n_shingles", "sketch")
    return (lower.select("a", (-F.col("m.b")).alias("b")), made.where(F.col("kind") == FURTHER).select("a", "b").distinct(), listed)


def between(links: DataFrame, found: DataFrame) -> DataFrame:
    """The links whose ends are of different components (id, component); an id that is not in
    ``found`` is its own."""
    ends = links
    for end in ("a", "b"):
        name = found.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))
        ends = ends.hint("merge").join(name, end, "left")
    return ends.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents, without those of no use if ``wanted`` (distinct
    doc_ids) are few enough to broadcast; a join with the wanted ids has to follow."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull())
    if row_count_at_most(wanted, FEW):  # texts of a few links need not all be shuffled
        texts = texts.join(F.broadcast(wanted), "doc_id", "left_semi")
    return texts


def wide_sketches(docs: DataFrame, ids: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(id, wide): the second sketch of the documents ``ids`` (doc_id, distinct). A doc_id that
    repeats with different sets has none."""

    def run(part, texts):
        return {"id": part.column(0), "wide": pa.array([tokens(shingles(t, size), _wide()) for t in texts], pa.binary())}

    made = map_texts(_texts(docs, ids).hint("merge").join(ids, "doc_id").select("doc_id", "text"), run, "id long, wide binary")
    made = made.groupBy("id").agg(F.min("wide").alias("wide"), F.max("wide").alias("other"))
    return made.where(F.col("wide") == F.col("other")).select("id", "wide")


def unconnected_links(listed: DataFrame, found: DataFrame, docs: DataFrame, percent: int = PERCENT,
                      size: int = SHINGLE) -> DataFrame:
    """Candidate links (a < b, distinct) of the nodes ``listed``: all similar pairs whose
    components in ``found`` (id, component) differ. Each block meets every other."""
    rows = listed.join(found.hint("merge"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    nodes = rows.groupBy("key").agg((F.max("part") + 1).alias("blocks"), F.min("component").alias("x"), F.max("component").alias("y"))
    rows = stored(rows.join(nodes.where("x <> y").select("key", "blocks").hint("merge"), "key"), "in-doubt")
    if rows.isEmpty():
        return rows.select(F.col("id").alias("a"), F.col("id").alias("b"))
    wide = wide_sketches(docs, rows.select(F.col("id").alias("doc_id")).distinct(), size)
    rows = rows.hint("merge").join(wide, "id", "left")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "id",
                       "n_shingles", "sketch", "component", "wide")
    return _unconnected_pairs(rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "id"), percent).distinct()


def confirm(links: DataFrame, docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The links whose full sets have 100 * intersection >= percent * union. The documents
    are shuffled once, to the ends of the links; a link's two texts then meet. Both sides
    grow with the documents, so neither is broadcast; only a list of at most ``FEW`` ids is,
    to leave out the texts that no link needs."""
    numbered = links.select("a", "b", F.explode(F.array("a", "b")).alias("doc_id"))
    texts = _texts(docs, numbered.select("doc_id").distinct())
    ends = numbered.hint("merge").join(texts, "doc_id").select("a", "b", "doc_id", "text")

    def sets(batches):
        """The set of each end; the rows of a document follow one another."""
        last, packed = None, b""
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part, made = batch.slice(start, 256), []
                for text in part.column(3).to_pylist():
                    if text != last:
                        last, packed = text, shingles(text, size).tobytes()
                    made.append(packed)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(made, pa.binary())], ["a", "b", "doc_id", "s"])

    def run(batches):
        held: dict[int, set[bytes]] = {}  # of each end; more than one if its doc_id repeats
        link, good = None, []

        def linked(x, y):
            both = len(np.intersect1d(x, y, assume_unique=True))
            return 100 * both >= percent * (len(x) + len(y) - both)

        def close():
            if len(held) == 2:
                one, two = ([np.frombuffer(s, np.uint64) for s in found] for found in held.values())
                if any(linked(x, y) for x in one for y in two):
                    good.append(link)
            held.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns)):
                    if row[:2] != link:
                        close()
                        link = row[:2]
                    held.setdefault(row[2], set()).add(row[3])
        close()
        yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in good], pa.int64()) for i in (0, 1)], ["a", "b"])

    ends = ends.mapInArrow(sets, "a long, b long, doc_id long, s binary")
    return ends.repartition("a", "b").sortWithinPartitions("a", "b", "doc_id").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id with a link: the smallest id reachable. Each round takes
    the least label of the neighbours and then the label of that label; rounds are tables
    in the shared folder."""
    both = stored(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("id"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("component").alias("m"))
        # An id's label has a label of its own; take the lower of that and the neighbours'.
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("j"))
        new = labels.join(jump, "component").join(near.withColumnRenamed("a", "id"), "id").select(
            "id", F.least("component", "j", "m").alias("component"), F.col("component").alias("old"))
        new = stored(new, "labels")
        labels = new.select("id", "component")
        if new.where("component <> old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, miss: float = MISS,
                    node_rows: int = NODE_ROWS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document row.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets;
    ``component_id`` is the smallest doc_id reachable over links, itself included, and
    ``kept`` marks the document that has it. Texts that are null, empty or without a word
    have an empty set and are linked with nothing. Rows of a null doc_id cannot be named by
    others: they get a null component and are kept. Rows that repeat a doc_id are one
    document (their links count together) and give a row each. Other columns are
    ignored."""
    trees = trees_for(percent, miss)
    signed = stored(signatures(docs, trees, size), "signatures")
    named = signed.where("n_shingles > 0 and doc_id is not null")
    classes = stored(named.groupBy("fp1", "fp2").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"),
        F.first("trees").alias("trees"), F.first("sketch").alias("sketch")), "classes")
    lower, further, listed = candidate_links(classes.drop("fp1", "fp2"), percent, node_rows, max_depth)
    # Members of a class, and repeated doc_ids with different sets, are links as well.
    repeated = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    again = (named.join(repeated, "doc_id").join(classes.select("fp1", "fp2", "id"), ["fp1", "fp2"])
             .select(F.col("id").alias("a"), F.col("doc_id").alias("b")).where("a <> b"))
    tried = stored(lower.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "candidates")
    confirmed = stored(confirm(tried, docs, percent, size).unionAll(again), "confirmed")
    found = components(confirmed)
    for candidates in (lambda: between(further, found), lambda: unconnected_links(listed, found, docs, percent, size)):
        more = stored(candidates().hint("merge").join(tried, ["a", "b"], "left_anti"), "candidates")
        if not more.isEmpty():
            good = stored(confirm(more, docs, percent, size), "confirmed")
            tried = tried.unionAll(more)
            if not good.isEmpty():
                confirmed = confirmed.unionAll(good)
                found = components(confirmed)
    class_of = classes.select("fp1", "fp2", F.col("id").alias("class_id")).join(
        found.withColumnRenamed("id", "class_id"), "class_id", "left").select(
        "fp1", "fp2", F.coalesce("component", "class_id").alias("class_component"))
    own = found.select(F.col("id").alias("doc_id"), F.col("component").alias("own_component"))
    out = (signed.select("doc_id", "n_shingles", "fp1", "fp2").join(class_of, ["fp1", "fp2"], "left")
           .join(own, "doc_id", "left"))
    component = F.when(F.col("n_shingles") == 0, F.coalesce("own_component", "doc_id")).otherwise(
        F.least("class_component", "own_component", "doc_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, without the documents that ``near_duplicates`` does
    not keep; of rows that repeat a doc_id, one. Rows of a null doc_id stay."""
    found = near_duplicates(docs, **options)
    found = stored(found.select("doc_id", "kept"), "kept")
    # The dropped ids grow with the documents: never broadcast.
    left = docs.join(found.where("not kept").select("doc_id").distinct().hint("merge"), "doc_id", "left_anti")
    repeated = found.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    if not repeated.isEmpty():
        left = left.join(repeated, "doc_id", "left_anti").unionByName(
            left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return left.select(docs.columns)


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
    GROUP BY ALL) p JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
  WHERE 100 * p.c >= 75 * (m.n + n.n - p.c)),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id <= coalesce(m, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""
