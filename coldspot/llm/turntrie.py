"""Conversation prefix trie (operator 13): adaptive radix trees over turn ids.

1. A turn (role, text) becomes a big-endian id of fixed width: 16 bytes of SHA-256 and the
   text's length in bytes (4). Equal turns have equal ids wherever they are, so no table of
   turns is joined, and a turn that opens a third of all conversations costs nothing. From
   here no text is shuffled.
2. Turns meet by the id of the conversation that lends its head (five conversations at most),
   are sorted, and joined to one byte string: the rebuilt conversation.
3. Equal conversations become one key. Their ids are sorted over all tasks by range and
   written as comma-joined stretches of at most ``STRETCH`` ids; a task that hashes the ends
   of a group of copies reads a few stretches, not the group's rows, and holds one of them.
4. Distinct keys are dealt into sorted ranges; every task builds the adaptive radix tree of its
   range (nodes of 4, 16, 48 or 256 places, compressed paths) and walks it bottom up. Only
   byte depths at the end of a turn give nodes; a compressed path gives one for each of them.
5. A node lies in several ranges only if it is a prefix of a border (see ``ranges``). Those
   nodes are given in parts; the driver adds up the parts, at most the turns of the common
   prefix of two neighbouring ranges for each range.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldspot.llm.common import importable, stored
from coldspot.llm.duck import CRC32
from coldspot.llm.ranges import Shared, sorted_ranges

SIZE_BYTES = 4
WIDTH = 16 + SIZE_BYTES
GROUP = 5  # conversation c takes its head from c - c % GROUP
HEADS = 9  # and the head has crc32(c) % HEADS turns
STRETCH = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- rebuilt conversations ---------------------------------------------------------------


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id): ``id`` is the turn's id in hexadecimal digits."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * (WIDTH - SIZE_BYTES))
    size = F.lpad(F.hex(F.octet_length(text)), 2 * SIZE_BYTES, "0")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.concat(digest, size).alias("id"))


def rebuilt(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """(conv_id, seq, k): each conversation's turn ids after the exchange of heads, as bytes,
    and a digest of them."""
    c = F.col("conv_id")
    turns = (turn_ids(conversations).withColumn("base", c - c % group).repartition("base").groupBy("base", "conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "id"))).alias("t")))
    # One task holds the at most ``group`` conversations of a base; a head is short.
    turns = turns.select("base", "conv_id", F.transform("t", lambda x: x["id"]).alias("t"))
    lent = F.first(F.when(F.col("base") == c, F.slice("t", 1, heads - 1)), ignorenulls=True).over(
        Window.partitionBy("base").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")
    turns = turns.withColumn("lent", F.coalesce(lent, F.array().cast("array<string>"))).withColumn("h", h)
    made = F.concat(F.slice("lent", F.lit(1), F.col("h")), F.slice("t", F.col("h") + 1, F.size("t")))
    seq = F.unhex(F.array_join(made, ""))
    return turns.select("conv_id", seq.alias("seq")).withColumn("k", F.unhex(F.substring(F.sha2("seq", 256), 1, 32)))


def _stretches(members: DataFrame, most: int) -> DataFrame:
    """Of (k, conv_id), sorted in their partition: (k, low, n, ids), stretches of at most
    ``most`` ids, comma-joined."""
    schema = pa.schema([("k", pa.binary()), ("low", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])

    def run(batches):
        key, held, rows = None, [], []

        def close():
            if held:
                rows.append((key, held[0], len(held), ",".join(map(str, held))))
                held.clear()

        for batch in batches:
            for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key or len(held) == most:
                    close()
                    key = k
                held.append(conv)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return members.mapInArrow(run, "k binary, low long, n long, ids string")


def ends(members: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(k, n, low, ends) of (k, conv_id): how many ids a key has, the smallest, and the SHA-256
    of all, ascending and comma-joined."""
    importable(members.sparkSession)
    made = stored(_stretches(members.repartitionByRange("k", "conv_id").sortWithinPartitions("k", "conv_id"), stretch), "stretches")
    schema = pa.schema([("k", pa.binary()), ("n", pa.int64()), ("low", pa.int64()), ("ends", pa.string())])

    def run(batches):
        key, n, low, digest, rows = None, 0, 0, None, []
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                for k, first, count, ids in zip(*(c.to_pylist() for c in whole.slice(start, 64).columns)):
                    if k != key:
                        if digest is not None:
                            rows.append((key, n, low, digest.hexdigest()))
                        key, n, low, digest = k, 0, first, hashlib.sha256()
                    digest.update((("," if n else "") + ids).encode())
                    n += count
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                (key, n, low, digest.hexdigest()), schema)], schema=schema)

    return made.repartition("k").sortWithinPartitions("k", "low").mapInArrow(run, "k binary, n long, low long, ends string")


# --- adaptive radix tree -----------------------------------------------------------------


class SmallNode:
    """Up to 4 or 16 children: their bytes in order, and the children."""

    __slots__ = ("prefix", "value", "places", "bytes", "kids")

    def __init__(self, prefix: bytes, value=None, places: int = 4):
        self.prefix, self.value, self.places = prefix, value, places
        self.bytes, self.kids = bytearray(), []

    def child(self, byte: int):
        at = self.bytes.find(byte)
        return None if at < 0 else self.kids[at]

    def full(self) -> bool:
        return len(self.kids) == self.places

    def put(self, byte: int, node) -> None:
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = node
        else:
            self.bytes.insert(at, byte)
            self.kids.insert(at, node)

    def items(self):
        return zip(self.bytes, self.kids)

    def larger(self):
        made = SmallNode(self.prefix, self.value, 16) if self.places == 4 else IndexedNode(self.prefix, self.value)
        for byte, node in self.items():
            made.put(byte, node)
        return made


class IndexedNode:
    """Up to 48 children: a table from byte to place, and the children."""

    __slots__ = ("prefix", "value", "index", "kids")
    places = 48

    def __init__(self, prefix: bytes, value=None):
        self.prefix, self.value = prefix, value
        self.index, self.kids = bytearray(256), []

    def child(self, byte: int):
        at = self.index[byte]
        return self.kids[at - 1] if at else None

    def full(self) -> bool:
        return len(self.kids) == self.places

    def put(self, byte: int, node) -> None:
        if self.index[byte]:
            self.kids[self.index[byte] - 1] = node
        else:
            self.kids.append(node)
            self.index[byte] = len(self.kids)

    def items(self):
        return ((byte, self.kids[at - 1]) for byte, at in enumerate(self.index) if at)

    def larger(self):
        made = DirectNode(self.prefix, self.value)
        for byte, node in self.items():
            made.put(byte, node)
        return made


class DirectNode:
    """A place for each of 256 bytes."""

    __slots__ = ("prefix", "value", "kids")
    places = 256

    def __init__(self, prefix: bytes, value=None):
        self.prefix, self.value, self.kids = prefix, value, [None] * 256

    def child(self, byte: int):
        return self.kids[byte]

    def full(self) -> bool:
        return False

    def put(self, byte: int, node) -> None:
        self.kids[byte] = node

    def items(self):
        return ((byte, node) for byte, node in enumerate(self.kids) if node is not None)


class RadixTree:
    """Adaptive radix tree of byte strings; a key may be the prefix of another."""

    def __init__(self):
        self.root = None

    def insert(self, key: bytes, value) -> None:
        if self.root is None:
            self.root = SmallNode(key, value)
            return
        node, parent, via, at = self.root, None, 0, 0

        def replace(new):
            if parent is None:
                self.root = new
            else:
                parent.put(via, new)

        while True:
            prefix = node.prefix
            if not key.startswith(prefix, at):
                same = next((i for i, (x, y) in enumerate(zip(prefix, memoryview(key)[at:])) if x != y), len(key) - at)
                upper = SmallNode(prefix[:same])
                upper.put(prefix[same], node)
                node.prefix = prefix[same + 1:]
                at += same
                if at == len(key):
                    upper.value = value
                else:
                    upper.put(key[at], SmallNode(key[at + 1:], value))
                replace(upper)
                return
            at += len(prefix)
            if at == len(key):
                node.value = value
                return
            kid = node.child(key[at])
            if kid is None:
                if node.full():
                    node = node.larger()
                    replace(node)
                node.put(key[at], SmallNode(key[at + 1:], value))
                return
            node, parent, via, at = kid, node, key[at], at + 1


class _Below:
    """What the part of a tree below a byte depth adds up to: members, the smallest, a key that
    lies in it, and of the complete nodes: leaves, saved bytes, and the rows without parent."""

    __slots__ = ("n", "low", "key", "leaves", "saved", "tops")

    def __init__(self):
        self.n, self.low, self.key, self.leaves, self.saved, self.tops = 0, None, None, 0, 0, []

    def add(self, other: _Below) -> None:
        self.n += other.n
        self.low = other.low if self.low is None else min(self.low, other.low)
        self.key = self.key or other.key
        self.leaves += other.leaves
        self.saved += other.saved
        self.tops += other.tops


# A node's row. Complete nodes: parent_conv_id, or the border (parent_owner, depth - 1) that
# names the parent. Nodes of a border (owner is set) are parts, to be added up.
NODE_SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
               "saved_tokens long, ends_sha256 string, owner long, parent_owner long, size long")


def trie_rows(tree: RadixTree, shared: Shared, width: int = WIDTH) -> list[list]:
    """Rows (``NODE_SCHEMA``) of the turn-aligned depths of a tree of (key: (n, low, ends, key))."""
    rows: list[list] = []
    borders = [(b, o) for b, o in ((shared.head, shared.head_owner), (shared.tail, shared.tail_owner)) if b is not None]

    def owner(key: bytes, depth: int):
        for border, owners in borders:
            if depth * width <= len(border) and key.startswith(border[:depth * width]):
                return owners[depth]
        return None

    def emit(below: _Below, depth: int, ended: str) -> _Below:
        size = int.from_bytes(below.key[depth * width - SIZE_BYTES:depth * width], "big") if depth else 0
        mine = owner(below.key, depth)
        above = _Below()
        above.n, above.low, above.key = below.n, below.low, below.key
        number = len(rows)
        if mine is None:
            leaves, saved = below.leaves or 1, below.saved + (below.n - 1) * size
            for top in below.tops:
                rows[top][2] = below.low
            rows.append([below.low, depth, None, below.n, len(below.tops), leaves, saved, ended, None, None, size])
            above.leaves, above.saved, above.tops = leaves, saved, [number]
        else:
            for top in below.tops:
                rows[top][9] = mine
            rows.append([below.low, depth, None, below.n, len(below.tops), below.leaves, below.saved, ended, mine,
                         owner(below.key, depth - 1) if depth else None, size])
        return above

    # Bottom up without recursion: (node, byte depth where its path starts, what lies below).
    stack = [(tree.root, 0, _Below(), iter(tree.root.items()))]
    while True:
        node, start, below, kids = stack[-1]
        kid = next(kids, None)
        if kid is not None:
            end = start + len(node.prefix)
            stack.append((kid[1], end + 1, _Below(), iter(kid[1].items())))
            continue
        stack.pop()
        end, ended = start + len(node.prefix), NO_ENDS
        if node.value is not None:
            n, low, ended, key = node.value
            own = _Below()
            own.n, own.low, own.key = n, low, key
            below.add(own)
        # Depths of this path: behind the parent's end; the root's path holds depth 0 as well.
        first = -(-start // width) if stack else 0
        for depth in range(end // width, first - 1, -1):
            below = emit(below, depth, ended if depth * width == end else NO_ENDS)
        if not stack:
            return rows
        stack[-1][2].add(below)


def _nodes(ranges: DataFrame, shared: dict[int, Shared]) -> DataFrame:
    """Of sorted ranges (seq, n, low, ends): the rows of each range's tree."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    importable(ranges.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(NODE_SCHEMA))

    def run(batches):
        tree = RadixTree()
        for batch in batches:
            for seq, n, low, ended in zip(*(c.to_pylist() for c in batch.columns)):
                tree.insert(seq, (n, low, ended, seq))
        if tree.root is not None:
            rows = trie_rows(tree, shared.get(TaskContext.get().partitionId(), Shared()))
            for i in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + 20_000]), arrow)], schema=arrow)

    return ranges.mapInArrow(run, NODE_SCHEMA)


def add_parts(parts: list) -> list[tuple]:
    """Nodes of borders from their parts (rows of ``NODE_SCHEMA``): (owner, and the result's
    columns)."""
    nodes: dict[tuple, dict] = {}
    for p in parts:
        node = nodes.setdefault((p["owner"], p["depth"]), {
            "low": p["conv_id"], "n": 0, "kids": 0, "leaves": 0, "saved": 0, "ends": NO_ENDS,
            "parent": (p["parent_owner"], p["depth"] - 1), "size": p["size"]})
        node["low"] = min(node["low"], p["conv_id"])
        for name, column in (("n", "n_convs"), ("kids", "n_children"), ("leaves", "n_leaves"), ("saved", "saved_tokens")):
            node[name] += p[column]
        if p["ends_sha256"] != NO_ENDS:  # one range holds the sequence itself
            node["ends"] = p["ends_sha256"]
    made = []
    for (owner, depth), node in sorted(nodes.items(), key=lambda kv: -kv[0][1]):
        node["leaves"] = node["leaves"] or 1
        node["saved"] += (node["n"] - 1) * node["size"]
        above = nodes.get(node["parent"])
        if above is not None:
            above["kids"] += 1
            above["leaves"] += node["leaves"]
            above["saved"] += node["saved"]
        made.append((owner, node["low"], depth, above, node))
    return [(owner, low, depth, above["low"] if above is not None else None, node["n"], node["kids"], node["leaves"],
             node["saved"], node["ends"]) for owner, low, depth, above, node in made]


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(conversations: DataFrame, group: int = GROUP, heads: int = HEADS, stretch: int = STRETCH) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations (columns ``COLUMNS``).

    Turns are ordered by ``turn`` (null first; equal ones by the digest of role and text);
    null role or text is the empty string. Conversation c becomes the first h turns of
    conversation c - c % ``group`` and its own turns after its first h; h is the crc32 of c in
    decimals, modulo ``heads``. A node is a distinct sequence of first turns, from the root
    (depth 0). ``conv_id`` is the smallest member (a conversation that starts with it),
    ``parent_conv_id`` the parent's; ``n_leaves`` and ``saved_tokens`` are sums over the
    node's subtree; ``ends_sha256`` is of the members that end at the node.

    Rows of a null conv_id belong to no conversation and are left out. Repeated rows are turns
    of their own. A conversation may be without turns: then it is a member of the root only.
    An empty table gives no rows. Texts of any length are read whole; other columns are
    ignored. A conversation's ids (20 bytes a turn) are one value of one row."""
    spark = conversations.sparkSession
    made = stored(rebuilt(conversations, group, heads), "rebuilt")
    distinct = made.select("k", "seq").distinct()
    keys = distinct.join(ends(made.select("k", "conv_id"), stretch).hint("merge"), "k").select("seq", "n", "low", "ends")
    rows, shared = sorted_ranges(keys, "seq", WIDTH)
    nodes = stored(_nodes(rows, shared), "trie-nodes")
    borders = spark.createDataFrame(
        add_parts(nodes.where("owner is not null").collect()),
        "owner long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
    complete = nodes.where("owner is null")
    parents = borders.select(F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("p"))
    complete = complete.join(parents, ["parent_owner", "depth"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "p"))
    return complete.select(*COLUMNS).unionAll(borders.select(*COLUMNS))


ORACLE_SQL = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, octet_length(encode(coalesce(text, ''))) AS bytes, turn,
         sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS k FROM turns),
keys AS (SELECT DISTINCT conv_id::VARCHAR AS s FROM turns),
""" + CRC32.strip() + r""",
convs AS (SELECT DISTINCT conv_id, h % 9 AS h FROM turns JOIN crc32s ON s = conv_id::VARCHAR),
joined AS (
  SELECT c.conv_id, id, bytes, k FROM convs c JOIN numbered n ON n.conv_id = c.conv_id - c.conv_id % 5 AND k <= h
  UNION ALL
  SELECT c.conv_id, id, bytes, k + h FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND k > h),
rebuilt AS (
  SELECT conv_id, list(id ORDER BY k) FILTER (id IS NOT NULL) AS ids, list(bytes ORDER BY k) FILTER (id IS NOT NULL) AS sizes
  FROM convs LEFT JOIN joined USING (conv_id) GROUP BY conv_id),
members AS (
  SELECT conv_id, coalesce(len(ids), 0) AS turns, unnest(range(coalesce(len(ids), 0) + 1)) AS depth, ids, sizes FROM rebuilt),
paths AS (
  SELECT conv_id, turns, depth, coalesce(array_to_string(ids[1:depth], ''), '') AS path,
         coalesce(array_to_string(ids[1:depth - 1], ''), '') AS above, CASE WHEN depth = 0 THEN 0 ELSE sizes[depth] END AS bytes
  FROM members),
nodes AS (
  SELECT depth, path, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = depth), '')) AS ends_sha256
  FROM paths GROUP BY depth, path),
kids AS (SELECT above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
own AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)),
sums AS (
  SELECT p.path, sum((own.n_children = 0)::BIGINT) AS n_leaves, sum((own.n_convs - 1) * own.bytes) AS saved_tokens
  FROM own JOIN paths p ON p.conv_id = own.conv_id AND p.depth <= own.depth GROUP BY p.path)
SELECT own.conv_id, own.depth, CASE WHEN own.depth > 0 THEN parent.conv_id END AS parent_conv_id, own.n_convs, own.n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, own.ends_sha256
FROM own JOIN sums USING (path) LEFT JOIN nodes parent ON parent.path = own.above
"""
