"""Tries over sorted ranges: what neighbouring ranges share.

A sorted table is dealt into ranges, one per partition, and every task builds the trie of
its own range. A node lies in several ranges only if it is a prefix that the last key of a
range and the first key of the next have in common. So two keys per partition are all that
has to be known elsewhere to give such nodes one name and every other node a local one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot.plans.sizing import cut_lineage


class Shared(NamedTuple):
    """Prefixes that a range shares with the range before (``head``) and after (``tail``):
    the longest one, and for each depth from 0 the number that names it (its owner: the
    first range that shares it; with the depth this is the node's name)."""

    head: object = None
    head_owner: tuple = ()
    tail: object = None
    tail_owner: tuple = ()


def common_units(a, b, width: int = 1) -> int:
    """How many leading units of ``width`` characters or bytes are equal."""
    most, k = min(len(a), len(b)) // width, 0
    if a[:most * width] == b[:most * width]:
        return most
    while a[k * width:(k + 1) * width] == b[k * width:(k + 1) * width]:
        k += 1
    return k


def sorted_ranges(rows: DataFrame, column: str, width: int = 1) -> tuple[DataFrame, dict[int, Shared]]:
    """The rows in ranges sorted by ``column`` (in the shared checkpoint folder, so a range
    stays the same when it is read again), and what each partition shares. The driver gets
    the first and last key of each partition, nothing else."""
    fixed = cut_lineage(rows.repartitionByRange(column).sortWithinPartitions(column))
    ends = sorted((r["part"], r["low"], r["high"]) for r in fixed.groupBy(
        F.spark_partition_id().alias("part")).agg(F.min(column).alias("low"), F.max(column).alias("high")).collect())
    return fixed, shared_prefixes([(p, _plain(low), _plain(high)) for p, low, high in ends], width)


def _plain(key):
    return bytes(key) if isinstance(key, bytearray) else key


def shared_prefixes(ends: list[tuple], width: int = 1) -> dict[int, Shared]:
    """``ends``: (partition, first key, last key) in key order."""
    heads: list[tuple] = []  # of each border: longest common prefix and its owners by depth
    for i in range(1, len(ends)):
        last, first = ends[i - 1][2], ends[i][1]
        depth = common_units(last, first, width)
        prefix = first[:depth * width]
        owner = [i] * (depth + 1)
        if heads:
            before, owners = heads[-1]
            same = common_units(before, prefix, width)
            owner[:same + 1] = owners[:same + 1]
        heads.append((prefix, tuple(owner)))
    borders = [(None, ()), *heads, (None, ())]
    return {part: Shared(*borders[i], *borders[i + 1]) for i, (part, _, _) in enumerate(ends)}
