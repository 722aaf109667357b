"""Best-fit packing of documents into sequences (operator 12): patterns by non-negative
least squares.

1. One pass over the texts makes the pieces: a document of at most ``window`` tokens is one
   piece; a longer one is cut into whole windows, its first piece takes what is left over.
   Each piece gets its place among the task's pieces of its length. The table is written.
2. The counts of each length (at most ``window`` numbers) go to the driver. There, patterns of
   few documents that fill a window exactly are enumerated, and non-negative least squares
   fits how often each is repeated; the numbers are rounded down to what the counts hold.
3. The rest is packed best-fit decreasing, still by counts: a group of equal sequences takes
   a length together, so the work depends on the number of lengths, not of documents.
4. The plan says, for each length, which places of which sequences its first, second, ...
   piece takes. Pieces get their number among all of their length (place in the task, plus
   the pieces of earlier tasks: prefix sums per length) and look their place up.

So the whole corpus is packed as one, and the driver and the plan are bounded by the number
of lengths: a sequence has at most 44 different lengths (1 + 2 + ... + 44 < 1024), and there
are a few thousand groups of sequences at most, whatever the number of documents.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldspot.llm.common import importable, stored, text_slices

WINDOW = 1024
END_ID = 2
ID_BYTES = 4
CACHE_BYTES = 48 << 20  # of chunks and their ids that a worker remembers, about
CACHED_CHARS = 48  # longer chunks are not remembered
LONG_WORD = 1000  # merging by ranks takes time quadratic in a word

# The splitting rule and the special token of the vocabulary file, and white
# space (Unicode White_Space).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPECIAL = "<|endoftext|>"

_CHUNKS = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+").findall


def _letter_bytes() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the other bytes in order for the characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """Token bytes to ids of a byte-level vocabulary file whose ids grow in the order of its
    merges, so that the id of a token is also its rank; else None."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters, vocabulary = _letter_bytes(), model["vocab"]
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        return None
    tokens = [t for t, i in vocabulary.items() if t in letters] + ["".join(
        m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    return {bytes(letters[c] for c in t): vocabulary[t] for t in tokens}


class TokenIds:
    """Text to ids (little-endian unsigned 32-bit), those of the tokenizer file.

    Latin-1 texts, whose classes of characters are the same in every Unicode version, are
    merged by ranks in one call (``merge_ranks``). Other texts, and those with a very long
    word, go to the tokenizer: its own words never reach from a non-space into white space, so
    the text is cut there and chunks met before are remembered. A text that holds the special
    token goes to the tokenizer whole. All three ways give the same ids."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer, self.cache_bytes = Tokenizer.from_file(path), cache_bytes
        self.known: dict[str, bytes] = {}
        self.held = 0
        ranks = merge_ranks(path)
        self.merge = ranks and tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, texts: list[str]):
        for i in range(0, len(texts), 1024):
            for made in self.tokenizer.encode_batch_fast(texts[i:i + 1024], add_special_tokens=False):
                yield np.asarray(made.ids, "<u4").tobytes()

    def simple(self, text: str) -> bool:
        """Whether the text may be merged by ranks."""
        if not self.merge or _SPECIAL in text:
            return False
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
        words = text.split()
        blanks = len(text) - sum(map(len, words)) - len(words)
        return max(map(len, words), default=0) <= LONG_WORD and blanks <= LONG_WORD

    def packed(self, texts: list[str]) -> list[bytes]:
        made: list[bytes | None] = [
            self.merge.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes() if self.simple(t) else None for t in texts]
        rest = [i for i, ids in enumerate(made) if ids is None]
        for i, ids in zip(rest, self.by_chunks([texts[i] for i in rest])):
            made[i] = ids
        return made

    def by_chunks(self, texts: list[str]) -> list[bytes]:
        if self.held > self.cache_bytes:
            self.known, self.held = {}, 0
        cut = [[] if _SPECIAL in t else _CHUNKS(t) for t in texts]
        new = list(set().union(*cut).difference(self.known))
        short = [c for c in new if len(c) <= CACHED_CHARS]
        long = [c for c in new if len(c) > CACHED_CHARS]
        for chunk, ids in zip(short, self._encode(short)):
            self.known[chunk] = ids
            self.held += 200 + len(ids)
        once = dict(zip(long, self._encode(long)))
        return [next(self._encode([t])) if _SPECIAL in t else
                b"".join(once[x] if len(x) > CACHED_CHARS else self.known[x] for x in c) for t, c in zip(texts, cut)]


@lru_cache(maxsize=2)
def _token_ids(path: str) -> TokenIds:
    return TokenIds(path)


def cuts(total: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` tokens."""
    first = total % window or window
    return [(0, first)] + [(start, window) for start in range(first, total, window)]


CUT_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth) of every document; ``nth`` counts
    the pieces of a length in the task ``part``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    importable(docs.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(CUT_SCHEMA))
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        ids_of, part = _token_ids(tokenizer), TaskContext.get().partitionId()
        seen = [0] * (window + 1)
        rows: list[tuple] = []
        for batch, texts in text_slices(batches):
            for doc, ids in zip(batch.column(0).to_pylist(), ids_of.packed([t or "" for t in texts])):
                ids += end
                for number, (start, length) in enumerate(cuts(len(ids) // ID_BYTES, window)):
                    crc = zlib.crc32(ids[start * ID_BYTES:(start + length) * ID_BYTES])
                    rows.append((doc, number, start, length, crc, part, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
            rows = []

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, CUT_SCHEMA)


def patterns(counts: np.ndarray) -> np.ndarray:
    """Ways to fill a window exactly with few documents of the lengths that occur: rows of
    lengths, ascending, filled up with zeros: one to three documents of any lengths, and up
    to eight of at most two lengths."""
    window = len(counts) - 1
    have = counts > 0
    have[0] = False
    lengths = np.flatnonzero(have)
    found = [np.array([[window]])] if have[window] else []
    a, b = (m.ravel() for m in np.meshgrid(lengths, lengths, indexing="ij"))
    a, b = a[a <= b], b[a <= b]
    c = window - a - b
    two = c == 0
    found.append(np.stack([a[two], b[two]], 1))
    three = c >= b
    three[three] = have[c[three]]
    found.append(np.stack([a[three], b[three], c[three]], 1))
    for of_a in range(1, 8):  # of_a documents of length a and of_b of length b
        for of_b in range(1, 9 - of_a):
            rest = window - of_a * lengths
            ok = (rest > 0) & (rest % of_b == 0) & (of_a + of_b > 3)
            a, b = lengths[ok], rest[ok] // of_b
            ok = have[b] & ((a != b) | (of_b == 1))
            found.append(np.repeat(np.stack([a[ok], b[ok]], 1), [of_a, of_b], axis=1))
    made = np.zeros((sum(map(len, found)), 8), np.int64)
    at = 0
    for some in found:
        made[at:at + len(some), :some.shape[1]] = np.sort(some, axis=1)
        at += len(some)
    return np.unique(made, axis=0)


def fit(columns: np.ndarray, counts: np.ndarray, rounds: int = 80, together: int = 64) -> np.ndarray:
    """Non-negative x with sum_j x_j * (lengths of pattern j) near ``counts``: least squares by
    active sets. Each round lets in the patterns with the steepest slopes that have no length
    in common with one another, at most ``together``."""
    width = len(counts)
    x = np.zeros(len(columns))
    if not len(columns):
        return x
    rest = counts.astype(float)
    active: list[int] = []
    for _ in range(rounds):
        rest[0] = 0
        slope = rest[columns].sum(axis=1)
        slope[active] = -1
        taken = np.zeros(width, bool)
        new = []
        for j in np.argsort(-slope, kind="stable")[:together * 32]:
            if slope[j] <= 0.5 or len(new) == together:
                break
            lengths = columns[j][columns[j] > 0]
            if not taken[lengths].any():
                taken[lengths] = True
                new.append(int(j))
        if not new or len(active) + len(new) > 2 * width:
            break
        active += new
        while active:
            a = np.zeros((len(active), width))
            np.add.at(a, (np.arange(len(active))[:, None], columns[active]), 1.0)
            a[:, 0] = 0
            gram = a @ a.T
            gram[np.diag_indices_from(gram)] += 1e-6
            z = np.linalg.solve(gram, a @ counts)
            if z.min() > 1e-9:
                x[:] = 0
                x[active] = z
                rest = counts - z @ a
                break
            old = x[active]
            low = z <= 1e-9
            step = np.min(old[low] / np.maximum(old[low] - z[low], 1e-12))
            x[active] = np.maximum(old + step * (z - old), 0)
            kept = [j for j, l in zip(active, low) if not (l and x[j] <= 1e-9)]
            x[[j for j, l in zip(active, low) if l and x[j] <= 1e-9]] = 0
            active = kept if len(kept) < len(active) else [j for j, l in zip(active, low) if not l]
    return x


class Group(NamedTuple):
    """``times`` equal sequences: lengths and how many of each, in their order."""

    times: int
    parts: tuple[tuple[int, int], ...]


def best_fit(counts: np.ndarray) -> list[Group]:
    """Best-fit decreasing over counts of lengths: a length goes to the sequences with the
    least room that can take it, group by group."""
    window = len(counts) - 1
    room: list[list[Group]] = [[] for _ in range(window + 1)]
    left = [int(c) for c in counts]
    for length in range(window, 0, -1):
        while left[length]:
            space = next((r for r in range(length, window) if room[r]), None)
            if space is None:
                each = window // length
                full, last = divmod(left[length], each)
                if full:
                    room[window - each * length].append(Group(full, ((length, each),)))
                if last:
                    room[window - last * length].append(Group(1, ((length, last),)))
                left[length] = 0
                break
            group = room[space].pop()
            take = min(left[length], group.times)
            if take < group.times:
                room[space].append(Group(group.times - take, group.parts))
            parts = group.parts
            if parts[-1][0] == length:
                parts = parts[:-1] + ((length, parts[-1][1] + 1),)
            else:
                parts += ((length, 1),)
            room[space - length].append(Group(take, parts))
            left[length] -= take
    return [g for groups in room for g in groups]


def plan_groups(counts: np.ndarray) -> list[Group]:
    """All sequences for ``counts`` pieces of each length (index: length, from 0)."""
    left = counts.astype(np.int64).copy()
    columns = patterns(left)
    x = fit(columns, left)
    groups = []
    for j in np.argsort(-x, kind="stable"):
        if x[j] < 0.5:
            break
        lengths, of_each = np.unique(columns[j][columns[j] > 0], return_counts=True)
        times = int(min(round(x[j]), (left[lengths] // of_each).min()))
        if times:
            left[lengths] -= times * of_each
            groups.append(Group(times, tuple(zip(lengths.tolist(), of_each.tolist()))))
    return groups + best_fit(left)


class Plan(NamedTuple):
    """Segments sorted by length and first place: the pieces ``first`` ... of a length go,
    ``each`` at a time, to the sequences from ``sequence`` on, from ``offset`` on."""

    key: np.ndarray  # length, first as one number
    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


_PLACES = 1 << 50  # more than the pieces of any length


def make_plan(counts: np.ndarray) -> Plan:
    rows, used, sequence = [], {}, 0
    for times, parts in plan_groups(counts):
        offset = 0
        for length, each in parts:
            first = used.get(length, 0)
            rows.append((length, first, each, sequence, offset))
            used[length] = first + times * each
            offset += length * each
        sequence += times
    length, first, each, seq, offset = (np.array(c, np.int64) for c in zip(*sorted(rows))) if rows else (
        np.zeros(0, np.int64) for _ in range(5))
    return Plan(length * _PLACES + first, length, first, each, seq, offset)


def places(plan: Plan, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the ``number``-th piece (from 0) of a length."""
    at = np.searchsorted(plan.key, length * _PLACES + number, side="right") - 1
    within = number - plan.first[at]
    each = plan.each[at]
    return plan.sequence[at] + within // each, plan.offset[at] + within % each * length


PIECE_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
                "sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``window`` tokens
    (``PIECE_SCHEMA``). A document is its ids and ``end_id``; only one of more than ``window``
    tokens is cut, into pieces of ``window`` tokens, of which the first may be shorter.
    Sequences are numbered from 0 and filled from offset 0 without gaps.

    Null and empty texts are one piece, the end id. Rows that repeat, or have a null doc_id,
    are packed like any other. An empty table gives no rows. Other columns are ignored."""
    cut = stored(pieces(docs, tokenizer, end_id, window), "pieces")
    tasks = stored(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = np.zeros(window + 1, np.int64)
    for row in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``window`` rows
        counts[row["length"]] = row["n"]
    plan = make_plan(counts)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    numbered = cut.join(tasks.select("part", "length", before.alias("before")).hint("merge"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("number"))

    def run(batches):
        for batch in batches:
            length, number = (batch.column(i).to_numpy() for i in (3, 5))
            sequence, offset = places(plan, length, number)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[
                "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(run, PIECE_SCHEMA)
