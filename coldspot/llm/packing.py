"""Packing documents into fixed windows (operator 3).

Method: non-negative least squares over a length histogram. Each task tokenises its
documents and packs them in blocks of at most ``BLOCK_TOKENS`` tokens:

1. whole windows are cut off long documents; the rests are counted in a histogram of
   lengths (in units of ``UNIT`` tokens, rounded up);
2. shallow combinations of lengths that fill the window exactly are enumerated: up to
   three lengths, or two lengths repeated any number of times;
3. non-negative least squares (active set) finds how often each combination should be
   used so that the combinations consume the histogram;
4. the counts are rounded, largest first, as far as the documents reach;
5. what is left is packed greedily, longest first, and cut at the window's end; the last,
   unfinished window goes on into the task's next block, and at the end of the task it is
   cut into windows whose length is a power of two, which need no padding.

No shuffle and nothing on the driver: a lost task is repeated alone, and sequence ids are
made of the partition number and a count, so they are unique. Memory holds one block.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot.llm.common import importable, text_slices

WINDOW = 4096
UNIT = 16
BLOCK_TOKENS = 8 << 20
CACHE_WORDS = 600_000
CACHED_CHARS = 48  # longer words are remembered for one call only
ID_BYTES = 4

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long")

# Lower-cased Latin-1 texts are cut into the tokenizer's own words here, so that words are
# met again in the cache. The splitting rule of the vocabulary file,
# restricted to Latin-1 (letters, number characters, white space).
_LETTERS = "a-zªµºß-öø-ÿ"
_NUMBERS = "0-9²³¹¼½¾"
_LATIN_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^ \\t-\\r\\x85\\xa0{_LETTERS}{_NUMBERS}]+").findall
_CHUNKS = re.compile(r"[^ \t\n\r]+").findall


def pack_ids(*ids: int) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Text to packed ids; remembers the ids of words met before, but of very long ones."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.known: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_letters = {i: to_bytes.pre_tokenize_str(chr(i))[0][0] for i in range(256)}

    def _learn_words(self, words: Iterable[str]) -> None:
        """Words as the tokenizer's splitting gives them: straight to its model."""
        tokenize, letters = self.tokenizer.model.tokenize, self.byte_letters
        for word in words:
            self.known[word] = pack_ids(*[t.id for t in tokenize(word.translate(letters))])

    def _learn_chunks(self, chunks: list[str]) -> None:
        for i in range(0, len(chunks), 4096):
            some = chunks[i:i + 4096]
            for chunk, made in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False)):
                self.known[chunk] = pack_ids(*made.ids)

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text (little-endian unsigned 32-bit), without the end id. Words never
        reach across white space, so the ids of a text are those of its words in turn."""
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        cut, words, chunks = [], set(), set()
        for text in texts:
            try:
                if "<|" in text:  # may hold a special token, which is one word
                    raise ValueError
                text.encode("latin-1")
                cut.append(_LATIN_WORDS(text.lower()))
                words |= set(cut[-1]).difference(known)
            except ValueError:
                cut.append(_CHUNKS(text))
                chunks |= set(cut[-1]).difference(known)
        self._learn_chunks(list(chunks))
        self._learn_words(words)
        get = known.__getitem__
        packed = [b"".join(map(get, words)) for words in cut]
        for word in words | chunks:
            if len(word) > CACHED_CHARS:
                del known[word]
        return packed


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def combinations(present: np.ndarray, window: int) -> list[dict[int, int]]:
    """Ways to fill ``window`` units exactly from the lengths that occur: up to three
    lengths, or two lengths repeated."""
    have = np.zeros(window + 1, bool)
    have[present] = True
    found: dict[tuple, dict[int, int]] = {}

    def add(*parts: tuple[int, int]) -> None:
        made: dict[int, int] = {}
        for length, times in parts:
            if times:
                made[length] = made.get(length, 0) + times
        found.setdefault(tuple(sorted(made.items())), made)

    lengths = [int(v) for v in present if 0 < v <= window]
    for a in lengths:
        if window % a == 0:
            add((a, window // a))
        for b in lengths:
            if b < a:
                continue
            c = window - a - b
            if c >= b and have[c]:
                add((a, 1), (b, 1), (c, 1))
        for m in range(1, window // a):
            rest = window - m * a
            for n in range(1, 9):  # the second length at most eight times
                if rest % n == 0 and rest // n != a and have[rest // n]:
                    add((a, m), (rest // n, n))
    return list(found.values())


def least_squares(columns: list[dict[int, int]], counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative x with sum_j x_j * columns[j] near ``counts`` (active-set method)."""
    width, n = len(counts), len(columns)
    x = np.zeros(n)
    if not n:
        return x
    a = np.zeros((n, width), np.float32)
    for j, column in enumerate(columns):
        for length, times in column.items():
            a[j, length] = times
    passive: list[int] = []
    rest = counts.astype(float).copy()
    tolerance = 0.25
    for _ in range(steps):
        slope = a @ rest.astype(np.float32)
        slope[passive] = -1
        j = int(slope.argmax())
        if slope[j] <= tolerance:
            break
        passive.append(j)
        while True:
            p = a[passive].astype(float)
            gram = p @ p.T
            gram[np.diag_indices_from(gram)] += 1e-9
            z = np.linalg.solve(gram, p @ counts)
            if z.min() > 1e-9:
                break
            old = x[passive]
            low = z <= 1e-9
            step = np.min(old[low] / np.maximum(old[low] - z[low], 1e-12))
            old = old + step * (z - old)
            x[passive] = np.maximum(old, 0)
            kept = [q for q, v, l in zip(passive, old, low) if not (l and v <= 1e-9)]
            for q in set(passive) - set(kept):
                x[q] = 0
            if len(kept) == len(passive):  # numerically stuck: drop the smallest
                worst = passive[int(z.argmin())]
                x[worst] = 0
                kept = [q for q in passive if q != worst]
            passive = kept
            if not passive:
                return x
        x[:] = 0
        x[passive] = z
        rest = counts - p.T @ z
    return x


class Packer:
    """Packs the documents of one task. Yields pieces
    (doc, start, length, ids, doc_tokens, sequence, offset)."""

    def __init__(self, window: int = WINDOW, unit: int = UNIT):
        self.window, self.unit, self.sequence = window, unit, 0
        self.open: list[tuple] = []  # pieces of the unfinished window, without sequence
        self.filled = 0

    def _next(self) -> int:
        self.sequence += 1
        return self.sequence - 1

    def _close(self) -> Iterator[tuple]:
        number, offset = self._next(), 0
        for doc, start, length, ids, total in self.open:
            yield doc, start, length, ids, total, number, offset
            offset += length
        self.open, self.filled = [], 0

    def _fill(self, doc, start: int, ids: bytes, total: int) -> Iterator[tuple]:
        """Greedy: into the open window, cut at its end."""
        at, n = 0, len(ids) // ID_BYTES
        while at < n:
            take = min(n - at, self.window - self.filled)
            self.open.append((doc, start + at, take, ids[at * ID_BYTES:(at + take) * ID_BYTES], total))
            self.filled += take
            at += take
            if self.filled == self.window:
                yield from self._close()

    def block(self, docs: list[tuple[object, bytes]]) -> Iterator[tuple]:
        window, units = self.window, self.window // self.unit
        bins: dict[int, list[tuple]] = {}
        for doc, ids in docs:
            total = len(ids) // ID_BYTES
            whole = total // window * window
            for start in range(0, whole, window):
                yield doc, start, window, ids[start * ID_BYTES:(start + window) * ID_BYTES], total, self._next(), 0
            if total > whole:
                bins.setdefault(-(-(total - whole) // self.unit), []).append((doc, whole, ids[whole * ID_BYTES:], total))
        counts = np.zeros(units + 1)
        for length, rests in bins.items():
            counts[length] = len(rests)
        columns = combinations(np.flatnonzero(counts), units)
        x = least_squares(columns, counts)
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 0.5:
                break
            column = columns[j]
            for _ in range(int(x[j] + 0.5)):
                if any(len(bins[length]) < times for length, times in column.items()):
                    break
                number, offset = self._next(), 0
                for length, times in column.items():
                    for _ in range(times):
                        doc, start, ids, total = bins[length].pop()
                        n = len(ids) // ID_BYTES
                        yield doc, start, n, ids, total, number, offset
                        offset += n
        for length in sorted(bins, reverse=True):
            for doc, start, ids, total in bins[length]:
                yield from self._fill(doc, start, ids, total)

    def finish(self) -> Iterator[tuple]:
        """The last window, cut into windows whose length is a power of two."""
        pieces, rest = self.open, self.filled
        self.open, self.filled = [], 0
        size = self.window
        while rest:
            while size > rest:
                size //= 2
            number, offset = self._next(), 0
            while offset < size:
                doc, start, length, ids, total = pieces.pop(0)
                take = min(length, size - offset)
                yield doc, start, take, ids[:take * ID_BYTES], total, number, offset
                offset += take
                if take < length:
                    pieces.insert(0, (doc, start + take, length - take, ids[take * ID_BYTES:], total))
            rest -= size


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW,
         block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of all documents packed into windows (schema ``PIECE_SCHEMA``).

    Null and empty texts are one piece, the end id. Repeated rows and null doc_ids are
    packed like any other row. An empty table gives no rows. Very long texts are cut into
    windows. ``window`` must be a power of two and a multiple of ``UNIT``."""
    importable(docs.sparkSession)
    schema = pa.schema([(name, pa.int64()) for name in
                        ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
    end = pack_ids(end_id)

    def run(batches):
        words = _word_ids(tokenizer)
        packer = Packer(window)
        base = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []

        def out(pieces):
            for doc, start, length, ids, total, number, offset in pieces:
                rows.append((doc, start, length, zlib.crc32(ids), total, base + number, offset))
                if len(rows) >= 20_000:
                    yield flush()

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
            rows.clear()
            return made

        block, tokens = [], 0
        for part, texts in text_slices(batches):
            for doc, ids in zip(part.column(0).to_pylist(), words.packed([t or "" for t in texts])):
                block.append((doc, ids + end))
                tokens += len(ids) // ID_BYTES + 1
            if tokens >= block_tokens:
                yield from out(packer.block(block))
                block, tokens = [], 0
        yield from out(packer.block(block))
        yield from out(packer.finish())
        if rows:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE_SCHEMA)
