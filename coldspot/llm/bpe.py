"""Byte-level BPE encoding and decoding (operator 8).

Method: bytes are mapped to Latin-1 characters so that one Aho-Corasick automaton over
the vocabulary lists every token at every position of a piece in one pass. A piece is
then encoded left to right with the longest token first; a token is accepted if it is
compatible with its left neighbour, that is, if no merge across their border comes before
both are complete (memoised per pair). If no token fits, the last one is taken back and
a shorter one tried, and the position is marked dead: the compatible encoding of a prefix
is unique, so no other way leads through it. This gives the exact merges in linear time.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot.llm.common import map_texts

# Pieces and token pairs a worker remembers; beyond it starts afresh (results are equal).
CACHE_PIECES = 500_000
CACHE_PAIRS = 1_000_000
CACHED_CHARS = 48  # longer pieces are not remembered


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a ``.tiktoken`` file (base64, blank, rank per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class BytePairEncoder:
    """Encodes single pieces (the matches of the splitting pattern)."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})

    def last_merge(self, token: bytes) -> tuple[bytes, bytes]:
        """The two parts whose merge gives a token of two bytes or more."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            _, at = min((self.ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts[0], parts[1]

    def edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at one end (0 left, 1 right) while the token is built,
        largest first, each with the rank at which it goes into a larger part."""
        known = self.edges[side].get(token)
        if known is None:
            part, until, known = self.token_bytes[token], 1 << 40, []
            known.append((part, until))
            while len(part) > 1:
                until = self.ranks[part]
                part = self.last_merge(part)[side]
                known.append((part, until))
            self.edges[side][token] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether both tokens survive next to each other. They do not if, while both are
        built, some part at the end of the left one merges with some part at the start of
        the right one first. Merges go by rank, equal ranks from left to right."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            rank = self.ranks.get
            known = True
            for a, a_until in self.edge(left, 1):
                for b, b_until in self.edge(right, 0):
                    r = rank(a + b)
                    if r is not None and r < a_until and r <= b_until:
                        known = False
                        break
                if not known:
                    break
            self.pairs[(left, right)] = known
        return known

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(piece.decode("latin-1")):
            found[end - match[1] + 1].append(match)  # of one start, in order of length
        dead = bytearray(n + 1)
        out: list[int] = []
        starts: list[int] = []
        choice: list[int] = []  # index of the token taken at each start
        pos, k = 0, len(found[0]) - 1
        compatible = self.compatible
        while pos < n:
            options = found[pos]
            while k >= 0:
                token, size = options[k]
                if not dead[pos + size] and (not out or compatible(out[-1], token)):
                    break
                k -= 1
            if k >= 0:
                out.append(token)
                starts.append(pos)
                choice.append(k)
                pos += size
                k = len(found[pos]) - 1 if pos < n else 0
            else:
                dead[pos] = 1
                out.pop()
                pos, k = starts.pop(), choice.pop() - 1
        return out


class TextEncoder(dict):
    """Text to ids; the dict holds the packed ids of pieces met before."""

    def __init__(self, path: str, pattern: str):
        import regex

        super().__init__()
        self.encoder = BytePairEncoder(read_ranks(path))
        self.pieces = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        packed = np.asarray(self.encoder.encode(piece.encode("utf-8")), "<u4").tobytes()
        if len(piece) <= CACHED_CHARS:
            self[piece] = packed
        return packed

    def packed(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(self) > CACHE_PIECES:
            self.clear()
        return b"".join(map(self.__getitem__, self.pieces(text)))


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(path, pattern)


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every whole text: ids packed as little-endian unsigned 32-bit.

    ``path`` is a rank file on every node, ``pattern`` the splitting pattern. Null and
    empty texts give no ids. Rows are independent: repeated rows and null doc_ids give a
    row each; other columns are ignored, so their names cannot clash."""

    def run(part, texts):
        packed = _encoder(path, pattern).packed
        return {"doc_id": part.column(0), "ids": pa.array([packed(t) if t else b"" for t in texts], pa.binary())}

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                     "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) with the bytes that the ids stand for (null ids: empty)."""

    def run(batches):
        table = _vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                decoded = [b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())) if ids else b""
                           for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded bytes."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
