"""Quality rules (operator 1): text statistics with fixed base limits, and a logistic
regression over hashed word and character n-grams, calibrated to probabilities.

The regression is trained on a bounded sample of labelled rows (``per_class`` documents of
each quality); features are computed on the executors and only their sparse counts reach
the driver. Scoring runs in Arrow batches: each n-gram of a batch is hashed with numpy to a
bucket, and a document's score is the mean weight of its word n-grams plus that of its
character n-grams. Thresholds are fixed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot.llm.common import (WORD_PATTERN, Sparse, class_weights, filter_texts, fit_logistic, fit_platt,
                                 labelled_texts, map_texts, sigmoid)

WORD_BUCKETS = 1 << 14
CHAR_BUCKETS = 1 << 15
WORD_GRAMS = (1, 2)
CHAR_GRAMS = (1, 2, 3)
SCALE = 20.0  # n-gram shares are small numbers
PER_CLASS = 1500
KEEP_FROM = 0.5  # least probability of good quality
# Characters of a slice: every n-gram takes some 100 bytes while a slice is scored, and twice
# that while its distinct buckets are counted for training.
SCORE_CHARS = 1 << 19
TRAIN_CHARS = 1 << 18

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 20
REPEAT_WINDOW = 8
MOST_REPEATED_PERCENT = 30

_WORDS = re.compile(WORD_PATTERN).findall


class Words:
    """The words of a batch of texts as integer codes, document by document."""

    def __init__(self, texts: list[str]):
        cut = [_WORDS(t) for t in texts]
        self.n_words = np.array([len(w) for w in cut], np.int64)
        flat = np.empty(int(self.n_words.sum()), object)
        flat[:] = [w for words in cut for w in words]
        self.codes, self.unique = pd.factorize(flat)
        self.codes = self.codes.astype(np.int64)
        self.doc = np.repeat(np.arange(len(texts)), self.n_words)
        self.end = np.repeat(np.cumsum(self.n_words), self.n_words)

    def chars(self) -> np.ndarray:
        sizes = np.fromiter(map(len, self.unique), np.int64, len(self.unique))
        return np.bincount(self.doc, sizes[self.codes], len(self.n_words)).astype(np.int64)

    def repeated(self, window: int = REPEAT_WINDOW) -> np.ndarray:
        """Words that lie in a window of ``window`` words found twice or more in the text.
        Windows are numbered exactly: pairs of words, pairs of pairs, and so on."""
        n, codes, size = len(self.codes), self.codes, 1
        while size < window:
            after = np.zeros(n, np.int64)
            after[:max(0, n - size)] = codes[size:]
            codes = pd.factorize(codes * (codes.max(initial=0) + 1) + after)[0].astype(np.int64)
            size *= 2
        at = np.flatnonzero(np.arange(n) + window <= self.end)
        key = pd.factorize(self.doc[at] * (codes.max(initial=0) + 1) + codes[at])[0]
        twice = at[np.bincount(key, minlength=1)[key] > 1]
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, twice, 1)
        np.add.at(edge, twice + window, -1)
        return np.bincount(self.doc, np.cumsum(edge)[:n] > 0, len(self.n_words)).astype(np.int64)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def base_columns(texts: list[str], words: Words) -> dict[str, np.ndarray]:
    repeated = words.repeated()
    return {
        "n_words": words.n_words,
        "word_chars": words.chars(),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts], np.int64),
        "n_repeat_words": repeated,
        "base_failed": (words.n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * words.n_words),
    }


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def buckets(texts: list[str], words: Words):
    """Yields (document, bucket, share) arrays: every n-gram with its share among the
    word (or character) n-grams of its document."""
    n = len(texts)
    offset = 0
    hashes = pd.util.hash_array(words.unique, categorize=False) if len(words.unique) else np.zeros(0, np.uint64)
    units = [(hashes[words.codes], words.doc, WORD_GRAMS, WORD_BUCKETS)]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(t) for t in texts], np.int64)
    units.append((_mix(points + np.uint64(1)), np.repeat(np.arange(n), sizes), CHAR_GRAMS, CHAR_BUCKETS))
    for values, doc, grams, width in units:
        made = []
        for size in range(1, max(grams) + 1):
            if size == 1:
                h, d = values, doc
            else:
                h = _mix(h[:-1] * np.uint64(31) + values[size - 1:])
                inside = doc[:len(h)] == doc[size - 1:size - 1 + len(h)]
                d = doc[:len(h)]
            if size in grams:
                k = ((_mix(h + np.uint64(size)) >> np.uint64(20)) % np.uint64(width)).astype(np.int64) + offset
                made.append((d, k) if size == 1 else (d[inside], k[inside]))
        total = np.maximum(1, sum(np.bincount(d, minlength=n) for d, _ in made))
        for d, k in made:
            yield d, k, SCALE / total
        offset += width


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    slope: float  # of the calibration
    intercept: float

    def probability(self, texts: list[str], words: Words) -> np.ndarray:
        z = np.full(len(texts), self.bias)
        for doc, bucket, share in buckets(texts, words):
            z += np.bincount(doc, self.weights[bucket], len(texts)) * share
        return sigmoid(self.slope * z + self.intercept)


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> QualityModel | None:
    """Fits on at most about ``per_class`` labelled documents of each quality; a quarter of
    them calibrates. None if the labels do not hold both qualities."""
    sample, counts = labelled_texts(documents, labels, "quality", per_class, only_train_fold=False)
    if len(counts) < 2:
        return None

    def features(part, texts):
        words = Words(texts)
        found = [(d, k, share[d]) for d, k, share in buckets(texts, words)]
        width = WORD_BUCKETS + CHAR_BUCKETS
        docs, cols, vals = (np.concatenate(c) for c in zip(*found))
        cells, at = np.unique(docs * width + cols, return_inverse=True)
        sums = np.bincount(at, vals, len(cells)).astype(np.float32)
        edges = np.searchsorted(cells // width, np.arange(len(texts) + 1)).astype(np.int32)
        return {"doc_id": part.column(0), "y": part.column(1),
                "idx": pa.ListArray.from_arrays(edges, pa.array((cells % width).astype(np.int32))),
                "val": pa.ListArray.from_arrays(edges, pa.array(sums))}

    rows = map_texts(sample.select("doc_id", "y", "text"), features,
                     "doc_id long, y int, idx array<int>, val array<float>", TRAIN_CHARS).toArrow()
    if not rows.num_rows:
        return None
    # One row per document id, in a fixed order, so that the fit does not depend on the
    # order of rows.
    ids = rows.column("doc_id").to_numpy()
    order = np.unique(ids, return_index=True)[1]
    y = rows.column("y").to_numpy().astype(float)[order]
    idx, val = ([np.asarray(c[int(i)].values) for i in order] for c in (rows.column("idx"), rows.column("val")))
    if len(set(y)) < 2:
        return None
    weight = class_weights(y, counts)
    held = ids[order] % 4 == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    fit = np.flatnonzero(~held)
    width = WORD_BUCKETS + CHAR_BUCKETS
    balanced = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, b = fit_logistic(Sparse([idx[i] for i in fit], [val[i] for i in fit], width), y[fit], balanced[fit], l2=1e-4)
    check = np.flatnonzero(held) if held.any() else fit
    z = Sparse([idx[i] for i in check], [val[i] for i in check], width).dot(w) + b
    slope, intercept = fit_platt(z, y[check], weight[check])
    return QualityModel(w, b, slope, intercept)


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, quality double")


def assess(docs: DataFrame, model: QualityModel | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per document row: the base statistics, ``kept`` and ``quality`` (probability
    of good quality; 1.0 without a model).

    Null texts count as empty: no words, so they fail the base rules. Repeated rows give
    repeated results; null doc_ids stay null; other columns are ignored. A probability of
    exactly ``keep_from`` is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: one weight per bucket

    def run(part, texts):
        texts = [t or "" for t in texts]
        words = Words(texts)
        out = base_columns(texts, words)
        own = shared.value
        quality = own.probability(texts, words) if own else np.ones(len(texts))
        return out | {"doc_id": part.column(0), "quality": quality, "kept": ~out["base_failed"] & (quality >= keep_from)}

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SCHEMA, SCORE_CHARS)


def filtered(docs: DataFrame, model: QualityModel | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs``, all columns, that ``assess`` keeps. Decided row by row, so null
    and repeated doc_ids are no special case."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(texts):
        texts = [t or "" for t in texts]
        words = Words(texts)
        own = shared.value
        quality = own.probability(texts, words) if own else np.ones(len(texts))
        return ~base_columns(texts, words)["base_failed"] & (quality >= keep_from)

    return filter_texts(docs, keep, SCORE_CHARS)
