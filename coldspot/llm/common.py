"""Shared helpers of the training-data operators: table reads, Arrow batches cut by
bytes, bounded labelled samples, and a small numpy logistic regression."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldspot.session import scratch_path

# White space of the word rule: space and U+0009..U+000D. Everything else is word.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# A task handles at most this many characters of text at a time, plus one text.
BATCH_CHARS = 2 << 20

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Python workers import this package: from ``--py-files`` on a cluster, else from the
    folder it was loaded from."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder of ``spark.checkpoint.dir`` and read back:
    later steps neither repeat the work nor depend on the executors that did it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str) -> str:
    """Path of a public vocabulary file: folder ``TOKENIZERS_DIR`` if set, else the
    installed ``public_tokenizers`` package."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_chars: int = BATCH_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Cut record batches so that a slice holds about ``max_chars`` UTF-8 bytes of text
    (at least one row), and hand out the slice with its texts."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_chars, side="right")))
            yield batch.slice(start, stop - start), texts.slice(start, stop - start).to_pylist()
            start = stop


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch, list], dict], schema: str,
              max_chars: int = BATCH_CHARS) -> DataFrame:
    """``mapInArrow`` over slices of bounded text size. ``fn(slice, texts)`` returns the
    output columns; it is called once or more per input batch."""
    from pyspark.sql.types import StructType

    importable(df.sparkSession)
    arrow = _arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, max_chars=max_chars):
            out = fn(part, texts)
            yield pa.RecordBatch.from_arrays(
                [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
                 for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def filter_texts(docs: DataFrame, keep: Callable[[list], np.ndarray], max_chars: int = BATCH_CHARS) -> DataFrame:
    """The rows, with all their columns, for which ``keep(texts)`` is true."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, max_chars=max_chars):
            yield part.filter(pa.array(np.asarray(keep(texts), bool)))

    return docs.mapInArrow(run, docs.schema)


def _arrow_schema(struct) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(struct)


def train_fold(doc_id) -> "F.Column":
    """True where crc32 of the id as text is not divisible by 5 (the learning rows)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def unit_hash(*cols) -> "F.Column":
    """A hash of the columns as a number in [0, 1)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)


def bounded_sample(rows: DataFrame, label: str, key: str, per_class: int,
                   max_classes: int = 256) -> tuple[DataFrame, dict]:
    """About ``per_class`` rows of each label value (all rows of smaller classes), picked
    by the hash of ``key``; never more than 2 * per_class * classes rows. Labels beyond the
    ``max_classes`` most frequent are not learnt. Returns the sample and the class counts
    over all rows (a bounded dict)."""
    counts = {r[label]: r["n"] for r in (
        rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), label).limit(max_classes).collect())}
    if not counts:
        return rows.limit(0), {}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_class / n))).otherwise(share)
    h = unit_hash(F.col(key).cast("string"), F.lit(17))
    picked = rows.where(F.col(label).isNotNull() & (h < share))
    return picked.orderBy(h, key).limit(2 * per_class * len(counts)), counts


def labelled_texts(documents: DataFrame, labels: DataFrame, label: str, per_class: int,
                   only_train_fold: bool) -> tuple[DataFrame, dict]:
    """Bounded sample of labelled documents (doc_id, y, text). Contradicting labels of one
    doc_id count as the smallest; null labels and ids are ignored. The sampled labels
    (at most 4 * per_class rows) are broadcast to the scan of the documents."""
    one = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
           .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.min("y").alias("y")))
    if only_train_fold:
        one = one.where(train_fold("doc_id"))
    sample, counts = bounded_sample(one, "y", "doc_id", per_class)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(sample), "doc_id"), counts


class Sparse:
    """Rows of (index, value) pairs for the regression."""

    def __init__(self, indices: list[np.ndarray], values: list[np.ndarray], width: int):
        self.n, self.width = len(indices), width
        self.rows = np.repeat(np.arange(self.n), [len(i) for i in indices])
        self.cols = np.concatenate(indices).astype(np.int64) if self.n else np.zeros(0, np.int64)
        self.vals = np.concatenate(values).astype(np.float64) if self.n else np.zeros(0)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.vals * w[self.cols], self.n)

    def t_dot(self, e: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, self.vals * e[self.rows], self.width)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: Sparse, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3,
                 steps: int = 80, memory: int = 8) -> tuple[np.ndarray, float]:
    """Weighted L2 logistic regression by L-BFGS with a backtracking line search."""
    weight = weight / weight.sum()

    def loss_grad(p):
        z = x.dot(p[:-1]) + p[-1]
        loss = np.sum(weight * (np.logaddexp(0, z) - y * z)) + 0.5 * l2 * p[:-1] @ p[:-1]
        e = weight * (sigmoid(z) - y)
        return loss, np.append(x.t_dot(e) + l2 * p[:-1], e.sum())

    p = np.zeros(x.width + 1)
    f, g = loss_grad(p)
    past: list[tuple] = []
    for _ in range(steps):
        q, alphas = g.copy(), []
        for s, d, rho in reversed(past):
            alphas.append(rho * (s @ q))
            q -= alphas[-1] * d
        if past:
            s, d, _ = past[-1]
            q *= (s @ d) / (d @ d)
        for (s, d, rho), a in zip(past, reversed(alphas)):
            q += s * (a - rho * (d @ q))
        slope, step = -(g @ q), 1.0
        if slope >= 0 or np.abs(g).max() < 1e-7:
            break
        while True:
            new = p - step * q
            f2, g2 = loss_grad(new)
            if f2 <= f + 1e-4 * step * slope or step < 1e-8:
                break
            step *= 0.5
        s, d = new - p, g2 - g
        if f - f2 < 1e-9 * max(1.0, abs(f)):
            p = new
            break
        if s @ d > 1e-12:
            past = (past + [(s, d, 1.0 / (s @ d))])[-memory:]
        p, f, g = new, f2, g2
    return p[:-1], float(p[-1])


def fit_platt(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Platt scaling: probability = sigmoid(a * score + b), with smoothed targets."""
    if len(score) == 0:
        return 1.0, 0.0
    spread = float(score.std()) or 1.0
    n1, n0 = (weight * y).sum(), (weight * (1 - y)).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = Sparse([np.zeros(1, int)] * len(score), [np.array([s / spread]) for s in score], 1)
    w, b = fit_logistic(x, target, weight, l2=1e-6, steps=60)
    return max(float(w[0]) / spread, 1e-6), b


def class_weights(y: np.ndarray, counts: dict) -> np.ndarray:
    """Weights that give the sample the class shares of all labelled rows."""
    w = np.ones(len(y))
    for c in (0, 1):
        own = int((y == c).sum())
        if own:
            w[y == c] = counts.get(c, own) / own
    return w * len(y) / max(w.sum(), 1e-12)
