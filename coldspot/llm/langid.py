"""Language identification (operator 2): a byte convolutional network in numpy.

A text becomes windows of ``WINDOW`` bytes of its lower-cased UTF-8 form (the last one is
padded with zero bytes), all windows together covering the whole text. Filters of several
widths slide over a window; a filter's weights are one value per position and byte, so a
convolution is a sum of table rows. Max pooling over the window, a rectifier and a softmax
layer follow. A document's probabilities are the means over its windows, weighted by their
bytes.

Training uses windows of a bounded sample of labelled documents (``per_language`` of each
language) and runs on the driver with mini-batches and Adam; the gradient of max pooling
touches only the bytes under the winning positions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot.llm.common import bounded_sample, map_texts, train_fold, unit_hash

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
PER_LANGUAGE = 500
SAMPLE_CHARS = 1500  # of a training document, from a place given by its hash
NO_LANGUAGE = "und"
WINDOWS_AT_ONCE = 512


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte windows of all texts, the text each belongs to, and its number of bytes."""
    data = [t.lower().encode("utf-8") for t in texts]
    parts = np.array([-(-len(d) // WINDOW) for d in data], np.int64)
    padded = b"".join(d + b"\0" * (-len(d) % WINDOW) for d in data)
    owner = np.repeat(np.arange(len(texts)), parts)
    used = np.full(len(owner), WINDOW, np.int64)
    ends = np.cumsum(parts) - 1
    for i, d in enumerate(data):
        if len(d) % WINDOW:
            used[ends[i]] = len(d) % WINDOW
    return np.frombuffer(padded, np.uint8).reshape(-1, WINDOW), owner, used


@dataclass
class ByteNetwork:
    languages: list[str]
    tables: dict[int, np.ndarray]  # width -> [position, byte, filter]
    bias: np.ndarray  # of all filters
    dense: np.ndarray
    dense_bias: np.ndarray

    def pooled(self, x: np.ndarray, with_place: bool = False):
        values, places = [], []
        for width, t in self.tables.items():
            n = x.shape[1] - width + 1
            z = t[0][x[:, :n]]
            for j in range(1, width):
                z += t[j][x[:, j:j + n]]
            if with_place:
                at = z.argmax(axis=1)
                places.append(at)
                values.append(np.take_along_axis(z, at[:, None, :], 1)[:, 0])
            else:
                values.append(z.max(axis=1))
        return np.concatenate(values, 1) + self.bias, places

    def fast_tables(self) -> list[tuple[int, list[np.ndarray]]]:
        """Tables over byte pairs: half as many rows are added per window position."""
        made = []
        for width, t in self.tables.items():
            made.append((width, [(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, -1) if j + 1 < width else t[j]
                                 for j in range(0, width, 2)]))
        return made

    def probabilities(self, x: np.ndarray, fast) -> np.ndarray:
        out = []
        for i in range(0, len(x), 16):  # small enough to stay in the processor's cache
            part = x[i:i + 16]
            pairs = part[:, :-1].astype(np.int32) * 256 + part[:, 1:]
            pooled = []
            for width, steps in fast:
                n = WINDOW - width + 1
                z = steps[0].take(pairs[:, :n], axis=0)
                for k, step in enumerate(steps[1:], 1):
                    z += step.take(pairs[:, 2 * k:2 * k + n] if len(step) > 256 else part[:, 2 * k:2 * k + n], axis=0)
                pooled.append(z.max(axis=1))
            out.append(np.concatenate(pooled, 1))
        h = np.maximum(np.concatenate(out) + self.bias, 0)
        return _softmax(h @ self.dense + self.dense_bias)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = 4, batch: int = 64,
        rate: float = 0.01, seed: int = 5) -> ByteNetwork:
    """Trains on windows ``x`` (bytes) with language numbers ``y``, classes weighted equally."""
    rng = np.random.default_rng(seed)
    tables = {w: rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    for t in tables.values():
        t[:, 0, :] = 0  # padding
    width = FILTERS * len(WIDTHS)
    net = ByteNetwork(languages, tables, np.zeros(width, np.float32),
                      rng.normal(0, 0.1, (width, len(languages))).astype(np.float32),
                      np.zeros(len(languages), np.float32))
    share = np.bincount(y, minlength=len(languages))
    weight = (len(y) / np.maximum(share, 1) / len(languages))[y].astype(np.float32)
    params = [*tables.values(), net.bias, net.dense, net.dense_bias]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(order), batch):
            pick = order[i:i + batch]
            bx, by = x[pick], y[pick]
            z, places = net.pooled(bx, with_place=True)
            h = np.maximum(z, 0)
            p = _softmax(h @ net.dense + net.dense_bias)
            p[np.arange(len(pick)), by] -= 1
            p *= weight[pick][:, None] / len(pick)
            dz = (p @ net.dense.T) * (z > 0)
            grads = []
            for k, (w, t) in enumerate(tables.items()):
                g, dk = np.zeros_like(t), dz[:, k * FILTERS:(k + 1) * FILTERS]
                for j in range(w):
                    hit = np.take_along_axis(bx, places[k] + j, 1)
                    np.add.at(g[j], (hit, np.arange(FILTERS)[None, :]), dk)
                g[:, 0, :] = 0
                grads.append(g)
            grads += [dz.sum(0), h.T @ p, p.sum(0)]
            step += 1
            for q, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def train(documents: DataFrame, per_language: int = PER_LANGUAGE) -> ByteNetwork | None:
    """Fits on the learning fold (crc32 of doc_id not divisible by 5) of rows with text and
    language: about ``per_language`` documents of each, ``SAMPLE_CHARS`` characters of each,
    so at most a few MB reach the driver. None if there are none."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.col("lang") != NO_LANGUAGE)
        & train_fold("doc_id") & F.col("text").rlike(r"\p{L}"))
    start = F.floor(unit_hash("doc_id", F.lit(3)) * F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS + 1)).cast("int") + 1
    rows = rows.select("doc_id", "lang", F.substring("text", start, F.lit(SAMPLE_CHARS)).alias("text"))
    sample, counts = bounded_sample(rows, "lang", "doc_id", per_language)
    got = sorted({(r["doc_id"], r["lang"], r["text"]) for r in sample.collect()})
    if not got:
        return None
    languages = sorted(counts)
    x, owner, _ = windows([r[2] for r in got])
    y = np.array([languages.index(r[1]) for r in got])[owner]
    return fit(x, y, languages)


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def predict(docs: DataFrame, net: ByteNetwork | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per document row, from the text alone.

    A null or empty text and one without a letter is ``und`` with score 0, as is every text
    if nothing was learnt. Equal probabilities go to the language that sorts first. Repeated
    rows give repeated results; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # fixed size, grows with the languages only
    prepared: dict = {}

    def run(part, texts):
        net = shared.value
        flags = part.column(part.schema.get_field_index("letters")).to_pylist()
        out = {"doc_id": part.column(0), "held_out": part.column(1),
               "lang_pred": [NO_LANGUAGE] * len(texts), "score": [0.0] * len(texts)}
        rows = [i for i, letters in enumerate(flags) if letters] if net else []
        if rows:
            if "fast" not in prepared:
                prepared["fast"] = net.fast_tables()
            x, owner, used = windows([texts[i] for i in rows])
            sums = np.zeros((len(rows), len(net.languages)))
            for i in range(0, len(x), WINDOWS_AT_ONCE):
                p = net.probabilities(x[i:i + WINDOWS_AT_ONCE], prepared["fast"])
                np.add.at(sums, owner[i:i + WINDOWS_AT_ONCE], p * used[i:i + WINDOWS_AT_ONCE, None])
            sums /= sums.sum(axis=1, keepdims=True)
            for i, best, p in zip(rows, sums.argmax(axis=1), sums.max(axis=1)):
                out["lang_pred"][i], out["score"][i] = net.languages[best], min(1.0, float(p))
        return out

    held = F.coalesce(~train_fold("doc_id"), F.lit(False))
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        "doc_id", held.alias("held_out"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return map_texts(cols, run, SCHEMA)
