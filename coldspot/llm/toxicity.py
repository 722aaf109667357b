"""Toxicity (operator 6): noisy-channel deobfuscation, then a score of the restored text.

Restoring: a word of letters without two alike in a row is itself, a number is no word. Any
other word, of any length, and a run of three or more single characters set apart by blanks,
is read as a lattice: each character may stand for itself, for the letters it imitates
(leetspeak), or for nothing (a separator), a character like its predecessor may be dropped
(repetition), and in a spaced run a word may end behind each letter. Viterbi decoding under a
character trigram model, learnt from the plain words of all documents, picks the reading;
every change has a fixed price. Results are remembered per word.

Scoring: the restored words and their prefixes that go along with toxic or with clean
training documents (by a z-value of their log odds) are the features of a logistic
regression, together with whether any almost purely toxic one is present; its score is
calibrated to probabilities. Training uses a bounded sample of labelled rows
of the learning fold (``per_class`` documents of each label).
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot.llm.common import (Sparse, class_weights, filter_texts, fit_logistic, fit_platt, importable, labelled_texts,
                                 map_texts, sigmoid, text_slices, train_fold)

PER_CLASS = 2500
PREFIXES = (3, 4, 5, 6, 7)
MOST_FEATURES = 4000
TELLING = 0.95  # least share of toxic documents (both labels weighted equally)
ANY_TELLING = "*"  # feature: at least one telling feature is present
LEAST_Z = 3.0
LEAST_DOCUMENTS = 4
CACHE_WORDS = 400_000
HIT_WORDS = 600_000  # words with few or no features each
L2 = 3e-5
CACHED_CHARS = 48  # readings of longer words are not remembered
COUNTED_WORDS = 200_000  # distinct words that a task counts before it passes them on,
COUNTED_CHARS = 32 << 20  # and characters of the texts they are from
TABLE = 1 << 20  # places of the letter model's table of counts

# Letters that digits and signs imitate.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i"}
PRICE_LEET = 1.5
PRICE_DROP = 6.0  # of a sign that may be a letter
PRICE_EDGE = 2.0  # of such a sign behind or before all letters
PRICE_REPEAT = 0.5  # in a run of three or more
PRICE_DOUBLE = 4.0  # in a run of two
PRICE_BREAK = 1.0  # of the end of a word within a spaced run

_CUT = re.compile(r"[^\x20\x09-\x0D]+").findall
_START, _STOP = "\x02", "\x03"


def _grams(trigram: str) -> tuple[str, ...]:
    """What a trigram counts for: itself, its last two letters and its last, and the contexts
    of two letters and of one."""
    return "3" + trigram, "2" + trigram[1:], "1" + trigram[2], "C" + trigram[:2], "c" + trigram[1]


def _place(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8")) % TABLE


class LetterModel:
    """Interpolated character trigram model: costs are negative log probabilities. Counts lie
    in a table of ``TABLE`` places by the crc32 of the gram, whatever the alphabets."""

    def __init__(self, table: np.ndarray, total: int):
        self.table, self.total = table, total or 1.0
        self.known: dict[str, float] = {}

    @classmethod
    def of(cls, trigrams: Counter) -> LetterModel:
        table = np.zeros(TABLE, np.int64)
        for w, n in trigrams.items():
            for gram in _grams(w):
                table[_place(gram)] += n
        return cls(table, sum(trigrams.values()))

    def _count(self, gram: str) -> int:
        return int(self.table[_place(gram)])

    def cost(self, context: str, c: str) -> float:
        got = self.known.get(context + c)
        if got is None:
            if len(self.known) > CACHE_WORDS:
                self.known.clear()
            three, two, one, three_all, two_all = map(self._count, _grams(context + c))
            p = (one + 0.1) / (self.total + 100)
            p = (two + 4 * p) / (two_all + 4)
            p = min((three + 4 * p) / (three_all + 4), 1.0)  # places may be shared
            got = self.known[context + c] = -math.log(p)
        return got


def trigrams_of(words) -> Counter:
    """Character trigrams of (word, count) pairs, with a word's start and end."""
    found = Counter()
    for word, n in words:
        w = _START * 2 + word + _STOP
        for i in range(2, len(w)):
            found[w[i - 2:i + 1]] += n
    return found


def count_words(batches, most: int = COUNTED_WORDS, most_chars: int = COUNTED_CHARS):
    """Batches of (word, texts with it), counted within the task; a word is passed on more than
    once if the task meets more than ``most`` distinct ones or ``most_chars`` of text."""
    found, chars = Counter(), 0

    def passed_on():
        made = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["w", "n"])
        found.clear()
        return made

    for _, texts in text_slices(batches):
        for text in texts:
            if text:
                found.update(set(_CUT(text)))
                chars += len(text)
                if len(found) > most or chars > most_chars:
                    yield passed_on()
                    chars = 0
    if found:
        yield passed_on()


def letter_model(documents: DataFrame) -> LetterModel:
    """Of the plain words of all documents; a word counts once a text. Words are counted
    within the tasks and summed by Spark, then the trigrams of the distinct words; the driver gets the table of ``TABLE``
    counts."""
    importable(documents.sparkSession)
    counted = documents.select("text").mapInArrow(count_words, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    # Distinct words are cleaned; counts of words that become equal add up in their trigrams.
    words = counted.select(F.lower(F.btrim("w", F.lit(".,;:?\"'()"))).alias("w"), "n").where(
        F.col("w").rlike(r"^\p{L}+$") & ~F.col("w").rlike(r"(.)\1\1"))

    def count(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 20_000):
                batch = whole.slice(start, 20_000)
                found = trigrams_of(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["w", "n"])

    grams = words.mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    w = F.col("w")
    each = F.array(F.concat(F.lit("3"), w), F.concat(F.lit("2"), F.substring(w, 2, 2)), F.concat(F.lit("1"), F.substring(w, 3, 1)),
                   F.concat(F.lit("C"), F.substring(w, 1, 2)), F.concat(F.lit("c"), F.substring(w, 2, 1)))
    places = grams.select(F.explode(each).alias("g"), "n").select(
        (F.crc32(F.col("g").cast("binary")) % TABLE).alias("place"), F.when(F.col("g").startswith("3"), F.col("n")).otherwise(0).alias("t"), "n")
    got = places.groupBy("place").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()
    table = np.zeros(TABLE, np.int64)
    table[got.column("place").to_numpy()] = got.column("n").to_numpy()
    return LetterModel(table, int(got.column("t").to_numpy().sum()))


def decode(word: str, model: LetterModel, spaced: bool = False) -> str:
    """The cheapest reading of a noisy word (lower case). With ``spaced``, words may end behind
    any letter; they are set apart by blanks in the reading. Time and memory are linear in the
    word."""
    paths = {_START * 2: (0.0, None)}  # last two letters -> cost, letters so far (last, rest)
    inner = [i for i, c in enumerate(word) if c.isalnum()] or [0, len(word)]
    for i, c in enumerate(word):
        again = i > 0 and word[i - 1] == c
        if again:
            longer = word[i - 2:i - 1] == c and i > 1 or word[i + 1:i + 2] == c
            repeat = PRICE_REPEAT if longer else PRICE_DOUBLE
        letters = [(c, 0.0)] if c.isalpha() else []
        letters += [(x, PRICE_LEET) for x in LEET.get(c, "")]
        if c.isalpha():
            drop = repeat if again else None
        elif not letters:
            drop = 0.0
        else:
            drop = PRICE_DROP * (2 if c.isdigit() else 1) if inner[0] <= i <= inner[-1] else PRICE_EDGE
            drop = min(drop, repeat) if again else drop
        new: dict[str, tuple[float, tuple | None]] = {}
        for context, (cost, text) in paths.items():
            for x, price in letters:
                value = cost + price + model.cost(context, x)
                key = context[1] + x
                if key not in new or value < new[key][0]:
                    new[key] = (value, (x, text))
            if drop is not None:
                value = cost + drop
                if context not in new or value < new[context][0]:
                    new[context] = (value, text)
        if spaced and i + 1 < len(word):
            value, text = min(((cost + model.cost(context, _STOP) + PRICE_BREAK, text) for context, (cost, text) in new.items()),
                              key=lambda end: end[0])
            if _START * 2 not in new or value < new[_START * 2][0]:
                new[_START * 2] = (value, (" ", text))
        paths = new
    _, text = min(((cost + model.cost(context, _STOP), text) for context, (cost, text) in paths.items()), key=lambda end: end[0])
    read = []
    while text is not None:
        read.append(text[0])
        text = text[1]
    return "".join(reversed(read))


class Restorer(dict):
    """Texts to restored words; the dict holds the readings of words met before."""

    def __init__(self, model: LetterModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> str:
        read = self.read(word)
        if len(word) <= CACHED_CHARS:
            self[word] = read
        return read

    def read(self, word: str) -> str:
        core = word.lower().strip(".,;:?\"'`´()[]{}#%&*-_~")
        if core.isalpha() and not _TWO_ALIKE(core):
            return core
        if not any(c.isalpha() or c in LEET for c in core) or not any(
                c.isalpha() for c in core) and any(c.isdigit() for c in core):
            return ""  # signs that imitate nothing, and numbers
        return decode(core, self.model)

    def words(self, text: str) -> list[str]:
        if len(self) > CACHE_WORDS:
            self.clear()
        return list(map(self.__getitem__, _CUT(text))) + self.runs(text)

    def runs(self, text: str) -> list[str]:
        """Single characters set apart by blanks, three or more in a row, are words in pieces."""
        read = []
        for run in _SPACED(text):
            whole = "".join(_CUT(run)).lower()
            read += [decode(whole, self.model), *decode(whole, self.model, spaced=True).split()]
        return read


_TWO_ALIKE = re.compile(r"(.)\1").search
_SPACED = re.compile(r"(?<![^\s])(?:[^\W_]|[@$!|+(<€£¡])(?:\s+(?:[^\W_]|[@$!|+(<€£¡])){2,}(?![^\s])").findall


def features(words) -> set[str]:
    distinct = set(words)
    found = {w for w in distinct if w}
    for size in PREFIXES:
        found.update([w[:size] + "*" for w in distinct if len(w) > size])
    return found


class Hits(dict):
    """Words as they are written to the chosen features of their readings; the dict holds those
    of words met before."""

    def __init__(self, restorer: Restorer, weights: dict[str, float]):
        super().__init__()
        self.restorer, self.weights = restorer, weights

    def __missing__(self, word: str) -> tuple[str, ...]:
        own = self.of_reading(self.restorer.read(word))
        if len(word) <= CACHED_CHARS:
            self[word] = own
        return own

    def of_reading(self, read: str) -> tuple[str, ...]:
        """``features([read])`` that are chosen, without making the others."""
        prefixes = [read[:size] + "*" for size in PREFIXES if len(read) > size]
        return tuple([f for f in [read, *prefixes] if f and f in self.weights])

    def of(self, text: str) -> set[str]:
        if len(self) > HIT_WORDS:
            self.clear()
        found = set(chain.from_iterable(map(self.__getitem__, set(_CUT(text)))))
        found.update(chain.from_iterable(map(self.of_reading, self.restorer.runs(text))))
        return found


@dataclass
class ToxicityModel:
    letters: LetterModel
    weights: dict[str, float]  # of the chosen features
    telling: set[str]
    bias: float
    slope: float
    intercept: float
    known: Hits | None = field(default=None, repr=False)

    def score(self, text: str) -> float:
        if self.known is None:
            self.known = Hits(Restorer(self.letters), self.weights)
        hits = self.known.of(text)
        if not self.telling.isdisjoint(hits):
            hits.add(ANY_TELLING)
        z = self.bias + sum([self.weights[f] for f in sorted(hits)])
        return float(sigmoid(self.slope * z + self.intercept))


def fit(texts: list[str], y: np.ndarray, held: np.ndarray, counts: dict, letters: LetterModel) -> ToxicityModel:
    """Learns features and weights from texts with labels; ``held`` rows calibrate."""
    restorer = Restorer(letters)
    # Distinct restored words of each text (shared strings); features are made when needed.
    found = [tuple(set(restorer.words(t))) for t in texts]
    fitted = np.flatnonzero(~held)
    n1, n0 = max(1, int(y[fitted].sum())), max(1, int((1 - y[fitted]).sum()))
    toxic, clean = Counter(), Counter()
    for i in fitted:
        (toxic if y[i] else clean).update(features(found[i]))
    chosen, telling = [], set()
    for f in toxic.keys() | clean.keys():
        a, b = toxic[f], clean[f]
        if a + b < LEAST_DOCUMENTS:
            continue
        z = (math.log((a + 0.5) / n1) - math.log((b + 0.5) / n0)) / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        if abs(z) >= LEAST_Z:
            chosen.append((-abs(z), f))
            if z > 0 and a / n1 >= TELLING * (a / n1 + (b + 0.5) / n0):
                telling.add(f)
    names = [f for _, f in sorted(chosen)[:MOST_FEATURES]]
    telling &= set(names)
    del toxic, clean
    number = {f: i for i, f in enumerate([*names, ANY_TELLING])}
    rows = []
    for words in found:
        own = features(words) & number.keys()
        if not telling.isdisjoint(own):
            own.add(ANY_TELLING)
        rows.append(np.array(sorted(number[f] for f in own), np.int64))
    names = list(number)

    def matrix(pick):
        return Sparse([rows[i] for i in pick], [np.ones(len(rows[i])) for i in pick], len(names))

    balanced = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    w, b = fit_logistic(matrix(fitted), y[fitted], balanced[fitted], l2=L2, steps=120)
    check = np.flatnonzero(held) if held.any() else fitted
    weight = class_weights(y, counts)
    slope, intercept = fit_platt(matrix(check).dot(w) + b, y[check], weight[check])
    return ToxicityModel(letters, {f: float(v) for f, v in zip(names, w)}, telling, b, slope, intercept)


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel | None:
    """Fits on at most about ``per_class`` labelled documents of each label, from rows whose
    crc32 of doc_id is not divisible by 5. Of a text, the distinct words reach the driver
    (and its runs of single characters). None if the labels do not hold both values."""
    sample, counts = labelled_texts(documents, labels, "toxic", per_class, only_train_fold=True)
    if len(counts) < 2:
        return None

    def distinct(part, texts):
        made = []
        for t in texts:
            words = sorted(set(_CUT(t)))
            # " .. " keeps single characters from becoming a run that the text does not have.
            made.append(" .. ".join(words + _SPACED(t)))
        return {"doc_id": part.column(0), "y": part.column(1), "text": pa.array(made, pa.string())}

    got = map_texts(sample.select("doc_id", "y", "text"), distinct, "doc_id long, y int, text string").toArrow().to_pylist()
    by_id = {r["doc_id"]: r for r in sorted(got, key=lambda r: (r["doc_id"], r["text"]))}
    rows = [by_id[k] for k in sorted(by_id)]
    y = np.array([r["y"] for r in rows], float)
    if len(set(y)) < 2:
        return None
    held = np.array([r["doc_id"] % 4 == 0 for r in rows])
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held[:] = False
    return fit([r["text"] for r in rows], y, held, counts, letter_model(documents))


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document row, from the text alone.

    Null and empty texts are scored like a text without words; without a model every score
    is 0. A score of exactly 0.5 is predicted toxic. Repeated rows give repeated results;
    null doc_ids are not held out; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample and the trigrams

    def run(part, texts):
        own = shared.value
        values = [own.score(t or "") for t in texts] if own else [0.0] * len(texts)
        return {"doc_id": part.column(0), "held_out": part.column(1), "score": values,
                "predicted": [int(v >= 0.5) for v in values]}

    held = F.coalesce(~train_fold("doc_id"), F.lit(False))
    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                     .select("doc_id", held.alias("held_out"), "text"), run, SCHEMA)


def filtered(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic. Null and empty texts are
    scored like a text without words; repeated rows are kept or go alike; null doc_ids and
    columns of any name pass; without a model, as of an empty table, every row stays."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(texts):
        own = shared.value
        return [not own or own.score(t or "") < 0.5 for t in texts]

    return filter_texts(docs, keep)
