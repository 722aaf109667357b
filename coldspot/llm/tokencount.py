"""Token counts (operator 9): count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces ending at each character; dynamic
programming carries, per position, only the best score and the number of pieces on the
best path. Tie rule of the unigram tokenizers: starts are tried from left to right and a
path is replaced only by a strictly better one, so the longest last piece wins a tie. A
character that is no piece itself may be taken as unknown (least score minus 10) and counts
one token per UTF-8 byte (byte fallback). Words are split at blanks (the blank becomes
U+2581 in front of its word), and the counts of words are remembered
(not of very long ones, so that what a worker holds is bounded in bytes).

The vocabulary (pieces and scores) is read from a sentencepiece model file; tokenizers are
never trained.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspot.llm.common import map_texts

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 500_000
CACHED_CHARS = 48  # the counts of longer words are not remembered


def read_pieces(path: str) -> list[tuple[str, float]]:
    """All pieces with their scores, in id order (control and byte pieces included)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter(dict):
    """Counts tokens of texts; the dict holds the counts of words met before."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.singles = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        n = len(word)
        best: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        best[0] = 0.0
        done = 0  # ends below or at it are final

        def unknown_at(end: int) -> None:
            c = word[end - 1]
            if c not in self.singles and best[end - 1] is not None:
                score = best[end - 1] + self.unknown
                if best[end] is None or score > best[end]:
                    best[end], count[end] = score, count[end - 1] + len(c.encode("utf-8"))

        for last, (size, value) in self.automaton.iter(word):
            end = last + 1
            while done < end - 1:
                done += 1
                unknown_at(done)
            start = end - size
            if best[start] is not None:
                score = best[start] + value
                if best[end] is None or score > best[end]:
                    best[end], count[end] = score, count[start] + 1
        while done < n:
            done += 1
            unknown_at(done)
        if n <= CACHED_CHARS:
            self[word] = count[n]
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if len(self) > CACHE_WORDS:
            self.clear()
        words = text.replace(BLANK, " ").split(" ")
        if not words[0]:
            words = words[1:]  # the text starts with a blank: none is put in front
        return sum([self[BLANK + w] for w in words])


@lru_cache(maxsize=2)
def _counter(path: str) -> UnigramCounter:
    return UnigramCounter(read_pieces(path))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens) of every whole text. Null and empty texts have 0 tokens; a row
    per input row, repeated rows and null doc_ids included; other columns are ignored."""

    def run(part, texts):
        count = _counter(path).count
        return {"doc_id": part.column(0), "n_tokens": [count(t) if t else 0 for t in texts]}

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                     "doc_id long, n_tokens long")
