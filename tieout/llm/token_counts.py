"""Token counts of a unigram vocabulary: Viterbi that carries scores and counts only.

An Aho-Corasick automaton lists all vocabulary pieces in a word, by their end.
The best score and the number of pieces are kept per position; no path is stored.

Exact rules of the unigram tokenizers: scores add up; a piece of a character that
is no piece costs the lowest score less ten and counts as its UTF-8 bytes; of
equal scores the path whose last piece starts first stays. Texts are cut before each
run of space marks, which no piece of the vocabularies that are accepted crosses; a
run stays whole, so pieces of several marks are matched.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import by_batch, texts_of
from .pieces import SPACE, Pieces

#: Fixed value of the unigram tokenizers.
UNKNOWN_PENALTY = 10.0
REMEMBERED = 300_000
WORDS = re.compile(r"[ ▁]+[^ ▁]*")


@dataclass
class Counter:
    pieces: Pieces
    remembered: int = REMEMBERED
    known: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        scores = []
        for text, score, kind in zip(self.pieces.text, self.pieces.score, self.pieces.kind):
            if kind == "normal":
                self.automaton.add_word(text, (len(text), score))
                scores.append(score)
        self.automaton.make_automaton()
        self.unknown = min(scores) - UNKNOWN_PENALTY
        self.single = {t for t, k in zip(self.pieces.text, self.pieces.kind) if k == "normal" and len(t) == 1}

    def count(self, word: str) -> int:
        """Pieces of the best path through one word."""
        n = len(word)
        if not self.single.issuperset(word):
            return self.count_spelled(word)
        best, pieces = [0.0] + [-math.inf] * n, [0] * (n + 1)
        # matches come by their end, the longest first: a tie does not replace it
        for last, (length, score) in self.automaton.iter(word):
            total = best[last + 1 - length] + score
            if total > best[last + 1]:
                best[last + 1], pieces[last + 1] = total, pieces[last + 1 - length] + 1
        return pieces[n]

    def count_spelled(self, word: str) -> int:
        """The same for a word with characters that are no pieces."""
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, (length, score) in self.automaton.iter(word):
            ends[last + 1].append((length, score))
        best, pieces = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            top, count, single = None, 0, False
            # longer pieces start earlier and are tried first: a tie does not replace them
            for length, score in sorted(ends[end], reverse=True):
                single = single or length == 1
                total = best[end - length] + score
                if top is None or total > top:
                    top, count = total, pieces[end - length] + 1
            if not single:
                total = best[end - 1] + self.unknown
                if top is None or total > top:
                    top, count = total, pieces[end - 1] + len(word[end - 1].encode())
            best[end], pieces[end] = top, count
        return pieces[n]

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        words = WORDS.findall(" " + text)
        known = self.known
        new = set(words).difference(known)
        if len(known) + len(new) > self.remembered:
            known.clear()
            new = set(words)
        for w in new:
            known[w] = self.count(w.replace(" ", SPACE))
        return sum(map(known.__getitem__, words))


def token_counts(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """(doc_id, n_tokens) of every whole text.

    A null or empty text has no tokens. Repeated rows are separate rows; the id
    may be null; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # bounded by the vocabulary

    def work(batch: pa.RecordBatch, counter: Counter) -> pa.RecordBatch:
        counts = pa.array(map(counter, texts_of(batch)), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), counts], ["doc_id", "n_tokens"])

    kind = dict(docs.dtypes)["doc_id"]
    return by_batch(docs.select("doc_id", "text"), work, f"doc_id {kind}, n_tokens long", lambda: Counter(shared.value))
