"""Byte-pair encoding with a sentencepiece vocabulary, and decoding, in numpy.

A text becomes words: a run of spaces and what follows up to the next space. No
piece of the vocabularies that are accepted crosses such a border, so words are
encoded apart and frequent ones are remembered. All new words of a batch are one
flat array of symbols. Each round finds the best pair of every word (segmented
minimum), merges its occurrences from the left at once, and compacts the array,
until no pair of any word is in the vocabulary.

Merging all occurrences at once equals merging one after the other unless a merge
makes a still better pair; pieces for which that can happen are known from the
vocabulary, and of those only the leftmost occurrence is merged in a round.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import by_batch, texts_of

SPACE = "▁"
NONE = np.int32(2**31 - 1)
#: Words that a task remembers; all are forgotten when there are more.
REMEMBERED = 500_000
WORDS = re.compile(r" +[^ ]*")
#: The same for vocabularies where a line feed is in no piece but its own.
WORDS_AND_LINES = re.compile(r" +[^ \n]*|[^ \n]+|\n")


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: text, score and kind (normal, byte, control, unknown) by id."""

    text: list[str]
    score: list[float]
    kind: list[str]
    begin: int
    end: int

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = [
            "byte" if sp.is_byte(i) else "control" if sp.is_control(i) else "unknown" if sp.is_unknown(i) else "normal"
            for i in range(sp.get_piece_size())
        ]
        text = [sp.id_to_piece(i) for i in range(len(kinds))]
        crossing = [t for t, k in zip(text, kinds) if k == "normal" and SPACE in t.lstrip(SPACE)]
        if crossing or kinds.count("byte") != 256:
            raise ValueError(f"not a byte-fallback vocabulary of words: {crossing[:3]}")
        return cls(text, [sp.get_score(i) for i in range(len(text))], kinds, sp.bos_id(), sp.eos_id())


class Slots(dict[str, int]):
    """A number for each word, given out when it is first looked up."""

    def __missing__(self, word: str) -> int:
        self[word] = slot = len(self)
        return slot


@dataclass
class Encoder:
    pieces: Pieces
    remembered: int = REMEMBERED
    known: Slots = field(default_factory=Slots)

    def __post_init__(self) -> None:
        p = self.pieces
        # the ids of word i: flat[start[i] : start[i] + length[i]]
        self.flat, self.used = np.empty(1 << 16, "<u4"), 0
        self.start, self.length = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        ids = {t: i for i, (t, k) in enumerate(zip(p.text, p.kind)) if k == "normal"}
        # best score first; equal scores are one rank and go from the left
        rank_of = {s: r for r, s in enumerate(sorted({p.score[i] for i in ids.values()}, reverse=True))}
        self.rank = np.full(len(p.text), NONE, np.int32)
        shared: dict[int, int] = {}
        for i in ids.values():
            self.rank[i] = rank_of[p.score[i]]
            shared[rank_of[p.score[i]]] = shared.get(rank_of[p.score[i]], 0) + 1
        self.careful = np.zeros(len(p.text), bool)
        pairs: dict[int, int] = {}
        self.size = len(p.text)
        for t, i in ids.items():
            if shared[int(self.rank[i])] > 1:
                self.careful[i] = True
            for cut in range(1, len(t)):
                a, b = ids.get(t[:cut]), ids.get(t[cut:])
                for part in (a, b):
                    # this piece may be made of one that ranks behind it
                    if part is not None and self.rank[part] >= self.rank[i]:
                        self.careful[part] = True
                if a is not None and b is not None:
                    pairs[a * self.size + b] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in sorted(pairs)], np.int32)
        self.symbol = np.full(0x110000, -1, np.int32)
        for t, i in ids.items():
            if len(t) == 1:
                self.symbol[ord(t)] = i
        missing = {c for t in ids if len(t) > 1 for c in t if self.symbol[ord(c)] < 0}
        if missing:
            raise ValueError(f"characters of pieces that are no piece: {sorted(missing)[:5]}")
        lines = any("\n" in t for t in ids if t != "\n")
        self.cut = (WORDS if lines else WORDS_AND_LINES).findall
        self.byte_id = {int(p.text[i][3:5], 16): i for i, k in enumerate(p.kind) if k == "byte"}
        plain = [t.replace(SPACE, " ") if k == "normal" else "" for t, k in zip(p.text, p.kind)]
        self.plain = np.array(plain, object)
        self.byte_of = np.array([int(t[3:5], 16) if k == "byte" else -1 for t, k in zip(p.text, p.kind)], np.int16)
        # an ASCII byte is a character whatever is beside it; other bytes hang on their neighbours
        ascii_bytes = (self.byte_of >= 0) & (self.byte_of < 128) & (self.byte_of != 32)
        self.spelled = pa.array([chr(b) if a else t for t, b, a in zip(plain, self.byte_of, ascii_bytes)], pa.large_string())
        self.odd = np.array([k in ("byte", "unknown") for k in p.kind]) & ~ascii_bytes

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id of the piece that two neighbours make, or -1."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.made[at], -1)

    def merge(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit numbers."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        sym = self.symbol[code]
        sym = np.where(sym < 0, -2 - code.astype(np.int64), sym).astype(np.int32)  # unknown: keeps its code point
        made = np.full(len(sym), -1, np.int32)
        if len(sym) > 1:
            made[:-1] = np.where(word[1:] == word[:-1], self.pair(sym[:-1], sym[1:]), -1)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            rank = np.where(made >= 0, self.rank[made], NONE)
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(sym)))
            best = np.repeat(best, length)
            ended = best == NONE
            if ended.any():
                done.append((word[ended], sym[ended]))
                go = ~ended
                sym, word, made, rank, best = sym[go], word[go], made[go], rank[go], best[go]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == best)
            # of pairs that overlap, every other one from the left
            new_run = np.concatenate(([True], at[1:] != at[:-1] + 1))
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            leftmost = np.concatenate(([True], word[at[1:]] != word[at[:-1]]))
            at = at[((np.arange(len(at)) - run_start) % 2 == 0) & (leftmost | ~self.careful[made[at]])]
            sym[at] = made[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            sym, word, made = sym[keep], word[keep], made[keep]
            at = place[at]
            changed = np.zeros(len(sym), bool)
            changed[at] = True
            changed[at[at > 0] - 1] = True
            touched = np.flatnonzero(changed)
            made[touched] = -1
            touched = touched[touched < len(sym) - 1]
            touched = touched[word[touched] == word[touched + 1]]
            made[touched] = self.pair(sym[touched], sym[touched + 1])
        if not done:
            return [b""] * len(words)
        word, sym = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        word, sym = word[order], sym[order]
        ends = np.searchsorted(word, np.arange(len(words) + 1))
        out = sym.astype("<u4").tobytes()
        if (sym < 0).any():  # spell unknown characters as bytes
            odd = set(word[sym < 0].tolist())
        else:
            odd = ()
        got = [out[4 * a : 4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        for w in odd:
            ids: list[int] = []
            for s in sym[ends[w] : ends[w + 1]].tolist():
                ids += [s] if s >= 0 else [self.byte_id[b] for b in chr(-2 - s).encode()]
            got[w] = np.array(ids, "<u4").tobytes()
        return got

    def learn(self, fresh: list[str], first: int) -> None:
        """Encode words and remember their ids; the slots of ``fresh`` are first, first + 1, ..."""
        slots = first + len(fresh)
        if slots > len(self.start):
            self.start, self.length = (np.concatenate((x, np.empty(slots, np.int64))) for x in (self.start, self.length))
        # words of like length end in like rounds
        order = sorted(range(len(fresh)), key=lambda i: len(fresh[i]))
        for i in range(0, len(order), 100_000):
            part = order[i : i + 100_000]
            got = self.merge([fresh[j].replace(" ", SPACE) for j in part])
            ids = np.frombuffer(b"".join(got), "<u4")
            if self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate((self.flat[: self.used], np.empty(self.used + len(ids), "<u4")))
            length = np.fromiter((len(x) // 4 for x in got), np.int64, len(got))
            at = first + np.array(part)
            self.length[at] = length
            self.start[at] = self.used + np.cumsum(length) - length
            self.flat[self.used : self.used + len(ids)] = ids
            self.used += len(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts with begin and end ids. The empty text has no other ids."""
        if len(self.known) > self.remembered:
            self.known.clear()
            self.used = 0
        first, slot = len(self.known), self.known.__getitem__
        split = (self.cut(" " + t.replace(SPACE, " ")) if t else [] for t in texts)
        slots = [np.fromiter(map(slot, words), np.int64, len(words)) for words in split]
        if len(self.known) > first:
            self.learn(list(islice(self.known, first, None)), first)
        head, tail = np.array([self.pieces.begin], "<u4").tobytes(), np.array([self.pieces.end], "<u4").tobytes()
        return [head + self.ids_of(x).tobytes() + tail for x in slots]

    def ids_of(self, slots: np.ndarray) -> np.ndarray:
        """The ids of remembered words, one after the other."""
        length = self.length[slots]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.start[slots] - ends + length, length) + np.arange(total)]

    def decode(self, ids: bytes) -> str:
        """The text of ids: control pieces vanish, byte pieces are read as UTF-8, one space in front goes."""
        at = np.frombuffer(ids, "<u4").astype(np.int64)
        parts = self.plain[at].tolist()
        raw = self.byte_of[at]
        spelled = np.flatnonzero(raw >= 0)
        if len(spelled):
            runs = np.split(spelled, np.flatnonzero(np.diff(spelled) != 1) + 1)
            for run in runs:
                parts[run[0]] = loose_utf8(bytes(raw[run].astype(np.uint8)))
        for i in np.flatnonzero(at == 0).tolist() if self.pieces.kind[0] == "unknown" else ():
            parts[i] = " ⁇ "
        out = "".join(parts)
        # the mark in front of a first word is no part of the text
        first = next((i for i in at[:4].tolist() if self.pieces.kind[i] != "control"), 0)
        return out[1:] if self.pieces.kind[first] == "normal" and out.startswith(" ") else out


    def decode_all(self, ids: list[bytes]) -> list[bytes]:
        """``decode`` of each, as UTF-8. All texts without unknown pieces and non-ASCII bytes are spelled together."""
        at = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        bounds = np.cumsum([0, *(len(x) // 4 for x in ids)])
        _, ends, data = self.spelled.take(pa.array(at)).buffers()
        ends = np.frombuffer(ends, np.int64)[: len(at) + 1] if len(at) else np.zeros(1, np.int64)
        data = memoryview(data) if data is not None else memoryview(b"")
        odd = np.concatenate(([0], np.cumsum(self.odd[at])))[bounds]
        out = []
        for x, a, b, c, d in zip(ids, ends[bounds[:-1]].tolist(), ends[bounds[1:]].tolist(), odd[:-1].tolist(), odd[1:].tolist()):
            # the mark in front of a first word is no part of the text
            out.append(bytes(data[a + (data[a:b][:1] == b" ") : b]) if c == d else self.decode(x).encode())
        return out


def loose_utf8(raw: bytes) -> str:
    """Bytes as UTF-8; each byte that is no part of a character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError as wrong:
        return raw[: wrong.start].decode() + "�" + loose_utf8(raw[wrong.start + 1 :])


def encoded(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """(doc_id, ids, decoded) of every whole text; ids as little-endian 32-bit numbers.

    A null text counts as empty and has the begin and end ids only. Repeated rows
    are separate rows; the id may be null; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # bounded by the vocabulary

    def work(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
        ids = encoder.encode(texts_of(batch))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(encoder.decode_all(ids), pa.binary()).cast(pa.string())],
            ["doc_id", "ids", "decoded"],
        )

    kind = dict(docs.dtypes)["doc_id"]
    return by_batch(
        docs.select("doc_id", "text"), work, f"doc_id {kind}, ids binary, decoded string", lambda: Encoder(shared.value)
    )


def digests(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, as ``encoded``."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def work(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
        ids = encoder.encode(texts_of(batch))
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([sha(x) for x in ids], pa.string()),
                pa.array([sha(x) for x in encoder.decode_all(ids)], pa.string()),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return by_batch(docs.select("doc_id", "text"), work, schema, lambda: Encoder(shared.value))
