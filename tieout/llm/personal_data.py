"""Personal data: base patterns, and a conditional random field for what has no pattern.

The field is a linear chain over word shapes, trained from a small table of
labelled sentences by gradient ascent on its likelihood (forward-backward in
numpy). Every word of a text has its scores. Words for which the weights prove that
the best path is outside there cut the chain exactly; the stretches between them are
decoded by Viterbi, all stretches of a batch at once.

Base spans always stay. Spans of the field that touch a base span are dropped.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import by_batch, texts_of

KINDS = ("email", "ip", "card", "phone")
#: Kinds that the field adds, in the order of the result.
MORE_KINDS = ("secret", "local_phone")
TAGS = ("O", "B-secret", "I-secret", "B-local_phone", "I-local_phone")

# Fixed patterns of the base kinds. Possessive runs and the look-behind change no
# match; they keep long runs of digits from being tried from each of their digits.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    out: list[Span] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[Span]]:
    """Leftmost non-overlapping spans per base kind, in code points, end exclusive."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        # more than three digits after leading zeros are above 255
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out["phone"].append(m.span())
    return out


# Words and their features

TOKEN = re.compile(r"[^ \t\n\r\x0b\x0c]+")
SHAPES = 4096
#: Classes of ASCII characters, as in ``shape``.
CLASSES = {i: "A" if chr(i).isupper() else "9" if chr(i).isdigit() else "a" for i in range(128) if chr(i).isalnum()}
RUNS = re.compile(r"(.)\1+", re.S)


def shape(word: str) -> str:
    """Classes of characters, runs written once: "Ab9-x" gives "Aa9-a"."""
    out = []
    for c in word[:64]:
        s = "A" if c.isupper() else "9" if c in "0123456789" else "a" if c.isalpha() else c
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out)


def number(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little") % SHAPES


@lru_cache(20_000)
def numbers(*names: str) -> list[int]:
    return [number(n) for n in names]


def features(word: str) -> list[int]:
    """Feature numbers of one word; the same in training and decoding, on any machine."""
    if word.isascii():
        classes = word.translate(CLASSES)
        looks = RUNS.sub(r"\1", classes[:64])
        digits = classes.count("9")
        letters = classes.count("a") + classes.count("A")
    else:
        looks = shape(word)
        digits = sum(c in "0123456789" for c in word)
        letters = sum(map(str.isalpha, word))
    switches = sum((a in "0123456789") != (b in "0123456789") for a, b in zip(word[:64], word[1:65])) if digits else 0
    core = word.strip(".,;:!?()[]{}\"'").lower()
    return [
        *numbers(
            "shape=" + looks[:6],
            f"length={min(len(word), 40) // 4}",
            f"digits={min(digits, 12)}",
            f"share={(4 * digits) // max(1, digits + letters)}",
            f"switches={min(switches, 8)}",
            f"upper={word.isupper()}",
        ),
        number("word=" + core if len(core) <= 10 and not digits else "word="),
        number("head=" + re.split(r"[=:]", core)[0]) if "=" in word else NO_HEAD,
        number("sign=" + word) if len(word) == 1 and not word.isalnum() else NO_SIGN,
        number("begin=" + word[:4]) if len(word) >= 16 and word.isalnum() and word.isupper() else NO_BEGIN,
    ]


NO_HEAD, NO_SIGN, NO_BEGIN = number("head="), number("sign="), number("begin=")


@dataclass(frozen=True)
class Field:
    """Weights by (place in the window, feature, tag), between tags, and at the start."""

    emit: np.ndarray  # 3 x SHAPES x tags
    move: np.ndarray  # tags x tags
    start: np.ndarray


WIDTH = 10


def emissions(field: Field, feats: np.ndarray) -> np.ndarray:
    """Scores (sequences, length, tags) of feature numbers (sequences, length, WIDTH)."""
    own = field.emit[1][feats].sum(2)
    if feats.shape[1] > 1:
        own[:, 1:] += field.emit[0][feats[:, :-1]].sum(2)
        own[:, :-1] += field.emit[2][feats[:, 1:]].sum(2)
    return own


def viterbi(field: Field, scores: np.ndarray) -> np.ndarray:
    """Best tags (sequences, length)."""
    n, length, tags = scores.shape
    best = field.start + scores[:, 0]
    back = np.zeros((n, length, tags), np.int8)
    for t in range(1, length):
        paths = best[:, :, None] + field.move
        back[:, t] = paths.argmax(1)
        best = paths.max(1) + scores[:, t]
    out = np.zeros((n, length), np.int8)
    out[:, -1] = best.argmax(1)
    for t in range(length - 1, 0, -1):
        out[:, t - 1] = back[np.arange(n), t, out[:, t]]
    return out


def viterbi_runs(move: np.ndarray, scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, tags: np.ndarray) -> None:
    """Write the best tags of runs of any lengths to ``tags``; scores (words, tags) have the start and the end added.

    All runs go forward together, the longest first, so those still going are the first ones.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    steps = int(lengths.max(initial=0))
    going = np.searchsorted(-lengths, -np.arange(steps), side="left")
    best = scores[starts]
    back = np.zeros(scores.shape, np.int8)
    for t in range(1, steps):
        n = going[t]
        paths = best[:n, :, None] + move
        back[starts[:n] + t] = paths.argmax(1)
        best[:n] = paths.max(1) + scores[starts[:n] + t]
    now = best.argmax(1)
    for t in range(steps - 1, -1, -1):
        n = going[t]
        tags[starts[:n] + t] = now[:n]
        if t:
            now[:n] = back[starts[:n] + t, now[:n]]


def logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(table: list[tuple[list[str], list[str]]], rounds: int = 60, rate: float = 0.3, shrink: float = 1e-3) -> Field:
    """Fit the field to (words, tags) rows. Rows without words, or with unequal lengths, are left out.

    Without rows all weights are zero and the field never leaves "O".
    """
    tags = len(TAGS)
    field = Field(np.zeros((3, SHAPES, tags)), np.zeros((tags, tags)), np.zeros(tags))
    groups: dict[int, list] = {}
    for words, marks in table:
        if words and marks and len(words) == len(marks) and all(w is not None and m in TAGS for w, m in zip(words, marks)):
            groups.setdefault(len(words), []).append(([features(w) for w in words], [TAGS.index(m) for m in marks]))
    batches = [(np.array([a for a, _ in g]), np.array([b for _, b in g])) for _, g in sorted(groups.items())]
    total = sum(len(b) for _, b in batches)
    # an inside tag follows only its own kind
    banned = np.zeros((tags, tags))
    banned_start = np.zeros(tags)
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            banned_start[j] = -50.0
            for i, before in enumerate(TAGS):
                if before[1:] != tag[1:] or before == "O":
                    banned[i, j] = -50.0
    params = [field.emit, field.move, field.start]
    seen = [np.zeros_like(p) for p in params]
    for _ in range(rounds if total else 0):
        grads = [-shrink * p for p in params]
        now = Field(params[0], params[1] + banned, params[2] + banned_start)
        for feats, gold in batches:
            scores = emissions(now, feats)
            n, length, _ = scores.shape
            fwd, bwd = np.zeros_like(scores), np.zeros_like(scores)
            fwd[:, 0] = now.start + scores[:, 0]
            for t in range(1, length):
                fwd[:, t] = logsum(fwd[:, t - 1][:, :, None] + now.move, 1) + scores[:, t]
            for t in range(length - 2, -1, -1):
                bwd[:, t] = logsum(now.move + (scores[:, t + 1] + bwd[:, t + 1])[:, None, :], 2)
            z = logsum(fwd[:, -1], 1)
            miss = np.eye(tags)[gold] - np.exp(fwd + bwd - z[:, None, None])  # observed less expected
            for place, (a, b) in enumerate(((miss[:, 1:], feats[:, :-1]), (miss, feats), (miss[:, :-1], feats[:, 1:]))):
                if b.size:
                    np.add.at(grads[0][place], b.reshape(-1, WIDTH), a.reshape(-1, tags)[:, None, :] / total)
            grads[2] += miss[:, 0].sum(0) / total
            for t in range(1, length):
                pair = fwd[:, t - 1][:, :, None] + now.move + (scores[:, t] + bwd[:, t])[:, None, :] - z[:, None, None]
                grads[1] -= np.exp(pair).sum(0) / total
                np.add.at(grads[1], (gold[:, t - 1], gold[:, t]), 1 / total)
        for p, g, s in zip(params, grads, seen):  # adaptive steps
            s += g * g
            p += rate * g / (np.sqrt(s) + 1e-8)
    return Field(params[0], params[1] + banned, params[2] + banned_start)


def labelled_table(spark: SparkSession, rows: int = 1_200, seed: int = 7) -> DataFrame:
    """A small labelled table (words, tags) of invented sentences, for callers without their own."""
    return spark.createDataFrame(example_sentences(rows, seed), "words array<string>, tags array<string>")


def example_sentences(rows: int = 400, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    rng = random.Random(seed)
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    low, hexa, caps = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

    names = ("password", "passwd", "secret", "token", "key", "api_key", "pwd")

    def plain() -> str:
        word = pick(low, rng.randint(2, 11))
        long = pick(low, rng.randint(12, 24))
        return rng.choice((word, word, word, word.capitalize(), word + ",", word + ".", word.upper(), word + ":", long, long.capitalize(), long.upper()))

    def number() -> list[str]:
        return rng.choice((
            [pick("123456789", rng.randint(1, 4))], [f"{rng.randint(1, 9)}.{rng.randint(0, 9)}."], ["version", f"{rng.randint(1, 9)}."],
            [f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}"],
            [pick("0123456789", 16)], [f"{pick(low, 4)}.{rng.randint(1, 99)}@{pick(low, 5)}.example.com"], [f"{plain()[:4]}-{rng.randint(1, 20)}"],
            ["+1", f"({pick('23456789', 3)})", f"555-{pick('0123456789', 4)}"], [f"{rng.randint(1900, 2040)}"], [f"{pick(low, 3)}={pick(low, 4)}"],
            [f"{rng.randint(1, 9)},{pick('0123456789', 3)}"], ["="], [rng.choice(names)], [f"{pick(low, 4)}_{pick(low, 5)}"], [f"{pick(low, 1)}{rng.randint(1, 99)}"],
        ))

    def secret() -> list[str]:
        name = rng.choice(names)
        value = rng.choice((pick(hexa, rng.randint(12, 44)), pick(low, rng.randint(8, 24))))
        aws = "AKIA" + pick(rng.choice((caps, caps[:26])), 16)
        return rng.choice(([f"{name}={value}"], [name, "=", f'"{value}"'], [aws], [f'{name}="{value}"'], [name, "=", value], [f"{name}:", value], [f"{name}:", value]))

    def local() -> list[str]:
        return [f"({pick('23456789', 3)})", f"{pick('23456789', 3)}-{pick('0123456789', 4)}"]

    table = []
    for _ in range(rows):
        words, tags = [], []
        for _ in range(rng.randint(1, 3)):
            for _ in range(rng.randint(1, 4)):
                words.append(plain())
                tags.append("O")
            kind, made = rng.choice((("O", number()), ("O", number()), ("secret", secret()), ("local_phone", local())))
            words += made
            tags += ["O"] * len(made) if kind == "O" else [f"B-{kind}"] + [f"I-{kind}"] * (len(made) - 1)
        words.append(plain())
        tags.append("O")
        table.append((words, tags))
    return table


#: Memory of a task for words that it has seen, in bytes; all are forgotten when there are more.
REMEMBERED_BYTES = 250_000_000


class Finder:
    """Spans of the field in whole texts."""

    def __init__(self, field: Field, remembered: int = REMEMBERED_BYTES):
        # a word's scores, its bytes, and about a hundred bytes of places in tables
        self.field, self.remembered = field, remembered // (3 * len(TAGS) * 8 + 150)
        self.known: dict[bytes, int] = {}
        self.scores = np.zeros((1024, 3, len(TAGS)))  # per known word and place in the window
        move = field.move
        # least gain of "O" over a tag, towards the tag before (or the start) and the tag after
        before = np.minimum((move[:, :1] - move).min(0), field.start[0] - field.start)
        inner = [j for j, tag in enumerate(TAGS) if tag[0] == "I"]
        outer = [j for j in range(len(TAGS)) if j not in inner]
        self.before, self.after = before, (move[:1, outer] - move[:, outer]).min(1)
        # an inside tag after it becomes the begin tag of its kind: (tag, begin tag, least gain per tag before it)
        self.turned = [
            (j, j - 1, move[0, j - 1] - move[:, j] + min(0.0, (move[j - 1] - move[j]).min())) for j in inner
        ]

    def numbers(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = set(words).difference(known)
        if len(known) + len(new) > self.remembered:
            known.clear()
            new = set(words)
        if new:
            first = len(known)
            if first + len(new) > len(self.scores):
                more = np.zeros((2 * (first + len(new)), *self.scores.shape[1:]))
                more[:first] = self.scores[:first]
                self.scores = more
            feats = np.array([features(w.decode("utf-8", "surrogatepass")) for w in new])
            self.scores[first : first + len(new)] = self.field.emit[:, feats].sum(2).transpose(1, 0, 2)
            known.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def open_words(self, scores: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Which words may be other than "O" in a best path.

        A path that has tag y at a word gains by having "O" there instead, whatever
        its other tags are, if the least of all gains is above zero; an inside tag
        that follows becomes a begin tag.
        """
        own = scores[:, :1] - scores + self.before
        rest = np.broadcast_to(self.after, own.shape).copy()
        for inside, begin, gain in self.turned:
            turn = scores[1:, begin] - scores[1:, inside]
            rest[:-1] = np.minimum(rest[:-1], turn[:, None] + gain)
        rest[last] = 0.0
        return ((own + rest)[:, 1:] <= 1e-6).any(1)

    def tagged(self, split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of all words of all texts in a row, and where each text begins."""
        bounds = np.concatenate(([0], np.cumsum([len(w) for w in split], dtype=np.int64)))
        words = [w for ws in split for w in ws]
        tags = np.zeros(len(words), np.int8)
        if not words:
            return tags, bounds
        ids = self.numbers(words)
        first, last = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        filled = bounds[1:] > bounds[:-1]
        first[bounds[:-1][filled]] = True
        last[bounds[1:][filled] - 1] = True
        scores = self.scores[ids, 1]
        scores[1:] += np.where(first[1:, None], 0.0, self.scores[ids[:-1], 0])
        scores[:-1] += np.where(last[:-1, None], 0.0, self.scores[ids[1:], 2])
        maybe = self.open_words(scores, last)
        # runs of open words within a text
        starts = np.flatnonzero(maybe & (first | ~np.concatenate(([False], maybe[:-1]))))
        ends = np.flatnonzero(maybe & (last | ~np.concatenate((maybe[1:], [False])))) + 1
        move, start = self.field.move, self.field.start
        scores[starts] += np.where(first[starts, None], start, move[0])
        scores[ends - 1] += np.where(last[ends - 1, None], 0.0, move[:, 0])
        viterbi_runs(move, scores, starts, ends - starts, tags)
        return tags, bounds

    def __call__(self, texts: list[str]) -> list[dict[str, list[Span]]]:
        out: list[dict[str, list[Span]]] = [{k: [] for k in MORE_KINDS} for _ in texts]
        # bytes are split at the same six characters as TOKEN
        tags, bounds = self.tagged([t.encode("utf-8", "surrogatepass").split() for t in texts])
        hits = np.flatnonzero(tags)
        for i in np.unique(np.searchsorted(bounds, hits, side="right") - 1).tolist():
            run = [m.span() for m in TOKEN.finditer(texts[i])]
            for kind, span in self.spans(tags[bounds[i] : bounds[i + 1]].tolist(), run):
                out[i][kind].append(self.trimmed(texts[i], span))
        for found in out:
            for kind in MORE_KINDS:
                found[kind] = sorted(set(found[kind]))
        return out

    @staticmethod
    def trimmed(text: str, span: Span) -> Span:
        a, b = span
        while b > a + 1 and text[b - 1] in ".,;:!?":
            b -= 1
        return a, b

    @staticmethod
    def spans(tags: list[int], run: list[Span]) -> list[tuple[str, Span]]:
        out: list[tuple[str, Span]] = []
        for tag, (a, b) in zip(tags, run):
            name = TAGS[tag]
            if name[0] == "B":
                out.append((name[2:], (a, b)))
            elif name[0] == "I" and out:
                out[-1] = (out[-1][0], (out[-1][1][0], b))
        return out


def all_spans(texts: list[str], finder: Finder) -> list[dict[str, list[Span]]]:
    found = finder(texts)
    out = []
    for text, more in zip(texts, found):
        spans = base_spans(text)
        taken = [s for k in KINDS for s in spans[k]]
        for kind in MORE_KINDS:
            spans[kind] = [(a, b) for a, b in more[kind] if not any(a < d and c < b for c, d in taken)]
        out.append(spans)
    return out


def joined(spans: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def personal_data(docs: DataFrame, labelled: DataFrame, bound: int = 2_000) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_local_phone).

    Reads every whole text; a null text counts as empty and has no spans. Offsets
    are code points. The field learns from the first ``bound`` rows of ``labelled``
    (words, tags) in the order of their words. Repeated rows are separate rows.
    """
    rows = labelled.select("words", "tags").filter("words is not null and tags is not null").orderBy("words", "tags").limit(bound)
    field = train([(list(r.words), list(r.tags)) for r in rows.collect()])
    shared = docs.sparkSession.sparkContext.broadcast(field)  # 3 x SHAPES x tags numbers

    def work(batch: pa.RecordBatch, finder: Finder) -> pa.RecordBatch:
        spans = all_spans(texts_of(batch), finder)
        base = [joined(s, KINDS) for s in spans]
        count = lambda k: pa.array([len(s[k]) for s in spans], pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), *[count(k) for k in KINDS],
                pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                pa.array([joined(s, KINDS + MORE_KINDS) for s in spans], pa.string()),
                *[count(k) for k in MORE_KINDS],
            ],
            ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", *[f"n_{k}" for k in MORE_KINDS]],
        )

    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
        "n_secret long, n_local_phone long"
    )
    return by_batch(docs.select("doc_id", "text"), work, schema, lambda: Finder(shared.value))
