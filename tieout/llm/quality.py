"""A quality classifier by attention over the passages of a document.

Multiple-instance learning: a document is a bag of passages and only the document
has a label. Every passage is encoded; gated attention weighs the passages; the
weighted sum of their representations is scored. All weights are learned from the
document labels, so what marks a bad passage is found without passage labels.

A passage is 64 words, in texts of any length, and every passage of a text is scored.
Only what training sends to the driver is bounded: of a labelled document with more
than 64 passages it takes 64, spaced evenly. A passage's first encoding is counted
from the bytes with numpy; nothing but the text enters a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_batch, mix, texts_of

WORDS, PASSAGES = 64, 64
#: Labelled documents that the classifier learns from, at most.
SAMPLE = 3_000
THRESHOLD = 0.3
HIDDEN = 12

# Classes of bytes; what is counted of each passage.
SPACE, UPPER, LOWER, DIGIT, STOP, MARK, BAR, HIGH = range(8)
CLASS = np.full(256, MARK, np.uint8)
for _class, _bytes in (
    (SPACE, b" \t\n\r\x0b\x0c"), (UPPER, bytes(range(65, 91))), (LOWER, bytes(range(97, 123))),
    (DIGIT, bytes(range(48, 58))), (STOP, b".,;:'\""), (BAR, b"|<>{}[]\\/_="), (HIGH, bytes(range(128, 256))),
):
    CLASS[list(_bytes)] = _class
#: A pseudo-random number per byte, for hashing words by their bytes.
BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64))
FEATURES = 18


def passage_features(text: str) -> np.ndarray:
    """(passages, FEATURES) of one text; a text without words is one empty passage."""
    raw = np.frombuffer(text.encode(), np.uint8)
    kind = CLASS[raw]
    inside = kind != SPACE
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(starts)
    if not n:
        return np.zeros((1, FEATURES), np.float32)
    first = np.arange(0, n, WORDS)
    bag = len(first)
    of_word = np.arange(n) // WORDS
    words = np.diff(np.append(first, n)).astype(np.float64)
    # per passage: bytes of each class
    of_byte = np.repeat(np.arange(bag), np.diff(np.append(starts[first], len(raw)))) if bag else None
    counts = np.bincount(of_byte * 8 + kind[starts[0] :], minlength=bag * 8).reshape(bag, 8).astype(np.float64)
    chars = np.maximum(counts.sum(1) - counts[:, SPACE], 1)
    # per word: length, hash, first and last byte
    length = ends - starts
    # a word's hash sums its bytes' numbers, whatever their order: enough to see repeats
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_HASH[raw])))
    word = mix(sums[ends] - sums[starts] + length.astype(np.uint64))
    same = np.concatenate(([False], word[1:] == word[:-1]))
    # different words of a passage: sort by passage, then hash
    key = np.sort((of_word.astype(np.uint64) << np.uint64(40)) | (word >> np.uint64(24)))
    fresh = np.concatenate(([True], key[1:] != key[:-1]))
    distinct = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=bag)
    per = lambda x: np.bincount(of_word, weights=x, minlength=bag) / words
    head, tail = kind[starts], kind[ends - 1]
    mean = per(length)
    lines = np.bincount(of_byte, weights=raw[starts[0] :] == 10, minlength=bag)
    out = np.stack(
        [
            *[counts[:, c] / chars for c in (UPPER, LOWER, DIGIT, STOP, MARK, BAR, HIGH)],
            per(same),
            distinct / words,
            mean / 10,
            np.sqrt(np.maximum(per(length * length) - mean * mean, 0)) / 10,
            per(head == UPPER),
            per(tail == MARK),
            per(tail == STOP),
            per(length == 1),
            lines / words,
            np.log1p(words) / 4,
            np.full(bag, np.log1p(n) / 8),
        ],
        axis=1,
    )
    return out.astype(np.float32)


def training_bag(text: str) -> np.ndarray:
    """At most PASSAGES passages of a text, spaced evenly."""
    bag = passage_features(text)
    return bag[np.linspace(0, len(bag) - 1, PASSAGES).round().astype(int)] if len(bag) > PASSAGES else bag


@dataclass(frozen=True)
class Model:
    """Encoder, gated attention and score; ``constant`` when there was nothing to learn."""

    centre: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bags), self.constant)
        x, of = flat(bags)
        return forward(self.weights, (x - self.centre) / self.scale, of, len(bags))["p"]


def flat(bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    of = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    return np.concatenate(bags).astype(np.float64) if bags else np.zeros((0, FEATURES)), of


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def forward(w: dict[str, np.ndarray], x: np.ndarray, of: np.ndarray, n: int) -> dict[str, np.ndarray]:
    h = np.tanh(x @ w["enc"] + w["enc_b"])
    t, g = np.tanh(h @ w["att"] + w["att_b"]), sigmoid(h @ w["gate"] + w["gate_b"])
    e = (t * g) @ w["focus"]
    first = np.searchsorted(of, np.arange(n))
    a = np.exp(e - np.maximum.reduceat(e, first)[of]) if len(e) else e
    a = a / np.add.reduceat(a, first)[of] if len(a) else a
    z = np.add.reduceat(h * a[:, None], first, axis=0) if len(a) else np.zeros((n, h.shape[1]))
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": sigmoid(z @ w["out"] + w["out_b"][0])}


def learn(bags: list[np.ndarray], labels: np.ndarray, rounds: int = 120, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Fit by Adam on the mean log loss; classes weigh alike. One class only: its label is the score."""
    if not len(bags) or labels.min() == labels.max():
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {}, float(labels.mean()) if len(bags) else 0.5)
    x, of = flat(bags)
    centre, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - centre) / scale
    rng = np.random.default_rng(11)
    draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    w = {
        "enc": draw(FEATURES, HIDDEN), "enc_b": np.zeros(HIDDEN), "att": draw(HIDDEN, HIDDEN), "att_b": np.zeros(HIDDEN),
        "gate": draw(HIDDEN, HIDDEN), "gate_b": np.zeros(HIDDEN), "focus": draw(HIDDEN), "out": draw(HIDDEN), "out_b": np.zeros(1),
    }
    n = len(bags)
    first = np.searchsorted(of, np.arange(n))
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / n
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        f = forward(w, x, of, n)
        up = (f["p"] - labels) * weight
        dz = up[:, None] * w["out"]
        dh = dz[of] * f["a"][:, None]
        da = (dz[of] * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, first)[of])
        dt = de[:, None] * w["focus"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * w["focus"] * f["t"] * f["g"] * (1 - f["g"])
        dh += dt @ w["att"].T + dg @ w["gate"].T
        du = dh * (1 - f["h"] ** 2)
        grad = {
            "enc": x.T @ du, "enc_b": du.sum(0), "att": f["h"].T @ dt, "att_b": dt.sum(0), "gate": f["h"].T @ dg,
            "gate_b": dg.sum(0), "focus": (f["t"] * f["g"]).T @ de, "out": f["z"].T @ up, "out_b": up.sum(keepdims=True),
        }
        for k in w:
            d = grad[k] + decay * w[k]
            m1[k] = 0.9 * m1[k] + 0.1 * d
            m2[k] = 0.999 * m2[k] + 0.001 * d * d
            w[k] = w[k] - rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return Model(centre, scale, w)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled documents, drawn by a hash of their ids.

    Of repeated labels the lower counts; labels other than 0 and 1, and ids that
    are held out, are left out. Texts stay on the executors, which send encoded
    passages: at most ``sample`` times PASSAGES rows of FEATURES numbers.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    marks = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    drawn = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # sample rows

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bags = [training_bag(t).tobytes() for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(bags, pa.binary())], ["doc_id", "label", "bag"]
        )

    kind = dict(docs.dtypes)["doc_id"]
    encoded = by_batch(texts.select("doc_id", "label", "text"), work, f"doc_id {kind}, label int, bag binary")
    # one text per id, whichever way it is read
    rows = encoded.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("bag").alias("bag")).collect()
    rows.sort(key=lambda r: r.doc_id)  # the sum of gradients does not depend on how rows arrive
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, FEATURES) for r in rows]
    return learn(bags, np.array([r.label for r in rows], np.float64))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text, 0 to 1; a null text counts as empty. Rows are independent."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.scores([passage_features(t) for t in texts_of(batch)])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return by_batch(docs.select("doc_id", "text"), work, f"doc_id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``."""
    out = scored(docs, trained(docs, labels, sample))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows and columns of ``docs`` that the classifier does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, sample))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.scores([passage_features(t) for t in texts_of(batch)])
        return batch.filter(pa.array(scores >= threshold))

    return by_batch(docs, work, docs.schema)
