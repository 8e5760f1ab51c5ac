"""Repeated passages by seed and extend.

Seeds are winnowed anchors: of every 9 consecutive 5-word hashes the least, so any
13 common words hold a common anchor. Anchors that more than one document has
are joined back to their places. Each place is extended both ways to the 13-word
windows whose least hash it is (equal windows have the same one), and per window the
smallest document is elected by an aggregate; windows that a smaller document also
has are the matches. That is done for a part of all window hashes at a time, so only a
part of them is in shuffles at once. Neighbouring matches join to maximal repeats, and
the words they cover are removed.

Nothing is compared pair by pair: a passage that a third of all documents share is
one row per task and window before it moves. Copies of a whole text are settled
beforehand by a digest of their words.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, forget
from .common import STEP, STEP_2, Words, by_batch, sequences, texts_of

WINDOW, SEED = 13, 5
#: Windows are matched by hash in so many parts, one after the other.
PARTS = 2


def words_of(text: str) -> list[bytes]:
    return text.encode().split()


def anchor_of_windows(seeds: np.ndarray) -> np.ndarray:
    """The place of each window's anchor among the seed hashes of a text of WINDOW words or more."""
    span = WINDOW - SEED + 1
    # the least of each run of seeds, the first of equal ones, by halves: 8 = 4 + 4, then one more
    best = np.arange(len(seeds))
    for gap in (1, 2, 4, 1):
        left, right = best[:-gap], best[gap:]
        best = np.where(seeds[right] < seeds[left], right, left)
    assert len(best) == len(seeds) - span + 1
    return best


def anchors(seeds: np.ndarray) -> np.ndarray:
    """The places of all anchors, each once."""
    best = anchor_of_windows(seeds)
    return best[np.concatenate(([True], best[1:] != best[:-1]))]  # they never go back


def first_pass(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, words_key, ver, all_sha256) of every text; ``ver`` tells texts of one id apart."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        joined, sizes = [], []
        for t in texts_of(batch):
            w = words_of(t)
            sizes.append(len(w))
            joined.append(b" ".join(w))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(sizes, pa.int64()),
                pa.array([xxhash.xxh3_128_digest(j) for j in joined], pa.binary()),
                pa.array([version(j) for j in joined], pa.int32()),
                pa.array([hashlib.sha256(j).hexdigest() for j in joined], pa.string()),
            ],
            ["doc_id", "n_words", "words_key", "ver", "all_sha256"],
        )

    return by_batch(docs, work, "doc_id long, n_words long, words_key binary, ver int, all_sha256 string")


def version(joined: bytes) -> int:
    return xxhash.xxh3_64_intdigest(joined) & 0x7FFFFFFF


def seed_places(docs: DataFrame, places: bool) -> DataFrame:
    """(h, doc) of the different anchors of each text, or (h, doc, at) of all their places."""

    def work(batch: pa.RecordBatch, words: Words) -> pa.RecordBatch:
        h, bounds = words(batch.column("text"))
        runs = sequences(h, SEED)
        hs, ats, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            at = np.empty(0, np.int64)
            if b - a >= WINDOW:
                seeds = runs[a : b - SEED + 1]
                at = anchors(seeds)
                hs.append(seeds[at] if places else np.unique(seeds[at]))
                ats.append(at)
            sizes.append(len(hs[-1]) if len(at) else 0)
        ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), sizes)
        out = [np.concatenate(hs).view(np.int64), ids]
        if places:
            out.append(np.concatenate(ats).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["h", "doc", "at"][: len(out)])

    return by_batch(docs, work, "h long, doc long" + ", at int" * places, lambda: Words(lower=False))


def extended(texts: DataFrame) -> DataFrame:
    """(w1, w2, doc, ver, at): the windows of each text whose anchor is at one of the places ``ats``."""

    def work(batch: pa.RecordBatch, own: tuple[Words, zstandard.ZstdDecompressor]) -> pa.RecordBatch:
        words, unpack = own
        out: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(5)]
        h, bounds = words(pa.array(map(unpack.decompress, batch.column("body").to_pylist()), pa.binary()))
        seeds = sequences(h, SEED)
        one, two = (sequences(h, WINDOW, step).view(np.int64) for step in (STEP, STEP_2))
        for i, (d, v, ats) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc", "ver", "ats")))):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if b - a < WINDOW:
                continue
            shared = np.zeros(b - a - SEED + 1, bool)
            ats = np.array(ats)
            shared[ats[ats < len(shared)]] = True  # other texts of this id may be longer
            at = np.flatnonzero(shared[anchor_of_windows(seeds[a : b - SEED + 1])])
            here = at + a
            for column, values in zip(out, (one[here], two[here], np.full(len(at), d), np.full(len(at), v), at)):
                column.append(values)
        arrays = [pa.array(np.concatenate(c)) for c in out]
        arrays[3:] = [c.cast(pa.int32()) for c in arrays[3:]]
        return pa.RecordBatch.from_arrays(arrays, ["w1", "w2", "doc", "ver", "at"])

    schema = "w1 long, w2 long, doc long, ver int, at int"
    return by_batch(texts, work, schema, lambda: (Words(lower=False), zstandard.ZstdDecompressor()))


def repeats(ats: np.ndarray) -> list[tuple[int, int]]:
    """Maximal repeats (from word, to word) of matching window starts."""
    ats = np.unique(ats)
    if not len(ats):
        return []
    breaks = np.flatnonzero(np.diff(ats) > WINDOW)
    starts = ats[np.concatenate(([0], breaks + 1))]
    ends = ats[np.concatenate((breaks, [len(ats) - 1]))] + WINDOW
    return list(zip(starts.tolist(), ends.tolist()))


def without_repeats(texts: DataFrame) -> DataFrame:
    """(doc, ver, n_removed, kept_sha256) from (doc, ver, body, ats)."""

    def work(batch: pa.RecordBatch, unpack: zstandard.ZstdDecompressor) -> pa.RecordBatch:
        removed, shas = [], []
        for body, ats in zip(batch.column("body").to_pylist(), batch.column("ats").to_pylist()):
            words = unpack.decompress(body).split()
            kept, at = [], 0
            for a, b in repeats(np.array(ats)):
                kept += words[at:a]
                at = b
            kept += words[at:]
            removed.append(len(words) - len(kept))
            shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("ver"), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
            ["doc", "ver", "n_removed", "kept_sha256"],
        )

    return by_batch(texts, work, "doc long, ver int, n_removed long, kept_sha256 string", zstandard.ZstdDecompressor)


def shared_by_several(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur in more than one document, with the smallest; a written table."""
    ends = rows.groupBy(*keys).agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    return cut_lineage(ends.filter("least < most").select(*keys, "least"))


def matched(windows: DataFrame) -> DataFrame:
    """(doc, ver, ats): where the windows start that a smaller document also has; a written table."""
    elected = shared_by_several(windows, ["w1", "w2"])
    matches = windows.join(elected, ["w1", "w2"]).filter("doc > least").groupBy("doc", "ver").agg(F.collect_set("at").alias("ats"))
    matches = cut_lineage(matches)
    forget(elected)
    return matches


def repeated_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per row of ``docs``.

    A word goes if a window of 13 words over it also starts in a document with a
    smaller id. Words are cut at ASCII white space and compared unchanged; a null
    text has none. Texts under 13 words stay whole. A row without an id loses
    nothing and takes nothing from others; rows with the same id are not smaller
    than each other. No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    each = cut_lineage(first_pass(docs))
    named = docs.filter("doc_id is not null")
    firsts = cut_lineage(
        each.filter(f"doc_id is not null and n_words >= {WINDOW}").groupBy("words_key").agg(F.min("doc_id").alias("first"))
    )

    # anchors that several documents have, then those that several first copies have
    wide = shared_by_several(seed_places(named, False), ["h"])
    places = seed_places(named, True).join(wide.select("h"), "h", "left_semi")
    places = cut_lineage(places.join(firsts.select(F.col("first").alias("doc")), "doc", "left_semi"))
    narrow = shared_by_several(places, ["h"])
    seeds = cut_lineage(places.join(narrow.select("h"), "h", "left_semi").groupBy("doc").agg(F.collect_set("at").alias("ats")))
    forget(wide, places, narrow)

    # a document's places are bounded by its length; repeated rows are one text
    texts = packed(named).join(seeds, "doc").groupBy("doc", "ver").agg(
        F.first("body").alias("body"), F.first("ats").alias("ats")
    )
    texts = cut_lineage(texts)
    windows = cut_lineage(extended(texts))
    found = [matched(windows.filter(F.pmod("w1", F.lit(PARTS)) == part)) for part in range(PARTS)]
    forget(seeds, windows)
    matches = reduce(DataFrame.unionByName, found).groupBy("doc", "ver").agg(F.flatten(F.collect_list("ats")).alias("ats"))
    cut = cut_lineage(without_repeats(texts.select("doc", "ver", "body").join(matches, ["doc", "ver"])))
    forget(texts, *found)

    rows = each.join(firsts, "words_key", "left")
    copy = F.col("doc_id") > F.col("first")
    rows = rows.join(cut.withColumnRenamed("doc", "doc_id"), ["doc_id", "ver"], "left")
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "all_sha256")).alias("kept_sha256"),
    )


def packed(docs: DataFrame) -> DataFrame:
    """(doc, ver, body): texts compressed, as they are moved by id."""

    def work(batch: pa.RecordBatch, pack: zstandard.ZstdCompressor) -> pa.RecordBatch:
        joined = [b" ".join(words_of(t)) for t in texts_of(batch)]
        vers, bodies = pa.array(map(version, joined), pa.int32()), pa.array(map(pack.compress, joined), pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), vers, bodies], ["doc", "ver", "body"])

    return by_batch(docs, work, "doc long, ver int, body binary", lambda: zstandard.ZstdCompressor(level=1))
