"""Maximal periodic runs of words, by suffix trees and Lyndon roots.

A run is a stretch whose words repeat with a smallest period q, at least ``folds``
times q and ``least`` words long, that neither neighbour extends. Each is found
from a Lyndon word: under one of the two orders of the words, some place of a run
starts a longest Lyndon word of length q. So for every place and both orders the
longest Lyndon word (up to the next smaller suffix) is a candidate root, which is
extended both ways by longest common extensions. Those come in constant time from
two suffix trees, of the words and of the words backwards, built by Ukkonen's
algorithm: an Euler tour puts the leaves in order, and the depth of the lowest
common ancestor of two leaves is a range minimum over the depths that the tour
turns at between neighbouring leaves. All candidates are extended at once in numpy.

Trees are built only where a run can be. In a run every three words in a row
occur at least three times (checked for folds >= 4 and least >= 6), so places
where that does not hold are borders; between two of them lies a stretch that
holds whole runs and is treated alone. The counts are of 64-bit hashes; a
collision can only make a stretch longer. Words themselves are compared as words.

Rows: a null or empty text, or one of white space, has no words and no runs, and
its collapsed text is empty. Very long texts take memory in proportion to their
longest stretch (about 1.2 kB a word). Repeated rows are separate rows, ids may be
null, no rows give no rows. Only doc_id and text are read, so other columns may
have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX_A, STEP, STEP_2, by_batch, mix

Rewrite = Callable[[int | None, int], tuple[int, int] | None]


class SuffixTree:
    """Ukkonen's tree of a list of numbers, ended by a sign of its own that sorts first."""

    def __init__(self, word: list[int]):
        text = [*word, -1]
        n = len(text)
        # node 0 is the root; the edge into a node is text[begin:end], a leaf's end is n
        begin, end, link, down = [0], [0], [0], [{}]
        node, edge, length, todo = 0, 0, 0, 0  # active point, and suffixes still to be put in
        for i, sign in enumerate(text):
            todo += 1
            waiting = 0  # an inner node that lacks its link
            while todo:
                if not length:
                    edge = i
                child = down[node].get(text[edge])
                if child is None:
                    down[node][text[edge]] = len(begin)
                    begin.append(i), end.append(n), link.append(0), down.append(None)
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    span = (end[child] if end[child] <= i else i + 1) - begin[child]
                    if length >= span:
                        node, edge, length = child, edge + span, length - span
                        continue
                    at = begin[child]
                    if text[at + length] == sign:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    split, leaf = len(begin), len(begin) + 1
                    begin += (at, i)
                    end += (at + length, n)
                    link += (0, 0)
                    down += ({sign: leaf, text[at + length]: child}, None)
                    begin[child] = at + length
                    down[node][text[edge]] = split
                    if waiting:
                        link[waiting] = split
                    waiting = split
                todo -= 1
                if node == 0:
                    if length:
                        length -= 1
                        edge = i - todo + 1
                else:
                    node = link[node]
        self.n, self.begin, self.end, self.down = n, begin, end, down

    def leaves(self, reverse: bool = False) -> tuple[list[int], list[int]]:
        """The suffixes in the order of an Euler tour, and the least depth it comes up to before each.

        Children go by their signs, or by falling signs, but the end always comes first.
        """
        begin, end, down, n = self.begin, self.end, self.down, self.n
        order, turn = [], []
        up = 0  # depth of the node at which the tour turned
        stack = [(0, 0, 0)]
        while stack:
            node, depth, from_ = stack.pop()
            if from_ < up:
                up = from_
            children = down[node]
            if children is None:
                order.append(n - depth)
                turn.append(up)
                up = depth
                continue
            signs = sorted(children, reverse=not reverse)
            if reverse and signs[0] == -1:
                signs = [*signs[1:], -1]
            for sign in signs:  # popped from the back
                child = children[sign]
                stack.append((child, depth + end[child] - begin[child], depth))
        return order, turn


class Extensions:
    """Longest common prefixes of suffixes in constant time, for whole arrays of pairs."""

    def __init__(self, order: list[int], turn: list[int]):
        n = len(order)
        self.rank = np.empty(n, np.int64)
        self.rank[order] = np.arange(n)
        self.least = [np.array(turn, np.int32)]
        step = 1
        while 2 * step <= n:
            last = self.least[-1]
            self.least.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common length of the different suffixes a and b."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for at in np.unique(level):
            here = np.flatnonzero(level == at)
            rows = self.least[at]
            out[here] = np.minimum(rows[low[here]], rows[high[here] - 2**at])
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """The first later place with a smaller rank, for every place but the last."""
    out, open_ = [0] * len(rank), []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return out[:-1]


def runs_of(word: list[int], folds: int, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, in order."""
    n = len(word)
    if n < least or n < folds:
        return []
    tree = SuffixTree(word)
    order, turn = tree.leaves()
    ahead = Extensions(order, turn)
    falling = np.empty(n + 1, np.int64)
    falling[tree.leaves(reverse=True)[0]] = np.arange(n + 1)
    back = Extensions(*SuffixTree(word[::-1]).leaves())
    place = np.arange(n)
    start = np.concatenate([place, place])
    after = np.concatenate([next_smaller(ahead.rank.tolist()), next_smaller(falling.tolist())])
    period = after - start
    # the suffix at n is empty, and so is the one backwards from the first place
    right = ahead(start, after)
    left = back(n - start, n - after)
    length = period + right + left
    good = np.flatnonzero((length >= folds * period) & (length >= least))
    found = np.stack([start[good] - left[good], length[good], period[good]], axis=1)
    return [tuple(r) for r in np.unique(found, axis=0).tolist()]


def stretches(codes: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the stretches of all documents in which every three words in a row are frequent."""
    n = len(codes)
    if n < 6:
        return []
    h = codes.astype(np.uint64)
    key = mix(((h[:-2] * STEP + h[1:-1]) * STEP_2 + h[2:]) * MIX_A + doc[2:].astype(np.uint64))
    _, at, count = np.unique(key, return_inverse=True, return_counts=True)
    good = (count[at] >= 3) & (doc[2:] == doc[:-2])
    edge = np.flatnonzero(np.diff(np.concatenate(([False], good, [False])).astype(np.int8)))
    # stretches of neighbouring documents touch nowhere: no three words span them
    return [(a, b + 2) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= 4]


def split_words(column: pa.Array) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, their codes (equal words of the batch, equal codes), and how many a text has."""
    words = [(t or b"").split() for t in column.cast(pa.binary()).to_pylist()]
    flat = pa.array([w for ws in words for w in ws], pa.binary())
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return words, codes, np.fromiter(map(len, words), np.int64, len(words))


def analysed(column: pa.Array, ids: list[int | None], rewrite: Rewrite | None, folds: int, least: int) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """The runs and the collapsed text of each text."""
    words, codes, sizes = split_words(column)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    if rewrite:
        for i, n in enumerate(sizes.tolist()):
            change = rewrite(ids[i], n)
            if change:
                a, p = change
                source = np.concatenate((np.arange(a), a + np.arange(n - a) % p))
                codes[bounds[i] : bounds[i + 1]] = codes[bounds[i] + source]
                words[i] = [words[i][j] for j in source.tolist()]
    doc = np.repeat(np.arange(len(words)), sizes)
    found: list[list[tuple[int, int, int]]] = [[] for _ in words]
    narrow = (folds, least) if folds < 4 or least < 6 else None
    spans = [(a, b) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())] if narrow else stretches(codes, doc)
    for a, b in spans:
        if b - a < least:
            continue
        at = int(doc[a])
        shift = a - int(bounds[at])
        found[at] += [(s + shift, n, q) for s, n, q in runs_of(codes[a:b].tolist(), folds, least)]
    out = []
    for ws, runs in zip(words, found):
        if runs:
            cover = np.zeros(len(ws) + 1, np.int64)
            for s, n, q in runs:
                cover[s + q] += 1
                cover[s + n] -= 1
            ws = [w for w, c in zip(ws, np.cumsum(cover).tolist()) if not c]
        out.append((sorted(runs), b" ".join(ws)))
    return out


def periodic_runs(docs: DataFrame, folds: int = 4, least: int = 6, rewrite: Rewrite | None = None) -> DataFrame:
    """(doc_id, runs, collapsed): the runs of each whole text in order, and the text without their repeats.

    ``collapsed`` keeps, of every run, its first period; words are joined by one
    space. ``rewrite`` may say, by id and number of words, from which word on the
    text goes round with which period before it is looked at.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = analysed(batch.column("text"), batch.column("doc_id").to_pylist(), rewrite, folds, least)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        runs = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r, _ in got]
        texts = pa.array([t for _, t in got], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(runs, kind), texts], ["doc_id", "runs", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return by_batch(docs.select("doc_id", F.col("text").cast("string").alias("text")), work, schema)


def planted_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first word, period) of the tail that goes round in a tenth of the documents; a null id has none."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def run_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the one with the greatest length by period, and digests of runs and collapsed text."""
    better = lambda x, y: (
        F.when(x["length"] * y["period"] > y["length"] * x["period"], -1)
        .when(x["length"] * y["period"] < y["length"] * x["period"], 1)
        .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
        .when(x["period"] < y["period"], -1)
        .otherwise(F.when(x["period"] > y["period"], 1).otherwise(0))
    )
    best = F.get(F.array_sort("runs", better), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
