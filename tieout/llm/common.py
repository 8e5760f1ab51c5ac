"""Helpers that several operators of this subpackage share.

Words are runs of characters other than space, tab, line feed, vertical tab,
form feed and carriage return. ``bytes.split`` cuts at exactly those, and
``bytes.lower`` changes A-Z only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: The splitmix64 finaliser and two odd multipliers for sequences.
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP, STEP_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)

#: Characters of text that a task turns into arrays at a time.
CHUNK_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, make=None) -> DataFrame:
    """Apply ``work`` to each Arrow batch, cut so that it holds a bounded amount of text.

    With ``make``, each task first calls it once and ``work`` gets its result as
    a second argument: caches live as long as the task and never grow past their limit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = (make(),) if make else ()
        for batch in batches:
            for piece in bounded(batch):
                yield work(piece, *own)

    return df.mapInArrow(run, schema)


def bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``CHUNK_CHARS`` bytes, or one longer row."""
    if batch.nbytes <= CHUNK_CHARS:
        yield batch
        return
    start, size, each = 0, 0, max(1, batch.nbytes // max(1, batch.num_rows))
    columns = [batch.column(c) for c in ("text", "html", "body") if c in batch.schema.names]
    # other columns may bear these names, too
    texts = [c for c in columns if c.type in (pa.string(), pa.binary(), pa.large_string(), pa.large_binary())]
    sizes = pc.binary_length(texts[0]).to_pylist() if texts else [each] * batch.num_rows
    for at, n in enumerate(sizes):
        if size and size + (n or 0) > CHUNK_CHARS:
            yield batch.slice(start, at - start)
            start, size = at, 0
        size += n or 0
    yield batch.slice(start)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


class Words:
    """Hashes of all words of a column of texts, from its bytes at once.

    A word's hash is a polynomial over pseudo-random numbers of its bytes: one
    running sum over the column gives every word as a difference. With ``lower``
    A-Z count as a-z.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, lower: bool):
        self.number = mix(np.arange(1, 257, dtype=np.uint64))
        if lower:
            self.number[65:91] = self.number[97:123]
        self.gap = np.zeros(256, bool)
        self.gap[[9, 10, 11, 12, 13, 32]] = True
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.power) < n:
            size = max(n, 2 * CHUNK_CHARS)
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 2**64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.power[:n], self.inverse

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of the words, bounds): the words of text i are bounds[i] to bounds[i + 1]."""
        if column.null_count:
            column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        _, ends, data = column.buffers()
        at = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
        at = at - at[0]
        if not len(raw):
            return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
        word = ~self.gap[raw]
        border = np.zeros(len(raw) + 1, bool)  # a text begins here
        border[at] = True
        before = np.concatenate(([False], word[:-1]))
        after = np.concatenate((word[1:], [False]))
        starts = np.flatnonzero(word & (~before | border[:-1]))
        stops = np.flatnonzero(word & (~after | border[1:])) + 1
        power, inverse = self.powers(len(raw))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.number[raw] * power)))
        return mix((total[stops] - total[starts]) * inverse[starts]), np.searchsorted(starts, at)


def sequences(h: np.ndarray, k: int, step: np.uint64 = STEP) -> np.ndarray:
    """One 64-bit hash for each run of ``k`` consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out *= step
        out += h[i : n + i]
    return mix(out)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; a null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]
