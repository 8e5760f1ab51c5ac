"""Exact k-means over integer vectors, nearest centroids by a progressive Walsh-Hadamard search.

The transform H of 64 integers is 64 integers, and squared distances between
transformed vectors are 64 times the squared distances between the vectors, so
nothing is rounded. Coefficients are taken in order of their number of sign
changes, coarse before fine. A vector's sums of squared coefficient differences
grow stage by stage; once one centroid, the best so far, is summed to the end, a
centroid whose sum already lies strictly above that total is out. What is left
sums all 64 and the smallest total wins, ties by the smaller number.

Vectors are transformed once and written in blocks. A round reads the blocks and
returns, per task, sums of coefficients and counts by centroid, which Spark adds
up; a centroid's new place is the exact floor of the mean. The centroids, ``k``
times 64 integers, are all that passes through the driver. A cluster with most of
the rows costs what an even spread costs.

Rows: kept are vectors with exactly 64 components, none null or non-finite; a null
id is kept but starts no centroid unless too few others are there. Repeated rows
are separate rows. With fewer than ``k`` kept vectors each starts a centroid. No
rows give no rows. Components beyond 2**21 (in blocks that hold one) are computed
in Python's integers, and a distance or sum that no long can hold becomes 2**63 - 1.
Only vec_id and embedding are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

DIMS = 64
#: Vectors of a block, and coefficients summed after each stage.
ROWS, STAGES = 4096, (4, 8, 16, 32, 64)
#: With components up to this, every sum of 64 squared differences fits into 63 bits.
SMALL = 2**21
LIMB, TOP = 30, 2**63 - 1


def walsh_order() -> np.ndarray:
    """Rows of the natural transform by number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < DIMS:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")


ORDER = walsh_order()


def transform(v: np.ndarray) -> np.ndarray:
    """The transform of each row, coarse coefficients first; integers of any kind stay exact."""
    out, step = v, 1
    while step < DIMS:
        pairs = out.reshape(len(v), -1, 2, step)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack([a + b, a - b], axis=2).reshape(len(v), DIMS)
        step *= 2
    return out[:, ORDER]


def untransform(t: np.ndarray) -> np.ndarray:
    """The rows whose transforms are given."""
    natural = np.empty_like(t)
    natural[:, ORDER] = t
    inverse = np.empty_like(t)
    inverse[:, ORDER] = transform(natural)
    return inverse // DIMS


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles, as longs, or as Python's integers where a component is large."""
    if np.abs(x).max(initial=0.0) * scale <= SMALL:
        return np.floor(x * scale).astype(np.int64)
    exact = [int(c) * scale if abs(c) >= 2.0**53 else int(np.floor(c * scale)) for c in x.ravel().tolist()]
    out = np.empty(len(exact), object)
    out[:] = exact
    return out.reshape(x.shape)


def pack(t: np.ndarray) -> bytes:
    """Coefficients as 32-bit numbers, or as text where they are Python's integers."""
    if t.dtype == object:
        return ",".join(map(str, t.ravel().tolist())).encode()
    return t.astype("<i4").tobytes()


def unpack(raw: bytes, wide: bool) -> np.ndarray:
    if not wide:
        return np.frombuffer(raw, "<i4").astype(np.int64).reshape(-1, DIMS)
    values = [int(x) for x in raw.decode().split(",")]
    out = np.empty(len(values), object)
    out[:] = values
    return out.reshape(-1, DIMS)


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, as long and array of doubles."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.filter((F.size("embedding") == DIMS) & F.coalesce(finite, F.lit(False)))


def blocks(rows: DataFrame, scale: int) -> DataFrame:
    """(ids, null, wide, t): up to ``ROWS`` transformed vectors at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids = part.column("vec_id")
                x = part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMS)
                t = transform(integers(x, scale))
                null = ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
                known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                columns = [pa.array([known], pa.binary()), pa.array([null], pa.binary()), pa.array([t.dtype == object]), pa.array([pack(t)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["ids", "null", "wide", "t"])

    return rows.mapInArrow(run, "ids binary, null binary, wide boolean, t binary")


def nearest(t: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest of the transformed centroids ``c`` to each row of ``t``."""
    if t.dtype == object or c.dtype == object:
        t, c = t.astype(object), c.astype(object)
    rows, k = len(t), len(c)
    done = np.zeros((rows, k), t.dtype)
    bar, from_ = None, 0
    row = col = None
    for to in STAGES:
        if bar is None:  # coarse coefficients, all centroids
            for j in range(from_, to):
                diff = t[:, j, None] - c[:, j]
                done += diff * diff
            guess = np.argmin(done, axis=1)
            diff = t[:, to:] - c[guess, to:]
            bar = done[np.arange(rows), guess] + (diff * diff).sum(axis=1)
            row, col = np.nonzero(done <= bar[:, None])
        else:
            diff = t[row, from_:to] - c[col, from_:to]
            done[row, col] += (diff * diff).sum(axis=1)
            alive = done[row, col] <= bar[row]
            row, col = row[alive], col[alive]
        from_ = to
    # what is alive is summed to the end; pairs come by row, then by number
    total = done[row, col]
    first = np.searchsorted(row, np.arange(rows))
    best = np.minimum.reduceat(total, first) if rows else total
    hit = np.flatnonzero(total == best[row])
    winner = hit[np.searchsorted(row[hit], np.arange(rows))]
    return col[winner], best // DIMS


def limbs(value: int) -> list[tuple[int, int]]:
    """A signed integer in digits of 30 bits that all bear its sign, so that longs can add up billions of them."""
    sign, rest, out = (-1 if value < 0 else 1), abs(value), []
    while rest or not out:
        out.append((len(out), sign * (rest & (2**LIMB - 1))))
        rest >>= LIMB
    return out


def summed(table: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and sum of coefficients of the vectors nearest to each centroid."""
    shared = table.sparkSession.sparkContext.broadcast(transform(centroids))  # k * 64 integers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        count, total = np.zeros(len(c), np.int64), np.zeros((len(c), DIMS), object)
        for batch in batches:
            for r in batch.to_pylist():
                t = unpack(r["t"], r["wide"])
                number, _ = nearest(t, c)
                order = np.argsort(number, kind="stable")
                found, first = np.unique(number[order], return_index=True)
                total[found] += np.add.reduceat(t[order], first, axis=0).astype(object)
                count += np.bincount(number, minlength=len(c))
        rows = [(int(i), -1, 0, int(count[i])) for i in np.flatnonzero(count)]
        rows += [(int(i), j, at, v) for i in np.flatnonzero(count) for j in range(DIMS) for at, v in limbs(total[i, j])]
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["cluster", "dim", "limb", "v"])

    parts = table.select("wide", "t").mapInArrow(run, "cluster int, dim int, limb int, v long")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("cluster", "dim", "limb").agg(F.sum("v").alias("v")).collect():  # k * 65 rows, times the limbs
        count, total = out.setdefault(r.cluster, (0, [0] * DIMS))
        if r.dim < 0:
            out[r.cluster] = (r.v, total)
        else:
            total[r.dim] += r.v << (LIMB * r.limb)
    return out


def as_array(rows: list[list[int]]) -> np.ndarray:
    """Whole numbers as longs where all are small, otherwise as Python's integers."""
    out = np.empty((len(rows), DIMS), object)
    for i, r in enumerate(rows):
        out[i] = r
    return out.astype(np.int64) if all(abs(x) <= SMALL for r in rows for x in r) else out


def first_centroids(rows: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The vectors with the ``k`` smallest digests of "seed:id", ties by the vector."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    drawn = rows.select("embedding", digest.alias("h")).orderBy(F.col("h").asc_nulls_last(), "embedding").limit(k).collect()
    x = np.array([r.embedding for r in drawn], np.float64).reshape(-1, DIMS)
    return as_array(integers(x, scale).tolist())


def moved(centroids: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """The floors of the means; a centroid without vectors stays."""
    new = centroids.astype(object).tolist()
    for i, (count, total) in sums.items():
        mean = untransform(np.array([total], object))[0]
        new[i] = [int(x) // count for x in mean]
    return as_array(new)


def clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, scale: int = 256) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of each kept vector, as a written table, and the final centroids."""
    rows = kept(vectors)
    centroids = first_centroids(rows, k, seed, scale)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), []
    table = cut_lineage(blocks(rows, scale))
    for _ in range(rounds):
        centroids = moved(centroids, summed(table, centroids))
    shared = vectors.sparkSession.sparkContext.broadcast(transform(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                number, distance = nearest(unpack(r["t"], r["wide"]), shared.value)
                if distance.dtype == object:
                    distance = np.array([min(d, TOP) for d in distance], np.int64)
                ids = pa.array(np.frombuffer(r["ids"], "<i8"), mask=np.frombuffer(r["null"], np.uint8).astype(bool))
                yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return cut_lineage(table.mapInArrow(run, "vec_id long, cluster int, distance long")), centroids.tolist()


def clustered(vectors: DataFrame, **options: int) -> DataFrame:
    """``clusters`` with cluster_inertia, inertia and centroid_sha256 beside every vector."""
    rows, centroids = clusters(vectors, **options)
    own = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()  # k rows
    total = min(int(sum(r.d for r in own)), TOP)
    facts = [
        (r.cluster, min(int(r.d), TOP), total, hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()) for r in own
    ]
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    facts = vectors.sparkSession.createDataFrame(facts, names)
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
