"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors become integers. A term is a dimension: a query row is its non-zero
terms, a block of candidates keeps for each term its postings (rows and
weights). Per term, the weights of the query rows are scattered into a dense
score array of queries by candidates. Each cell keeps the best k of its array by
partition selection; a window merges the cells.

Queries are a stated subset of the rows, in blocks; every query block meets every
candidate block once. Blocks meet by an equi-join on (query block, group), with
``PER_GROUP`` candidate blocks to a group, so the number of groups grows with the
rows and a task folds a group into k rows per query before they move. A row is told
apart from its repeats by its place in the written table, not by its id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import counted_write, cut_lineage

QUERY_BLOCK, ROW_BLOCK, PER_GROUP, AT_ONCE = 512, 2048, 16, 128
BLOCK = ["n", "ids", "places", "values", "small"]
#: Sums of products below this are exact in doubles.
EXACT = 2.0**53


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x) as doubles.

    Rows with a null id, a null vector or a null or non-finite component take no
    part. Repeated ids are separate rows. Missing dimensions are zeros.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    fit = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.coalesce(fit, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of up to ``size`` rows (vec_id, row, v), ordered by id: (n, ids, places, values, small) as raw arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                ids, places = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("vec_id", "row"))
                v = part.column("v")
                lengths = np.diff(v.offsets.to_numpy())
                dims = int(lengths.max(initial=0))
                values = np.zeros((len(ids), dims))
                values[np.arange(dims) < lengths[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
                order = np.lexsort((places, ids))
                small = np.abs(values).max(initial=0.0) < 2**31
                raw = values[order].astype(np.int32 if small else np.float64).tobytes()
                out = [[len(ids)], [ids[order].tobytes()], [places[order].tobytes()], [raw], [bool(small)]]
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], BLOCK)

    return rows.mapInArrow(run, "n long, ids binary, places binary, values binary, small boolean")


def unpacked(n: int, ids: bytes, places: bytes, values: bytes, small: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    v = np.frombuffer(values, np.int32 if small else np.float64).reshape(n, -1).astype(np.float64)
    return np.frombuffer(ids, np.int64), np.frombuffer(places, np.int64), v


def accumulate(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores of all queries and rows, one term after the other."""
    terms = min(queries.shape[1], rows.shape[1])
    bound = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(terms, 1)
    if bound >= EXACT:  # beyond doubles: exact Python integers, kept within a long
        q = np.array([[int(x) for x in r] for r in queries[:, :terms]], object).reshape(len(queries), terms)
        c = np.array([[int(x) for x in r] for r in rows[:, :terms]], object).reshape(len(rows), terms)
        scores = q.dot(c.T) if terms else np.zeros((len(queries), len(rows)), object)
        return np.clip(scores, -(2**63) + 1, 2**63 - 1)
    scores = np.zeros((len(queries), len(rows)))
    for term in range(terms):
        weights, postings = queries[:, term], rows[:, term]
        have, held = np.flatnonzero(weights), np.flatnonzero(postings)
        if len(have) == len(weights) and len(held) == len(postings):
            scores += weights[:, None] * postings
        elif len(have) and len(held):
            scores[np.ix_(have, held)] += weights[have, None] * postings[held]
    return scores


def select(
    scores: np.ndarray, ids: np.ndarray, places: np.ndarray, own: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the best k per row but its ``own`` place; ``ids`` ascend; ties go to the smaller id."""
    valid = places[None, :] != own[:, None]
    if scores.dtype == object:
        low = -(2**63)
        scores = np.where(valid, scores, low)
    else:
        low = -np.inf
        scores[~valid] = low
    if scores.shape[1] > k:
        bar = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        row, col = np.nonzero((scores >= bar[:, None]) & valid)
    else:
        row, col = np.nonzero(valid)
    score = scores[row, col]
    # the columns of a row come by id, so a stable sort by score keeps ties right
    order = np.argsort(-score, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    row, col, score = row[order], col[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    best = place < k
    return row[best], ids[col[best]], score[best]


def fold(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Best k per query over all candidate blocks that arrive with the same query block."""
    at, held, names = None, None, None

    def out() -> pa.RecordBatch:
        q, ids, scores = held
        asked, place = names
        at = np.searchsorted(place, q)
        columns = [asked[at], q, ids]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in columns], pa.array([int(s) for s in scores], pa.int64())],
            ["query_id", "row", "vec_id", "score"],
        )

    for batch in batches:
        for r in batch.to_pylist():
            if (r["q"], r["g"]) != at:
                if held is not None:
                    yield out()
                at, held = (r["q"], r["g"]), None
            asked, own, queries = unpacked(*[r[f"q_{c}"] for c in BLOCK])
            ids, places, rows = unpacked(*[r[c] for c in BLOCK])
            by_place = np.argsort(own)
            names = asked[by_place], own[by_place]
            found = [] if held is None else [held]
            for start in range(0, len(own), AT_ONCE):
                mine = own[start : start + AT_ONCE]
                row, cand, score = select(accumulate(queries[start : start + AT_ONCE], rows), ids, places, mine, k)
                found.append((mine[row], cand, score))
            q, cand, score = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((cand, -score, q)) if score.dtype != object else np.array(
                sorted(range(len(q)), key=lambda i: (q[i], -score[i], cand[i])), np.int64
            )
            q, cand, score = q[order], cand[order], score[order]
            best = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
            held = (q[best], cand[best], score[best])
    if held is not None:
        yield out()


def top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds, the k best other rows.

    Ties go to the smaller vec_id; a query with fewer candidates returns all. No
    rows, or no queries, give no rows. Works on (vec_id, embedding) only.
    """
    rows = cut_lineage(integer_vectors(vectors, scale).withColumn("row", F.monotonically_increasing_id()))
    blocks, n = counted_write(packed(rows, ROW_BLOCK), blocks=F.lit(True))
    # one row per block of queries, numbered one after the other
    asked = packed(rows.filter(queries), QUERY_BLOCK).select(*[F.col(c).alias(f"q_{c}") for c in BLOCK])
    asked, m = counted_write(asked, blocks=F.lit(True))
    if not m["blocks"]:
        empty = "query_id long, rank int, vec_id long, score long"
        return vectors.sparkSession.createDataFrame([], empty)
    groups = -(-n["blocks"] // PER_GROUP)
    numbered = asked.withColumn("q", F.row_number().over(W.orderBy(F.monotonically_increasing_id())) - 1)
    left = blocks.withColumn("g", F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int"))
    left = left.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(m["blocks"] - 1))))
    right = numbered.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    met = left.join(right, ["q", "g"]).mapInArrow(lambda it: fold(it, k), "query_id long, row long, vec_id long, score long")
    best = W.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id"))
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
