"""Exact top-k inner-product search over vector-approximation files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


_EXACT = 1 << 53
_LONG = (-(1 << 63), (1 << 63) - 1)


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int = 64) -> DataFrame:
    """(vec_id, vector): floor(scale * x) of each component as a long; rows with a null id or vector, or a null or
    non-finite component, are left out. Components beyond the range of a long stop at its ends."""
    x = F.col(vector)
    good = F.col(key).isNotNull() & x.isNotNull() & F.forall(x, lambda v: F.coalesce(
        ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)))
    cells = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    return rows.filter(good).select(F.col(key).cast("long").alias("vec_id"), cells.alias("vector"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    return np.asarray(flat.flatten(), dtype=np.int64).reshape(len(flat), dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T: in floating point while every sum fits its mantissa, else in long or unbounded integers."""
    reach = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * max(1, a.shape[1])
    if reach < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if reach < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if reach < 1 << 62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, *_LONG).astype(np.int64)


class ApproximationFile:
    """Cells of a block of vectors: 2^bits equal intervals of each dimension's range, kept as bytes."""

    def __init__(self, vectors: np.ndarray, bits: int):
        self.low = vectors.min(axis=0).astype(np.float64)
        self.width = np.ceil((vectors.max(axis=0).astype(np.float64) - self.low + 1) / (1 << bits))
        self.codes = np.clip((vectors - self.low) // np.maximum(1, self.width), 0, (1 << bits) - 1).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the products of each query (row) with each vector (column).

        The part of q that is positive takes a cell's upper edge for the upper bound, the negative part its lower edge.
        A slack for rounding keeps both bounds safe.
        """
        q = queries.astype(np.float64)
        at_low = self.low[None, :] * q
        base = at_low.sum(axis=1, keepdims=True)
        scaled = q * self.width[None, :]
        cells = scaled.astype(np.float32) @ self.codes.T.astype(np.float32)
        edge = q * np.maximum(0, self.width - 1)[None, :]
        up, down = np.maximum(edge, 0).sum(axis=1, keepdims=True), np.minimum(edge, 0).sum(axis=1, keepdims=True)
        slack = 1e-5 * ((np.abs(scaled) * 255).sum(axis=1, keepdims=True) + np.abs(at_low).sum(axis=1, keepdims=True)) + 1e-6
        return base + cells + down - slack, base + cells + up + slack


def search_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, bits: int,
                 step: int = 64) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query position, vector ids, scores): the exact k best of this block for each query, ties to the smaller id.

    Cells are scanned for bounds; exact vectors are then read in order of their upper bound, until the kth exact score
    is above every bound that is left. A vector whose upper bound equals the kth score may still win a tie and is read.
    """
    file = ApproximationFile(vectors, bits)
    for at in range(0, len(queries), 256):
        part = queries[at:at + 256]
        low, up = file.bounds(part)
        low[ids[None, :] == query_ids[at:at + 256, None]] = -np.inf  # skipped, so they make nothing sure
        if low.shape[1] > k:
            sure = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
        else:
            sure = np.full(len(part), -np.inf)
        for i in range(len(part)):
            open_ = np.flatnonzero((up[i] >= sure[i]) & (ids != query_ids[at + i]))
            open_ = open_[np.argsort(-up[i][open_], kind="stable")]
            bounds = up[i][open_]
            best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            done, take = 0, step
            while done < len(open_) and (len(best) < k or bounds[done] >= best[k - 1]):
                some = open_[done:done + take]
                best = np.concatenate([best, _products(part[i:i + 1], vectors[some])[0]])
                best_ids = np.concatenate([best_ids, ids[some]])
                order = np.lexsort((best_ids, -best.astype(object) if best.min(initial=0) == _LONG[0] else -best))[:k]
                best, best_ids = best[order], best_ids[order]
                done, take = done + take, take * 2
            yield at + i, best_ids, best


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, bits: int = 4, query_block: int = 2048,
          vector_block: int = 8192) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k largest inner products of every query, its own row excepted.

    vectors and queries: (vec_id, vector of long), see integer_vectors. Both are dealt into hash blocks and each pair
    of blocks with the same vector length meets in one task, so that nothing is broadcast or collected; a block pair
    answers with k rows per query, which one window per query merges. Block counts follow from the row counts.
    Vectors compare with those of their own length only; rows of one id are separate candidates (a query skips all of
    its id) and separate queries of one id give their rows once. Ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    queries = queries.dropDuplicates(["vec_id", "vector"]) if queries is not vectors else queries
    n_vectors, n_queries = vectors.count(), queries.count()
    wide, high = max(1, -(-n_vectors // vector_block)), max(1, -(-n_queries // query_block))
    shape = F.size("vector").alias("dim")
    numbered = vectors.withColumn("_nth", F.monotonically_increasing_id())
    v = numbered.select("vec_id", "vector", shape, F.pmod(F.xxhash64("vec_id", "_nth"), F.lit(wide)).cast("int").alias("col"),
                       F.explode(F.sequence(F.lit(0), F.lit(high - 1))).alias("row"))
    q = queries.select("vec_id", "vector", shape, F.pmod(F.xxhash64("vec_id", "vector", F.lit(7)), F.lit(high)).cast("int").alias("row"),
                       F.explode(F.sequence(F.lit(0), F.lit(wide - 1))).alias("col"))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        dim = left.column("dim")[0].as_py()
        qs, vs = _matrix(left.column("vector"), dim), _matrix(right.column("vector"), dim)
        q_ids, v_ids = np.asarray(left.column("vec_id")), np.asarray(right.column("vec_id"))
        parts = list(search_block(qs, q_ids, vs, v_ids, k, bits))
        lengths = [len(p[1]) for p in parts]
        return pa.table([np.repeat(q_ids[[p[0] for p in parts]], lengths), np.concatenate([p[1] for p in parts]),
                         np.concatenate([p[2] for p in parts])], schema=out)

    keys = ["row", "col", "dim"]
    near = q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
