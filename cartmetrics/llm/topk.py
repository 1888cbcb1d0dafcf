"""Exact top-k search by inner product with a vector-approximation file.

Candidates are packed in blocks of exact vectors. Queries are packed in blocks, too, and every block of
queries meets every block of candidates in a task of its own. The task forms the approximation of its
candidates in memory: per vector one byte per dimension, the cell of a uniform grid. The scan of the
cells bounds each score from below and above; exact products are taken in the order of the upper bounds
until the k-th best score is certain. No file of cells is kept, so the exact vectors are shipped whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a block of queries and of candidates, and cells of the grid along a dimension.
QUERY_BLOCK, CANDIDATE_BLOCK, CELLS = 256, 4096, 64
_PACKED = "dim int, wide boolean, ids binary, vectors binary"
#: Row groups of the queries and column groups of the candidates; each side is copied to all groups of the other.
GRID = (4, 64)


def usable_vectors(rows: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(id, v): integer vectors floor(scale * x), without those that are null or hold a null, NaN or infinity."""
    v = F.col(vector_column)
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    whole = F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return rows.where(F.col(id_column).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite).select(F.col(id_column).cast("long").alias("id"), whole.alias("v"))


def pack(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of up to `size` vectors of one dimension, as bytes. A block never leaves its task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            dims = frame["v"].map(len)
            for dim, rows in frame.groupby(dims):
                for at in range(0, len(rows), size):
                    part = rows.iloc[at : at + size]
                    ids = part["id"].to_numpy(np.int64)
                    values = np.stack(part["v"]).astype(np.int64)
                    wide = bool(np.abs(values).max() >= 1 << 31)
                    packed = values.tobytes() if wide else values.astype(np.int32).tobytes()
                    yield pd.DataFrame({"dim": [dim], "wide": [wide], "ids": [ids.tobytes()], "vectors": [packed]})

    return vectors.mapInPandas(run, _PACKED)


def search_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of the k best of this block for each query; ties go to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    low = v.min(axis=0).astype(np.float64)
    width = np.maximum((v.max(axis=0) - low) / CELLS, 1.0)
    cells = np.minimum((v - low) / width, CELLS - 1).astype(np.uint8)
    middle = (low + (cells + 0.5) * width).T
    qf = q.astype(np.float64)
    estimate = qf @ middle
    # Half a cell in every dimension, and what float arithmetic may lose.
    reach = np.abs(qf) @ (width / 2) + 1e-9 * (np.abs(qf) @ np.abs(v).max(axis=0)) + 1
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(len(q)):
        upper = estimate[i] + reach[i]
        upper[ids == q_ids[i]] = -np.inf
        if len(ids) > k:
            kth = np.partition(upper, len(ids) - k)[len(ids) - k] - 2 * reach[i]
            near = np.flatnonzero((upper >= kth) & (upper > -np.inf))
        else:
            near = np.flatnonzero(upper > -np.inf)
        near = near[np.argsort(-upper[near], kind="stable")]
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(near), 256):
            if len(best) >= k and upper[near[at]] < best[k - 1]:
                break
            read = near[at : at + 256]
            best_ids, best = np.concatenate([best_ids, ids[read]]), np.concatenate([best, v[read] @ q[i]])
            top = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[top], best[top]
        out.append((np.full(len(best), q_ids[i]), best_ids, best))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def exact_top_k(rows: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of every query with the other rows.

    Vectors are compared as floor(scale * x). Vectors that are null, empty or hold null or non-finite
    components and rows without id take no part; a query has no result among vectors of another
    dimension. Ties go to the smaller id. Rows with the query's own id are not candidates. Repeated
    rows: each counts as a candidate, queries count once per id and vector. Sums are 64-bit integers;
    components beyond 2**26 are outside of what is exact.
    """
    candidates = pack(usable_vectors(rows, id_column, vector_column, scale), CANDIDATE_BLOCK)
    asked = pack(usable_vectors(queries, id_column, vector_column, scale).distinct(), QUERY_BLOCK)
    # Blocks of both sides are dealt over a grid of groups; each cell of the grid is a key of its own.
    row, column = (F.pmod(F.xxhash64("ids"), F.lit(n)) for n in GRID)
    every = [F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) for n in GRID]
    left = asked.select("dim", row.alias("r"), every[1].alias("c"), F.col("wide").alias("q_wide"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    right = candidates.select("dim", every[0].alias("r"), column.alias("c"), "wide", "ids", "vectors")
    met = left.join(right, ["dim", "r", "c"]).select("dim", "q_wide", "q_ids", "q_vectors", "wide", "ids", "vectors")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, q_wide, q_ids, q, wide, ids, v in frame.itertuples(index=False):
                vectors = [np.frombuffer(x, np.int64 if w else np.int32).astype(np.int64).reshape(-1, dim) for x, w in ((q, q_wide), (v, wide))]
                found = search_block(np.frombuffer(q_ids, np.int64), vectors[0], np.frombuffer(ids, np.int64), vectors[1], k)
                yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    best = met.mapInPandas(run, "query_id long, vec_id long, score long")
    # k rows per query and block. The rank limit cuts each task's rows to k per query before the shuffle
    # and sorts the rest with spill, so that no list of a query is held in memory.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
