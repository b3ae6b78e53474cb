"""Exact nearest neighbours by a block matrix join with int8 product tiles.

Queries and candidates are dealt into blocks of bounded size by a hash of their id, and every pair of blocks is one
tile of a stated query set against all rows. In a tile the vectors are quantised to int8; the integer products give
each inner product with a proven error bound, |x.y - x'.y'| <= |x-x'||y| + |x'||y-y'|. Pairs whose upper bound
reaches the k-th best lower bound are computed again in double precision and merged into a heap for each query. The
tiles' best k are then ranked with a window, whose partial limit runs before its shuffle. A tile that is lost is
simply computed again; the result does not depend on block sizes.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows without an id
take no part; vectors of different lengths are never compared; rows with the same id count once, with their best
score; a query never meets its own id; fewer candidates than k are all returned; ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Largest dimension for which float32 holds sums of products of int8 exactly.
_EXACT_DIMENSION = (1 << 24) // (127 * 127)


def _quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, norm of the vector, norm of its quantised form, norm of the difference."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    norm = lambda a: np.sqrt((a * a).sum(axis=1))
    return codes, scale, norm(x), norm(near), norm(x - near)


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, components added from first to last."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * y[:, d]
    return total


def search_tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, rows: int = 512, columns: int = 4096) -> list[list[tuple[float, int]]]:
    """For each query its best k (score, id), nearest first, among the tile's candidates of another id."""
    best: list[list[tuple[float, int]]] = [[] for _ in query_ids]  # heaps of (score, -id), the worst on top
    wide = np.float32 if queries.shape[1] <= _EXACT_DIMENSION else np.float64
    left = _quantise(queries)
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    for at in range(0, len(ids), columns):
        part_ids, part = ids[at : at + columns], vectors[at : at + columns]
        right = _quantise(part)
        repeated = len(part_ids) - len(np.unique(part_ids))
        turned = np.ascontiguousarray(right[0].T.astype(wide))
        for top in range(0, len(queries), rows):
            codes, scale, norm, near_norm, off = (a[top : top + rows] for a in left)
            near = (codes.astype(wide) @ turned).astype(np.float64) * scale[:, None] * right[1][None, :]
            bound = off[:, None] * right[2][None, :] + near_norm[:, None] * right[4][None, :] + 1e-9 * norm[:, None] * right[2][None, :]
            own = query_ids[top : top + rows, None] == part_ids[None, :]
            low = np.where(own, -np.inf, near - bound)
            kth = min(k + repeated, low.shape[1])
            reach = -np.partition(-low, kth - 1, axis=1)[:, kth - 1] if kth == k + repeated else np.full(len(low), -np.inf)
            held = np.array([heap[0][0] if len(heap) == k else -np.inf for heap in best[top : top + rows]])
            reach = np.maximum(reach, held)
            who, which = np.nonzero((near + bound >= reach[:, None]) & ~own)
            if not len(who):
                continue
            scores = np.concatenate([_exact(queries[top + who[i : i + 65536]], part[which[i : i + 65536]]) for i in range(0, len(who), 65536)])
            found = part_ids[which]
            sort = np.lexsort((found, -scores, who))
            who, scores, found = who[sort], scores[sort], found[sort]
            starts = np.searchsorted(who, np.arange(len(low) + 1))
            for q in range(len(low)):
                heap, seen = best[top + q], None
                taken: set[int] = set()
                for j in range(starts[q], starts[q + 1]):
                    number = int(found[j])
                    if number in taken:
                        continue
                    if len(taken) == k:
                        break
                    taken.add(number)
                    entry = (float(scores[j]), -number)
                    if seen is None:
                        seen = {e[1] for e in heap}
                    if entry[1] in seen:  # rows of one id that straddle two parts
                        old = next(e for e in heap if e[1] == entry[1])
                        if entry > old:
                            heap[heap.index(old)] = entry
                            heapq.heapify(heap)
                    elif len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    else:
                        break
    return [[(s, -n) for s, n in sorted(heap, reverse=True)] for heap in best]


def _matrix(table: pa.Table, name: str, size: int) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def search(queries: DataFrame, candidates: DataFrame, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", query_block: int = 8192, candidate_block: int = 16384) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k candidates of largest inner product for each query."""

    def usable(frame: DataFrame) -> DataFrame:
        vector = F.col(vector_column)
        fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
        return frame.where(F.col(id_column).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(id_column).cast("long").alias("id"), vector.cast("array<double>").alias("vector") if "double" in frame.schema[vector_column].dataType.simpleString() else vector.alias("vector"), F.size(vector).alias("dim"))

    queries, candidates = usable(queries), usable(candidates)
    query_blocks = max(1, -(-queries.count() // query_block))
    candidate_blocks = max(1, -(-candidates.count() // candidate_block))
    number = F.xxhash64("id")
    left = queries.withColumn("qb", F.pmod(number, F.lit(query_blocks)).cast("int")).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(candidate_blocks - 1))))
    right = candidates.withColumn("cb", F.pmod(number, F.lit(candidate_blocks)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        asked, ranks, found, scores = [], [], [], []
        if a.num_rows and b.num_rows:
            size = a.column("dim")[0].as_py()
            ids = a.column("id").to_numpy()
            kept, first = np.unique(ids, return_index=True)
            if len(kept) < len(ids):  # a query id that occurs again asks once, with its first row
                first = np.sort(first)
                a, ids = a.take(pa.array(first)), ids[first]
            for query, best in zip(ids, search_tile(ids, _matrix(a, "vector", size), b.column("id").to_numpy(), _matrix(b, "vector", size), k)):
                for score, vec in best:
                    asked.append(query)
                    found.append(vec)
                    scores.append(score)
        return pa.table({"query_id": pa.array(asked, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(scores, pa.float64())})

    tiles = left.groupBy("qb", "cb", "dim").cogroup(right.groupBy("qb", "cb", "dim")).applyInArrow(tile, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = tiles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
