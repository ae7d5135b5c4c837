"""Exact nearest neighbours by a block matrix join.

Vectors are dealt into blocks, and each pair of a query block and a candidate block is a tile. In a
tile the vectors are held in 8-bit integers with one scale each, and their product gives all
distances of the tile at once. With the length of what rounding left of each vector, the triangle
inequality bounds the true distance from below and above. Pairs whose lower bound does not exceed the
k-th smallest upper bound survive, are computed again from the original vectors in double precision,
and go through a heap for each query: first those of a tile, then those of all tiles.

No pair is lost, so the result is exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import tasks

#: Vectors of a query block and of a candidate block.
QUERY_BLOCK, CANDIDATE_BLOCK = 2_048, 16_384
#: Candidates multiplied at once.
STRIP = 2_048
#: Products of 8-bit integers are added exactly in 32-bit floats over so many components.
EXACT_COMPONENTS = 1_024


class Quantised:
    """Rows as 8-bit integers times a scale, and the length of each row's rounding error."""

    def __init__(self, rows: np.ndarray) -> None:
        top = np.abs(rows).max(axis=1)
        # A scale that would vanish in a division is replaced; the error then is the row itself.
        self.scale = np.where(top > 0, np.maximum(top / 127.0, np.finfo(np.float64).tiny), 1.0)
        self.values = np.clip(np.rint(rows / self.scale[:, None]), -127, 127).astype(np.int8)
        left = rows - self.values * self.scale[:, None]
        self.error = length(left)
        self.squares = (self.values.astype(np.float64) ** 2).sum(axis=1) * self.scale**2


def length(rows: np.ndarray) -> np.ndarray:
    """Euclidean lengths that neither overflow nor vanish."""
    top = np.abs(rows).max(axis=1, initial=0)
    safe = np.where((top > 0) & np.isfinite(top), top, 1.0)
    return np.sqrt(((rows / safe[:, None]) ** 2).sum(axis=1)) * np.where(np.isfinite(top), safe, np.inf)


def approximate(a: Quantised, b: Quantised) -> tuple[np.ndarray, np.ndarray]:
    """Distances of all pairs of two blocks as quantised, and by how much the true ones can differ."""
    product = np.zeros((len(a.values), len(b.values)))
    for i in range(0, a.values.shape[1], EXACT_COMPONENTS):
        product += a.values[:, i : i + EXACT_COMPONENTS].astype(np.float32) @ b.values[:, i : i + EXACT_COMPONENTS].astype(np.float32).T
    product *= a.scale[:, None]
    product *= b.scale[None, :]
    sums = a.squares[:, None] + b.squares[None, :]
    # what double precision itself may lose, before and after the root
    slack = 1e-7 * np.sqrt(sums)
    return np.sqrt(np.maximum(sums - 2 * product, 0)), a.error[:, None] + b.error[None, :] + slack


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, added from the first component to the last."""
    return np.sqrt(np.cumsum((a - b) ** 2, axis=1)[:, -1])


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k nearest of a tile for each query, as query numbers, ids and distances; a query is not its own candidate."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    quantised = Quantised(queries)
    for start in range(0, len(ids), STRIP):
        some, own = vectors[start : start + STRIP], ids[start : start + STRIP]
        with np.errstate(over="ignore", invalid="ignore"):
            about, error = approximate(quantised, Quantised(some))
            low, high = about - error, about + error
        self_ = query_ids[:, None] == own[None, :]
        high[self_ | ~np.isfinite(high)] = np.inf
        # A strip's k-th upper bound, or the k-th distance that the heap holds, whichever is less.
        bound = np.partition(high, k - 1, axis=1)[:, k - 1] if len(own) > k else np.full(len(query_ids), np.inf)
        held = np.array([-h[0][0] if len(h) == k else np.inf for h in heaps])
        alive = ~(low > np.minimum(bound, held)[:, None]) & ~self_
        for rows in np.array_split(np.argwhere(alive), max(1, int(alive.sum()) * vectors.shape[1] // 4_000_000)):
            with np.errstate(over="ignore"):
                exact = distances(queries[rows[:, 0]], some[rows[:, 1]])
            for q, d, v in zip(rows[:, 0].tolist(), exact.tolist(), own[rows[:, 1]].tolist()):
                push(heaps[q], d, v, k)
    found = [(q, v, d) for q, heap in enumerate(heaps) for d, v in ((-d, -v) for d, v in heap)]
    return tuple(np.array(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)


def push(heap: list[tuple[float, int]], distance: float, vec_id: int, k: int) -> None:
    """Keep the k least by distance, then id: the heap has the worst of them on top."""
    entry = (-distance, -vec_id)
    if len(heap) < k:
        heapq.heappush(heap, entry)
    elif entry > heap[0]:
        heapq.heapreplace(heap, entry)


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    lists = column.combine_chunks()
    flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(lists), size)


def usable(vector: str = "embedding") -> Column:
    """Not null, not all zero, and no component null or not finite."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean) of the k nearest rows of every query row.

    Reads vec_id and embedding. Ties go to the smaller vec_id; with fewer candidates all are
    returned. Vectors that are null, zero, or have a null or non-finite component take no part, nor
    do rows without an id; only vectors of equal length are compared. A row is no candidate of a
    query of its own id; rows repeated with one id are one query and one candidate (the least vector
    of them). An empty table gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable()).groupBy("vec_id").agg(F.min(F.struct("embedding", "is_query")).alias("r"))
    rows = rows.select("vec_id", "r.*", F.size("r.embedding").alias("size"))
    counts = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).agg(F.max("n"), F.max("q")).first()
    candidate_blocks = max(1, math.ceil((counts[0] or 0) / candidate_block))
    query_blocks = max(1, math.ceil((counts[1] or 0) / query_block))
    hashed = F.xxhash64("vec_id")
    candidates = rows.select("vec_id", "embedding", "size", F.pmod(hashed, F.lit(candidate_blocks)).alias("j"))
    candidates = candidates.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = rows.where("is_query").select("vec_id", "embedding", "size", F.pmod(hashed, F.lit(query_blocks)).alias("i"))
    queries = queries.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(candidate_blocks - 1))))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        size = key[0].as_py()
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        query_ids = left["vec_id"].to_numpy()
        numbers, ids, scores = tile(query_ids, _matrix(left["embedding"], size), right["vec_id"].to_numpy(), _matrix(right["embedding"], size), k)
        return pa.table({"query_id": query_ids[numbers.astype(np.int64)], "vec_id": ids.astype(np.int64), "score": scores.astype(np.float64)})

    columns = ["vec_id", "embedding", "size", F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j")]
    left, right = queries.select(columns), candidates.select(columns)
    found = left.groupBy("size", "i", "j").cogroup(right.groupBy("size", "i", "j")).applyInArrow(run, "query_id long, vec_id long, score double")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for q, v, d in zip(*(c.to_pylist() for c in batch.columns)):
                push(heaps.setdefault(q, []), d, v, k)
        out = [(q, n, -v, -d) for q, heap in heaps.items() for n, (d, v) in enumerate(sorted(heap, reverse=True), 1)]
        for start in range(0, len(out), 10_000):
            q, n, v, d = zip(*out[start : start + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(n, pa.int32()), pa.array(v, pa.int64()), pa.array(d, pa.float64())], names=["query_id", "rank", "vec_id", "score"])

    return found.repartition(tasks(vectors.sparkSession), "query_id").mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
