"""Exact nearest neighbours by a block matrix join.

Vectors and queries are dealt out by hash over a grid: candidates to G groups,
queries to R chunks, and every (group, chunk) tile is one task of bounded
size.  Within a tile vectors are quantised to int8 and multiplied as integer
matrices; scale factors and the norms of what quantisation lost bound the true
inner product from above.  Only pairs whose bound reaches the k-th best score
so far are recomputed in double precision on the original components, and a
heap per query keeps the best k.  Tiles hand on k rows per query; a heap merge
per query gives the result.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from weatherlake.llm.shared import modest_batches, table, tidy

GROUP, CHUNK = 1 << 16, 1 << 15  # candidates and queries of a tile, at most about so many
BLOCK = 4096  # candidates multiplied at a time


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale, norm, and norm of the error of every row."""
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None])
    return q.astype(np.int8), scale, np.sqrt((x * x).sum(1)), np.sqrt(((x - q * scale[:, None]) ** 2).sum(1))


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision, components added in order."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("embedding")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


class _Tile:
    """The candidates of a tile in blocks; ``search`` keeps heaps of (score, -id)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.blocks = [(ids[i:i + BLOCK], x[i:i + BLOCK], *quantised(x[i:i + BLOCK])) for i in range(0, len(ids), BLOCK)]

    def search(self, ids: np.ndarray, x: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
        q, scale, norm, lost = quantised(x)
        heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        least = np.full(len(ids), -np.inf)
        for c_ids, c, cq, c_scale, c_norm, c_lost in self.blocks:
            # products of int8 are whole numbers below 2^24 up to 1,040 dimensions: exact in float32
            kind = np.float32 if x.shape[1] <= 1040 else np.float64
            near = (q.astype(kind) @ cq.T.astype(kind)).astype(np.float64) * scale[:, None] * c_scale
            slack = (norm + lost)[:, None] * c_lost + lost[:, None] * c_norm + 1e-9 * norm[:, None] * c_norm
            own = ids[:, None] == c_ids
            if len(c_ids) > k:
                sure = np.where(own, -np.inf, near - slack)
                least = np.maximum(least, np.partition(sure, len(c_ids) - k, axis=1)[:, len(c_ids) - k])
            row, at = np.nonzero((near + slack >= least[:, None]) & ~own)
            for part in np.array_split(np.arange(len(row)), max(1, len(row) // 65536)):
                scores = inner_products(x[row[part]], c[at[part]])
                for r, i, s in zip(row[part].tolist(), c_ids[at[part]].tolist(), scores.tolist(), strict=True):
                    heap = heaps[r]
                    if len(heap) < k:
                        heapq.heappush(heap, (s, -i))
                    elif (s, -i) > heap[0]:
                        heapq.heapreplace(heap, (s, -i))
            for r, heap in enumerate(heaps):
                if len(heap) == k:
                    least[r] = max(least[r], heap[0][0])
        return heaps


def _searcher(k: int) -> Callable:
    """Rows sorted by tile, candidates before queries -> the best k of the tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parts, tile = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "g", "r", "kind")], 1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                here, run_of = tuple(keys[a][:3]), batch.slice(a, b - a)
                if here != place:
                    place, parts, tile = here, [], None
                ids, x = run_of.column("vec_id").to_numpy(), _vectors(run_of)
                if keys[a][3] == 0:
                    parts.append((ids, x))
                    continue
                if tile is None:
                    if not parts:
                        continue
                    tile = _Tile(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                    parts = []
                for i in range(0, len(ids), 256):
                    heaps = tile.search(ids[i:i + 256], x[i:i + 256], k)
                    rows = [(int(q), -n, s) for q, heap in zip(ids[i:i + 256], heaps, strict=True) for s, n in heap]
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                                      pa.array([r[2] for r in rows], pa.float64())], names=["query_id", "vec_id", "score"])
    return run


def _merger(k: int) -> Callable:
    """Rows brought together by query -> the best k by a heap, ranked."""
    def best(found: list[tuple[float, int]]) -> list[tuple[float, int]]:
        return heapq.nsmallest(k, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, found = None, []

        def rows() -> list[tuple]:
            return [(query, n + 1, i, -s) for n, (s, i) in enumerate(best(found))]

        for batch in batches:
            out: list[tuple] = []
            for q, i, s in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if q != query:
                    out += rows() if query is not None else []
                    query, found = q, []
                found.append((-s, i))
                if len(found) > 64 * k:
                    found = best(found)
            yield _ranked(out)
        if query is not None:
            yield _ranked(rows())
    return run


def _ranked(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                      names=["query_id", "rank", "vec_id", "score"])


def nearest_neighbours(vectors: DataFrame, is_query: str, k: int = 20, *, id: str = "vec_id",
                       embedding: str = "embedding") -> DataFrame:
    """The ``k`` other vectors of largest inner product for every query.

    ``is_query`` is an SQL condition on the id column that selects the queries;
    all other rows are candidates for it, and so are queries for each other.  Rows with a null id, and
    vectors that are null, empty, zero or hold null or non-finite components,
    take no part.  Only vectors of equal dimension meet.  Rows that repeat an
    id are separate candidates and, as queries, give one list for all of them
    (the best k of both).  Columns: ``query_id``, ``rank`` (from 1, ties to
    the smaller id), ``vec_id``, ``score``; fewer than ``k`` rows where there
    are fewer candidates, none for an empty table.
    """
    e = F.col("embedding")
    rows = (vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"),
                           F.expr(is_query).alias("asks"))
            .filter(F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0)
                    & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                    & F.exists(e, lambda x: x != 0)))
    rows = rows.withColumn("dim", F.size("embedding"))
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    cores = max(2, rows.sparkSession.sparkContext.defaultParallelism)
    groups = max(-(-total // GROUP), min(cores, -(-total // BLOCK)), 1)
    chunks = max(-(-asked // CHUNK), 1)

    def spread(n: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    held = rows.select("dim", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("g"), spread(chunks, "r"),
                       F.lit(0).alias("kind"), "vec_id", "embedding")
    asking = rows.filter("asks").select("dim", spread(groups, "g"), F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("r"),
                                        F.lit(1).alias("kind"), "vec_id", "embedding")
    tiles = (held.unionByName(asking).repartition(groups * chunks, "dim", "g", "r")
             .sortWithinPartitions("dim", "g", "r", "kind"))
    found = tiles.mapInArrow(tidy(_searcher(k)), "query_id long, vec_id long, score double")
    return (found.repartition("query_id").sortWithinPartitions("query_id")
            .mapInArrow(tidy(_merger(k)), "query_id long, rank int, vec_id long, score double"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         list_reduce([q.e[i] * v.e[i] FOR i IN range(1, len(q.e) + 1)], lambda a, b: a + b) AS score
  FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
