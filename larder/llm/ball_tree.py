"""Exact inner-product top-k by branch and bound over a ball tree for each shard.

Candidates are dealt into shards of bounded bytes, queries into blocks. A task builds the ball tree
of its shard and answers a block of queries: nodes are visited by the upper bound of the inner
product in their ball, and a query stops when no bound reaches its k-th score. Every query first
searches its home shard; the k-th score found there is the one it starts with in all others.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import settle

SCALE = 1024
#: Bytes of one shard's vectors, queries of one block, rows of a leaf.
SHARD_BYTES = 32 << 20
QUERY_BLOCK = 16_384
LEAF = 128
#: A shard is not made smaller than this for the sake of more tasks.
LEAST_ROWS = 1024
FOUND = "query_id long, vec_id long, score long"


def whole_numbers(vector: str, scale: int = SCALE) -> Column:
    """Each component x as floor(scale * x), x as a double."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def usable(vector: str) -> Column:
    """Not null, not empty, and every component a finite number."""
    fine = F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < np.inf),
    )
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


@dataclass
class Tree:
    """Nodes over a permuted shard: node i has children 2i+1, 2i+2 unless it is a leaf."""

    ids: np.ndarray
    rows: np.ndarray
    spans: dict[int, tuple[int, int]]
    order: np.ndarray
    centers: np.ndarray
    radii: np.ndarray
    place: dict[int, int]
    exact: bool


def build(ids: np.ndarray, rows: np.ndarray) -> Tree:
    """Split at the median along the line between two far points until leaves are small."""
    points = rows.astype(np.float64)
    order = np.arange(len(rows))
    spans, centers, radii, place = {}, [], [], {}
    stack = [(0, 0, len(rows))]
    while stack:
        node, low, high = stack.pop()
        own = points[order[low:high]]
        center = own.mean(axis=0)
        apart = ((own - center) ** 2).sum(axis=1)
        place[node] = len(centers)
        centers.append(center)
        radii.append(np.sqrt(apart.max()))
        spans[node] = (low, high)
        if high - low > LEAF and apart.max() > 0:
            far = own[apart.argmax()]
            other = own[((own - far) ** 2).sum(axis=1).argmax()]
            half = (high - low) // 2
            split = np.argpartition((own @ (other - far)), half)
            order[low:high] = order[low:high][split]
            stack += [(2 * node + 1, low, low + half), (2 * node + 2, low + half, high)]
    largest = float(np.abs(points).max())
    exact = largest * largest * rows.shape[1] < 2**52
    kept = points[order] if exact else rows[order]
    return Tree(ids[order], kept, spans, order, np.array(centers), np.array(radii), place, exact)


def search(tree: Tree, query_id: int, query: np.ndarray, k: int, floor: int | None):
    """Ids and scores of the best ``k`` with a score of at least ``floor``; ties to smaller ids."""
    point = query.astype(np.float64)
    length = np.sqrt(point @ point)
    reach = np.sqrt((tree.centers**2).sum(axis=1)) + tree.radii
    # The slack covers the rounding of the bounds, scores being whole numbers.
    bounds = tree.centers @ point + length * tree.radii + 1e-9 * length * reach + 1e-3
    exact = tree.exact and float(np.abs(point).max()) * float(
        np.abs(tree.rows).max()
    ) * len(point) < 2**52
    vector = point if exact else query
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        if floor is not None and -bound < floor:
            break
        if 2 * node + 1 in tree.place:
            for child in (2 * node + 1, 2 * node + 2):
                own = min(-bound, bounds[tree.place[child]])
                if floor is None or own >= floor:
                    heapq.heappush(heap, (-own, child))
            continue
        low, high = tree.spans[node]
        here = tree.rows[low:high] @ vector
        here = here.astype(np.int64)
        take = tree.ids[low:high] != query_id
        if floor is not None:
            take &= here >= floor
        if not take.any():
            continue
        ids = np.concatenate([ids, tree.ids[low:high][take]])
        scores = np.concatenate([scores, here[take]])
        if len(ids) > k:
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        if len(ids) == k and (floor is None or scores.min() > floor):
            floor = int(scores.min())
    return ids, scores


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _answer(queries: pa.Table, shard: pa.Table, k: int) -> pa.Table:
    found = [np.zeros(0, np.int64)] * 3
    if queries.num_rows and shard.num_rows:
        dim = queries["dim"][0].as_py()
        tree = build(shard["vec_id"].to_numpy(), _matrix(shard["vector"], dim))
        parts = []
        rows = zip(
            queries["query_id"].to_pylist(),
            _matrix(queries["vector"], dim),
            queries["floor"].to_pylist(),
            strict=True,
        )
        for query_id, vector, floor in rows:
            ids, scores = search(tree, query_id, vector, k, floor)
            parts.append((np.full(len(ids), query_id), ids, scores))
        found = [np.concatenate(x) for x in zip(*parts, strict=True)]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))


def _search_shards(queries: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    on = ["shard", "block", "dim"]
    pair = queries.groupBy(*on).cogroup(shards.groupBy(*on))
    return pair.applyInArrow(lambda q, s: _answer(q, s, k), FOUND)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows of every query, all if fewer.

    Queries are the rows where ``is_query`` holds; candidates are all rows of another id with as
    many components. The score is the inner product of ``whole_numbers``, ties go to the smaller
    id. Rows that are not ``usable`` or have a null id take no part. Rows of one id are candidates
    each; as a query such an id counts once, with its smallest vector. Whole scores beyond 63 bits
    wrap.
    """
    spark = vectors.sparkSession
    base = settle(
        vectors.where(F.col(id_col).isNotNull() & usable(vector_col)).select(
            F.col(id_col).cast("bigint").alias("vec_id"),
            whole_numbers(vector_col).alias("vector"),
            F.size(vector_col).alias("dim"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        ),
        "vectors",
    )
    asked = base.where("asks").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = settle(
        asked.select(
            F.col("vec_id").alias("query_id"), "vector", F.size("vector").alias("dim")
        ),
        "queries",
    )
    count, width = base.agg(F.count(F.lit(1)), F.max("dim")).first()
    cores = spark.sparkContext.defaultParallelism
    rows = max(1, SHARD_BYTES // (8 * (width or 1)))
    shards = max(-(-count // rows), min(2 * cores, -(-count // LEAST_ROWS)), 1)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    home = F.pmod(F.xxhash64("query_id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(blocks)).cast("int")
    placed = asked.select("*", home.alias("home"), block.alias("block"))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    dealt = base.select(
        "vec_id",
        "vector",
        "dim",
        F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(shards)).cast("int").alias("shard"),
        every_block,
    )
    none = F.lit(None).cast("bigint").alias("floor")
    at_home = settle(
        _search_shards(placed.withColumn("shard", F.col("home")).select("*", none), dealt, k),
        "home-scores",
    )
    floors = (
        at_home.groupBy("query_id")
        .agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == k)
        .drop("n")
    )
    away = (
        placed.join(floors, "query_id", "left")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .where("shard != home")
    )
    found = at_home.unionByName(_search_shards(away, dealt, k))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
