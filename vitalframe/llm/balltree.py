"""Exact top-k inner-product search with a ball tree per shard.

Vectors become integers, so scores are exact. They are dealt by hash into shards of bounded size; a
shard's task builds a ball tree and searches it for a block of queries by branch and bound: a node's
largest possible score is its centre's score plus radius times query length, nodes are visited in
falling order of that bound, and the search ends when the bound falls below the k-th best score.
Queries visit one shard first; the k-th scores found there travel with them as the floor for all
other shards, which then open few nodes and return few rows.

Results for odd input: vectors that are null, empty, or hold a null or non-finite component, and rows
with a null id, take no part; neither do vectors so long that an inner product might pass 64 bits
(squared length above LONGEST, after scaling); vectors of other lengths than the query's are no
candidates; repeated rows are candidates each (searched once, with their number), but a query's own id
never is; of repeated query ids the smallest vector asks; ties go to the smaller id; an empty table
gives no rows; extra columns play no part.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.common import written

SCALE = 1024
SHARD_ROWS = 4096
BLOCK_QUERIES = 4096
LEAF = 32
# sums of products below this are exact in double precision
EXACT = float(1 << 53)
# Squared lengths up to this: by Cauchy and Schwarz no product of two such vectors passes 64 bits, with
# room for the rounding of the sum.
LONGEST = 9.2e18
RESULT = "query_id long, vec_id long, score long, copies long"


def integers(vector: Column) -> Column:
    """floor(SCALE * x) per component; null for vectors that take no part."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    scaled = lambda x: F.lit(float(SCALE)) * x.cast("double")
    # one more than the scaled size, as floors go away from zero below it
    square = lambda x: (F.abs(scaled(x)) + 1) * (F.abs(scaled(x)) + 1)
    short = F.aggregate(vector, F.lit(0.0), lambda total, x: total + square(x)) <= LONGEST
    return F.when((F.size(vector) > 0) & F.forall(vector, finite) & short, F.transform(vector, lambda x: F.floor(scaled(x))))


@dataclass
class Tree:
    """Nodes in arrays; rows of a node are a slice of the order."""

    order: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    start: list[int]
    stop: list[int]
    children: list[tuple[int, int] | None]


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Halve along the line between two far points until a node is small."""
    order = np.arange(len(points))
    centre, radius, start, stop, children = [], [], [], [], []

    def add(a: int, b: int) -> int:
        own = points[order[a:b]]
        mid = own.mean(axis=0)
        centre.append(mid)
        radius.append(float(np.sqrt(((own - mid) ** 2).sum(axis=1).max())))
        start.append(a)
        stop.append(b)
        children.append(None)
        return len(start) - 1

    todo = [add(0, len(points))]
    while todo:
        node = todo.pop()
        a, b = start[node], stop[node]
        if b - a <= leaf or radius[node] == 0:
            continue
        own = points[order[a:b]]
        far = own[((own - centre[node]) ** 2).sum(axis=1).argmax()]
        other = own[((own - far) ** 2).sum(axis=1).argmax()]
        half = (b - a) // 2
        order[a:b] = order[a:b][np.argsort(own @ (other - far), kind="stable")]
        children[node] = (add(a, a + half), add(a + half, b))
        todo += children[node]
    return Tree(order, np.array(centre), np.array(radius), start, stop, children)


def search(tree: Tree, points: np.ndarray, ids: np.ndarray, query: np.ndarray, own_id: int, k: int, floor: float, exact) -> list[tuple[int, int]]:
    """(score, row) of the best k rows above or at the floor, ties to the smaller id."""
    length = float(np.sqrt(query @ query))
    slack = 1e-6 * (1 + length * (np.abs(tree.centre).max(initial=0) * np.sqrt(points.shape[1]) + tree.radius.max(initial=0)))
    bounds = tree.centre @ query + length * tree.radius + slack
    best: list[tuple[int, int, int]] = []
    heap = [(-bounds[0], 0)]
    while heap and -heap[0][0] >= floor:
        node = heapq.heappop(heap)[1]
        if tree.children[node]:
            for child in tree.children[node]:
                if bounds[child] >= floor:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        rows = tree.order[tree.start[node] : tree.stop[node]]
        scores = exact(rows, query)
        for row, score in zip(rows, scores):
            if score >= floor and ids[row] != own_id:
                entry = (int(score), -int(ids[row]), int(row))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        if len(best) == k:
            floor = max(floor, best[0][0])
    return [(score, row) for score, _, row in best]


def _cell(k: int):
    def run(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(vectors) and len(queries):
            whole = np.array(vectors["v"].tolist(), dtype=np.int64)
            points, ids = whole.astype(float), vectors["vec_id"].to_numpy()
            copies = vectors["copies"].to_numpy()
            tree = build(points)
            largest = float(np.abs(points).max())
            for own_id, v, floor in zip(queries["query_id"], queries["q"], queries["floor"]):
                asked = np.array(v, dtype=np.int64)
                query = asked.astype(float)
                if largest * float(np.abs(query).max()) * len(query) < EXACT:
                    exact = lambda at, q: points[at] @ q
                else:
                    exact = lambda at, q, asked=asked: whole[at].astype(object) @ asked.astype(object)
                found = search(tree, points, ids, query, own_id, k, -np.inf if floor is None or np.isnan(floor) else floor, exact)
                rows += [(own_id, int(ids[row]), s, int(copies[row])) for s, row in found]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score", "copies"])

    return run


def _numbers(n: int) -> Column:
    """One row per number below n."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def best_k(found: DataFrame, k: int) -> DataFrame:
    """The k best rows per query with their rank; copies count as rows."""
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, asks: Column, k: int = 10, vector: str = "embedding", id_col: str = "vec_id",
    shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id and score for every row that asks, against all other rows."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), integers(F.col(vector)).alias("v"), F.coalesce(asks, F.lit(False)).alias("asks"))
    # equal rows become one before the shuffle, so that a row repeated without end fills no shard
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).groupBy("vec_id", "v", "asks").agg(F.count("*").alias("copies"))
    rows = written(rows.withColumn("dim", F.size("v")), "integers")
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")).first()
    shards, blocks = max(1, -(-counts["n"] // shard_rows)), max(1, -(-counts["q"] // block_queries))
    block = F.pmod(F.xxhash64(F.lit(1), "query_id"), F.lit(blocks)).alias("block")
    # the row digest spreads repeated ids as well
    dealt = rows.select("dim", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).alias("shard"), "vec_id", "v", "copies")
    dealt = dealt.select("*", _numbers(blocks).alias("block"))
    queries = rows.where("asks").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    queries = queries.select("query_id", F.size("q").alias("dim"), "q", block, F.pmod(F.xxhash64(F.lit(2), "query_id"), F.lit(shards)).alias("home"))
    cell = ["dim", "shard", "block"]

    def wave(asked: DataFrame) -> DataFrame:
        return dealt.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInPandas(_cell(k), RESULT)

    first = written(wave(queries.select("dim", F.col("home").alias("shard"), "block", "query_id", "q", F.lit(None).cast("double").alias("floor"))), "home-shards")
    if shards == 1:
        return best_k(first, k)
    floors = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    floors = floors.select("query_id", F.when(F.col("n") >= k, F.col("least").cast("double")).alias("floor"))
    rest = queries.join(floors, "query_id", "left").select("*", _numbers(shards).alias("shard")).where(F.col("shard") != F.col("home"))
    return best_k(first.unionByName(wave(rest.select("dim", "shard", "block", "query_id", "q", "floor"))), k)
