"""Exact top-k by inner product with KD-trees, one for each shard of the vectors.

Vectors are dealt by a hash into shards of about ``SHARD`` rows. Each shard becomes a tree:
nodes are split at the median of their widest component down to ``LEAF`` rows and keep the
tight box around what they hold. For a query q, the sum of max(q * low, q * high) over the
components of a box bounds every inner product in it. A search pops the node of the highest
bound, opens it, and ends when that bound is below the k-th score found so far; at an equal
bound it goes on, since ties are won by the smaller id.

Queries travel in blocks. A task takes one block through the trees of its lane (some shards)
one after the other, so the k-th scores of earlier trees prune later ones; a window over the
winners of all lanes gives the result. One tree and one block are held at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.frames import written
from rowmill.llm.lattice import integers, largest

SHARD = 2048
LEAF = 64
BLOCK = 512
#: Shards that a task takes one after the other.
LANE = 4
NONE = np.iinfo(np.int64).min
_PACKED = "dim int, shard bigint, ids binary, points binary, low binary, high binary"


@lru_cache(maxsize=64)
def layout(n: int) -> list[tuple[int, int, int]]:
    """The nodes of a tree over n rows, by level: first row, end, and the first of two
    children (0 for a leaf). Median splits make it depend on n alone."""
    nodes, at = [(0, n, 0)], 0
    while at < len(nodes):
        a, b, _ = nodes[at]
        if b - a > LEAF:
            nodes[at] = (a, b, len(nodes))
            middle = a + (b - a) // 2
            nodes += [(a, middle, 0), (middle, b, 0)]
        at += 1
    return nodes


def plant(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the rows in their tree, and the low and high corner of each node's box."""
    order = np.arange(len(points))
    nodes = layout(len(points))
    low = np.empty((len(nodes), points.shape[1]), np.int64)
    high = np.empty_like(low)
    for at, (a, b, child) in enumerate(nodes):
        own = order[a:b]
        x = points[own]
        low[at], high[at] = x.min(axis=0), x.max(axis=0)
        if child:
            axis = int((high[at] - low[at]).argmax())
            order[a:b] = own[np.argpartition(x[:, axis], (b - a) // 2)]
    return order, low, high


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows; by floating point where that is exact."""
    bound = q.shape[1] * largest(q) * largest(x)
    if bound >= 1 << 63:
        raise ArithmeticError("inner products of these vectors exceed 64 bits")
    if bound < 1 << 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


class Search:
    """The best k rows so far for each query of a block, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, k: int):
        self.ids, self.points = ids, points
        self.positive, self.negative = np.maximum(points, 0), np.minimum(points, 0)
        self.scores = np.full((len(ids), k), NONE)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def through(self, ids: np.ndarray, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Best first through one tree. All queries that pop the same node open it together."""
        bound = products(self.positive, high) + products(self.negative, low)
        front = np.full(bound.shape, NONE)
        front[:, 0] = bound[:, 0]
        nodes = layout(len(ids))
        going = np.arange(len(self.ids))
        while len(going):
            top = front[going].argmax(axis=1)
            best = front[going, top]
            open_ = (best > NONE) & (best >= self.scores[going, -1])
            going, top = going[open_], top[open_]
            for node in np.unique(top):
                rows = going[top == node]
                a, b, child = nodes[node]
                front[rows, node] = NONE
                if child:
                    front[rows, child], front[rows, child + 1] = bound[rows, child], bound[rows, child + 1]
                else:
                    self.meet(rows, ids[a:b], products(self.points[rows], points[a:b]))

    def meet(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        scores[self.ids[rows][:, None] == ids[None]] = NONE
        good = (scores >= self.scores[rows, -1][:, None]) & (scores > NONE)
        some = good.any(axis=1)
        if not some.any():
            return
        rows, scores, kept = rows[some], scores[some], good[some].any(axis=0)
        k = self.scores.shape[1]
        scores = np.concatenate([self.scores[rows], scores[:, kept]], axis=1)
        named = np.concatenate([self.found[rows], np.broadcast_to(ids[kept], (len(rows), int(kept.sum())))], axis=1)
        # the least value has no negative, so its complement is sorted: ~x = -x - 1
        order = np.lexsort((named, ~scores), axis=1)[:, :k]
        self.scores[rows] = np.take_along_axis(scores, order, axis=1)
        self.found[rows] = np.take_along_axis(named, order, axis=1)

    def result(self) -> pa.RecordBatch:
        row, at = np.nonzero(self.scores > NONE)
        return pa.RecordBatch.from_pydict(
            {"query_id": self.ids[row], "vec_id": self.found[row, at], "score": self.scores[row, at]}
        )


def _pack_tree(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    points = np.stack(rows["x"]).astype(np.int64)
    order, low, high = plant(points)
    ids = rows["id"].to_numpy(np.int64)[order]
    return pd.DataFrame(
        [[key[0], key[1], ids.tobytes(), points[order].tobytes(), low.tobytes(), high.tobytes()]],
        columns=["dim", "shard", "ids", "points", "low", "high"],
    )


def _pack_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    points, ids = np.stack(rows["x"]).astype(np.int64), rows["id"].to_numpy(np.int64)
    return pd.DataFrame([[key[0], key[1], ids.tobytes(), points.tobytes()]], columns=["dim", "block", "ids", "points"])


def _array(column: pa.Array, at: int) -> np.ndarray:
    return np.frombuffer(column[at].as_buffer(), np.int64)


def top_k(df: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query.

    ``queries`` is a condition on ``id`` that picks the query rows; all vectors but the
    query's own are candidates, fewer than k give fewer rows, ties go to the smaller id.

    Vectors that are null, empty or hold null or non-finite components take no part, nor do
    rows without an id. Rows of one id are one vector, the least of differing ones. Vectors
    are compared with those of as many components. An empty table gives no rows. Components
    so large that a score exceeds 64 bits end the job with an error. Other columns are left
    out whatever their names. What reaches the driver is one count for each number of
    components.
    """
    vectors = written(
        integers(df, id_col, vector_col).where("id IS NOT NULL").groupBy("id").agg(F.min("x").alias("x"))
        .select("id", "x", F.size("x").alias("dim"), F.coalesce(queries, F.lit(False)).alias("asked")),
        "integers",
    )
    sizes = {r["dim"]: r for r in vectors.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asked").alias("q")).collect()}
    sizes = {d: (-(-r["n"] // SHARD), -(-r["q"] // BLOCK)) for d, r in sizes.items() if r["q"]}
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    of_dim = lambda at: F.create_map(*[F.lit(v) for d, s in sizes.items() for v in (d, s[at])])[F.col("dim")]
    place = F.xxhash64("id", F.lit("shard"))
    met = vectors.where(F.col("dim").isin(*sizes))
    trees = written(
        met.withColumn("shard", F.pmod(place, of_dim(0))).groupBy("dim", "shard").applyInPandas(_pack_tree, _PACKED), "trees"
    )
    blocks = written(
        met.where("asked").withColumn("block", F.pmod(place, of_dim(1))).groupBy("dim", "block")
        .applyInPandas(_pack_block, "dim int, block bigint, ids binary, points binary"),
        "query-blocks",
    )
    lanes = F.ceil(of_dim(0) / LANE)
    none = F.lit(None).cast("binary")
    spot = ["dim", "block", "lane"]
    meetings = (
        trees.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), of_dim(1).cast("long") - 1)))
        .withColumn("lane", F.pmod("shard", lanes))
        .select(*spot, "shard", "ids", "points", "low", "high")
        .union(
            blocks.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), lanes.cast("long") - 1)))
            .select(*spot, F.lit(-1).cast("long"), "ids", "points", none, none)
        )
        .repartition(*spot)
        .sortWithinPartitions(*spot, "shard")
    )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            shards, dims = batch.column("shard").to_pylist(), batch.column("dim").to_pylist()
            for at, (shard, dim) in enumerate(zip(shards, dims)):
                ids, points = _array(batch.column("ids"), at), _array(batch.column("points"), at).reshape(-1, dim)
                if shard < 0:  # the queries of the next lane come before its trees
                    if now is not None:
                        yield now.result()
                    now = Search(ids, points, k)
                elif now is not None:
                    boxes = (_array(batch.column(c), at).reshape(-1, dim) for c in ("low", "high"))
                    now.through(ids, points, *boxes)
        if now is not None:
            yield now.result()

    won = meetings.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return won.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
