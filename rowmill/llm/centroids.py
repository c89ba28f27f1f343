"""Centroid clustering with the equal-average equal-variance search.

By the mean m and the deviation v = |x - m| of vectors of d components, a centroid c is at
least d * (mx - mc)^2 + (vx - vc)^2 away from x. Centroids are kept sorted by their mean.
A vector's search begins at its own mean and goes outward; once the means alone are too far
apart, all further ones are, and it ends. Of the centroids met before, those whose deviation
differs too much are passed over; the rest are measured in whole numbers, ties go to the
smaller number. The bounds have room for rounding, so they never decide a tie.

Each round is one pass of Spark over the vectors; a task returns one sum for each centroid,
and the totals, centroids times components, are what reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.frames import written
from rowmill.llm.lattice import integers, largest, matrix

ROUNDING = 1e-9
PIECE = 8192


def deviations(x: np.ndarray) -> np.ndarray:
    off = x - x.mean(axis=1, keepdims=True)
    return np.sqrt((off * off).sum(axis=1))


class Sorted:
    """Centroids in the order of their means."""

    def __init__(self, centroids: np.ndarray):
        self.points = centroids
        total = centroids.sum(axis=1)
        self.order = np.argsort(total, kind="stable")
        self.totals = total[self.order]
        self.deviation = deviations(centroids)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row."""
        n, size = x.shape
        reach = max(largest(x), largest(self.points))
        if size * (2 * reach) ** 2 >= 1 << 63:
            raise ArithmeticError("squared distances of these vectors exceed 64 bits")
        total, deviation = x.sum(axis=1), deviations(x)
        room = ROUNDING * (1 + reach * size**0.5)
        left = np.searchsorted(self.totals, total) - 1
        right = left + 1
        best, which = np.full(n, np.iinfo(np.int64).max), np.full(n, len(self.points))
        going = np.arange(n)
        while len(going):
            low, high, t = left[going], right[going], total[going]
            below = np.where(low >= 0, (t - self.totals[np.maximum(low, 0)]).astype(float), np.inf)
            above = np.where(
                high < len(self.totals), (self.totals[np.minimum(high, len(self.totals) - 1)] - t).astype(float), np.inf
            )
            down = below <= above
            by_mean = np.minimum(below, above) ** 2 / size * (1 - ROUNDING)
            more = by_mean <= best[going]
            going, down, by_mean = going[more], down[more], by_mean[more]
            met = self.order[np.where(down, low[more], high[more])]
            left[going] -= down
            right[going] += ~down
            apart = np.maximum(np.abs(deviation[going] - self.deviation[met]) - room, 0)
            close = by_mean + apart**2 * (1 - ROUNDING) <= best[going]
            rows, met = going[close], met[close]
            gap = x[rows] - self.points[met]
            distance = (gap * gap).sum(axis=1)
            better = (distance < best[rows]) | ((distance == best[rows]) & (met < which[rows]))
            best[rows[better]], which[rows[better]] = distance[better], met[better]
        return which, best


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE):
            yield batch.slice(start, PIECE)


def _totals(vectors: DataFrame, centroids: np.ndarray) -> dict[int, list[int]]:
    """For each centroid that has any vectors, their sum by component and then their number."""
    search, size = Sorted(centroids), centroids.shape[1]

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centroids), size + 1), np.int64)
        for part in _pieces(batches):
            x = matrix(part.column("x"))
            which, _ = search.nearest(x)
            np.add.at(sums, which, np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1))
        met = np.flatnonzero(sums[:, -1])
        yield pa.RecordBatch.from_pydict({"cluster": met.astype(np.int32), "sums": list(sums[met])})

    parts = vectors.select("x").mapInArrow(add, "cluster int, sums array<bigint>")
    rows = (
        parts.select("cluster", F.posexplode("sums").alias("at", "part"))
        .groupBy("cluster", "at")
        .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
        .collect()
    )
    out: dict[int, list[int]] = {}
    for r in rows:
        out.setdefault(r["cluster"], [0] * (size + 1))[r["at"]] = int(r["total"])
    return out


def cluster(
    df: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, size: int = 64, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid): one row for each vector
    of ``size`` components; null vectors and those that hold null or non-finite components
    are left out.

    The k vectors of least sha256 of "seed:id" start as centroids 0, 1, ... Each round moves
    every centroid that has vectors to their mean, rounded down.

    Every row counts as a vector of its own, repeated ones too; a null id is hashed as an
    empty text. Fewer than k vectors start fewer clusters; of equal centroids only the
    smallest number gets vectors. An empty table gives no rows. Components so large that a
    distance exceeds 64 bits end the job with an error. Other columns are left out whatever
    their names.
    """
    spark = df.sparkSession
    vectors = written(integers(df, id_col, vector_col).where(F.size("x") == size), "integers")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    start = vectors.orderBy(F.sha2(name, 256), "x").limit(k).select("x").collect()
    schema = (
        "id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    )
    if not start:
        return spark.createDataFrame([], schema)
    centroids = np.array([r["x"] for r in start], np.int64)
    for _ in range(rounds):
        for at, (*sums, n) in _totals(vectors, centroids).items():
            centroids[at] = [s // n for s in sums]
    search = Sorted(centroids)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches):
            which, distance = search.nearest(matrix(part.column("x")))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(which.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"]
            )

    found = written(vectors.mapInArrow(assign, "id bigint, cluster int, distance bigint"), "assigned")
    sums = {
        r["cluster"]: int(r["s"])
        for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    }
    about = spark.createDataFrame(
        [(c, s, sum(sums.values()), centroids[c].tolist()) for c, s in sums.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>",
    )
    return found.join(about, "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
