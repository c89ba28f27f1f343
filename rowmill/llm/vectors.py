"""Embedding near-dedup by product quantisation.

Vectors of unit length are put in coarse inverted lists; within a list the residual to its
centre is coded by eight subspace codewords. A pair with a cosine of 0.98 or more is at most
0.2 apart, so a vector has to look into every list whose border is that near, and in it only
at members whose table-lookup distance, less their own coding error, is not larger. These
are the probes and the shortlist that suffice for every link; the shortlist is then compared
by exact cosines in double precision.

Centres and codewords are fitted on at most ``SAMPLE`` distinct vectors (in expectation) of
each dimension, picked by a hash; every vector is indexed. Equal vectors of one label are
one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.frames import components, written

THRESHOLD = 0.98
SAMPLE = 20_000
MOST_LISTS = 1024
PARTS = 8
CODES = 256
BLOCK = 2048
#: Room for rounding in the bounds; the exact cosine decides.
SLACK = 1e-6


def unit(vectors: np.ndarray) -> np.ndarray:
    v = np.asarray(vectors, np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def centres(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means with a fixed start."""
    k = min(k, len(points))
    out = points[np.random.default_rng(7).permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        near = squared(points, out).argmin(axis=1)
        sums = np.zeros_like(out)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=k)
        out[n > 0] = sums[n > 0] / n[n > 0, None]
    return out


@dataclass
class Index:
    lists: np.ndarray  # list x dimension
    parts: list[np.ndarray]  # dimensions of each subspace
    books: list[np.ndarray]  # of each subspace, codeword x dimension

    @classmethod
    def fitted(cls, sample: np.ndarray, lists: int) -> Index:
        coarse = centres(sample, lists)
        rest = sample - coarse[squared(sample, coarse).argmin(axis=1)]
        parts = np.array_split(np.arange(sample.shape[1]), min(PARTS, sample.shape[1]))
        return cls(coarse, parts, [centres(rest[:, p], CODES) for p in parts])

    @classmethod
    def plain(cls, size: int) -> Index:
        """One list and one codeword, for a dimension of which the sample has no vector."""
        return cls(np.zeros((1, size)), [np.arange(size)], [np.zeros((1, size))])

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and how far each is from what its codes stand for."""
        codes = np.stack([squared(rest[:, p], book).argmin(axis=1) for p, book in zip(self.parts, self.books)], axis=1)
        off = sum(((rest[:, p] - book[codes[:, i]]) ** 2).sum(axis=1) for i, (p, book) in enumerate(zip(self.parts, self.books)))
        return codes.astype(np.uint8), np.sqrt(off)

    def distances(self, rest: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distance from each residual to what each row of codes stands for, by table lookup."""
        total = np.zeros((len(rest), len(codes)))
        for i, (p, book) in enumerate(zip(self.parts, self.books)):
            total += squared(rest[:, p], book)[:, codes[:, i]]
        return np.sqrt(total)

    def probes(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Nearest list of each vector, and (vector x list) whether the list may hold
        anything within reach: whether the plane between the two centres is that near."""
        d = squared(x, self.lists)
        own = d.argmin(axis=1)
        apart = np.sqrt(squared(self.lists, self.lists))
        near = d - d[np.arange(len(x)), own][:, None] <= 2 * reach * apart[own] + SLACK
        near[np.arange(len(x)), own] = True
        return own, near


def fit(classes: DataFrame, sample: int = SAMPLE) -> dict[int, Index]:
    """An index for each dimension of (vec), lists about the root of the number of vectors."""
    sizes = {r["dim"]: r["count"] for r in classes.groupBy(F.size("vec").alias("dim")).count().collect()}
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for d, n in sizes.items() for x in (d, min(1.0, sample / n))])[F.size("vec")]
    place = F.pmod(F.xxhash64("vec", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    picked = classes.where(place < share).select("vec").toPandas()["vec"]
    out = {}
    for dim, n in sizes.items():
        own = [v for v in picked if len(v) == dim]
        lists = int(min(MOST_LISTS, max(1, round(n**0.5))))
        out[dim] = Index.fitted(unit(np.stack(own)), lists) if own else Index.plain(dim)
    return out


def _by_dim(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors of each dimension in a column."""
    flat, ends = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *vectors.value_lengths().to_pylist()])
    dims = np.diff(ends)
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        yield rows, unit(flat[ends[rows][:, None] + np.arange(dim)])


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """(id, n_links, component): one row for each distinct id, null included.

    ``n_links`` counts the other vectors of the same label at a cosine of ``threshold`` or
    more, ``component`` is the smallest id reachable. Vectors that are null, empty, zero or
    hold null or non-finite numbers, those without a label and those of another dimension
    are linked with nothing. Rows of one id are one vector: of differing ones the least
    that can be linked stands. Rows without an id take no part: no links, a null component.
    Other columns are left out whatever their names.
    """
    reach = float(np.sqrt(2 - 2 * threshold)) + SLACK
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"), F.col(label_col).alias("label"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    linkable = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    vectors = written(linkable.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("v")).select("id", "v.*"), "vectors")
    classes = written(
        vectors.groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes"
    )
    indexes = fit(classes)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                for at, x in _by_dim(batch.column("vec")):
                    index = indexes[x.shape[1]]
                    own, near = index.probes(x, reach)
                    codes, off = index.encode(x - index.lists[own])
                    row, spot = np.nonzero(near)
                    member = [np.arange(len(at)), own]
                    take = pa.array(np.concatenate([at, at[row]]))
                    n = len(row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(c).take(take) for c in ("label", "rep", "copies", "vec")),
                            pa.array(np.concatenate([member[1], spot]).astype(np.int32)),
                            pa.array([*(c.tobytes() for c in codes), *[None] * n], pa.binary()),
                            pa.array(np.concatenate([off, np.zeros(n)])),
                        ],
                        ["label", "rep", "copies", "vec", "list", "code", "off"],
                    )

    kind = {f.name: f.dataType.simpleString() for f in classes.schema}
    entries = written(
        classes.mapInArrow(
            assign, f"label {kind['label']}, rep bigint, copies bigint, vec {kind['vec']}, list int, code binary, off double"
        ).withColumn("dim", F.size("vec")),
        "entries",
    )
    spot = ["label", "dim", "list"]
    sizes = entries.groupBy(*spot).agg(
        F.ceil(F.count("code") / BLOCK).alias("members"), F.ceil(F.count_if(F.col("code").isNull()) / BLOCK).alias("queries")
    )
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("code").isNotNull(), F.col("members")).otherwise(F.col("queries")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("code").isNotNull(), F.col("queries")).otherwise(F.col("members")) - 1))
    is_member = F.col("code").isNotNull()
    dealt = (
        entries.join(sizes.where("members > 0 AND queries > 0"), spot)
        .withColumn("own", own)
        .withColumn("other", other)
        .withColumn("mb", F.when(is_member, F.col("own")).otherwise(F.col("other")))
        .withColumn("qb", F.when(is_member, F.col("other")).otherwise(F.col("own")))
        .select(*spot, "mb", "qb", "rep", "copies", "vec", "code", "off")
    )

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        is_member = group["code"].notna().to_numpy()
        members, queries = group[is_member], group[~is_member]
        none = pd.DataFrame({"rep": [], "links": [], "root": []})
        if members.empty or queries.empty:
            return none
        index, centre = indexes[key[1]], indexes[key[1]].lists[key[2]]
        x, y = unit(np.stack(members["vec"])), unit(np.stack(queries["vec"]))
        codes = np.stack([np.frombuffer(c, np.uint8) for c in members["code"]])
        limit = members["off"].to_numpy() + reach
        pairs = []
        for start in range(0, len(y), 256):
            q, m = np.nonzero(index.distances(y[start : start + 256] - centre, codes) <= limit)
            q += start
            exact = np.concatenate([(x[m[k : k + 65536]] * y[q[k : k + 65536]]).sum(axis=1) for k in range(0, len(m), 65536)] or [np.zeros(0)])
            pairs.append((q[exact >= threshold], m[exact >= threshold]))
        q, m = (np.concatenate(p) for p in zip(*pairs))
        q_rep, m_rep, copies = queries["rep"].to_numpy(), members["rep"].to_numpy(), members["copies"].to_numpy()
        other = q_rep[q] != m_rep[m]
        q, m = q[other], m[other]
        links = np.zeros(len(y), np.int64)
        np.add.at(links, q, copies[m])
        q_root, m_root, before = q_rep.copy(), m_rep.copy(), None
        while before is None or (before != q_root).any():
            before = q_root.copy()
            np.minimum.at(q_root, q, m_root[m])
            np.minimum.at(m_root, m, q_root[q])
        out = pd.DataFrame({"rep": q_rep, "links": links, "root": q_root})[links > 0]
        held = np.unique(m)
        return pd.concat([out, pd.DataFrame({"rep": m_rep[held], "links": 0, "root": m_root[held]})], ignore_index=True)

    links = written(
        dealt.groupBy(*spot, "mb", "qb").applyInPandas(compare, "rep bigint, links bigint, root bigint"), "links"
    )
    groups = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "rep")
    totals = links.groupBy("rep").agg(F.sum("links").alias("links")).join(groups, "rep", "left")
    named = vectors.join(classes, ["label", "vec"]).select("id", "rep", "copies").join(totals, "rep", "left")
    return (
        rows.select("id").distinct()
        .join(named, "id", "left")
        .select(
            "id",
            (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep", "id").alias("component"),
        )
    )
