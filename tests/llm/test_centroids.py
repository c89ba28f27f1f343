"""Equal-average equal-variance search against measuring every centroid, and whole runs against plain rounds."""

import hashlib

import numpy as np
import pytest

from rowmill.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k, rounds, size):
    xs = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v):
            xs.append((i, np.floor(np.asarray(v, np.float32).astype(np.float64) * 1024).astype(np.int64).tolist()))
    named = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in xs)
    means = [x for _, x in named[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, m)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        groups = {}
        for _, x in xs:
            groups.setdefault(near(x)[1], []).append(x)
        means = [[sum(c) // len(groups[n]) for c in zip(*groups[n])] if n in groups else m for n, m in enumerate(means)]
    out = [(i, near(x)[1], near(x)[0]) for i, x in xs]
    total = sum(d for *_, d in out)
    return sorted(((i, c, d, sum(e for _, f, e in out if f == c), total, means[c]) for i, c, d in out), key=str)


def found(df, **more):
    return sorted((tuple(r) for r in centroids.cluster(df, **more).collect()), key=str)


def test_nearest_as_all_distances():
    rnd = np.random.default_rng(5)
    for size, spread in ((1, 3), (4, 2), (16, 1000), (64, 1000), (3, 1 << 27)):
        c = rnd.integers(-spread, spread + 1, (40, size))
        c[7] = c[3]
        x = np.concatenate([rnd.integers(-spread, spread + 1, (500, size)), c])
        every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        which, distance = centroids.Sorted(c).nearest(x)
        assert (distance == every.min(axis=1)).all() and (which == every.argmin(axis=1)).all()
    with pytest.raises(ArithmeticError):
        centroids.Sorted(np.array([[1 << 62]])).nearest(np.array([[0]]))


def test_as_plain_rounds(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, (rnd.normal(size=5) + 2 * rnd.integers(0, 4)).round(3).tolist()) for i in range(300)]
    nan, inf = float("nan"), float("inf")
    rows += [(900, None), (901, []), (902, [1.0] * 4), (903, [nan] * 5), (904, [inf] + [0.0] * 4), (905, [None] + [1.0] * 4)]
    rows += [rows[0], rows[0], (None, [1.0] * 5), (None, [-1.0] * 5), (5, [3.0] * 5)]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], SCHEMA + ", cluster string, id int").repartition(5)
    assert found(df, rounds=4, size=5) == plain(rows, 8, 4, 5)


def test_few_equal_and_none(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, [1.0])], SCHEMA)) == []
    rows = [(i, [0.5, -0.5]) for i in range(12)]
    assert found(spark.createDataFrame(rows, SCHEMA), size=2) == plain(rows, 8, 10, 2)
    rows = [(1, [0.0, 0.0]), (2, [1.0, -1.0]), (3, [1.0, -1.5])]
    assert found(spark.createDataFrame(rows, SCHEMA), size=2) == plain(rows, 8, 10, 2)
