"""KD-trees against all scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowmill.llm import nearest

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, every=100, k=10):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            x = np.floor(np.asarray(v, np.float32).astype(np.float64) * 1024).astype(np.int64).tolist()
            usable[i] = min(usable.get(i, x), x)
    out = []
    for q, x in usable.items():
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in usable.items() if i != q and len(y) == len(x))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(df, every=100, k=10):
    return sorted(tuple(r) for r in nearest.top_k(df, F.col("id") % every == 0, k).collect())


@pytest.mark.parametrize("shard,leaf,block,lane", [(2048, 64, 512, 4), (40, 4, 3, 2)])
def test_as_all_scores(spark, monkeypatch, shard, leaf, block, lane):
    for name, value in (("SHARD", shard), ("LEAF", leaf), ("BLOCK", block), ("LANE", lane)):
        monkeypatch.setattr(nearest, name, value)
    nearest.layout.cache_clear()
    rnd = np.random.default_rng(1)
    rows = [(i, (rnd.normal(size=6) * rnd.choice([0.2, 1, 3])).round(2).tolist()) for i in range(-30, 400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(60)] + [(2000 + i, [0.25 * i, 1.0]) for i in range(4)]
    nan, inf = float("nan"), float("inf")
    rows += [(5000, None), (5100, []), (5200, [nan] * 6), (5300, [inf] + [1.0] * 5), (5400, [None] + [1.0] * 5), (None, [9.0] * 6)]
    rows += [rows[30], (100, [0.0] * 6), (5500, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", score string, shard int, id int")
    assert found(df, 20) == plain(rows, 20)
    nearest.layout.cache_clear()


def test_few_none_and_large(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(100, [1.0]), (7, None)], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, [1.0]), (2, [1.0])], SCHEMA)) == []
    assert found(spark.createDataFrame([(100, [1.0]), (2, [-1.0]), (1, [-1.0])], SCHEMA)) == [
        (100, 1, 1, -(1 << 20)), (100, 2, 2, -(1 << 20))
    ]
    far = float(1 << 17)
    assert found(spark.createDataFrame([(100, [far, 1.0]), (2, [far, 2.0])], SCHEMA)) == [(100, 1, 2, (1 << 54) + (1 << 21))]
    with pytest.raises(Exception, match="64 bits"):
        found(spark.createDataFrame([(100, [1e30]), (2, [1e30])], SCHEMA))


def test_boxes_are_tight_and_prune():
    rnd = np.random.default_rng(2)
    x = rnd.integers(-1000, 1000, (1000, 3))
    order, low, high = nearest.plant(x)
    assert sorted(order) == list(range(1000))
    for (a, b, _), lo, hi in zip(nearest.layout(1000), low, high):
        own = x[order[a:b]]
        assert (own.min(axis=0) == lo).all() and (own.max(axis=0) == hi).all()
    search = nearest.Search(np.array([-1]), np.array([[1, 1, 1]]), 1)
    met = []
    meet = search.meet
    search.meet = lambda rows, ids, scores: (met.append(len(ids)), meet(rows, ids, scores))
    search.through(np.arange(1000), x[order], low, high)
    assert search.scores[0, 0] == x.sum(axis=1).max() and sum(met) < 500
