"""Product quantisation against all pairs."""

import numpy as np
import pytest

from rowmill.llm import vectors


def plain(rows, threshold=0.98):
    ids = [r[0] for r in rows]
    usable = {}
    for i, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        usable[i] = (label, np.asarray(v, np.float64)) if ok else None
    links = {i: set() for i in ids}
    for i in ids:
        for j in ids:
            a, b = usable[i], usable[j]
            if i != j and a and b and a[0] == b[0] and len(a[1]) == len(b[1]):
                cos = a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1]))
                if cos >= threshold:
                    links[i].add(j)
    label = {i: i for i in ids}
    for _ in ids:
        label = {i: min([label[i], *(label[j] for j in links[i])]) for i in ids}
    return sorted((i, len(links[i]), label[i]) for i in ids)


def found(df):
    return sorted((r.id, r.n_links, r.component) for r in vectors.near_vectors(df).collect())


@pytest.mark.parametrize("block", [2048, 16])
def test_links_as_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rnd = np.random.default_rng(2)
    rows = []
    for c in range(60):
        base = rnd.normal(size=24)
        for _ in range(int(rnd.integers(1, 9))):
            v = (base + rnd.normal(size=24) * rnd.choice([0.0, 0.05, 0.14, 0.16, 0.5])).astype(np.float32)
            rows.append((len(rows) + 10, (v * rnd.choice([1, 3])).tolist(), int(c % 3)))
    nan, inf = float("nan"), float("inf")
    rows += [(1, None, 0), (2, [], 0), (3, [0.0] * 24, 0), (4, [1.0, nan] * 12, 0), (5, [1.0, inf] * 12, 0), (6, [1.0, None] * 12, 0)]
    rows += [(7, rows[0][1], None), (8, [1.0, 2.0], 0), (9, [1.0, 2.0], 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, rep string, copies int")
    assert found(df) == plain(rows)


def test_repeats_and_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert found(spark.createDataFrame([], schema)) == []
    df = spark.createDataFrame([(2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)], schema)
    rows = {r.id: (r.n_links, r.component) for r in vectors.near_vectors(df).collect()}
    assert rows == {1: (1, 1), 2: (1, 1), None: (0, None)}


def test_probes_and_shortlist_lose_nothing():
    rnd = np.random.default_rng(0)
    x = vectors.unit(rnd.normal(size=(1500, 16)))
    y = vectors.unit(x + rnd.normal(size=x.shape) * 0.04)
    index = vectors.Index.fitted(x[:500], 40)
    close = (x * y).sum(axis=1) >= 0.98
    own, _ = index.probes(x, 0.2)
    _, near = index.probes(y, 0.2)
    assert close.sum() > 500 and near[np.arange(len(x)), own][close].all()
    rest = x - index.lists[own]
    codes, off = index.encode(rest)
    for i in np.flatnonzero(close)[:200]:
        d = index.distances(y[i : i + 1] - index.lists[own[i]], codes[i : i + 1])[0, 0]
        assert d - off[i] <= 0.2 + 1e-9
