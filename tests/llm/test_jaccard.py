"""The chosen-path join against all pairs."""

import random

import numpy as np
import pytest
from brute import BLANK

from rowmill.llm import jaccard


def plain(rows):
    sets = {}
    for i, t in rows:
        w = BLANK.findall(t or "")
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    links = {i: set() for i in sets}
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i != j and both and both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i].add(j)
    label = {i: i for i in sets}
    for _ in sets:
        label = {i: min([label[i], *(label[j] for j in links[i])]) for i in sets}
    copy = {i: min([j for j in sets if sets[j] == sets[i] and sets[i]] or [i]) for i in sets}
    return sorted((i, copy[i], len(links[i]), label[i]) for i in sets)


def near_copies(rnd, n, words, edits):
    base = [f"w{rnd.randrange(3000)}" for _ in range(words)]
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(edits)):
            w[rnd.randrange(words)] = f"x{rnd.randrange(10**6)}"
        yield " ".join(w)


def result(df):
    return sorted((r.id, r.copy_of, r.n_links, r.class_id) for r in jaccard.jaccard_groups(df).collect())


def test_join_as_plain(spark):
    rnd = random.Random(4)
    boiler = " ".join(f"b{k}" for k in range(60)) + " "
    texts = [None, "", "one", "one", "one two three four", "a b c d e", "a b c d e f"]
    texts += [*near_copies(rnd, 40, 120, 9), *near_copies(rnd, 12, 300, 20), *near_copies(rnd, 8, 30, 3)]
    texts += [boiler + " ".join(f"v{rnd.randrange(10**5)}" for _ in range(rnd.randrange(5, 60))) for _ in range(60)]
    rows = list(enumerate(texts, 100))
    rnd.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows] + [(110, dict(rows)[110], 2, "y"), (None, "one", 0, "")], "doc_id long, text string, rep int, leaf string")
    assert result(df) == plain(rows)


def test_large_buckets_split_and_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIMIT", 6)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rnd = random.Random(8)
    texts = [*near_copies(rnd, 60, 80, 6), *near_copies(rnd, 20, 80, 3)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == plain(rows)


def test_no_rows(spark):
    assert result(spark.createDataFrame([], "doc_id long, text string")) == []
    assert result(spark.createDataFrame([(None, None), (5, None)], "doc_id long, text string")) == [(5, 5, 0, 5)]


def test_common_counts():
    rnd = np.random.default_rng(0)
    lists = [np.unique(rnd.integers(0, 30000, rnd.integers(0, 9000))) for _ in range(14)]
    a, b = (x.ravel() for x in np.triu_indices(14, 1))
    got = jaccard._common(lists, a, b, np.zeros(14, int))
    assert got.tolist() == [len(np.intersect1d(lists[x], lists[y])) for x, y in zip(a, b)]


def test_long_lists_in_ranges():
    rnd = np.random.default_rng(1)
    lists = [np.unique(rnd.integers(0, 5000, 900)) for _ in range(12)]
    parts = list(jaccard._ranges(lists, 1000))
    assert len(parts) > 5 and all((np.concatenate(x) == y).all() for x, y in zip(zip(*parts), lists))
    a, b = (x.ravel() for x in np.triu_indices(12, 1))
    out = np.zeros(len(a), np.int64)
    for part in parts:
        jaccard._add_common(part, a, b, out)
    assert out.tolist() == [len(np.intersect1d(lists[x], lists[y])) for x, y in zip(a, b)]


def test_runs_miss_less_than_stated():
    """Pairs with each token equal by a chance of 0.8, all buckets split to the last level."""
    runs = jaccard.runs_needed()
    assert jaccard.missed(runs) < jaccard.MISSED <= jaccard.missed(runs - 1)
    rnd = np.random.default_rng(3)
    n, few = 100_000, 4
    same = rnd.random((n, jaccard.TOKENS)) < jaccard.THRESHOLD
    met = np.zeros(n, bool)
    for run in range(few):
        one = same[:, run]
        for _ in range(jaccard.DEPTH - 1):
            first = rnd.integers(0, jaccard.TOKENS, n)
            spots = [(first + c * (jaccard.TOKENS // jaccard.CHILDREN)) % jaccard.TOKENS for c in range(jaccard.CHILDREN)]
            one = one & np.any([same[np.arange(n), s] for s in spots], axis=0)
        met |= one
    assert abs((~met).mean() / jaccard.missed(few) - 1) < 0.15


def test_recall_with_all_buckets_split(spark, monkeypatch):
    """Every pair at a similarity of 0.8 or just above is linked, though no bucket is kept."""
    monkeypatch.setattr(jaccard, "LIMIT", 1)
    monkeypatch.setattr(jaccard, "ALIKE", 2)
    rnd = np.random.default_rng(8)
    rows = []
    for pair in range(400):
        words = [f"p{pair}w{i}" for i in range(int(rnd.integers(94, 400)))]
        k = len(words) - 4
        changed = (k - 1) // 9  # shingles at the end that differ: (k - c) / (k + c) is 0.8 or more
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join([*words[: len(words) - changed], *[f"q{pair}w{i}" for i in range(changed)]]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    linked = [r for r in jaccard.jaccard_groups(df).collect() if r.n_links]
    assert {(r.id, r.class_id) for r in linked} == {(i, i - i % 2) for i in range(800)}


@pytest.mark.parametrize("witnesses", [8, 1])
def test_one_large_group_of_near_copies(spark, monkeypatch, witnesses):
    """A bucket of near copies is left whole without being dealt again; results are all pairs'."""
    monkeypatch.setattr(jaccard, "LIMIT", 10)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "WITNESSES", witnesses)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        words[i] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"o{i}v{k}" for k in range(30)) + " " + " ".join(base[:40])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == plain(rows)
