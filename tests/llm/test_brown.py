"""Class-based scores: counts and base scores as plain, the model as a probability."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowmill.llm import brown


def texts(seed, n):
    rnd = random.Random(seed)
    nouns, verbs = [f"n{i}" for i in range(60)], [f"v{i}é" for i in range(60)]
    out = [None, "", " \t", "Odd ODD odd", "x" * 5000]
    for _ in range(n):
        w = []
        for _ in range(rnd.randrange(40)):
            w += ["The", rnd.choice(nouns), rnd.choice(verbs)] if rnd.random() < 0.9 else [f"rare{rnd.randrange(10**4)}"]
        out.append(" ".join(w))
    return out


def plain(rows):
    train = Counter()
    words = {}
    for k, (i, t) in enumerate(rows):
        words[k] = [*brown.words_of((t or "").encode()), b""]
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(words[k])
    n, v = sum(train.values()), len(train)
    for k, (i, _) in enumerate(rows):
        w = words[k]
        yield i, len(w), sum(train[x] > 0 for x in w), n, sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w)


@pytest.mark.parametrize(("listed", "clustered"), [(100_000, 1000), (40, 20)])
def test_base_as_plain_and_model_better(spark, monkeypatch, listed, clustered):
    monkeypatch.setattr(brown, "LISTED", listed)
    monkeypatch.setattr(brown, "CLUSTERED", clustered)
    monkeypatch.setattr(brown, "HELD", 30)
    rows = [*enumerate(texts(1, 250)), (7, "odd"), (None, "odd new")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, learned int")
    got = brown.score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[4])
    a = sorted(((r.id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for x, y in zip(a, sorted(plain(rows), key=key), strict=True):
        assert x[:4] == y[:4] and x[4] == pytest.approx(y[4], abs=1e-9)
    held = [r for r in got if not r.learned]
    assert len(held) > 20 and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)


def test_probabilities_add_up(spark):
    """Over all known words and one unknown for each class, no more than one after any class."""
    df = spark.createDataFrame([(t,) for t in texts(2, 60)], "text string")
    vocab = brown.vocabulary(df).cache()
    model = brown.fit(df, vocab)
    numbers = brown._Numbers(model.words[: model.clustered], model.clustered)
    mass = np.zeros(brown.CLASSES + 1)
    for row in vocab.collect():
        word = bytes(row["word"])
        cls = model.classes[numbers[word] if word else model.boundary]
        mass[cls] += (row["n"] + 1) / 10 ** model.room[cls]
    unseen = 1 / 10**model.room
    assert np.allclose(mass + unseen, 1) and np.allclose((10**model.steps).sum(axis=1), 1)


def test_exchange_finds_classes():
    rnd = np.random.default_rng(1)
    kinds = rnd.integers(0, 3, 60)
    pairs = np.zeros((61, 61), np.int64)
    for _ in range(40000):
        a = rnd.integers(0, 60)
        pairs[a, rnd.choice(np.flatnonzero(kinds == (kinds[a] + 1) % 3))] += 1
    own = brown.exchange(pairs, 3)
    assert all(len(set(own[:60][kinds == k])) == 1 for k in range(3)) and own[60] == 3


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = brown.score(df, F.lit(None).cast("boolean")).collect()
    assert sorted((r.id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
    assert brown.score(df.where("false"), F.lit(True)).count() == 0
    assert all(0 <= brown.shape(w) < brown.SHAPES for w in [b"a", b"abc1", b"1", b"\xc3\xa9", b"x" * 99, b"\xff.", b"abcd,"])


def test_rare_words_get_the_class_of_their_neighbours(spark, monkeypatch):
    """Words of one shape beyond the clustered ones: in their order they are likelier than out of it."""
    monkeypatch.setattr(brown, "CLUSTERED", 12)
    monkeypatch.setattr(brown, "LISTED", 40)
    monkeypatch.setattr(brown, "HELD", 30)
    rnd = random.Random(4)
    names = [bytes(x).decode() for x in ([97 + i // 13, 97 + 4 * (i % 6), 97 + i % 17, 101] for i in range(400))]
    names = sorted({x for x in names if brown.shape(x.encode()) == brown.shape(b"aaae")})
    rnd.shuffle(names)
    a, b = names[::2], names[1::2]
    assert len(a) > 60
    heads = [f"h{i}" for i in range(6)], [f"k{i}" for i in range(6)]
    pick = lambda k: rnd.choice(heads[k]) if rnd.random() < 0.6 else rnd.choice((a, b)[k])
    rows = [(i, " ".join(pick(k % 2) for k in range(20)), True) for i in range(400)]
    right = [(1000 + i, " ".join(x for _ in range(5) for x in (rnd.choice(a), rnd.choice(b))), False) for i in range(30)]
    wrong = [(2000 + i, " ".join([*t.split()[::2], *t.split()[1::2]]), False) for i, t, _ in right for i in [i - 1000]]
    df = spark.createDataFrame(rows + right + wrong, "doc_id long, text string, learned boolean")
    got = {r.id: r for r in brown.score(df, F.col("learned")).collect()}
    assert all(got[1000 + i].base_score == pytest.approx(got[2000 + i].base_score) for i in range(30))
    assert sum(got[1000 + i].score - got[2000 + i].score for i in range(30)) / 30 > 3


def test_texts_are_cut_once_for_their_numbers(spark, monkeypatch):
    """Stored numbers stand for the words, whatever the white space; a task gives each listed
    word's neighbours in one row, however many pieces it met the word in."""
    monkeypatch.setattr(brown, "CLUSTERED", 2)
    monkeypatch.setattr(brown, "LISTED", 12)
    monkeypatch.setattr(brown, "CODED_BYTES", 64)
    rows = [*texts(5, 60), "\x0bA b\x0c\x1cc\r\n", "b c É"]
    df = spark.createDataFrame([(t,) for t in rows], "text string").coalesce(1)
    vocab = brown.vocabulary(df).cache()
    words, counts = brown.listed_words(vocab)
    numbered = brown.coded(df, words).cache()
    assert 2 < len(words) <= 12
    for text, row in zip(rows, numbered.collect(), strict=True):
        ids, tail = np.frombuffer(row.ids, np.int32).tolist(), [bytes(w) for w in row.tail]
        found = brown.words_of((text or "").encode())
        assert [words[i] if i < len(words) else None for i in ids] == [w if w in words else None for w in found]
        assert tail == [w for w in found if w not in words]
        assert [i - len(words) for i in ids if i >= len(words)] == [brown.shape(w) for w in tail]
    near = brown.neighbours(numbered, brown.fit_coded(numbered, vocab, words, counts)).collect()
    given = Counter(bytes(r.word) for r in near)
    assert all(given[w] == 1 for w in words[2:]) and not any(given[w] for w in words[:2])
    total = Counter()
    for r in near:
        total[bytes(r.word)] += sum(r.counts)
    assert total == {bytes(r.word): 2 * r.n for r in vocab.collect() if r.word and bytes(r.word) not in words[:2]}
