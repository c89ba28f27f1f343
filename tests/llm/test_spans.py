"""Substring dedup and decontamination against plain versions."""

import random

import numpy as np
from brute import contamination as plain_contamination
from brute import remove_repeats as plain_repeats

from rowmill.llm import arrays
from rowmill.llm.decontaminate import contamination
from rowmill.llm.substrings import remove_repeats


def corpus(seed, documents=120):
    """Texts with copies, near copies, shared passages at all offsets, runs and odd cases."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["é", "an", "The", "x.", "ß1", "to", "漢"]) + str(rnd.randrange(60))
    passages = [[word() for _ in range(n)] for n in (34, 35, 36, 50, 90, 200)]
    texts = [None, "", "   \n", "one", "loop " * 120, "a b " * 60]
    for _ in range(documents):
        w = [word() for _ in range(rnd.randrange(0, 150))]
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(w) + 1)
            p = rnd.choice(passages)
            cut = rnd.randrange(0, 20)
            w[at:at] = p[cut:] if rnd.random() < 0.5 else p[: len(p) - cut]
        texts.append(rnd.choice([" ", "\n", " \t "]).join(w))
        if rnd.random() < 0.4 and w:
            copy = list(w)
            for _ in range(rnd.randrange(4)):
                copy[rnd.randrange(len(copy))] = word()
            texts += [" ".join(copy)] * rnd.randrange(1, 4)
    return texts


def test_repeats_as_plain(spark):
    for seed in (1, 2):
        texts = corpus(seed)
        rows = [(i, t, "kept", 0) for i, t in enumerate(texts)] + [(0, None, None, None), (9, texts[9], None, None)]
        df = spark.createDataFrame(rows, "doc_id long, text string, kept string, th int")
        got = sorted((r.id, r.n_words, r.n_removed, r.kept) for r in remove_repeats(df).collect())
        assert got == sorted((r[0], *w) for r, w in zip(rows, plain_repeats([r[1] for r in rows])))


def test_repeats_without_ids_or_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, text), (None, text), (None, None)], "doc_id long, text string")
    assert sorted(r.n_removed for r in remove_repeats(df).collect()) == [0, 60, 60]
    assert remove_repeats(df.where("false")).count() == 0


def test_contamination_as_plain(spark):
    rnd = random.Random(5)
    texts = [t for t in corpus(3) if t is None or len(t) < 3000]
    words = " ".join(t or "" for t in texts).split()
    items = [(None, "no id " * 6), (1, None), (2, ""), (3, "one"), (4, "Loop loop LOOP"), (7, "never seen anywhere at all")]
    for i in range(10, 60):
        at = rnd.randrange(len(words) - 60)
        items.append((i % 55, " ".join(words[at : at + rnd.choice([3, 7, 9, 10, 11, 14, 40])]).upper() + rnd.choice(["", "!", " new words after it"])))
    texts += ["no id " * 10, "no id", words[0].upper()]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.id, r.n_words, r.n_hit, r["items"], sum(b - a for a, b in r.spans)) for r in contamination(df, bench).collect())
    want = plain_contamination(texts, items)
    assert got == [(i, n, h, names, h) for i, (n, h, names) in enumerate(want)]
    assert sum(h > 0 for _, _, h, _, _ in got) > 20


def test_contamination_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    rows = contamination(docs, none).collect()
    assert sorted(r.n_words for r in rows) == [0, 3, 3] and not any(r.n_hit for r in rows)
    assert contamination(docs.where("false"), docs.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_choice_of_windows_depends_on_content_only():
    rnd = np.random.default_rng(3)
    grams = rnd.integers(0, 5, 400).astype(np.uint64) << np.uint64(40)
    for width in (1, 2, 6, 27):
        got = arrays.window_choice(grams, width)
        want = [i + width - 1 - int(np.argmin(grams[i : i + width][::-1])) for i in range(len(grams) - width + 1)]
        assert got.tolist() == want


def test_pieces_keep_every_row():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["x" * 10, None, "y" * 300, "", "z"]})
    parts = list(arrays.pieces([batch, batch.slice(0, 0)], "text", 20))
    assert [p.num_rows for p in parts] == [2, 1, 2]
