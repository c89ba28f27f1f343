"""Substring dedup: words covered by a window of 35 words that occurs again anywhere.

Level-wise doubling. The first level counts grams of 9 words; only those that occur again
are extended to 18 words, and only what occurs again then goes on to the full window. To
keep the first level small, grams are counted at anchors only: of every 35-word window its
9-word gram of least hash. Equal windows have equal anchors at equal places, so nothing is
lost, and there are about fourteen times fewer anchors than words.

The full windows of an anchor all lie within 26 words before and after it. If that whole
neighbourhood occurs again, so do all its windows, and they are settled as one. What is left
are neighbourhoods that occur once: near edits and at the ends of a shared passage. There
each window is hashed (128 bits) and counted against the windows of one representative of
every neighbourhood of the same anchor. No pair of documents is ever formed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.arrays import Words, grams, grams_between, pieces, signed, window_choice
from rowmill.llm.frames import bit_filter, passes, written

WINDOW = 35
BASE = 9
REACH = WINDOW - BASE


class _Anchored:
    """A piece of documents with its anchors, and the windows that chose each of them."""

    def __init__(self, part: pa.RecordBatch):
        self.words = Words(part.column("text").cast(pa.binary()).to_pylist())
        self.hashes = self.words.hashes()
        self.base = grams(self.hashes, BASE)
        choice = window_choice(self.base, REACH + 1)
        self.windows = np.flatnonzero(self.words.room()[: len(choice)] >= WINDOW)
        self.choice = choice[self.windows]
        self.at = np.unique(self.choice)
        self.of = self.words.text_of_word()
        self.first = self.words.first

    def survivors(self, filters: list[np.ndarray]) -> np.ndarray:
        """Anchors whose gram, and an extension of each further length, occurs again."""
        at = self.at
        if filters:
            at = at[passes(filters[0], self.base[at])]
        for level, bitmap in enumerate(filters[1:], 1):
            alive = np.zeros(len(at), bool)
            for starts, fits, seed in self.extensions(at, level):
                alive[fits] |= passes(bitmap, grams_between(self.hashes, starts, BASE << level, seed))
            at = at[alive]
        return at

    def extensions(self, at: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Starts of the doubled grams, those to the right and those to the left of an anchor."""
        length = BASE << level
        d = self.of[at]
        right = np.flatnonzero(at + length <= self.first[d + 1])
        yield at[right], right, 0
        begin = at + BASE - length
        left = np.flatnonzero(begin >= self.first[d])
        yield begin[left], left, 1

    def level_hashes(self, filters: list[np.ndarray]) -> np.ndarray:
        at = self.survivors(filters)
        if not filters:
            return self.base[at]
        return np.concatenate([grams_between(self.hashes, s, BASE << len(filters), seed) for s, _, seed in self.extensions(at, len(filters))])


def _over(docs: DataFrame, work: Callable[[pa.RecordBatch], dict[str, object]], schema: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            yield pa.RecordBatch.from_pydict(work(part))

    return docs.mapInArrow(run, schema)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(kid, th, spans) of documents (kid, th, text): word ranges covered by windows that
    occur again; spans may overlap."""
    filters: list[np.ndarray] = []
    texts = docs.select("text")
    while BASE << len(filters) < WINDOW:
        known = list(filters)

        def level(part: pa.RecordBatch, known=known) -> dict[str, object]:
            return {"h": signed(_Anchored(part).level_hashes(known))}

        again = _over(texts, level, "h bigint").groupBy("h").count().where("count > 1")
        filters.append(bit_filter(again, "h"))

    def neighbourhoods(part: pa.RecordBatch) -> dict[str, object]:
        a = _Anchored(part)
        at = a.survivors(filters)
        d = a.of[at]
        start, stop = np.maximum(a.first[d], at - REACH), np.minimum(a.first[d + 1], at + WINDOW)
        before = (at - start).astype(np.uint64)
        c = [signed(grams_between(a.hashes, start, stop - start, seed) + before * np.uint64(0x9E3779B97F4A7C15)) for seed in (0, 1)]
        return {
            "kid": part.column("kid").take(pa.array(d)),
            "th": part.column("th").take(pa.array(d)),
            "at": (at - a.first[d]).astype(np.int32),
            "before": (at - start).astype(np.int32),
            "after": (stop - at).astype(np.int32),
            "h": signed(a.base[at]),
            "c1": c[0],
            "c2": c[1],
        }

    marks = written(
        _over(docs, neighbourhoods, "kid bigint, th bigint, at int, before int, after int, h bigint, c1 bigint, c2 bigint"), "anchors"
    )
    around = written(
        marks.groupBy("h", "c1", "c2").agg(F.count("*").alias("n"), F.min(F.struct("kid", "th", "at")).alias("one")), "around"
    )
    settled = marks.join(around.where("n > 1").select("c1", "c2"), ["c1", "c2"]).select(
        "kid", "th", (F.col("at") - F.col("before")).alias("start"), (F.col("at") + F.col("after")).alias("stop")
    )
    mixed = around.groupBy("h").agg(F.count("*").alias("kinds"), F.sum((F.col("n") == 1).cast("int")).alias("single"))
    open_ = around.join(mixed.where("kinds > 1 AND single > 0").select("h"), "h")
    wanted = open_.groupBy("one.kid", "one.th").agg(F.collect_list(F.struct(F.col("one.at").alias("at"), "n")).alias("anchors"))

    def windows(part: pa.RecordBatch) -> dict[str, object]:
        a = _Anchored(part)
        lists = part.column("anchors")
        sizes = np.array([len(x) for x in lists.to_pylist()], np.int64)
        d = np.repeat(np.arange(len(sizes)), sizes)
        flat = lists.flatten()
        at = flat.field("at").to_numpy() + a.first[d]
        order = np.argsort(at)
        at, n = at[order], flat.field("n").to_numpy()[order]
        spot = np.minimum(np.searchsorted(at, a.choice), max(len(at) - 1, 0))
        chosen = np.flatnonzero(at[spot] == a.choice) if len(at) else np.zeros(0, np.int64)
        start = a.windows[chosen]
        d = a.of[start]
        return {
            "w1": signed(grams_between(a.hashes, start, WINDOW, 0)),
            "w2": signed(grams_between(a.hashes, start, WINDOW, 1)),
            "kid": part.column("kid").take(pa.array(d)),
            "th": part.column("th").take(pa.array(d)),
            "start": (start - a.first[d]).astype(np.int32),
            "n": n[spot[chosen]],
        }

    # rows of equal (kid, th) have equal texts: any one of them stands for all, and their number is in n
    single = written(
        _over(
            docs.join(wanted, ["kid", "th"]).groupBy("kid", "th").agg(F.first("text").alias("text"), F.first("anchors").alias("anchors")),
            windows,
            "w1 bigint, w2 bigint, kid bigint, th bigint, start int, n bigint",
        ),
        "windows",
    )
    again = single.groupBy("w1", "w2").agg(F.sum("n").alias("all"), F.max((F.col("n") == 1).cast("int")).alias("open"))
    found = (
        single.where("n = 1")
        .join(again.where("all > 1 AND open = 1").select("w1", "w2"), ["w1", "w2"])
        .select("kid", "th", "start", (F.col("start") + WINDOW).alias("stop"))
    )
    return settled.union(found).groupBy("kid", "th").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept): each document's words without those covered by a
    window of 35 words that starts anywhere else too, joined by one space.

    Windows are judged on the input; overlapping ones in one document count as well. Null
    texts have no words. Every input row gets one row; rows with equal or null ids are
    documents of their own. Other columns are left out whatever their names.
    """
    docs = df.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.xxhash64(F.col(id_col)), F.lit(0)).alias("kid"),
        F.xxhash64(F.col(text_col), F.col(id_col).isNull()).alias("th"),
        F.col(text_col).alias("text"),
    )
    spans = repeated_spans(docs.select("kid", "th", "text"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            words = Words(part.column("text").cast(pa.binary()).to_pylist())
            gone = np.zeros(len(words.start) + 1, np.int64)
            lists = part.column("spans")
            sizes = np.array([len(x or ()) for x in lists.to_pylist()], np.int64)
            base = np.repeat(words.first[:-1], sizes)
            flat = lists.flatten()
            np.add.at(gone, flat.field("start").to_numpy() + base, 1)
            np.add.at(gone, flat.field("stop").to_numpy() + base, -1)
            keep = np.cumsum(gone[:-1]) == 0
            kept, removed = [], []
            for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                own = words.words(a, b)
                left = [w for w, k in zip(own, keep[a:b].tolist()) if k]
                kept.append(b" ".join(left))
                removed.append(len(own) - len(left))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(words.count, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["id", "n_words", "n_removed", "kept"],
            )

    schema = T.StructType(
        [docs.schema["id"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    )
    return docs.join(spans, ["kid", "th"], "left").select("id", "text", "spans").mapInArrow(cut, schema)
