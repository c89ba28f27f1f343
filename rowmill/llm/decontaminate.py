"""Benchmark decontamination by winnowing.

Of every 10-word window, the 5-word gram of least hash is kept as its fingerprint, for
benchmark items and documents alike. Equal windows keep equal grams, so every shared span
of 10 words or more has a fingerprint in common; fingerprints of both sides are joined and
each hit is extended word by word. An item of fewer than 10 words is one window, whose
fingerprint is the whole of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.arrays import LETTERS_AND_DIGITS, Words, grams, pieces, signed, window_choice
from rowmill.llm.frames import bit_filter, passes, written

WINDOW = 10
GRAM = 5
REACH = WINDOW - GRAM

_MARK = pa.struct(
    [("fp", pa.int64()), ("size", pa.int32()), ("at", pa.int32()), ("lead", pa.int32()), ("words", pa.list_(pa.string()))]
)
_MARKS = "array<struct<fp: bigint, size: int, at: int, lead: int, words: array<string>>>"


def _marked(texts: DataFrame, short: list[int] | None, bitmap: np.ndarray | None) -> DataFrame:
    """(id, n_words, marks) of (id, text): the fingerprints with the words around them.

    ``short`` lists the window sizes below 10 to look for; None takes a text of fewer words
    than 10 as one window. With a bitmap, only fingerprints that pass it are kept.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            words = Words(texts, LETTERS_AND_DIGITS, lower=True)
            hashes, room, of, first = words.hashes(), words.room(), words.text_of_word(), words.first
            marks: list[list[dict]] = [[] for _ in texts]

            def keep(at: np.ndarray, fp: np.ndarray, size: int, gram: int) -> None:
                if bitmap is not None:
                    found = passes(bitmap, fp)
                    at, fp = at[found], fp[found]
                around = size - gram
                for p, f in zip(at.tolist(), signed(fp).tolist()):
                    d = int(of[p])
                    a, b = max(int(first[d]), p - around), min(int(first[d + 1]), p + size)
                    marks[d].append({"fp": f, "size": size, "at": p - int(first[d]), "lead": p - a, "words": words.words(a, b)})

            five = grams(hashes, GRAM)
            choice = window_choice(five, WINDOW - GRAM + 1)
            at = np.unique(choice[room[: len(choice)] >= WINDOW])
            keep(at, five[at], WINDOW, GRAM)
            if short is None:
                sizes = words.count[(words.count > 0) & (words.count < WINDOW)]
                wanted = np.unique(sizes).tolist()
            else:
                wanted = short
            for size in wanted:
                whole = grams(hashes, size)
                fits = room[: len(whole)] >= size
                if short is None:  # an item that is this window and no more
                    fits &= words.count[of[: len(whole)]] == size
                at = np.flatnonzero(fits)
                keep(at, whole[at], size, size)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(words.count, pa.int64()), pa.array(marks, pa.list_(_MARK))],
                ["id", "n_words", "marks"],
            )

    schema = T.StructType([texts.schema["id"], T.StructField("n_words", T.LongType()), T.StructField("marks", T._parse_datatype_string(_MARKS))])
    return texts.select("id", "text").mapInArrow(run, schema)


def _equal_words(a: Column, b: Column) -> Column:
    """How many words two arrays have in common from their start on."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    other = F.array_position(same, False)
    return F.when(other == 0, F.size(same)).otherwise(other.cast("int") - 1)


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(id, n_words, n_hit, spans, items): for each document row, the words covered by
    benchmark windows, as spans [start, stop) of word numbers, and the ids of the items
    with a window in it, as texts in order.

    Null and empty texts have no words and hit nothing. Every input row gets one row, rows
    with equal or null ids too. Items of one id count once; windows of an item without an
    id hit, but are not listed. Other columns are left out whatever their names.
    """
    tests = written(
        _marked(items.select(F.col(item_id_col).cast("string").alias("id"), F.col(item_text_col).alias("text")), None, None)
        .select("id", F.explode("marks").alias("m"))
        .select(F.col("id").alias("item"), F.col("m.fp").alias("fp"), F.col("m.size").alias("size"), F.col("m.lead").alias("i_lead"), F.col("m.words").alias("i_words")),
        "items",
    )
    sizes = [r["size"] for r in tests.where(F.col("size") < WINDOW).select("size").distinct().collect()]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = written(
        _marked(texts, sorted(sizes), bit_filter(tests, "fp")).select(F.monotonically_increasing_id().alias("row"), "*"), "marks"
    )
    hits = (
        marked.select("row", F.explode("marks").alias("m"))
        .select("row", F.col("m.fp").alias("fp"), F.col("m.size").alias("size"), F.col("m.at").alias("at"), F.col("m.lead").alias("lead"), F.col("m.words").alias("words"))
        .join(tests, ["fp", "size"])
    )
    gram = F.when(F.col("size") == WINDOW, F.lit(GRAM)).otherwise(F.col("size"))
    tail = lambda words, lead: F.slice(words, lead + gram + 1, WINDOW)
    head = lambda words, lead: F.reverse(F.slice(words, F.lit(1), lead))
    spans = (
        hits.where(F.slice("words", F.col("lead") + 1, gram) == F.slice("i_words", F.col("i_lead") + 1, gram))
        .select(
            "row",
            "item",
            "size",
            (F.col("at") - _equal_words(head(F.col("words"), F.col("lead")), head(F.col("i_words"), F.col("i_lead")))).alias("start"),
            (F.col("at") + gram + _equal_words(tail(F.col("words"), F.col("lead")), tail(F.col("i_words"), F.col("i_lead")))).alias("stop"),
        )
        .where(F.col("stop") - F.col("start") >= F.col("size"))
    )
    found = spans.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("raw"), F.array_sort(F.collect_set("item")).alias("items")
    )
    nothing = F.array().cast("array<struct<start: int, stop: int>>")
    merged = F.aggregate(
        "raw",
        nothing,
        lambda done, s: F.when((F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= s["start"]), F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["stop"], s["stop"]).alias("stop"))),
        )).otherwise(F.concat(done, F.array(s))),
    )
    found = found.select("row", "items", merged.alias("spans"))
    return (
        marked.select("row", "id", "n_words")
        .join(found, "row", "left")
        .select(
            "id",
            "n_words",
            F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]), F.lit(0)).alias("n_hit"),
            F.coalesce("spans", nothing).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )
