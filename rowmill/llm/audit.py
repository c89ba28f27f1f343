"""What filters take from each other, for every order in which they can be applied.

A document fails some of n filters: a mask. For an order of the filters, its removal step
is the least position of a filter that it fails. With a mask matrix (0 where the filter is
failed, infinite elsewhere) and the matrix of positions of each filter in each order (the
inverse permutations), all removal steps are one min-plus product. Documents enter it only
as counts of masks, of which there are 2**n for each part and kind of label; the steps say
where in the scatter counts they are added.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.frames import written
from rowmill.operators.joins import spread_lookup

FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
COLUMNS = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def text_failures(text: Column) -> tuple[Column, Column, Column, Column]:
    """A: under 200 words; B: fewer than half of them distinct; C: more than 2 % capital
    letters A-Z; D: holds one of # $ % & * |."""
    words = F.array_remove(F.split(text, SPACE), "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return (
        n < 200,
        100 * F.size(F.array_distinct(words)).cast("long") < 50 * n.cast("long"),
        100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    )


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents fail which filters, by source and label.

    Bit 4 (filter E) is set for a document whose text a smaller id has too. Texts are told
    apart by their sha256. Copies are counted by text before their least id is looked up, so
    no text is one large group, however often it occurs.

    A null text or source is an empty one. A row without an id is nobody's copy and has no
    label. Rows of one id are counted each, copies of none of them. Of repeated labels one
    that says good or toxic is enough.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(F.col("t")))]
    rows = docs.select(
        F.col("doc_id").alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("t")
    ).select("id", "part", F.sha2("t", 256).alias("sha"), sum(bits[1:], bits[0]).alias("mask"))
    rows = written(rows, "masks")
    said = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(*[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))])
    )
    known = rows.where("id IS NOT NULL").join(said, "id", "left")
    nameless = rows.where("id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    key = ["sha", "part", "mask", "good", "toxic"]
    texts = written(
        known.unionByName(nameless)
        .fillna(False, ["good", "toxic"])
        .groupBy("id", *key)
        .agg(F.count("*").alias("n"))
        .groupBy(*key)
        .agg(
            F.sum("n").alias("n"),
            F.min("id").alias("id"),
            (F.coalesce(F.min_by("n", "id"), F.lit(0)) + F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0))).alias("own"),
            F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        ),
        "texts",
    )
    shared = texts.groupBy("sha").agg(F.min("id").alias("least"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    first = F.coalesce(F.col("id") == F.col("least"), F.lit(True))
    single = F.when(first, F.col("own")).otherwise(F.col("nameless"))
    both = F.array(
        F.struct(F.col("mask"), single.alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - single).alias("n")),
    )
    return (
        spread_lookup(texts, shared, ["sha"], "left")
        .select("part", "good", "toxic", F.inline(both))
        .where("n > 0")
        .groupBy("part", "mask", "good", "toxic")
        .agg(F.sum("n").alias("n"))
    )


def removal_steps(orders: np.ndarray) -> np.ndarray:
    """(mask x order) step at which an order removes a mask, from 0; as many as there are
    filters where it never does. ``orders`` is (order x step) filter numbers."""
    n = orders.shape[1]
    position = np.argsort(orders, axis=1).T  # filter x order: the inverse permutations
    failed = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    cost = np.where(failed == 1, 0, n)
    return np.minimum((cost[:, :, None] + position[None]).min(axis=1), n)


def report(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley) of the counts of ``masks``: each part has a row for each step of
    each order, zeros included. No counts give no rows."""
    n = len(filters)
    orders = np.array(list(permutations(range(n))))
    names = ["".join(filters[i] for i in o) for o in orders]
    steps = removal_steps(orders)
    failed = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    every = np.arange(len(orders))

    def scatter(weights: np.ndarray) -> np.ndarray:
        """(part x mask) counts added up where they are removed: part x order x step."""
        out = np.zeros((len(weights), len(orders), n + 1), np.int64)
        for mask in range(1 << n):
            out[:, every, steps[mask]] += weights[:, mask, None]
        return out[:, :, :n]

    def combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                held = batch.column("held")
                mask, good, toxic, number = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in held.flatten().flatten())
                weight = np.zeros((batch.num_rows, 1 << n, 2, 2), np.int64)
                part = np.repeat(np.arange(batch.num_rows), held.value_lengths().to_numpy(zero_copy_only=False))
                np.add.at(weight, (part, mask, good, toxic), number)
                total = weight.sum(axis=(2, 3))
                removed = scatter(total)
                by_filter = total @ failed  # part x filter
                alone = total[:, 1 << np.arange(n)]
                shapley = np.zeros_like(by_filter)
                for at in range(n):
                    np.add.at(shapley, (slice(None), orders[:, at]), removed[:, :, at])
                columns = {
                    "kept": total.sum(axis=1)[:, None, None] - removed.cumsum(axis=2),
                    "removed": removed,
                    "redundant": by_filter[:, orders] - removed,
                    "unique_fails": alone[:, orders],
                    "good_lost": scatter(weight[:, :, 1].sum(axis=2)),
                    "toxic_lost": scatter(weight[:, :, :, 1].sum(axis=2)),
                    "shapley": shapley[:, orders],
                }
                parts = batch.num_rows
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": batch.column("part").take(pa.array(np.repeat(np.arange(parts), orders.size))),
                        "filter_order": pa.array(np.tile(np.repeat(names, n), parts).tolist(), pa.string()),
                        "step": np.tile(np.arange(1, n + 1, dtype=np.int32), parts * len(orders)),
                        **{c: np.ascontiguousarray(v).reshape(-1) for c, v in columns.items()},
                    }
                )

    held = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("held"))
    return held.mapInArrow(combine, COLUMNS)
