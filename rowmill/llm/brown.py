"""Language-model scores by Brown class-based bigrams.

Exchange clustering of the most frequent words, with all others by shape (length, last
letter, digits, accents), gives the classes to start from. Then every other training word
goes to the class in which its own neighbours, counted over all rows, are most likely, and
class bigrams and word counts are counted anew with the classes of all words. A token's
probability is its class given the class before, times the word given its class, both
smoothed. Shapes stay only for words that no training row has.

All counts cover all training rows. Sent to tasks is only what a parameter bounds: counts
and classes of the ``LISTED`` most frequent words and the class tables. Rarer words are
looked up by a join with the whole vocabulary.

Texts are cut into words twice: for the counts, and for the numbers of the words, which are
stored. What follows reads the stored numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.arrays import pieces
from rowmill.llm.frames import written

#: Words that exchange clustering starts with; the others join their classes.
CLUSTERED = 1000
LISTED = 100_000
CLASSES = 64
SHAPES = 64
PASSES = 12
SMOOTH = 0.5
#: Words that a task holds, or gives out, at once.
HELD = 200_000
#: Bytes of text, or of word numbers, that a task looks at in one go.
COUNTED_BYTES = 8 << 20
CODED_BYTES = 4 << 20
_STRIPE = 16
_DIGIT = re.compile(rb"[0-9]").search


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split() if text else []


def shape(word: bytes) -> int:
    """One of SHAPES kinds of word."""
    plain = word.isascii()
    digits = _DIGIT(word) is not None
    end = 0 if word[-1:].isalpha() else 1
    last = word[-1] % 4 if plain and not end else 0
    return (min(len(word) // 4, 3) * 2 + plain) * 8 + (4 + digits * 2 + (last & 1) if end or digits else last)


def shapes(words: pa.BinaryArray) -> np.ndarray:
    """``shape`` of each of some words, none of them empty."""
    if not len(words):
        return np.zeros(0, np.int64)
    ends = _offsets(words)
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    begins, size = ends[:-1] - ends[0], np.diff(ends)
    any_of = lambda x: np.logical_or.reduceat(x, begins)
    plain, digits = ~any_of(data >= 128), any_of((data >= 48) & (data < 58))
    final = data[begins + size - 1].astype(np.int64)
    letter = ((final | 32) >= 97) & ((final | 32) <= 122)
    last = np.where(plain & letter, final % 4, 0)
    kind = np.where(~letter | digits, 4 + digits * 2 + (last & 1), last)
    return (np.minimum(size // 4, 3) * 2 + plain) * 8 + kind


@dataclass
class Model:
    """Words are numbered by frequency; unit k is word k below ``clustered``, then come the
    shapes of all others, then the text boundary (the end token)."""

    words: list[bytes]
    counts: np.ndarray
    clustered: int
    tokens: int
    vocabulary: int
    classes: np.ndarray  # class of each unit; the boundary is the last class, alone
    starts: np.ndarray  # class of the unit of each number that ``coded`` gives
    steps: np.ndarray  # log10 P(class | class before)
    room: np.ndarray  # log10 of what counts of a class's words are divided by

    @property
    def boundary(self) -> int:
        return self.clustered + SHAPES


class _Numbers(dict):
    """Numbers of the listed words; others get ``beyond`` plus their shape.

    The shapes of the last words met, HELD at most, are kept.
    """

    def __init__(self, words: list[bytes], beyond: int):
        super().__init__((w, i) for i, w in enumerate(words))
        self.beyond = beyond
        self.met: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        out = self.met.get(word)
        if out is None:
            if len(self.met) >= HELD:
                self.met.clear()
            out = self.met[word] = self.beyond + shape(word)
        return out


def _over(df: DataFrame, run, schema) -> DataFrame:
    return df.select("text").mapInArrow(run, schema)


def _offsets(values: pa.Array) -> np.ndarray:
    return np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)


def _words(part: pa.RecordBatch) -> tuple[pa.BinaryArray, np.ndarray]:
    """The words of all texts of a piece as ``words_of`` has them, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(part.column("text").cast(pa.string()), "")))
    flat = lists.flatten().cast(pa.binary())
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = np.diff(_offsets(flat)) > 0
    if not full.all():  # white space at either end leaves empty words
        kept = np.concatenate([[0], np.cumsum(full)])
        ends = np.cumsum(sizes)
        flat, sizes = flat.filter(pa.array(full)), kept[ends] - kept[ends - sizes]
    return flat, sizes


def vocabulary(train: DataFrame) -> DataFrame:
    """(word, n) over all rows of (text); the end token is the empty word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", COUNTED_BYTES):
            found = pc.value_counts(_words(part)[0])
            word, n = pa.array([b""], pa.binary()), pa.array([part.num_rows], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([found.field(0), word]), pa.concat_arrays([found.field(1), n])], ["word", "n"])

    return _over(train, run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def listed_words(vocab: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """The most frequent words, by frequency, and their counts."""
    top = _frequent(vocab.where(F.length("word") > 0), LISTED).toPandas()
    top["word"] = top["word"].map(bytes)
    top = top.sort_values(["n", "word"], ascending=[False, True])
    return top["word"].tolist(), top["n"].to_numpy(np.int64)


def coded(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """The columns of ``docs`` with (ids, tail) for its text: the number of each word, as 32-bit
    integers, and those words that are not listed. Theirs is ``len(words)`` and their shape."""
    others, listed = [c for c in docs.columns if c != "text"], len(words)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(words, pa.binary())
        for part in pieces(batches, "text", CODED_BYTES):
            flat, sizes = _words(part)
            ids = pc.fill_null(pc.index_in(flat, value_set=known), -1).to_numpy().astype(np.int32)
            rare = ids < 0
            rest = flat.filter(pa.array(rare))
            ids[rare] = listed + shapes(rest)
            before = np.concatenate([[0], np.cumsum(rare)])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            numbers = pa.Array.from_buffers(
                pa.binary(), part.num_rows, [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(ids)]
            )
            tail = pa.ListArray.from_arrays(pa.array(before[ends].astype(np.int32)), rest)
            yield pa.RecordBatch.from_arrays([*map(part.column, others), numbers, tail], [*others, "ids", "tail"])

    kinds = [T.StructField("ids", T.BinaryType()), T.StructField("tail", T.ArrayType(T.BinaryType()))]
    return docs.select(*others, "text").mapInArrow(run, T.StructType([*(docs.schema[c] for c in others), *kinds]))


def _chain(part: pa.RecordBatch, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The word numbers of a piece's texts with ``end`` before the first and after each text,
    and where in it each text begins."""
    ids = part.column("ids")
    ends = _offsets(ids)
    sizes = np.diff(ends) // 4
    chain = np.full(int(sizes.sum()) + len(sizes) + 1, end, np.int64)
    if sizes.any():
        own = np.frombuffer(ids.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.int32)
        chain[np.arange(len(own)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)] = own
    return chain, np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) + 1


def _pairs(train: DataFrame, unit_of: np.ndarray, units: int) -> np.ndarray:
    """How often each unit follows each other one, over all rows of (ids); ``unit_of`` has the
    unit of each number.

    Tasks add up a matrix of fixed size and give it out in stripes; stripes are added in
    two steps, so no task gets more than a few thousand of them.
    """
    units_of = np.append(unit_of, units - 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(units * units, np.int64)
        for part in pieces(batches, "ids", CODED_BYTES):
            ids = units_of[_chain(part, len(unit_of))[0]]
            total += np.bincount(ids[:-1] * units + ids[1:], minlength=units * units)
        own = TaskContext.get().partitionId()
        rows = total.reshape(units, units)
        for stripe in range(0, units, _STRIPE):
            block = rows[stripe : stripe + _STRIPE]
            if block.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([stripe], pa.int32()), pa.array([own], pa.int32()), pa.array([block.tobytes()], pa.binary())],
                    ["stripe", "task", "counts"],
                )

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in group["counts"])
        return pd.DataFrame({"stripe": [key[0]], "task": [key[1]], "counts": [total.tobytes()]})

    schema = "stripe int, task int, counts binary"
    stripes = train.select("ids").mapInArrow(run, schema)
    for some in (64, 1 << 30):
        stripes = stripes.groupBy("stripe", F.floor(F.col("task") / some).cast("int").alias("task")).applyInPandas(add, schema)
    out = np.zeros((units, units), np.int64)
    for row in stripes.collect():  # the matrix, whose size is fixed
        block = np.frombuffer(row["counts"], np.int64).reshape(-1, units)
        out[row["stripe"] : row["stripe"] + len(block)] = block
    return out


def exchange(pairs: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """Class of each unit by the exchange algorithm; the last unit stays alone in the last class."""
    units = len(pairs)
    f = lambda x: x * np.log(np.maximum(x, 1))
    own = np.arange(units) % classes
    own[-1] = classes
    n = classes + 1
    one = np.eye(n)[own]
    table = one.T @ pairs @ one
    weight = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = [u for u in np.argsort(-weight, kind="stable").tolist() if u != units - 1 and weight[u]]
    for _ in range(passes):
        moved = 0
        for u in order:
            after = np.bincount(own, pairs[u], n)
            before = np.bincount(own, pairs[:, u], n)
            alone = float(pairs[u, u])
            a = own[u]
            after[a] -= alone
            before[a] -= alone
            table[a] -= after
            table[:, a] -= before
            table[a, a] -= alone
            rows, columns = table.sum(axis=1), table.sum(axis=0)
            gain = (f(table + after[None]) - f(table)).sum(axis=1) + (f(table + before[:, None]) - f(table)).sum(axis=0)
            at = np.arange(n)
            inner = table[at, at]
            gain += f(inner + after + before + alone) - f(inner + after) - f(inner + before) + f(inner)
            out, into = after.sum() + alone, before.sum() + alone
            gain -= f(rows + out) - f(rows) + f(columns + into) - f(columns)
            gain[-1] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            own[u] = b
            table[b] += after
            table[:, b] += before
            table[b, b] += alone
        if not moved:
            break
    return own


def _frequent(vocab: DataFrame, most: int) -> DataFrame:
    """The most frequent words, ``most`` of them or somewhat fewer.

    A histogram of counts on a log scale, of some thousand bars whatever the corpus, tells
    from which count on they fit, so nothing is sorted and no task or driver gets more.
    """
    bar = F.floor(F.log2("n") * 64)
    least = None
    room = most
    for row in sorted(vocab.groupBy(bar.alias("bar")).count().collect(), reverse=True):
        room -= row["count"]
        if room < 0:
            break
        least = row["bar"]
    return vocab.where(F.lit(False) if least is None else bar >= least)


def fit(train: DataFrame, vocab: DataFrame) -> Model:
    """The starting model of the rows of (text), whose (word, n) counts are given."""
    words, counts = listed_words(vocab)
    return fit_coded(coded(train.select("text"), words), vocab, words, counts)


def fit_coded(train: DataFrame, vocab: DataFrame, words: list[bytes], counts: np.ndarray) -> Model:
    """The starting model of the rows of (ids), the numbers that ``coded`` gave by ``words``."""
    sizes = vocab.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    clustered = min(CLUSTERED, len(words))
    units = clustered + SHAPES + 1
    rest = clustered + shapes(pa.array(words[clustered:], pa.binary()))
    unit_of = np.concatenate([np.arange(clustered), rest, np.arange(clustered, clustered + SHAPES)])
    pairs = _pairs(train, unit_of, units)
    classes = exchange(pairs)

    known = words[:clustered]

    def kinds_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = batch.column("word").cast(pa.binary())
            rest = pc.and_(pc.greater(pc.binary_length(word), 0), pc.invert(pc.is_in(word, value_set=pa.array(known, pa.binary()))))
            unit, n = shapes(word.filter(rest)), batch.column("n").filter(rest).to_numpy()
            yield pa.RecordBatch.from_pydict(
                {
                    "shape": np.arange(SHAPES, dtype=np.int32),
                    "n": np.bincount(unit, n, SHAPES).astype(np.int64),
                    "v": np.bincount(unit, minlength=SHAPES).astype(np.int64),
                }
            )

    size, kinds = np.zeros(units), np.zeros(units)
    size[:clustered], kinds[:clustered] = counts[:clustered], 1
    ends = vocab.where(F.length("word") == 0).first()
    size[-1], kinds[-1] = (ends["n"], 1) if ends else (0, 0)
    for row in vocab.mapInArrow(kinds_of, "shape int, n bigint, v bigint").groupBy("shape").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        size[clustered + row["shape"]], kinds[clustered + row["shape"]] = row["n"], row["v"]
    n = CLASSES + 1
    one = np.eye(n)[classes]
    table = one.T @ pairs @ one + SMOOTH
    return Model(
        words, counts, clustered, int(sizes["n"] or 0), int(sizes["v"] or 0), classes, classes[unit_of],
        np.log10(table / table.sum(axis=1, keepdims=True)), np.log10(one.T @ size + one.T @ kinds + 1),
    )


def neighbours(train: DataFrame, model: Model) -> DataFrame:
    """(word, contexts, counts) of all words that are not clustered, of the rows of (ids, tail).

    Context c below the number of classes is class c before the word, n + c is class c after.
    A listed word has one row for each task, whose table of them has a fixed size, any other
    word one for each piece that it is in.
    """
    words, first, listed, n = model.words, model.clustered, len(model.words), len(model.room)
    starts = np.append(model.starts, model.classes[-1]).astype(np.int64)
    wide = 2 * n

    def rows(names: pa.Array, key: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        """One row for each name that has keys, which are sorted: the name's place, then the context."""
        of, own = np.unique(key // wide, return_index=True)
        for at in range(0, len(of), HELD):
            begin = np.append(own, len(key))[at : at + HELD + 1]
            some, offsets = slice(begin[0], begin[-1]), pa.array((begin - begin[0]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    names.take(pa.array(of[at : at + HELD])),
                    pa.ListArray.from_arrays(offsets, pa.array((key[some] % wide).astype(np.int16))),
                    pa.ListArray.from_arrays(offsets, pa.array(count[some].astype(np.int64))),
                ],
                ["word", "contexts", "counts"],
            )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((listed - first) * wide, np.int32)
        for part in pieces(batches, "ids", CODED_BYTES):
            ids, _ = _chain(part, len(starts) - 1)
            near = starts[ids]
            at = np.flatnonzero((ids >= first) & (ids < listed))
            own = (ids[at] - first) * wide
            np.add.at(table, own + near[at - 1], np.int32(1))
            np.add.at(table, own + n + near[at + 1], np.int32(1))
            at = np.flatnonzero((ids >= listed) & (ids < len(starts) - 1))
            if len(at):
                met = part.column("tail").flatten().cast(pa.binary()).dictionary_encode()
                own = met.indices.to_numpy().astype(np.int64) * wide
                key, count = np.unique(np.concatenate([own + near[at - 1], own + n + near[at + 1]]), return_counts=True)
                yield from rows(met.dictionary, key, count)
        key = np.flatnonzero(table)
        if len(key):
            yield from rows(pa.array(words[first:], pa.binary()), key, table[key])

    return train.select("ids", "tail").mapInArrow(run, "word binary, contexts array<smallint>, counts array<bigint>")


def assign(train: DataFrame, model: Model) -> DataFrame:
    """(word, n, class) of every training word but the end token.

    Clustered words keep their class. Any other gets the one in which its neighbours, with
    the classes they start with, are most likely; of equal ones the first.
    """
    n = len(model.room)
    # log10 P(class | class before) and P(class after | class), and what the class's words share
    gains = np.concatenate([model.steps, model.steps.T])
    room = model.room

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by word; the last word of a batch waits for the next one."""

        def best(words: list[bytes], table: np.ndarray) -> pa.RecordBatch:
            size = table[:, :n].sum(axis=1)
            likely = table @ gains - size[:, None] * room
            likely[:, -1] = -np.inf
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(size.astype(np.int64)), pa.array(likely.argmax(axis=1).astype(np.int32))], ["word", "n", "class"]
            )

        last, held = None, np.zeros(2 * n)
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                part = whole.slice(start, 4096)
                names = part.column("word").to_pylist()
                fresh = np.array([a != b for a, b in zip(names, [last, *names])])
                of = np.cumsum(fresh) - (last is None)
                contexts, counts = part.column("contexts"), part.column("counts")
                row = np.repeat(of, np.diff(contexts.offsets.to_numpy()))
                words = [*([] if last is None else [last]), *(w for w, f in zip(names, fresh) if f)]
                place = row * (2 * n) + contexts.flatten().to_numpy()
                table = np.bincount(place, counts.flatten().to_numpy(), len(words) * 2 * n).reshape(-1, 2 * n)
                if last is not None:
                    table[0] += held
                if len(words) > 1:
                    yield best(words[:-1], table[:-1])
                last, held = words[-1], table[-1]
        if last is not None:
            yield best([last], held[None])

    rest = neighbours(train, model).repartition("word").sortWithinPartitions("word").mapInArrow(run, "word binary, n bigint, class int")
    k = model.clustered
    head = pd.DataFrame({"word": model.words[:k], "n": model.counts[:k], "class": model.classes[:k].astype(np.int32)})
    return rest.union(train.sparkSession.createDataFrame(head, "word binary, n bigint, class int"))


def _bigrams(classed: DataFrame, n: int) -> np.ndarray:
    """How often each class follows each other one in the rows of (classes)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * n, np.int64)
        for part in batches:
            for own in part.column("classes").to_pylist():
                chain = np.frombuffer(own, np.uint8).astype(np.int64)
                total += np.bincount(chain[:-1] * n + chain[1:], minlength=n * n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    out = np.zeros(n * n)
    for row in classed.select("classes").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[row["at"]] = row["n"]
    return out.reshape(n, n)


def score(df: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, learned, n_tokens, n_known, train_tokens, base_score, score), one row for each input row.

    ``learned`` tells which rows the model is made from; null counts as false. Scores are
    log10 probabilities of a text's words and its end: ``base_score`` by smoothed word
    counts, ``score`` by the class model. A null text is empty: its end only. With nothing
    to learn from, all counts are 0. Ids may be null or repeated; other columns are left
    out whatever their names.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(learned, F.lit(False)).alias("learned"))
    vocab = written(vocabulary(docs.where("learned").select("text")), "vocabulary")
    words, counts = listed_words(vocab)
    numbered = written(coded(docs.select(F.monotonically_increasing_id().alias("row"), "*"), words), "coded")
    train = numbered.where("learned")
    model = fit_coded(train, vocab, words, counts)
    known = written(assign(train, model), "classes")
    ends = 0
    if model.tokens:
        ends = vocab.where(F.length("word") == 0).first()["n"]

    listed, n = len(words), len(model.room)
    #: Marks the class of a word's shape where the word's own is still to be looked up.
    by_shape = np.uint8(128)
    own_class = {bytes(w): c for w, c in _frequent(known, LISTED).select("word", "class").toPandas().itertuples(index=False)}
    class_of = np.concatenate(
        [np.array([own_class[w] for w in words], np.uint8), model.classes[model.clustered :].astype(np.uint8)]
    )
    class_of[listed:-1] |= by_shape
    count = np.concatenate([counts, np.zeros(SHAPES, np.int64), [ends]])
    rarity = np.log10(count + 1.0)
    base = float(np.log10(model.tokens + model.vocabulary + 1))

    def classify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "ids", CODED_BYTES):
            chain, begin = _chain(part, listed + SHAPES)
            classes, ids = class_of[chain], chain[1:]
            sizes = np.diff(np.append(begin, len(chain)))
            per = lambda x: np.add.reduceat(x, begin - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    *map(part.column, ["row", "id", "learned"]),
                    pa.array(sizes, pa.int64()),
                    pa.array(per((count[ids] > 0).astype(np.int64))),
                    pa.array(per(rarity[ids])),
                    pa.array([classes[b - 1 : b + s].tobytes() for b, s in zip(begin.tolist(), sizes.tolist())], pa.binary()),
                ],
                ["row", "id", "learned", "n_tokens", "n_known", "rarity", "classes"],
            )

    schema = T.StructType(
        [
            *(numbered.schema[c] for c in ("row", "id", "learned")),
            *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")),
            T.StructField("rarity", T.DoubleType()),
            T.StructField("classes", T.BinaryType()),
        ]
    )
    rest = (
        numbered.select("row", F.posexplode("tail").alias("place", "word"))
        .join(known, "word")
        .groupBy("row")
        .agg(
            F.count("*").alias("known"),
            F.sum(F.log10(F.col("n") + 1.0)).alias("more"),
            F.collect_list("place").alias("places"),
            F.collect_list(F.col("class").cast("tinyint")).alias("found"),
        )
    )

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "classes"):
            out = []
            for own, places, found in zip(*(part.column(c).to_pylist() for c in ("classes", "places", "found"))):
                chain = np.frombuffer(own, np.uint8).copy()
                at = np.flatnonzero(chain & by_shape)
                chain[at] &= by_shape - 1
                if places:
                    chain[at[places]] = found
                out.append(chain.tobytes())
            yield pa.RecordBatch.from_arrays([*map(part.column, kept), pa.array(out, pa.binary())], [*kept, "classes"])

    kept = ["id", "learned", "n_tokens", "n_known", "rarity"]
    joined = numbered.select("row", "id", "learned", "ids").mapInArrow(classify, schema).join(rest, "row", "left").select(
        "id", "learned", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        (F.col("rarity") + F.coalesce("more", F.lit(0.0))).alias("rarity"),
        "classes", "places", "found",
    )
    classed = written(joined.mapInArrow(fill, T.StructType([schema[c] for c in [*kept, "classes"]])), "classed")

    table = _bigrams(classed.where("learned"), n) + SMOOTH
    steps = np.log10(table / table.sum(axis=1, keepdims=True))
    size = np.zeros(n)
    for row in known.groupBy("class").agg((F.sum("n") + F.count("*")).alias("n")).collect():
        size[row["class"]] = row["n"]
    size[-1] = ends + (ends > 0)
    room = np.log10(size + 1)

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "classes"):
            chains = [np.frombuffer(x, np.uint8) for x in part.column("classes").to_pylist()]
            path = np.array([(steps[c[:-1], c[1:]] - room[c[1:]]).sum() for c in chains])
            plain, sizes = (part.column(c).to_numpy() for c in ("rarity", "n_tokens"))
            yield pa.RecordBatch.from_arrays(
                [*map(part.column, kept[:4]), pa.array(plain - sizes * base), pa.array(plain + path)], [*kept[:4], "base_score", "score"]
            )

    rated = T.StructType([*(schema[c] for c in kept[:4]), *(T.StructField(c, T.DoubleType()) for c in ("base_score", "score"))])
    return classed.mapInArrow(rate, rated).select(
        "id", "learned", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
