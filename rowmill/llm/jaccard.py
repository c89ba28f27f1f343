"""Jaccard join on five-word shingles by chosen paths.

Each distinct shingle set is embedded as 64 tokens: the token of least hash under each of
64 hash functions. Two sets share each of them with a probability equal to their Jaccard
similarity. A run splits all sets by one sampled token; a bucket that is still large is
split again by two tokens sampled for its path, and so on. Small buckets are compared by
brute force, a large one that no token splits (near copies of one text) in blocks of fixed
size. Runs are repeated until a pair at the threshold is missed with a probability below
one in a million.

Sets that are equal are one class from the start. Within a bucket, sizes and embeddings
discard most pairs; the others are compared exactly. A pair that meets in several buckets
counts in the first of them only. Tasks report, for each class, its number of links and one
link that keeps its group connected, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.arrays import Words, grams, grams_between, mix, pieces, signed
from rowmill.llm.frames import components, written
from rowmill.operators.joins import spread_lookup

SHINGLE = 5
THRESHOLD = 0.8
TOKENS = 64
CHILDREN = 2
DEPTH = 4
LIMIT = 256
BLOCK = 256
#: Of rows to compare, so many bytes are taken at a time, and the rest of their last group.
GROUP_BYTES = 8 << 20
#: A bucket that keeps more than this share of the one it was split from holds texts that
#: are alike all over; splitting it further would only repeat it.
ALIKE = 0.5
#: So many members of a large bucket show whether its members are alike.
WITNESSES = 8
MISSED = 1e-6
#: Embeddings of sets at the threshold agree in 51 of 64 tokens, give or take 3.2. Fewer
#: than 32 is six deviations below.
LEAST_EQUAL = 32

_SALTS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64)) | np.uint64(1)


def missed(runs: int, similarity: float = THRESHOLD) -> float:
    """The share of pairs at a similarity that no run brings together, even if each of their
    buckets is split to the last level, or that the embeddings discard. All runs draw from
    the same tokens, so it is a sum over how many of those are equal."""
    total = 0.0
    for equal in range(TOKENS + 1):
        share = equal / TOKENS
        meets = share * (1 - (1 - share) ** CHILDREN) ** (DEPTH - 1)
        likely = math.comb(TOKENS, equal) * similarity**equal * (1 - similarity) ** (TOKENS - equal)
        total += likely * (1 if equal < LEAST_EQUAL else (1 - meets) ** runs)
    return total


def runs_needed(most: float = MISSED, similarity: float = THRESHOLD) -> int:
    """Runs after which a pair at the threshold is missed with less than this probability."""
    return next(runs for runs in range(1, TOKENS + 1) if missed(runs, similarity) < most)


def _sets(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle sets of a piece: tokens sorted within each document, the documents that have
    any, and where each one's tokens start. A text of 1 to 4 words is one shingle."""
    words = Words(part.column("text").cast(pa.binary()).to_pylist())
    hashes, room = words.hashes(), words.room()
    five = grams(hashes, SHINGLE)
    at = np.flatnonzero(room[: len(five)] >= SHINGLE)
    short = np.flatnonzero((words.count > 0) & (words.count < SHINGLE))
    tokens = np.concatenate([five[at], grams_between(hashes, words.first[short], words.count[short])])
    of = np.concatenate([words.text_of_word()[at], short])
    order = np.lexsort((tokens, of))
    tokens, of = tokens[order], of[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1])
    tokens, of = tokens[new], of[new]
    begin = np.flatnonzero(np.diff(of, prepend=-1))
    return tokens, of[begin], begin


def _keys(tokens: np.ndarray, begin: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """128 bits that name each set, whatever the order of its tokens."""
    return tuple(pa.array(signed(np.add.reduceat(mix(tokens + np.uint64(k)), begin))) for k in (1, 2))


def _embed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, "text"):
        tokens, docs, begin = _sets(part)
        if not len(docs):
            continue
        sketch = np.empty((len(docs), TOKENS), np.uint32)
        for i, salt in enumerate(_SALTS):
            sketch[:, i] = mix(np.minimum.reduceat(tokens * salt, begin)) >> np.uint64(32)
        k1, k2 = _keys(tokens, begin)
        flat = pa.array(sketch.view(np.int32).reshape(-1))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id").take(pa.array(docs)),
                k1,
                k2,
                pa.array(np.diff(begin, append=len(tokens)).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(docs) + 1, dtype=np.int32) * TOKENS), flat),
            ],
            ["id", "k1", "k2", "size", "sketch"],
        )


def _shingle_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, "text"):
        tokens, docs, begin = _sets(part)
        if not len(docs):
            continue
        ends = [*begin[1:].tolist(), len(tokens)]
        sets = [tokens[a:b].tobytes() for a, b in zip(begin.tolist(), ends)]
        k1, k2 = _keys(tokens, begin)
        yield pa.RecordBatch.from_arrays(
            [part.column("id").take(pa.array(docs)), k1, k2, pa.array(sets, pa.binary())], ["rep", "k1", "k2", "tokens"]
        )


def _spots() -> list:
    """The places of the tokens by which a bucket is split, drawn for its path."""
    first = F.pmod(F.xxhash64("path"), F.lit(TOKENS)).cast("int")
    return [F.pmod(first + c * (TOKENS // CHILDREN), F.lit(TOKENS)) for c in range(CHILDREN)]


def _alike(large: DataFrame, classes: DataFrame) -> DataFrame:
    """(path, alike) of the large buckets most of whose members have one token at a place of
    the next split: near copies of one text, which a split would only repeat.

    A few members of each bucket, those of least hashes, stand for all. A bucket that is
    left whole compares all its members, so whatever they say no pair is lost.
    """
    witnesses = large.groupBy("path").agg(*[F.min_by("rep", F.xxhash64("rep", F.lit(i))).alias(f"w{i}") for i in range(WITNESSES)])
    drawn = witnesses.select("path", F.explode(F.array(*[f"w{i}" for i in range(WITNESSES)])).alias("rep"))
    places = F.posexplode(F.array(*[F.element_at("sketch", s + 1) for s in _spots()])).alias("place", "token")
    same = drawn.join(classes.select("rep", "sketch"), "rep").select("path", places).groupBy("path", "place", "token").count()
    most = same.groupBy("path").agg(F.max("count").alias("most"))
    return most.where(F.col("most") > ALIKE * WITNESSES).select("path", F.lit(True).alias("alike"))


def _leaves(classes: DataFrame, runs: int) -> DataFrame:
    """(leaf, rep, n): the buckets of two classes or more that are compared."""
    token = lambda at: F.element_at("sketch", at + 1)
    members = classes.select(
        "rep", F.explode(F.array(*[F.xxhash64(F.lit(r), token(F.lit(r))) for r in range(runs)])).alias("path")
    ).withColumn("parent", F.lit(None).cast("long"))
    done = None
    for depth in range(1, DEPTH + 1):
        sizes = members.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        shared = spread_lookup(members, sizes, ["path"])
        last = depth == DEPTH
        if not last:
            shared = written(shared, "buckets")
        kept = F.coalesce(F.col("n") > ALIKE * F.col("parent"), F.lit(False))
        split = F.lit(False) if last else (F.col("n") > LIMIT) & ~kept
        leaf = shared.where(~split).select(F.col("path").alias("leaf"), "rep", "n")
        done = leaf if done is None else done.union(leaf)
        large = shared.where(split)
        if last or large.isEmpty():
            return done
        large = written(spread_lookup(large, _alike(large, classes), ["path"], "left"), "large")
        done = done.union(large.where("alike").select(F.col("path").alias("leaf"), "rep", "n"))
        members = large.where("alike IS NULL").join(classes.select("rep", "sketch"), "rep").select(
            "rep", F.explode(F.array(*[F.xxhash64("path", s, token(s)) for s in _spots()])).alias("path"), F.col("n").alias("parent")
        )
    return done


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Deal the members of each leaf in blocks, each pair of blocks by itself: (leaf, i, j, side, ...)."""
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("rep"), blocks)
    dealt = (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .select(
            "*",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
        )
        .drop("other", "n")
    )
    return dealt.repartition("leaf", "i", "j").sortWithinPartitions("leaf", "i", "j")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Whole (leaf, i, j) groups of a sorted partition, many small ones at a time."""
    rest: list[pd.DataFrame] = []
    key = ["leaf", "i", "j"]
    for batch in batches:
        step = max(1, min(2048, GROUP_BYTES * batch.num_rows // max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            rows = batch.slice(start, step).to_pandas()
            rest.append(rows)
            same = (rows[key] == rows[key].iloc[-1]).all(axis=1).to_numpy()
            if same.all():
                continue
            cut = int(np.flatnonzero(~same)[-1]) + 1
            yield pd.concat([*rest[:-1], rows.iloc[:cut]], ignore_index=True)
            rest = [rows.iloc[cut:]]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def _common(lists: list[np.ndarray], a: np.ndarray, b: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How many values lists a and b have in common (each list sorted, without repeats).

    Groups of few pairs are merged pair by pair; in larger ones the values become columns
    of a bit matrix, some thousand at a time. Long lists are taken in ranges of values, so
    that about a million values are held at once.
    """
    out = np.zeros(len(a), np.int64)
    of = group[a]
    edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(a)]
    for start, stop in zip(edges[:-1], edges[1:]):
        if stop - start <= 64:
            for k in range(start, stop):
                out[k] = len(np.intersect1d(lists[a[k]], lists[b[k]], assume_unique=True))
            continue
        rows = np.unique(np.concatenate([a[start:stop], b[start:stop]]))
        left, right = np.searchsorted(rows, a[start:stop]), np.searchsorted(rows, b[start:stop])
        own = [lists[r] for r in rows]
        for some in _ranges(own, 1 << 20):
            _add_common(some, left, right, out[start:stop])
    return out


def _ranges(lists: list[np.ndarray], values: int) -> Iterator[list[np.ndarray]]:
    """The lists cut at the same values into parts of about so many values in all."""
    total = sum(map(len, lists))
    if total <= values:
        yield lists
        return
    longest = max(lists, key=len)
    cuts = longest[np.linspace(0, len(longest), total // values + 2).astype(int)[1:-1]]
    at = [np.concatenate([[0], np.searchsorted(x, cuts), [len(x)]]) for x in lists]
    for k in range(len(cuts) + 1):
        yield [x[e[k] : e[k + 1]] for x, e in zip(lists, at)]


def _add_common(lists: list[np.ndarray], left: np.ndarray, right: np.ndarray, out: np.ndarray) -> None:
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    _, column, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(shared.sum()), 8192):
        lo, hi = np.searchsorted(column, [first, first + 8192])
        bits = np.zeros((len(lists), 8192), bool)
        bits[row[lo:hi], column[lo:hi] - first] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for k in range(0, len(out), 4096):
            both = packed[left[k : k + 4096]] & packed[right[k : k + 4096]]
            out[k : k + 4096] += np.bitwise_count(both).sum(axis=1, dtype=np.int64)


def _candidates(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers (a, b) of the pairs of each group that may be similar and that no earlier
    leaf has, and the group of each row. Between two blocks only pairs across them count."""
    key = rows[["leaf", "i", "j"]].to_numpy()
    begin = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
    end = np.append(begin[1:], len(rows))
    group = np.repeat(np.arange(len(begin)), end - begin)
    size, own, cross = rows["size"].to_numpy(), rows["own"].to_numpy(), key[:, 1] != key[:, 2]
    sketch = np.stack(rows["sketch"].to_numpy())
    reach = end[group] - np.arange(len(rows)) - 1
    upto = np.cumsum(reach)
    pairs = []
    at = 0
    while at < len(rows):  # as many first rows at a time as make some 200,000 pairs
        stop = max(at + 1, int(np.searchsorted(upto, upto[at] - reach[at] + 200_000, "right")))
        n = reach[at:stop]
        a = np.repeat(np.arange(at, stop), n)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        near = np.minimum(size[a], size[b]) >= THRESHOLD * np.maximum(size[a], size[b])
        near &= ~cross[a] | (own[a] != own[b])
        a, b = a[near], b[near]
        near = (sketch[a] == sketch[b]).sum(axis=1) >= LEAST_EQUAL
        pairs.append((a[near], b[near]))
        at = stop
    a, b = (np.concatenate(x) for x in zip(*pairs))
    earlier = [np.asarray(x)[: np.searchsorted(x, leaf)] for x, leaf in zip(rows["leaves"], key[:, 0])]
    mine = _common(earlier, a, b, group) == 0
    return a[mine], b[mine], group


def _owners(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _groups(batches):
        a, b, _ = _candidates(rows)
        part = rows.iloc[np.unique(np.concatenate([a, b]))]
        yield pa.RecordBatch.from_pydict({c: part[c].to_numpy() for c in ("leaf", "i", "j", "own", "rep")})


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact comparison: for each row, the copies of the classes it is linked with, and the
    least class of what is connected in the group."""
    for rows in _groups(batches):
        a, b, group = _candidates(rows)
        sets = [np.frombuffer(x, np.uint64) for x in rows["tokens"]]
        size = rows["size"].to_numpy().astype(np.int64)
        both = _common(sets, a, b, group)
        linked = both >= THRESHOLD * (size[a] + size[b] - both) - 1e-9
        a, b = a[linked], b[linked]
        copies, rep = rows["copies"].to_numpy(), rows["rep"].to_numpy()
        links = np.zeros(len(rows), np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        root, before = rep.copy(), None
        while before is None or (root != before).any():
            before = root.copy()
            least = np.minimum(root[a], root[b])
            np.minimum.at(root, a, least)
            np.minimum.at(root, b, least)
        hit = np.flatnonzero(links)
        yield pa.RecordBatch.from_pydict({"rep": rep[hit], "links": links[hit], "root": root[hit]})


def jaccard_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, copy_of, n_links, class_id): one row for each distinct id.

    ``copy_of`` is the smallest id with the same shingles, ``n_links`` the number of other
    documents with a similarity of 0.8 or more, copies included, and ``class_id`` the
    smallest id reachable by links.

    Texts without words (null, empty) link with nothing; a text of one to four words is one
    shingle. Rows of one id are one document, for which the row with the least set key
    stands. Rows without an id take no part and are not returned. Other columns are left
    out whatever their names.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    sets = written(
        docs.mapInArrow(_embed, "id bigint, k1 bigint, k2 bigint, size int, sketch array<int>")
        .groupBy("id")
        .agg(F.min(F.struct("k1", "k2", "size", "sketch")).alias("s"))
        .select("id", "s.*"),
        "sets",
    )
    classes = written(
        sets.groupBy("k1", "k2")
        .agg(F.min(F.struct("id", "size", "sketch")).alias("s"), F.count("*").alias("copies"))
        .select("k1", "k2", F.col("s.id").alias("rep"), "s.size", "s.sketch", "copies"),
        "classes",
    )
    leaves = written(_leaves(classes, runs_needed()), "leaves")
    records = written(
        classes.join(leaves.groupBy("rep").agg(F.sort_array(F.collect_set("leaf")).alias("leaves")), "rep"), "records"
    )
    light = leaves.join(records.select("rep", "size", "sketch", "leaves"), "rep")
    owners = written(
        _in_blocks(light).mapInArrow(_owners, "leaf bigint, i bigint, j bigint, own bigint, rep bigint"), "owners"
    )
    wanted = records.join(owners.select("rep").distinct(), "rep", "left_semi").select("rep", "k1", "k2")
    tokens = (
        docs.join(wanted.select(F.col("rep").alias("id")), "id", "left_semi")
        .mapInArrow(_shingle_sets, "rep bigint, k1 bigint, k2 bigint, tokens binary")
        .join(wanted, ["rep", "k1", "k2"], "left_semi")
        .groupBy("rep")
        .agg(F.first("tokens").alias("tokens"))
    )
    full = (
        owners.join(records.select("rep", "size", "sketch", "leaves", "copies"), "rep")
        .join(tokens, "rep")
        .repartition("leaf", "i", "j")
        .sortWithinPartitions("leaf", "i", "j")
    )
    links = written(full.mapInArrow(_links, "rep bigint, links bigint, root bigint"), "links")
    groups = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "rep")
    linked = links.groupBy("rep").agg(F.sum("links").alias("links")).join(groups, "rep", "left")
    named = sets.select("id", "k1", "k2").join(classes.select("k1", "k2", "rep", "copies"), ["k1", "k2"])
    known = named.join(linked, "rep", "left").select("id", "rep", "copies", "links", "component")
    return (
        docs.select("id")
        .distinct()
        .join(known, "id", "left")
        .select(
            "id",
            F.coalesce("rep", "id").alias("copy_of"),
            (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep", "id").alias("class_id"),
        )
    )
