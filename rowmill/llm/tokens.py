"""Byte-level byte-pair encoding, decoding and token counts.

``encode`` and ``decode`` turn texts into ids and ids into bytes; ``count_tokens`` counts
only. The vocabulary files are read by the task from a path every machine has (a parameter),
so nothing but the path is sent. Each worker keeps a bounded memo of short pieces: words
repeat, so nearly all pieces are looked up and only new ones are merged.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.arrays import pieces

MEMO_PIECES = 250_000
#: Of those with ids, which all tasks of a worker share: some 100 MB of them.
MEMO_ENCODED = 500_000
MEMO_BYTES = 48
DECODED_IDS = 4_000_000
_NONE = 1 << 62


class Memo(dict):
    """Values of short pieces, worked out when first asked for; emptied when full."""

    def __init__(self, work, most: int | None = None):
        self.work = work
        self.most = MEMO_PIECES if most is None else most

    def __missing__(self, piece):
        value = self.work(piece)
        if len(piece) <= MEMO_BYTES:
            if len(self) >= self.most:
                self.clear()
            self[piece] = value
        return value


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def read_merges(path: str) -> tuple[dict[tuple[bytes, bytes], int], list[str]]:
    """Rank of each mergeable pair of byte strings, and the added special strings."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    plain = byte_letters()
    raw = {letter: byte for byte, letter in plain.items()}
    merges = {}
    for rank, pair in enumerate(model["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[bytes(raw[c] for c in left), bytes(raw[c] for c in right)] = rank
    return merges, [t["content"] for t in model.get("added_tokens", [])]


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable Latin-1 as itself, the others in
    order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the leftmost pair of least rank is merged until none is left.

    A segment tree over the byte positions holds, at each position where a live symbol
    starts, the rank of the pair it makes with the next one; its root is the least rank and
    its leftmost position. A merge changes three leaves, each in logarithmic time.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n < 2:
        return [ranks[piece[i : i + 1]] for i in range(n)]
    get = ranks.get
    size = 1 << (n - 2).bit_length()
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank * n + i
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    while tree[1] < _NONE:
        at = tree[1] % n
        gone = after[at]
        end = after[gone]
        after[at] = end
        before[end] = at
        rank = get(piece[at : after[end]]) if end < n else None
        changed = [(at, _NONE if rank is None else rank * n + at)]
        if gone < n - 1:  # no pair begins at the last byte
            changed.append((gone, _NONE))
        start = before[at]
        if start >= 0:
            rank = get(piece[start:end])
            changed.append((start, _NONE if rank is None else rank * n + start))
        for leaf, value in changed:
            node = size + leaf
            while node and tree[node] != value:
                tree[node] = value
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


def count_piece(piece: bytes, merges: dict[tuple[bytes, bytes], int]) -> int:
    """Tokens of one piece: its bytes less the merges done. No id is looked up.

    A heap holds (rank, place of the left symbol, both symbols); the symbols are a linked
    list. An entry whose symbols have changed since is passed over when popped.
    """
    n = len(piece)
    symbol: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = merges.get((symbol[i], symbol[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbol[i], symbol[i + 1]))
    heapq.heapify(heap)
    left = n
    while heap:
        _, at, a, b = heapq.heappop(heap)
        gone = after[at]
        if symbol[at] != a or gone >= n or symbol[gone] != b:
            continue
        symbol[at], symbol[gone] = a + b, None
        left -= 1
        end = after[at] = after[gone]
        if end < n:
            before[end] = at
        for start, second in ((before[at], at), (at, end)):
            if start >= 0 and second < n:
                rank = merges.get((symbol[start], symbol[second]))
                if rank is not None:
                    heapq.heappush(heap, (rank, start, symbol[start], symbol[second]))
    return left


@lru_cache(maxsize=2)
def _known(ranks_path: str) -> tuple[dict[bytes, int], Memo]:
    """Ranks and the packed ids of pieces met so far, for all tasks that a worker runs."""
    ranks = read_ranks(ranks_path)
    return ranks, Memo(lambda piece: np.array(merge_piece(piece.encode(), ranks), "<i4").tobytes(), MEMO_ENCODED)


def _encoded(batches: Iterable[pa.RecordBatch], ranks_path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """(id, ids) batches of (id, text) ones."""
    find = regex.compile(pattern).findall
    get = _known(ranks_path)[1].__getitem__
    for part in pieces(batches, "text"):
        packed = [b"".join(map(get, find(t))) if t else b"" for t in part.column("text").to_pylist()]
        ends = np.cumsum([0, *map(len, packed)]) // 4
        values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(packed))])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        yield pa.RecordBatch.from_arrays([part.column("id"), ids], ["id", "ids"])


def _decoded(batches: Iterable[pa.RecordBatch], ranks: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """(id, ids, decoded) batches of (id, ids) ones."""
    vocabulary = _vocabulary(ranks)
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:  # some million ids at a time, one row at least
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + DECODED_IDS, "right")))
            rows = batch.slice(start, stop - start)
            taken = vocabulary.take(rows.column("ids").flatten())
            offsets = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)
            edges = offsets[np.concatenate([[0], ends[start:stop] - done])]
            decoded = pa.Array.from_buffers(
                pa.binary(), stop - start, [None, pa.py_buffer((edges - edges[0]).astype(np.int32)), taken.buffers()[2] or pa.py_buffer(b"")]
            )
            yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("ids"), decoded], ["id", "ids", "decoded"])
            start = stop


def _vocabulary(ranks: dict[bytes, int]) -> pa.Array:
    """The bytes of each id."""
    table = np.full(max(ranks.values(), default=-1) + 1, None, object)
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, pa.large_binary())


def _some(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows in turn, some million ids at a time, one row at least."""
    start = 0
    while start < len(ends) - 1:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + DECODED_IDS, "right")) - 1)
        yield start, stop
        start = stop


def _joined(table: pa.Array, ids: pa.Array, edges: np.ndarray) -> list[memoryview]:
    """What the ids between two edges stand for, one after the other."""
    taken = table.take(ids)
    at = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)[edges].tolist()
    data = memoryview(taken.buffers()[2] or b"")
    return [data[a:b] for a, b in zip(at, at[1:])]


def _schema(source: DataFrame, *fields: T.StructField) -> T.StructType:
    return T.StructType([source.schema["id"], *fields])


_IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
_DECODED = T.StructField("decoded", T.BinaryType())


def encode(df: DataFrame, id_col: str, text_col: str, ranks_path: str, pattern: str) -> DataFrame:
    """(id, ids): the token ids of every text, in row order, one row for each input row.

    Each match of ``pattern`` is encoded by itself; strings of special tokens are plain
    text. A null text has no ids; null and repeated ids are kept as they are; other
    columns are left out whatever their names. Any text length is taken whole.
    """
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(lambda batches: _encoded(batches, ranks_path, pattern), _schema(source, _IDS))


def decode(df: DataFrame, id_col: str, ids_col: str, ranks_path: str) -> DataFrame:
    """(id, ids, decoded): the bytes that the ids stand for. Null ids decode to no bytes."""
    source = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return source.mapInArrow(lambda batches: _decoded(batches, read_ranks(ranks_path)), _schema(source, _IDS, _DECODED))


def round_trip(df: DataFrame, id_col: str, text_col: str, ranks_path: str, pattern: str) -> DataFrame:
    """(id, ids, decoded): ``encode`` and then ``decode`` in one pass over the rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoded(_encoded(batches, ranks_path, pattern), _known(ranks_path)[0])

    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, _schema(source, _IDS, _DECODED))


def digests(df: DataFrame, id_col: str, text_col: str, ranks_path: str, pattern: str) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): ``round_trip`` without its ids and bytes.

    The ids of a text, in decimal and joined by blanks, and the bytes that they stand for in
    the table of tokens, are hashed in the task that makes them, so neither leaves it. Both
    come from tables by the ids. Nulls, repeats and other columns are as in ``encode``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _vocabulary(_known(ranks_path)[0])
        named = pa.array([b"%d " % i for i in range(len(tokens))], pa.large_binary())
        for batch in _encoded(batches, ranks_path, pattern):
            ids, ends = batch.column("ids"), np.cumsum([0, *batch.column("ids").value_lengths().to_pylist()])
            for start, stop in _some(ends):
                some = ids.slice(start, stop - start).flatten()
                edges = ends[start : stop + 1] - ends[start]
                numbers, decoded = _joined(named, some, edges), _joined(tokens, some, edges)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(start, stop - start),
                        pa.array(np.diff(edges)),
                        pa.array([sha256(x[:-1]).hexdigest() for x in numbers], pa.string()),
                        pa.array([sha256(x).hexdigest() for x in decoded], pa.string()),
                    ],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = [T.StructField("n_tokens", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256"))]
    return source.mapInArrow(run, _schema(source, *fields))


def count_tokens(df: DataFrame, id_col: str, text_col: str, tokenizer_path: str, pattern: str) -> DataFrame:
    """(id, n_bytes, n_tokens) of every text, one row for each input row.

    A special string inside a text counts one token and is cut out before the pattern is
    applied, as the library does by default. A null text counts as empty; ids may be null
    or repeated; other columns are left out whatever their names.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, special = read_merges(tokenizer_path)
        find = regex.compile(pattern).findall
        get = Memo(lambda piece: count_piece(piece.encode(), merges)).__getitem__
        cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))).split if special else lambda t: [t]
        for part in pieces(batches, "text"):
            counts = []
            for text in part.column("text").to_pylist():
                between = cut(text) if text else []
                counts.append(max(0, len(between) - 1) + sum(sum(map(get, find(x))) for x in between))
            size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), size, pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return source.mapInArrow(run, schema)
