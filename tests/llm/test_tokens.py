"""Encoding, decoding and counting against the public libraries."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowmill.llm import tokens

RANKS_PATH, JSON_PATH = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
RANKS = tokens.read_ranks(RANKS_PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
COUNTER = Tokenizer.from_file(JSON_PATH)
MERGES, _ = tokens.read_merges(JSON_PATH)

TEXTS = [
    None, "", " ", "\n\n  x", "It's the 3rd, isn't it?", "äöü ß 漢字 🎈🎈", "<|endoftext|>a<|endoftext|><|endoftext|>",
    "aaaa" * 5000, " 　 ½ Ⅷ ٣", "same", "same", "ab" * 3000 + " tail",
]


def frame(spark, rows, extra=", ids string, n_tokens int"):
    return spark.createDataFrame([(i, t, *["x", 1, 2][: extra.count(",")]) for i, t in rows], "doc_id long, text string" + extra)


def test_encode_and_decode_as_the_library(spark):
    df = frame(spark, [*enumerate(TEXTS), (None, "no id"), (1, "")])
    rows = tokens.decode(tokens.encode(df, "doc_id", "text", RANKS_PATH, P.PATTERN), "id", "ids", RANKS_PATH).collect()
    at_once = tokens.round_trip(df, "doc_id", "text", RANKS_PATH, P.PATTERN).collect()
    assert sorted(map(str, at_once)) == sorted(map(str, rows))
    got = sorted((-1 if r.id is None else r.id, r.ids, bytes(r.decoded)) for r in rows)
    want = [(-1, "no id"), (1, ""), *enumerate(t or "" for t in TEXTS)]
    assert got == sorted((i, LIBRARY.encode_ordinary(t), t.encode()) for i, t in want)


def test_digests_as_the_library(spark):
    df = frame(spark, [*enumerate(TEXTS), (None, "no id"), (1, "")], ", ids string, n_tokens int, ids_sha256 int")
    got = sorted((-1 if r.id is None else r.id, *list(r)[1:]) for r in tokens.digests(df, "doc_id", "text", RANKS_PATH, P.PATTERN).collect())
    want = []
    for i, t in [(-1, "no id"), (1, ""), *enumerate(t or "" for t in TEXTS)]:
        ids = LIBRARY.encode_ordinary(t)
        named = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), named, hashlib.sha256(LIBRARY.decode_bytes(ids)).hexdigest()))
    assert got == sorted(want)
    assert tokens.digests(df.limit(0), "doc_id", "text", RANKS_PATH, P.PATTERN).count() == 0


def test_counts_as_the_library(spark):
    df = frame(spark, [*enumerate(TEXTS), (None, "no id"), (1, "")])
    got = sorted((-1 if r.id is None else r.id, r.n_bytes, r.n_tokens) for r in tokens.count_tokens(df, "doc_id", "text", JSON_PATH, P.PATTERN).collect())
    want = [(-1, "no id"), (1, ""), *enumerate(t or "" for t in TEXTS)]
    assert got == sorted((i, len(t.encode()), len(COUNTER.encode(t, add_special_tokens=False).ids)) for i, t in want)


def test_empty_tables(spark):
    df = frame(spark, [])
    assert tokens.encode(df, "doc_id", "text", RANKS_PATH, P.PATTERN).count() == 0
    assert tokens.count_tokens(df, "doc_id", "text", JSON_PATH, P.PATTERN).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60) | st.text("ab e'", max_size=60).map(str.encode))
def test_pieces_of_any_bytes(piece):
    ids = tokens.merge_piece(piece, RANKS)
    assert ids == (LIBRARY._encode_single_piece(piece) if piece else [])
    assert b"".join(LIBRARY.decode_single_token_bytes(i) for i in ids) == piece


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 3)
    memo = tokens.Memo(len)
    assert [memo["x" * k] for k in range(1, 60)] == list(range(1, 60))
    assert len(memo) <= 3


@pytest.mark.parametrize("text", ["abc", "The quick brown fox's 12 jumps"])
def test_count_is_bytes_less_merges(text):
    piece = text.split(" ")[0].encode()
    assert tokens.count_piece(piece, MERGES) == len(COUNTER.encode(piece.decode()).ids)
