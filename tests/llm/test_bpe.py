"""BPE against the tiktoken library, and the round trip."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st

from tidemark.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
CODEC = bpe.codec(PATH)
TIKTOKEN = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})

HARD = ["", " ", "\n\n  x", "a" * 3000, "ab" * 400 + "é" * 300, "​🦆🦆 👩‍👩‍👧", "x" * 256 + " " + "y" * 257, "<|endoftext|> it's I'LL 123456789",
        "\x00\x01�", "Straße naïve 東京都 ประเทศ العربية"]


def encode(text):
    pieces = regex.findall(PATTERN, text)
    memory = bpe._Memory()
    memory.learn(set(pieces), CODEC)
    return memory.encode(pieces)


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    ids = encode(text)
    assert ids.tolist() == TIKTOKEN.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=120) | st.text("abcdest ñé01.", max_size=400))
def test_any_text(text):
    ids = encode(text)
    assert ids.tolist() == TIKTOKEN.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=300), min_size=1, max_size=20))
def test_rows_of_a_matrix_equal_the_heap(pieces):
    for piece, ids in zip(pieces, CODEC.encode_pieces(pieces)):
        if piece not in CODEC.known:
            assert ids.tolist() == CODEC._long(piece).tolist()
        assert CODEC.decode(ids) == piece


def test_table_holds_every_pair():
    ranks = CODEC.known
    some = [t for t in list(ranks)[::97] if len(t) > 1]
    for token in some:
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                assert CODEC.pairs.ranks(np.array([a]), np.array([b]))[0] == ranks[token]


def test_frames(spark):
    rows = [(i, t, "own") for i, t in enumerate(HARD)] + [(None, None, "own"), (0, "", "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = bpe.encode(docs, PATH, PATTERN)
    assert coded.columns == ["doc_id", "ids"]
    decoded = bpe.decode(coded, PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.decoded)) for r in decoded) == sorted(
        (i is None, i or 0, (t or "").encode()) for i, t, _ in rows)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(none, PATH, PATTERN), PATH).count() == 0


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in bpe.op9_byte_bpe(spark, sf).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in docs:
        ids = TIKTOKEN.encode_ordinary(r.text or "")
        mine = got[r.doc_id]
        assert (mine.n_tokens, mine.ids_sha256, mine.decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode()))
