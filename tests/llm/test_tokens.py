"""Byte-level BPE and token files against the libraries themselves."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tracklayer.llm import bpe, token_files

RANKS = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
CODEC = bpe.Codec(bpe.serialise_model(RANKS), P.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TOKENIZER = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
ENCODER = token_files.TextEncoder(P.path("byte_bpe_50k.json"))


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_bpe_is_that_of_the_library_and_round_trips(text):
    ids = CODEC.encode(text)
    assert ids == REFERENCE.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_text_encoder_is_that_of_the_library(text):
    assert np.frombuffer(next(ENCODER.encode([text])), "<u2").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "a b", "\n", "é🙂", "don't"]), max_size=9))
def test_added_tokens_are_taken_as_the_library_takes_them(pieces):
    text = "".join(pieces)
    ids = np.frombuffer(next(ENCODER.encode([text])), "<u2").tolist()
    assert ids == TOKENIZER.encode(text, add_special_tokens=False).ids
    assert ids.count(50256) == text.count("<|endoftext|>")


def test_encode_texts(docs, clashing, no_docs, rows):
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    wanted = []
    for i, t in rows:
        ids = REFERENCE.encode_ordinary(t or "")
        wanted.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    for frame in (docs, clashing):
        found = bpe.encode_texts(frame, RANKS, P.PATTERN, bpe.digests, schema).collect()
        assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    assert bpe.encode_texts(no_docs, RANKS, P.PATTERN).collect() == []


def test_ranks_with_gaps_are_refused():
    with pytest.raises(ValueError):
        bpe.serialise_model({b"a": 0, b"b": 2})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=700), st.integers(6, 12))
def test_huffman_round_trip(values, bits):
    ids = np.array(values)
    lengths = token_files.code_lengths(np.bincount(ids), bits)
    assert lengths.max() <= bits and sum(2.0 ** -int(n) for n in lengths if n) <= 1
    data, marks = token_files.pack(ids, lengths, token_files.canonical_codes(lengths))
    assert token_files.unpack(data, marks, len(ids), token_files.decode_table(lengths)).tolist() == values


def test_code_lengths_are_optimal_where_the_limit_is_loose():
    import heapq

    counts = np.random.default_rng(3).integers(1, 10_000, 300)
    heap, total = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    assert int((counts * token_files.code_lengths(counts, 30)).sum()) == total


def test_token_files(docs, clashing, no_docs, rows):
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(zlib.crc32(np.array([*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()))
    for frame in (docs, clashing):
        found = token_files.read_tokens(token_files.write_tokens(frame, P.path("byte_bpe_50k.json"), 2)).collect()
        found.sort(key=lambda r: r.start)
        order = [r.doc_id for r in found]
        assert order == sorted(order, key=lambda i: (i is not None, i))
        start = 0
        for r in found:
            assert r.start == start and r.n_tokens * 4 == len(r.ids)
            start += r.n_tokens
        got = {}
        for r in found:
            got.setdefault(r.doc_id, []).append(zlib.crc32(bytes(r.ids)))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}
    assert token_files.read_tokens(token_files.write_tokens(no_docs, P.path("byte_bpe_50k.json"), 2)).collect() == []
