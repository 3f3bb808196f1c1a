"""Matrix byte-pair encoding against the reference library, and an exact round trip."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from snapmart.llm import bpe, queries

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.tokenizer(PATH, P.PATTERN)


def encoded(tokenizer, texts):
    ids, counts = tokenizer.encode(texts)
    assert len(counts) == len(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def decoded(tokenizer, ids):
    return tokenizer.decode(np.array(ids, np.int32))[0].tobytes()


def test_long_pieces_and_runs(reference, tokenizer):
    rng = random.Random(4)
    texts = ["a" * 1000, "ab" * 700, "the" * 300, " " * 500, "\n" * 300 + "x", "0123456789" * 50, "é" * 333,
             "".join(rng.choice("abcdefgh") for _ in range(5000)), "I'll don't 's't", "<|endoftext|>", ""]
    got = encoded(tokenizer, texts)
    assert got == [reference.encode_ordinary(t) for t in texts]
    assert [decoded(tokenizer, x).decode() for x in got] == texts


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(reference, tokenizer, text):
    ids = encoded(tokenizer, [text])[0]
    assert ids == reference.encode_ordinary(text)
    assert decoded(tokenizer, ids) == text.encode()


def test_pieces_can_be_forgotten(reference, monkeypatch):
    monkeypatch.setattr(bpe, "_KNOWN_PIECES", 3)
    small = bpe.Tokenizer(PATH, P.PATTERN)
    for text in ("one two three four five", "six seven two", "one more time over and over", None, ""):
        assert encoded(small, [text])[0] == reference.encode_ordinary(text or "")


def test_query_over_the_whole_table(spark, sf_dir, reference):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op2_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = reference.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (None, "hello", "z"), (3, "again", "z"), (3, "again", "z")],
                               "doc_id long, text string, ids string")
    rows = bpe.digests(df, PATH, P.PATTERN).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in rows) == [
        (False, 1, 0), (False, 2, 0), (False, 3, 1), (False, 3, 1), (True, 0, 1)]
    assert bpe.digests(df.limit(0), PATH, P.PATTERN).count() == 0


def test_decoding_null_and_empty_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [31373, 995]), (4, None), (5, [0])], "doc_id long, ids array<int>")
    rows = {r.doc_id: bytes(r.decoded) for r in bpe.decode(df, PATH, P.PATTERN).collect()}
    assert rows == {1: b"", 2: b"", 3: b"hello world", 4: b"", 5: b"!"}


def test_round_trip_in_one_task(spark):
    texts = [None, "", "a b  c\n", "é😀 ñandú", "x" * 5000, "word " * 3000, "\x00�"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(2)
    path, pattern = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    apart = {r.doc_id: (r.ids, r.decoded) for r in bpe.decode(bpe.encode(df, path, pattern), path, pattern).collect()}
    both = {r.doc_id: (r.ids, r.decoded) for r in bpe.round_trip(df, path, pattern).collect()}
    assert both == apart and {i: bytes(d) for i, (_, d) in both.items()} == {i: (t or "").encode() for i, t in enumerate(texts)}
    assert bpe.round_trip(df.limit(0), path, pattern).count() == 0
