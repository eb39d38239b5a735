"""Byte-level BPE against the library that defines it."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from corpusgrove.llm import byte_bpe
from tests.llm.helpers import corpus, documents

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = byte_bpe.read_ranks(PATH)
MERGES = byte_bpe.Merges(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = [
    "", " ", "  a  b ", "\n\n x\n", "a   b", "don't we'll 'tis ’s", "<|endoftext|> <|fim|>", "١٢٣ 12三 Ⅷ½", "a\x1cb \x1f x",
    "𝒜𝓁 𐐀𐐁 𝟘1 \U0001f600\U0001f600 x", "é ́", "﻿x ​ y", "aaaa" * 500, " " * 3000 + "x", "\t \r\n" * 200, "ß" * 999, "中文字" * 300 + " 中 文",
]


def encoded(texts, words=None):
    out = [b"" for _ in texts]
    for k, part in byte_bpe.Encoder(MERGES, public_tokenizers.PATTERN, words or {}).encode(texts):
        out[k] += part
    return [byte_bpe.np.frombuffer(x, byte_bpe.ID).tolist() for x in out]


def test_equals_the_library_on_odd_texts(monkeypatch):
    want = LIBRARY.encode_ordinary_batch(ODD)
    assert encoded(ODD) == want
    monkeypatch.setattr(byte_bpe, "PART", 5)
    monkeypatch.setattr(byte_bpe, "HELD", 3)
    assert encoded(ODD, {"aaaa": b"\0\0\0\0"}) == want


def test_classes_of_every_code_point():
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f" {c}a{c}1{c}!{c}  {c} x" for c in signs[k : k + 500]) for k in range(0, len(signs), 500)]
    assert encoded(texts) == LIBRARY.encode_ordinary_batch(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sab1é ")), max_size=80), max_size=6))
def test_equals_the_library_on_any_text(texts):
    assert encoded(texts) == LIBRARY.encode_ordinary_batch(texts)


def test_merges_that_make_a_pair_of_lower_rank():
    # "abc" has a lower rank than "ab": merging "ab" makes a pair that goes before other places of "ab"
    rng = random.Random(3)
    for trial in range(300):
        tokens = {"".join(rng.choices("abc", k=rng.randint(2, 5))).encode() for _ in range(12)}
        order = [bytes([b]) for b in range(256)] + rng.sample(sorted(tokens), len(tokens))
        own = byte_bpe.Merges({t: k for k, t in enumerate(order)})
        words = ["".join(rng.choices("abc", k=rng.randint(1, 30))).encode() for _ in range(20)]
        library = tiktoken.Encoding("own", pat_str="(?s:.)+", mergeable_ranks=own.ranks, special_tokens={})
        got = [byte_bpe.np.frombuffer(x, byte_bpe.ID).tolist() for x in own.replay(words)]
        assert got == [library.encode_ordinary(w.decode()) for w in words], trial


@pytest.mark.parametrize("limit", [0, 40, byte_bpe.WORDS])
def test_query_equals_the_library(spark, monkeypatch, limit):
    monkeypatch.setattr(byte_bpe, "HELD", 100)
    rows = corpus(30) + [(1000 + k, t) for k, t in enumerate(ODD)]
    docs = documents(spark, rows)
    got = [tuple(r) for r in byte_bpe.round_trips(docs, PATH, public_tokenizers.PATTERN, limit).collect()]
    want = []
    for i, text in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_ids_and_their_bytes(spark):
    rows = [(1, "Ünï çødé 12"), (2, None), (3, "")]
    ids = byte_bpe.encode(documents(spark, rows), PATH, public_tokenizers.PATTERN)
    got = {r["doc_id"]: (r["ids"], bytes(r["data"])) for r in byte_bpe.decode(ids, PATH).collect()}
    assert got == {i: (LIBRARY.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows}


def test_word_table_is_bounded(spark):
    counts = spark.createDataFrame([(f"w{k}", 2 + k % 64) for k in range(200)], "word string, n long")
    kept = {r["word"] for r in byte_bpe.frequent(counts, 140).collect()}
    assert kept == {f"w{k}" for k in range(200) if 2 + k % 64 >= 32}
    assert byte_bpe.frequent(counts, 0).count() == 0


def test_empty_table(spark):
    assert byte_bpe.round_trips(documents(spark, []), PATH, public_tokenizers.PATTERN).collect() == []
