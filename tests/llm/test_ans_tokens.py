"""Token blocks: round trips, checkpoints, checksums, and the word table against the tokenizer."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corpusgrove.llm import ans_tokens, word_table
from corpusgrove.llm.queries import tokenizer_path

from .helpers import corpus, documents

ODD = [
    "Don't stop's I'LL we've'", "H̱ello T̈x İstanbul ΣΑΣ", "a…!b '!x !'s it's", "<|endoftext|> hi<|startoftext|>a", "x" * 40_000 + " y",
    "foo bar baz\x1cq\x00z", "a,b.c;d 1234 5.6e-7 #tag @me", "日本語 テキスト、。 A日B", "don''t ''' \"'s\"", "́abc ̸= ≠", "KK K",
]


def naive(rows):
    made = Tokenizer.from_file(tokenizer_path())
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out, start = [], 0
    for i, t in ordered:
        ids = np.array([*made.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def key(row):
    return row[1]


@pytest.mark.parametrize("options", [{}, {"table_tokens": 2000, "block_tokens": 300, "lanes": 4, "checkpoint_steps": 8}, {"by_words": False}])
def test_files_give_back_every_document(spark, tmp_path, options):
    rows = corpus(40) + [(1000 + k, t) for k, t in enumerate(ODD)]
    path = str(tmp_path / "tokens")
    ans_tokens.write_tokens(documents(spark, rows), path, tokenizer_path(), **options)
    got = [tuple(r) for r in ans_tokens.document_digests(spark, path).collect()]
    assert sorted(got, key=key) == naive(rows)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "tokens")
    ans_tokens.write_tokens(documents(spark, []), path, tokenizer_path())
    assert ans_tokens.document_digests(spark, path).count() == 0


@pytest.mark.parametrize("n, symbols, lanes", [(1, 1, 8), (5, 3, 8), (1000, 1, 16), (5000, 40, 7), (30_000, 20_000, 64)])
def test_coder_round_trip_and_checkpoints(n, symbols, lanes):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % symbols).astype(np.uint32)
    freq, bits = ans_tokens.frequency_table(ids)
    assert freq.sum() == 1 << bits and ((freq > 0) == (np.bincount(ids) > 0)).all()
    coder = ans_tokens.unpack_coder(ans_tokens.pack_frequencies(freq))
    words, states, marks = coder.encode(ids, lanes, 10)
    block = ans_tokens.encode_block(coder, ids, lanes, 10)
    assert (ans_tokens.decode_block(coder, block) == ids).all()
    for token in (0, n // 3, n - 1):
        assert (ans_tokens.decode_from(coder, block, token) == ids[token:]).all()
    assert len(block["checkpoints"]) == max(0, -(-(-(-n // block["lanes"])) // 10) - 1)


def test_coded_size_is_near_the_entropy():
    ids = np.random.default_rng(2).geometric(0.2, 400_000).astype(np.uint32)
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum() / 8
    freq, bits = ans_tokens.frequency_table(ids)
    block = ans_tokens.encode_block(ans_tokens.Coder(freq, bits), ids, 1024, 1 << 20)
    assert len(block["words"]) < 1.01 * entropy * len(ids)


@pytest.mark.parametrize("field, what", [("words", "words"), ("states", "ids")])
def test_damage_is_noticed(field, what):
    ids = np.arange(5000, dtype=np.uint32) % 97
    freq, bits = ans_tokens.frequency_table(ids)
    coder = ans_tokens.Coder(freq, bits)
    block = ans_tokens.encode_block(coder, ids, 8, 100)
    data = bytearray(block[field])
    data[len(data) // 2] ^= 1
    with pytest.raises((ValueError, IndexError), match=f"{what} of a block" if field == "words" else None):
        ans_tokens.decode_block(coder, block | {field: bytes(data)})


def test_word_table_equals_the_tokenizer(monkeypatch):
    monkeypatch.setattr(word_table, "FULL", 3000)  # the table starts anew now and then
    made = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(1)
    texts = ODD + [t for _, t in corpus(40)]
    texts += ["".join(rng.choice("aA'!.,? \n\téÉ̱́ …1#") for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    table, got = word_table.WordTable(made), []
    for ids, counts in table.encode(pa.array(texts, pa.string())):
        cuts = np.concatenate(([0], np.cumsum(counts)))
        got += [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]
    assert got == [made.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_word_table_cuts_long_texts_at_blanks(monkeypatch):
    monkeypatch.setattr(word_table, "PIECE", 64)
    made = Tokenizer.from_file(tokenizer_path())
    text = " ".join(t for _, t in corpus(10) if t)[:20_000]
    ids, counts = word_table.WordTable(made)._long(np.frombuffer(text.encode(), np.uint8))
    assert ids.tolist() == made.encode(text, add_special_tokens=False).ids and counts.tolist() == [len(ids)]
