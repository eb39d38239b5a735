"""Chunk and suffix deduplication against byte-by-byte searches."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from corpusgrove.llm import gear_chunks, shared_prints, spans, suffix_levels

from .helpers import corpus, documents, prose


def result(data: bytes, covered: bytearray) -> tuple:
    kept = bytes(c for c, gone in zip(data, covered) if not gone)
    runs = sum(1 for k in range(len(data)) if covered[k] and not (k and covered[k - 1]))
    return len(data), sum(covered), runs, hashlib.sha256(kept).hexdigest()


def naive_suffix(rows, length):
    first: dict[bytes, int] = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is not None:
            for p in range(len(b) - length + 1):
                w = b[p : p + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in data:
        covered = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if i is not None and first[b[p : p + length]] < i:
                covered[p : p + length] = b"\1" * length
        out.append((i, *result(b, covered)))
    return out


def naive_ends(b):
    h, raw, ends, at = 0, [], [], 0
    for k, c in enumerate(b):
        h = (2 * h + int(gear_chunks.GEAR[c])) % (1 << 16)
        if h >> 12 == 0:
            raw.append(k + 1)
    for e in [e for k, e in enumerate(raw) if k == 0 or e - raw[k - 1] >= gear_chunks.NEAREST] + [len(b)]:
        while e - at > gear_chunks.LARGEST:
            at += gear_chunks.LARGEST
            ends.append(at)
        if e > at:
            ends.append(e)
            at = e
    return ends


def naive_chunks(rows, least):
    first, cut = {}, []
    for i, t in rows:
        b = (t or "").encode()
        ends = naive_ends(b)
        cut.append((i, b, list(zip([0, *ends[:-1]], ends))))
        for s, e in cut[-1][2]:
            if i is not None:
                first[b[s:e]] = min(first.get(b[s:e], i), i)
    out = []
    for i, b, chunks in cut:
        covered, run = bytearray(len(b)), []
        for s, e in [*chunks, (None, None)]:
            if s is not None and i is not None and first[b[s:e]] < i:
                run.append((s, e))
                continue
            if run and run[-1][1] - run[0][0] >= least:
                covered[run[0][0] : run[-1][1]] = b"\1" * (run[-1][1] - run[0][0])
            run = []
        out.append((i, *result(b, covered)))
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row[:1]) + tuple(row[1:])


def rows_with_lines():
    rng = random.Random(11)
    line = prose(rng, 12)
    rows = corpus(40) + [(500 + k, f"{prose(rng, 5)}\n{line}\n{prose(rng, 5)}") for k in range(30)]
    return rows + [(600, line * 40), (601, "ab" * 500), (602, "ab" * 700 + "c"), (603, "x" * 49), (604, "x" * 49), (605, "x" * 50), (606, "x" * 50)]


def test_suffix_levels_equal_byte_search(spark):
    rows = rows_with_lines()
    got = [tuple(r) for r in suffix_levels.without_repeats(documents(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(naive_suffix(rows, 50), key=key)


def test_suffix_levels_with_small_batches_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_levels, "SENT_BYTES", 4000)
    monkeypatch.setattr(suffix_levels, "BATCH_STRINGS", 64)
    monkeypatch.setattr(suffix_levels, "INDEX_BYTES", 500)
    monkeypatch.setattr(suffix_levels, "SEGMENT", 1000)
    monkeypatch.setattr(suffix_levels, "pieces", lambda offsets: ((k, k + 1) for k in range(len(offsets) - 1)))
    monkeypatch.setattr(shared_prints, "CHUNK_PRINTS", 300)
    rows = [(k, t[:3000] if t else t) for k, t in corpus(30)]
    got = [tuple(r) for r in suffix_levels.without_repeats(documents(spark, rows), length=20).collect()]
    assert sorted(got, key=key) == sorted(naive_suffix(rows, 20), key=key)


def test_levels_stay_few_and_find_the_smallest_document():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(8, 30))) for _ in range(300)]
    documents_ = np.sort(np.array([rng.randint(0, 99) for _ in texts]))
    want, first = [], {}
    for d, t in zip(documents_, texts):
        for p in range(len(t) - 7):
            first.setdefault(t[p : p + 8], d)
    for d, t in zip(documents_, texts):
        want.append([first[t[p : p + 8]] < d for p in range(len(t) - 7)])
    got = [flags.tolist() for _, flags in suffix_levels.repeated_strings(texts, documents_, 8, batch_strings=40)]
    assert got == want
    family = suffix_levels.Levels()
    for k in range(64):
        data = np.frombuffer(b"%08d" % (k * 7919 % 100), np.uint8)
        family.add(suffix_levels.Level(data, np.array([0]), np.array([k]), 8))
    assert len(family.levels) == 1 and len(family.levels[0].at) == 64
    held = [bytes(family.levels[0].data[p : p + 8]) for p in family.levels[0].at]
    assert held == sorted(held) and [h for h in held] == [b"%08d" % n for n in sorted(k * 7919 % 100 for k in range(64))]


def test_suffix_order_is_that_of_the_bytes():
    rng = random.Random(4)
    for length in (3, 8, 20, 50):
        data = np.frombuffer(bytes(rng.choices(b"ab\0\xff", k=400)), np.uint8)
        starts = np.arange(len(data) - length + 1)
        rank = suffix_levels.suffix_ranks(data, length)[starts]
        strings = [bytes(data[p : p + length]) for p in starts]
        assert sorted(starts, key=lambda p: (rank[p], p)) == sorted(starts, key=lambda p: (strings[p], p))
        assert len(set(strings)) == len(set(rank.tolist()))
        words = suffix_levels._words(data, starts, length)
        a, b = np.array(rng.choices(starts, k=300)), np.array(rng.choices(starts, k=300))
        assert suffix_levels._compare(words[a], words[b]).tolist() == [(strings[x] > strings[y]) - (strings[x] < strings[y]) for x, y in zip(a, b)]


def test_memory_of_the_index_follows_its_strings():
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 105, 113).astype(np.uint8).tobytes() for _ in range(16_000)]
    tracemalloc.start()
    n = sum(len(flags) for _, flags in suffix_levels.repeated_strings(texts, np.arange(len(texts)), 50))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 64 * len(texts) and peak < 100 * n


def test_strings_that_end_in_zero_bytes_differ():
    texts = [b"abc\0\0\0\0\0", b"abc\0\0\0\0d", b"\0" * 8, b"abc\0\0\0\0\0"]
    got = [f.tolist() for _, f in suffix_levels.repeated_strings(texts, np.array([1, 2, 3, 4]), 8)]
    assert got == [[False], [False], [False], [True]]


def test_chunks_equal_naive_search(spark):
    rows = rows_with_lines()
    got = gear_chunks.without_copies(documents(spark, rows)).collect()
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(naive_chunks(rows, 96), key=key)
    assert all(bool(r["sources"]) == (r["n_removed"] > 0) for r in got)
    assert all(s < r["doc_id"] for r in got for s in r["sources"])


def test_chunk_ends_move_only_near_an_insertion():
    text = prose(random.Random(9), 3000).encode()
    data = np.frombuffer(text, np.uint8)
    changed = np.frombuffer(text[:5000] + b"some new words " + text[5000:], np.uint8)
    a = set(gear_chunks.chunk_ends(data).tolist())
    b = {e - 15 if e > 5015 else e for e in gear_chunks.chunk_ends(changed).tolist()}
    assert len(a - b) <= 3 and gear_chunks.chunk_ends(data).tolist() == naive_ends(text)


def test_chunks_of_pieces_equal_chunks_of_texts():
    texts = [t for _, t in corpus(40)]
    for (data, ends, hashes), text in zip(gear_chunks.batch_chunks(pa.array(texts, pa.string())), texts):
        b = (text or "").encode()
        assert data.tobytes() == b and ends.tolist() == naive_ends(b)
        assert hashes.tolist() == gear_chunks.chunk_hashes(np.frombuffer(b, np.uint8), ends).tolist()


WORDS = ["der", "it", "a", "und", "the", "que", "no", "и", "not", "Wasser", "encyclopaedia"]


def test_runs_of_a_repeated_word_are_found_at_any_offset(spark):
    rng = random.Random(21)
    rows, shared = [], {}
    for k, word in enumerate(WORDS):
        run = " ".join([word] * 60)
        rows.append((k, f"{prose(rng, 9 + k)} {run} {prose(rng, 20)}"))
        rows.append((100 + k, f"{prose(rng, 30 + 3 * k)} {run} {prose(rng, 15)}"))
        shared[100 + k] = len(run.encode())
    rows += [(200, prose(rng, 8) + " der der der der " + prose(rng, 8)), (201, "-" * 40)]
    got = {r["doc_id"]: (r["n_removed"], r["sources"]) for r in gear_chunks.without_copies(documents(spark, rows)).collect()}
    for doc_id, size in shared.items():
        if size >= 96 + 2 * 24:
            removed, sources = got[doc_id]
            assert 0.7 * size <= removed <= size + 2 * 24 and list(sources) == [doc_id - 100], WORDS[doc_id - 100]
    assert all(not got[i][0] for i in got if i not in shared)


def test_run_chunks_of_pieces_equal_chunks_of_texts():
    rng = random.Random(22)
    texts = [f"{prose(rng, rng.randint(0, 9))} {(word + ' ') * rng.randint(30, 99)}{prose(rng, 5)}" for word in WORDS for _ in range(3)]
    texts += ["der " * 400_000, "", "-" * 500, "- " * 47, "- " * 48]
    for (data, ends, _), text in zip(gear_chunks.batch_chunks(pa.array(texts, pa.string()), runs=True), texts):
        b = np.frombuffer(text.encode(), np.uint8)
        assert data.tobytes() == b.tobytes() and ends.tolist() == gear_chunks.chunk_ends(b, runs=True).tolist()
    both = np.frombuffer(b"x" + b"der " * 30 + b"XYZ" + b"- " * 60, np.uint8)
    assert gear_chunks.repeated_runs(both, np.array([0, len(both)])) == [(1, 121, 4), (124, 244, 2)]
    assert gear_chunks.repeated_runs(both, np.array([0, 61, 240, len(both)])) == [(124, 240, 2)]


def test_spans_merge_and_cut():
    merged = spans.merge_spans(np.array([[5, 9], [0, 2], [8, 12], [12, 13], [20, 21], [6, 7]]))
    assert merged.tolist() == [[0, 2], [5, 13], [20, 21]]
    assert spans.kept_bytes(bytes(range(25)), merged) == bytes([2, 3, 4, *range(13, 20), *range(21, 25)])


@pytest.mark.parametrize("run", [suffix_levels.without_repeats, gear_chunks.without_copies])
def test_empty_table(spark, run):
    assert run(documents(spark, [])).count() == 0
    assert run(documents(spark, [(1, None), (2, "")])).where("n_bytes = 0 and n_removed = 0").count() == 2


def test_unpacked_passages_keep_their_places_in_one_array():
    rows = [(b"a" * 60, 7, 3, 11, [5, 90]), (b"b" * 70, 1 << 31, 4, 12, [0]), (b"c" * 50, 9, 5, 13, [2, 4, 1 << 40])]
    texts, prints, docs, keys, counts, places = suffix_levels.unpack_passages(*suffix_levels.pack_passages(rows))
    assert list(zip(texts, prints.tolist(), docs.tolist(), keys.tolist())) == [r[:4] for r in rows]
    assert counts.tolist() == [2, 1, 3] and places.tolist() == [5, 90, 0, 2, 4, 1 << 40]


def test_least_hashes_fill_all_buckets_alike():
    rng = random.Random(31)
    texts = pa.array([prose(rng, 400) for _ in range(40)], pa.string())
    prints = np.concatenate(list(suffix_levels.distinct_prints(50)(texts)))
    sizes = np.bincount(shared_prints.buckets_of(prints, 48).astype(np.int64), minlength=48)
    assert sizes.min() > 0 and sizes.max() < 2 * sizes.mean()


def test_passages_of_a_bucket_become_texts_in_slices(monkeypatch):
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 50, 400)
    slices = list(suffix_levels.passage_slices(prints, 30))
    assert sorted(np.concatenate(slices).tolist()) == list(range(400)) and len(slices) > 5
    assert not any(set(prints[a]) & set(prints[b]) for k, a in enumerate(slices) for b in slices[:k])

    rows = [(bytes([65 + k % 3]) + bytes([97 + k % 13] * 12) + bytes([48 + k % 5]), k % 13, k // 3, k, [k, k + 100]) for k in range(200)]
    size, pack = suffix_levels.pack_passages(rows)
    table = pa.table({"bucket": [0, 0], "size": [size, None], "pack": [pack, None], "doc_id": [None, 900], "row_key": [None, 5], "spans": [None, b"x"]})
    whole = suffix_levels.bucket_spans(table, 12)
    monkeypatch.setattr(suffix_levels.passage_slices, "__defaults__", (20,))
    sliced = suffix_levels.bucket_spans(table, 12)
    assert (900, 5, b"x") in zip(*sliced.to_pydict().values())
    assert sorted(zip(*sliced.to_pydict().values())) == sorted(zip(*whole.to_pydict().values())) and whole.num_rows > 20
