"""Leaks against an exact search of every window, and the Hamming index against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusgrove.llm import simhash_leaks

from .helpers import LOWER, corpus, documents, prose

ITEMS = "item_id long, text string, doc_id string, similarity string"


def runs(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return [tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))] if found else [], len(found)


def naive(docs, items):
    """(doc_id, item_id) -> best similarity, one entry per document row and distinct item."""
    known = {}
    for i, t in sorted(items, key=lambda x: (x[0] is not None, x[0] or 0)):
        s, n = runs(t)
        if s:
            known.setdefault((tuple(s), n), i)
    out = []
    for d, t in docs:
        s, n = runs(t)
        for (item, words), i in known.items():
            width = min(5, words)
            mine = s if width == 5 else [tuple(x) for x in _short(t, width)]
            if not mine or (width == 5 and n < 5):
                continue
            m, best, want = min(len(item), len(mine)), 0.0, Counter(item)
            for k in range(len(mine) - m + 1):
                same = sum((Counter(mine[k : k + m]) & want).values())
                best = max(best, same / (m + len(item) - same))
            if best >= 0.75:
                out.append((d, i, round(best, 9)))
    return out


def _short(text, width):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return [found[k : k + width] for k in range(len(found) - width + 1)]


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(21)
    items = [(k, prose(rng, rng.randint(12, 60))) for k in range(25)]
    items += [(30, "one two three"), (31, None), (32, ""), (33, items[4][1]), (2, "..."), (34, "lone"), (None, prose(rng, 20)), (35, "ha " * 30)]
    docs = [(i, t) for i, t in corpus(25)]
    for k in range(30):
        words = items[k % 25][1].split()
        if k % 3 == 1:
            words[len(words) // 2] = "other"
        if k % 5 == 2:
            words.insert(3, "added")
        docs.append((100 + k, prose(rng, rng.randint(0, 50)) + "\n" + " ".join(words).upper() + ", " + prose(rng, rng.randint(0, 50))))
    docs += [(300, "zero ONE, two three four"), (301, "a lone word"), (302, "ha " * 200), (303, items[-2][1]), (304, " ".join(items[6][1].split()[:-1]))]
    return docs, items


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("slice_bytes", [1 << 20, 400])
def test_leaks_equal_search_of_every_window(spark, tables, slice_bytes):
    docs, items = tables
    benchmark = spark.createDataFrame([(*r, "x", "y") for r in items], ITEMS)
    got = simhash_leaks.find_leaks(documents(spark, docs), benchmark, slice_bytes=slice_bytes).collect()
    assert sorted([(r[0], r[1], round(r[2], 9)) for r in got], key=key) == sorted(naive(docs, items), key=key)


def test_decontaminate_keeps_clean_rows_whole(spark, tables):
    docs, items = tables
    benchmark = spark.createDataFrame([(*r, "x", "y") for r in items], ITEMS)
    frame = documents(spark, docs)
    kept = simhash_leaks.decontaminate(frame, benchmark, slice_bytes=2000)
    assert kept.columns == frame.columns
    clean = [d for d, t in docs if not naive([(d, t)], items)]
    assert sorted([r["doc_id"] for r in kept.collect()], key=lambda x: (x is None, x or 0)) == sorted(clean, key=lambda x: (x is None, x or 0))


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(4)
    items = [simhash_leaks.Item(k, rng.integers(0, 1 << 63, 30, dtype=np.uint64)) for k in range(200)]
    index = simhash_leaks.Sizes(items)
    for k in range(50):
        window = index.prints[k] ^ np.packbits(rng.random(64) < rng.random() * 0.6)
        away = np.unpackbits(index.prints ^ window, axis=1).sum(1)
        assert index.near(window).tolist() == np.flatnonzero(away <= simhash_leaks.RADIUS).tolist()


def test_empty_tables(spark, tables):
    benchmark = spark.createDataFrame([(*r, "x", "y") for r in tables[1]], ITEMS)
    assert simhash_leaks.find_leaks(documents(spark, []), benchmark).count() == 0
    assert simhash_leaks.find_leaks(documents(spark, tables[0]), benchmark.limit(0)).count() == 0
    assert simhash_leaks.decontaminate(documents(spark, tables[0]), benchmark.limit(0)).count() == len(tables[0])
