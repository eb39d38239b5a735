"""Components against all pairs of shingle sets."""

import random

import numpy as np
import pytest

from corpusgrove.llm import minhash_star
from corpusgrove.llm.components import connected_components, merge_components

from .helpers import corpus, documents, prose, shingles


def naive(rows):
    """(doc_id, n_shingles, component, kept) of every row; rows with one id are one node."""
    sets = [shingles(t) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            same = len(sets[a] & sets[b])
            if 100 * same >= 75 * (len(sets[a]) + len(sets[b]) - same):
                x, y = root(rows[a][0]), root(rows[b][0])
                parent[max(x, y)] = min(x, y)
    out = []
    for (i, _), s in zip(rows, sets):
        own = None if i is None else root(i)
        out.append((i, len(s), own, own == i))
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def check(spark, table, **options):
    got = minhash_star.near_duplicates(documents(spark, table), **options).collect()
    assert sorted([tuple(r) for r in got], key=key) == sorted(naive(table), key=key)


def test_components_equal_all_pairs(spark):
    check(spark, corpus(60))


def test_chain_of_changes_and_large_group(spark):
    rng = random.Random(2)
    text = prose(rng, 120).split(" ")
    rows = []
    for k in range(40):  # each near the one before, the ends far apart
        text[(k * 7) % len(text)] = f"new{k}"
        rows.append((100 - k, " ".join(text)))
    base = prose(rng, 80).split(" ")
    for k in range(60):  # a group around one text, its members less alike
        copy = list(base)
        for at in rng.sample(range(len(copy)), 2):
            copy[at] = f"word{k}"
        rows.append((1000 + k, " ".join(copy)))
    check(spark, rows)


def test_links_survive_buckets_with_unlike_members(spark):
    # one row a band: everything that shares a least hash meets, most of it unlike
    rng = random.Random(4)
    shared = prose(rng, 60)
    rows = [(k, shared + " " + prose(rng, 45)) for k in range(12)]
    rows += [(50 + k, rows[k][1] + " tail words") for k in range(0, 12, 2)]
    check(spark, rows, bands=40, rows=1)


def test_boundary_is_inclusive(spark):
    # three of four shingles: exactly 0.75
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "one two"), (4, "ONE  two"), (5, "one two three")]
    check(spark, rows)
    assert naive(rows)[1][2] == 1


def test_repeated_ids_whose_texts_have_copies_elsewhere(spark):
    rng = random.Random(31)
    a, b, c, d, e = (prose(rng, 40) for _ in range(5))
    near = " ".join(["other", *b.split(" ")[1:]])
    rows = [(3, a), (5, a), (5, b), (7, b), (8, near), (9, c), (9, d), (11, d), (12, c), (20, e), (21, e), (21, None), (22, ""), (22, prose(rng, 9)), (30, None), (30, "")]
    rows += [(40, prose(rng, 12)), (41, b), (41, e)]  # joins the groups of 3 and 20
    check(spark, rows)
    got = {(r["doc_id"], r["component_id"]) for r in minhash_star.near_duplicates(documents(spark, rows)).collect()}
    assert {(5, 3), (7, 3), (8, 3), (21, 3), (11, 9)} <= got and len(got) == len({i for i, _ in rows})
    kept = minhash_star.first_of_groups(documents(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 9, 22, 30, 40]


def test_first_of_groups_keeps_whole_rows(spark):
    rows = corpus(30)
    docs = documents(spark, rows)
    kept = minhash_star.first_of_groups(docs)
    assert kept.columns == docs.columns
    want = sorted({i for i, _, _, keep in naive(rows) if keep and i is not None})
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == want
    assert kept.where("doc_id is null").count() == 2


def test_empty_table(spark):
    assert minhash_star.near_duplicates(documents(spark, [])).count() == 0


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for size in (4, 40, 4000):
        every = rng.integers(0, 1 << 63, size * 5 // 4, dtype=np.uint64)
        a, b = np.sort(every[:size]), np.sort(every[-size:])
        similarity = len(np.intersect1d(a, b)) / len(every)
        s = minhash_star.fill_bins([a, b], 2048)
        assert (s[0] == s[1]).mean() == pytest.approx(similarity, abs=0.25 if size == 4 else 0.08)


def test_connected_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 70)] + [(200, 200 + k) for k in range(1, 30)] + [(300, 300), (5, 4)]
    labels = connected_components(spark.createDataFrame(edges, "a long, b long"))
    got = {r["id"]: r["component"] for r in labels.collect()}
    assert got == {**{k: 0 for k in range(71)}, **{k: 200 for k in range(200, 230)}}


def test_merged_components_equal_those_of_all_edges(spark):
    rng = random.Random(12)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    want = {tuple(r) for r in connected_components(frame(edges)).collect()}
    grown = merge_components(connected_components(frame(edges[:20])), frame(edges[20:]))
    assert {tuple(r) for r in grown.collect()} == want
