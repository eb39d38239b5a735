"""Hard negatives against brute force, and the bounds that leave pairs out."""

import math

import numpy as np
import pytest

from corpusgrove.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, x string, cell string, rank string"


def brute(rows):
    good = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        row = (label, [math.floor(256 * float(np.float32(c))) for c in v])
        good[i] = min(good.get(i, row), row)
    score = lambda a, b: sum(p * q for p, q in zip(good[a][1], good[b][1]))
    out = []
    for a in (i for i in good if i % 50 == 0):
        ranked = sorted((-score(a, b), b) for b in good if b != a)
        same = [(s, b) for s, b in ranked if good[b][0] == good[a][0]][:5]
        for s, b in same:
            window = [(t, c) for t, c in ranked if good[c][0] != good[a][0] and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(a, b, k + 1, c, -s, -t) for k, (t, c) in enumerate(window)]
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame([(i, v, label, "x", "c", "r") for i, v, label in rows], SCHEMA)
    assert sorted(tuple(r) for r in H.mine(df).collect()) == brute(rows)


def made(n, width, seed, labels=4, spread=0.6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    return [(k, (centres[k % labels] * 0.3 + spread * rng.normal(size=width)).tolist(), k % labels) for k in range(n)]


@pytest.fixture
def small(monkeypatch):
    for name, value in (("BLOCK", 8), ("GROUP", 2), ("PACK", 3), ("SAMPLE", 64), ("REFERENCES", 4)):
        monkeypatch.setattr(H, name, value)


def test_equals_brute_force_over_many_packs_and_groups(spark, small):
    check(spark, made(600, 6, 1))


def test_ties_copies_zero_and_unusable_rows(spark, small):
    same = [0.5, 0.25, -0.5]
    rows = [(k, same, k % 2) for k in range(120)] + [(200 + k, [0.0, 0.0, 0.0], 1) for k in range(10)]
    rows += [(300, None, 1), (350, [1.0, None, 1.0], 1), (400, [float("nan"), 1.0, 1.0], 0), (450, same, None), (None, same, 0)]
    rows += [(500, [], 0), (550, [0.4], 1), (7, [9.0, 9.0, 9.0], 0), (50, [-1.0, -1.0, -1.0], -3), (600, [-0.5, -0.25, 0.5], 0)]
    rows += [(700 + 50 * k, [0.6 - 0.1 * k, 0.2, 0.1 * k], 0) for k in range(4)]
    check(spark, rows)


def test_labels_of_one_row_each_and_empty_table(spark, small):
    check(spark, [(50 * k, [1.0, 0.1 * k], k) for k in range(12)])
    check(spark, [])
    check(spark, [(50, [1.0], None)])


def test_a_hot_label_and_default_sizes(spark):
    check(spark, [(i, v, 0 if i % 3 else label) for i, v, label in made(300, 5, 2)])


def rows_of(x, references):
    x = np.asarray(x, np.int64)
    return H.Rows(np.arange(len(x), dtype=np.int64).tobytes(), x.tobytes(), H.angles_to(x, references).tobytes(), x.shape[1])


def test_bounds_hold_and_leave_out_most_pairs_of_clusters():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16)) * 100
    x = np.rint(centres[np.arange(400) % 8] + rng.normal(size=(400, 16)) * 4).astype(np.int64)
    x[::50] = 0
    x[7] = x[15] = 3
    references = H.reference_directions(x, 8)
    a, b = rows_of(x[::3], references), rows_of(x, references)
    scores = x[::3] @ x.T
    everyone = np.arange(len(a.ids))
    assert H.overlapping(a, everyone, b, scores.min(1), scores.max(1)).all()
    for shift in (-1, 0, 1):
        exact = scores[:, [5]] + shift
        inside = H.overlapping(a, everyone, b, exact[:, 0], exact[:, 0])
        assert inside[scores == exact].all()
    low = np.sort(scores, 1)[:, -20]
    assert H.overlapping(a, everyone, b, low, scores.max(1)).mean() < 0.3
    least, most = H.block_bounds(a, b)
    assert (least <= scores.min(1)).all() and (scores.max(1) <= most).all()


def test_scored_pairs_are_few_where_vectors_gather():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(10, 16)) * 100
    x = np.rint(centres[np.arange(1000) // 100] + rng.normal(size=(1000, 16)) * 5).astype(np.int64)
    references = H.reference_directions(x[::7], 10)
    blocks = [rows_of(x[k : k + 50], references) for k in range(0, 1000, 50)]
    a = rows_of(x[::20], references)
    a.ids = a.ids + 10_000
    best = H.Best(len(a.ids), 5)
    edge = np.full((len(a.ids), 1), H.MOST)
    scored = H.search(a, blocks, [best], -edge, edge, lambda b: np.ones(len(a.ids), bool))
    assert scored < 0.35 * len(a.ids) * len(x)
    want = np.sort(x[::20] @ x.T, 1)[:, -5:]
    assert np.array_equal(np.sort(best.scores.reshape(-1, 5), 1), want)


def test_exact_scores_of_large_numbers():
    x = np.array([[2**30 + 1, 3]], np.int64)
    assert H.whole_scores(x, x).tolist() == [[(2**30 + 1) ** 2 + 9]]
    with pytest.raises(OverflowError):
        H.whole_scores(x << 1, x << 1)
