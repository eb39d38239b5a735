"""Neighbours against brute force, and the curve itself."""

import numpy as np
import pytest

from corpusgrove.llm import hilbert_ann

SCHEMA = "vec_id long, embedding array<float>, label int, score string, klass string, block string"


def brute(rows, k, every):
    good = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q, v in good.items():
        if q % every:
            continue
        scores = [(-float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w))), i) for i, w in good.items() if i != q and len(w) == len(v)]
        out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scores)[:k]]
    return {q: found for q, found in out.items() if found}


def check(spark, rows, k=5, every=5, **options):
    df = spark.createDataFrame([(i, v, 0, "x", "y", None) for i, v in rows], SCHEMA)
    got = {}
    for r in hilbert_ann.nearest_neighbours(df, k, every, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows, k, every)
    assert got.keys() == want.keys()
    for q, found in want.items():
        assert [(n + 1, i) for n, (i, _) in enumerate(found)] == [g[:2] for g in got[q]]
        assert [s for _, s in found] == pytest.approx([g[2] for g in got[q]], abs=1e-9)


def test_equals_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hilbert_ann, "BLOCK", 16)
    monkeypatch.setattr(hilbert_ann, "PACK", 3)
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=12).tolist()) for k in range(230)]
    check(spark, rows)


def test_copies_ties_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(hilbert_ann, "BLOCK", 8)
    rng = np.random.default_rng(6)
    same = rng.normal(size=6).tolist()
    rows = [(k, same) for k in range(100, 140)] + [(k, rng.normal(size=6).tolist()) for k in range(40)]
    rows += [(200, None), (201, []), (205, [0.0] * 6), (210, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (215, [float("nan")] * 6), (220, [float("inf")] + [1.0] * 5)]
    rows += [(300, [1.0, 2.0]), (301, [2.0, 1.0]), (305, [5.0]), (None, same), (100, same)]
    check(spark, rows)


def test_fewer_candidates_than_asked_and_empty_table(spark):
    check(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (5, [0.0, 1.0])])
    check(spark, [])


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = hilbert_ann.hilbert_index(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_curves_alone_find_clustered_neighbours(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 16)) * 4
    rows = [(k, (centres[k % 40] + 0.1 * rng.normal(size=16)).tolist()) for k in range(800)]
    df = spark.createDataFrame([(i, v, 0, "x", "y", None) for i, v in rows], SCHEMA)
    want = {(q, i) for q, found in brute(rows, 5, 20).items() for i, _ in found}
    got = {(r["query_id"], r["vec_id"]) for r in hilbert_ann.nearest_neighbours(df, 5, 20, exact=False).collect()}
    assert len(got & want) >= 0.9 * len(want)
