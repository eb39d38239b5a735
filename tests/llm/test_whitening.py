"""Whitening against the definition, in plain numpy and whole numbers."""

import math

import numpy as np
import pytest

from corpusgrove.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, z string, weight string, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "z", None, "c") for i, v in rows], SCHEMA)


def brute(rows, components, weight):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in good), default=0)
    whole = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))])) for i, v in good]
    found = sorted({x for _, x in whole})
    weights = [1 if weight == "one" else sum(x == y for _, y in whole) for x in found]
    n, total = sum(weights), [sum(w * x[d] for x, w in zip(found, weights)) for d in range(width)]
    centred = np.array([[(n * x[d] - total[d]) / n for d in range(width)] for x in found]).reshape(-1, width)
    v = (centred * np.array(weights)[:, None]).T @ centred / max(n, 1)
    deviation = {x: sum((n * x[d] - total[d]) ** 2 for d in range(width)) for x in found}
    return whole, n, deviation, dict(zip(found, centred)), v


def check(spark, rows, components=16, weight="one", expect=None):
    got = whitening.whiten(table(spark, rows), components, weight=weight).collect()
    whole, n, deviation, centred, v = brute(rows, components, weight)
    kept = min(components, len(v)) if expect is None else expect
    assert len(got) == len(whole) * kept
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], r["component"]), []).append(r)
    values = np.sort(np.linalg.eigvalsh(v))[::-1] if len(v) else v
    for k in range(1, kept + 1):
        for i, x in whole:
            assert {(r["n"], r["deviation"]) for r in by_row[i, k]} >= {(n, deviation[x])}
            for r in by_row[i, k]:
                assert r["explained"] == pytest.approx(values[k - 1] / np.trace(v), rel=1e-9)
                assert r["identity_error"] < 1e-9
        # the projection is on one unit eigenvector: whitened = c . a with V a = e a
        once = {x: by_row[i, k][0]["whitened"] for i, x in whole if sum(j == i for j, _ in whole) == 1}
        axis = np.linalg.lstsq(np.array([centred[x] for x in once]), np.array([z for z in once.values()]) * math.sqrt(values[k - 1]), rcond=None)[0]
        assert np.linalg.norm(axis) == pytest.approx(1, abs=1e-6)
        assert np.allclose(v @ axis, values[k - 1] * axis, atol=1e-6 * values[0])


def test_copies_count_once(spark):
    rng = np.random.default_rng(1)
    rows = [(k, (rng.normal(size=5) * [1, 2, 3, 4, 5]).tolist()) for k in range(80)]
    rows += [(100 + k, rows[3][1]) for k in range(60)]
    check(spark, rows)
    check(spark, rows, weight="count")
    check(spark, rows, components=2)


def test_unusable_and_short_vectors_null_and_repeated_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=3).tolist()) for k in range(30)]
    rows += [(40, None), (41, [1.0, None, 2.0]), (42, [float("nan"), 0.0, 0.0]), (43, [float("-inf"), 0.0, 0.0])]
    rows += [(None, [1.0, 2.0, 3.0]), (50, []), (51, [1.5]), (7, rows[7][1]), (8, [9.0, 9.0, 9.0])]
    check(spark, rows)


def test_constant_components_have_no_rows(spark):
    rng = np.random.default_rng(3)
    check(spark, [(k, [float(rng.normal()), 1.0, 2.0]) for k in range(20)], expect=1)
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        got = whitening.whiten(table(spark, rows))
        assert got.collect() == [] and len(got.columns) == 7


def test_large_whole_numbers_stay_exact_or_raise(spark):
    check(spark, [(k, [float(2**10 * k), float(-(2**8) * k * k)]) for k in range(40)])
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(table(spark, [(1, [1e30]), (2, [1.0])])).collect()


def test_sums_meet_in_few_rows(spark):
    df = spark.range(1000).repartition(40)
    total = whitening.added(df, lambda b: np.array([b.column(0).to_numpy().sum()]), (1,), np.int64)
    assert total.tolist() == [499500]
