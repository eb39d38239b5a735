"""The field against enumeration of all label sequences, and held-out accuracy."""

import itertools
import random
import zlib

import numpy as np
import pytest

from corpusgrove.llm import line_crf

from .helpers import documents, prose


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    bounds = np.array([0, 1, 1, 5, 8])
    unary, pair = rng.normal(size=8), rng.normal(size=(2, 2))
    good, pairs, total = line_crf.forward_backward(unary, pair, bounds)
    want_total, want_pairs, want = 0.0, np.zeros((2, 2)), np.zeros(8)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if a == b:
            continue
        weights = {}
        for states in itertools.product((0, 1), repeat=b - a):
            score = sum(unary[a + k] for k, s in enumerate(states) if s) + sum(pair[x, y] for x, y in zip(states, states[1:]))
            weights[states] = np.exp(score)
        z = sum(weights.values())
        want_total += np.log(z)
        for states, w in weights.items():
            want[a:b] += np.array(states) * w / z
            for x, y in zip(states, states[1:]):
                want_pairs[x, y] += w / z
    assert np.allclose(good, want) and np.allclose(pairs, want_pairs) and np.isclose(total, want_total)


def junk(rng, kind):
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in prose(rng, 40).split())
    if kind == 1:
        return "\n".join(prose(rng, 8) if k % 4 == 0 else " ".join([rng.choice(["click", "buy"])] * 12) for k in range(8))
    return " ".join(w + rng.choice(["###", "$$$", "%%"]) for w in prose(rng, 60).split())


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(400):
        bad = k % 3 == 0
        rows.append((k, junk(rng, k % 9 // 3) if bad else prose(rng, rng.randint(5, 200))))
        labels.append((k, int(not bad), 0))
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, "word " * 20_000), (0, rows[0][1]), (None, rows[1][1])]
    labels += [(1, None, 1), (2, 7, 0), (None, 1, 0), (5, 1, 0)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_odd_rows(labelled):
    docs, labels = labelled
    rows = line_crf.quality(docs, labels, sample=150).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in by_id.items() if i is not None)
    tested = [r for r in rows if r["held_out"] and r["doc_id"] < 400]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 != 0) for r in tested]) > 0.9
    assert {by_id[k]["score"] for k in (900, 901, 902)} == {0.0}
    assert len({r["score"] for r in rows if r["doc_id"] == 0}) == 1


def test_held_out_labels_are_not_learned_from(spark, labelled):
    docs, labels = labelled
    swapped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality")
    assert line_crf.quality(docs, labels, sample=50).exceptAll(line_crf.quality(docs, swapped, sample=50)).isEmpty()


def test_accepted_keeps_whole_rows(labelled):
    docs, labels = labelled
    kept = line_crf.accepted(docs, labels, sample=150)
    assert kept.columns == docs.columns
    scored = line_crf.quality(docs, labels, sample=150).where("predicted = 1")
    assert sorted(r[0] for r in kept.where("doc_id is not null").select("doc_id").collect()) == sorted(r["doc_id"] for r in scored.collect() if r["doc_id"] is not None)


def test_without_labels_and_without_rows(spark, labelled):
    docs, labels = labelled
    rows = line_crf.quality(docs, labels.where("quality = 1")).collect()
    assert {r["score"] for r in rows} == {0.0, 0.5}
    assert line_crf.quality(docs.limit(0), labels).count() == 0
    assert line_crf.quality(docs.limit(0), labels.limit(0)).count() == 0


def test_without_both_labels_all_rows_with_words_are_accepted(spark):
    docs = documents(spark, [(1, "some words"), (2, "more of them\nin lines"), (3, None), (4, " \n"), (None, "no id")])
    schema = "doc_id long, quality int, toxic int"
    for rows in ([], [(1, 1, 0), (2, 1, 0)], [(1, None, 0), (2, 7, 0)]):
        kept = line_crf.accepted(docs, spark.createDataFrame(rows, schema))
        assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, None}
