import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgrove.operators import packing, subtopics as Sub
from tests import naive


@pytest.mark.parametrize("fan", [2, 64])
def test_batches_match_next_fit_across_chunks(spark, monkeypatch, fan):
    monkeypatch.setattr(packing, "FAN", fan)
    rng = random.Random(11)
    rows, want = [], {}
    for case in range(60):
        budget = 100
        kind = case % 4
        n = rng.randint(1, 40)
        sizes = [rng.randint(2, {0: 22, 1: 5, 2: 60, 3: 22}[kind]) for _ in range(n)]
        if kind == 3:
            sizes = [20 if rng.random() < 0.7 else 22 for _ in range(n)]
        rows += [(f"t{case}", i, s) for i, s in enumerate(sizes)]
        want[f"t{case}"] = naive.pack(sizes, budget)
    df = spark.createDataFrame(rows, "topic string, n bigint, n_tokens bigint").repartition(3)
    for chunk in (1, 3, 7, 1000) if fan == 64 else (1,):
        got = {}
        for r in packing.number_batches(df, ["topic"], 100, chunk).collect():
            got.setdefault(r.topic, {})[r.n] = r.batch_id
        for topic, batches in want.items():
            assert [got[topic][i] for i in range(len(batches))] == batches, (chunk, topic)


def test_packed_text_around_the_budget(spark):
    budget = 50
    texts = ["w " * n for n in (9, 10, 11, 8, 7, 3, 9, 9, 1, 40, 2)]
    texts[3] = "a\nb\nc d e f g h"
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_idx bigint, text string")
    topics = docs.select(F.lit("T").alias("topic"), "doc_idx")
    rows = packing.pack_documents(docs, topics, ["topic"], budget).orderBy("batch_id").collect()
    blocks, sizes = [], []
    for i, t in enumerate(texts):
        cut = naive.count(t) >= budget // 5
        body = naive.truncate(t, budget // 5) if cut else t.replace("\n", " ")
        blocks.append(f"Document {i + 1}\n{body}\n")
        sizes.append(naive.count(blocks[-1]))
    batches = naive.pack(sizes, budget)
    want = ["".join(b for b, k in zip(blocks, batches) if k == batch) for batch in range(batches[-1] + 1)]
    assert [r.text for r in rows] == want
    assert all(r.n_tokens < budget for r in rows)


def test_budget_without_room_is_refused(spark):
    df = spark.createDataFrame([("t", 0, 1)], "topic string, n bigint, n_tokens bigint")
    with pytest.raises(ValueError):
        packing.number_batches(df, ["topic"], 5)


NAMES = ["Alpha", "alpha", "Beta", "Gamma", "Delta"]


def random_response(rng):
    lines = []
    for _ in range(rng.randint(1, 6)):
        name, lvl = rng.choice(NAMES), rng.choice([1, 2, 2])
        lines.append(f"  [{lvl}] {name}" if rng.random() < 0.35 else f" [{lvl}] {name} (Document: 1, 2): d{rng.randint(0, 99)}.")
    if rng.random() < 0.2:
        lines.insert(rng.randint(0, len(lines)), "no match (here)")
    return "\n".join(lines)


@pytest.mark.parametrize("seed", range(6))
def test_subtopic_fold_matches_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    root = naive.nest([(1, "Alpha", 3, "x"), (1, "Beta", 2, "x"), (2, "Gamma", 1, "old")][: 1 + seed % 3])
    tree = naive.tree_rows(spark, root)
    responses = [random_response(rng) for _ in range(14)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(responses)], "prompt_idx bigint, topics string").repartition(3)
    got = Sub.fold_subtopics(tree, df)
    assert naive.dump_table(got) == naive.dump(naive.fold_subtopics(root, responses)), responses


def test_document_topics(spark):
    docs = spark.createDataFrame(
        [(0, "[1] Trade: x\n[1] Law: y\n[1] Trade: again"), (1, "[1] trade: x"), (2, " [1] Law: lead"), (3, "None"), (4, "[1] Law : x")],
        "doc_idx bigint, responses string",
    )
    labels = spark.createDataFrame([("[1] Trade",), ("[1] Law",)], "label string")
    rows = Sub.doc_topics(docs, labels).orderBy("doc_idx").collect()
    assert [r.topics for r in rows] == [["[1] Trade", "[1] Law", "[1] Trade"], ["None"], ["None"], ["None"], ["None"]]
    assert [r.doc_idx for r in Sub.docs_with_topics(Sub.doc_topics(docs, labels)).collect()] == [0]
    counted = {r.topic: r.docs for r in Sub.doc_frequency(Sub.topic_mentions(docs, labels)).collect()}
    assert counted == {"[1] Trade": 1, "[1] Law": 1}
    refined = docs.withColumn("refined_responses", F.lit("[1] Law: z"))
    assert all(r.topics == ["[1] Law"] for r in Sub.doc_topics(refined, labels).collect())


@pytest.mark.parametrize("links", [9, 70])
def test_chain_of_subtopics_takes_two_passes(spark, monkeypatch, links):
    root = naive.nest([(1, "S0", 5, "x")])
    answers = [f"[{1 if k == 0 else 2}] S{k}\n    [2] S{k + 1} (Document: 1): part {k}." for k in range(links)]
    responses = spark.createDataFrame(list(enumerate(answers)), "prompt_idx long, topics string")
    passes, parent = [], Sub.subtopic_parent
    monkeypatch.setattr(Sub, "subtopic_parent", lambda *a: (passes.append(1), parent(*a))[1])
    joins, write = [], Sub.materialize
    monkeypatch.setattr(Sub, "materialize", lambda df, label: (joins.append(label), write(df, label))[1])
    grown = Sub.fold_subtopics(naive.tree_rows(spark, root), responses)
    assert naive.dump_table(grown) == naive.dump(naive.fold_subtopics(root, answers))
    assert grown.count() == links + 1
    # one without subtopics, one with the likely ones, which they reproduce; doubling in between
    assert len(passes) == 2 and joins.count("subtopic-steps") <= 2 + links.bit_length()


@pytest.mark.parametrize("seed", range(4))
def test_entangled_chains_match_the_sequential_rule(spark, seed):
    rng = random.Random(40 + seed)
    root = naive.nest([(1, "Alpha", 3, "x"), (1, "S3", 2, "x")])
    tree = naive.tree_rows(spark, root)
    answers = []
    for k in range(25):
        lines = []
        for _ in range(rng.randint(1, 4)):
            name = rng.choice(["Alpha", *(f"S{rng.randint(max(0, k - 3), k + 1)}" for _ in range(4))])
            lines.append(f"[{rng.choice([1, 2, 2, 2])}] {name}" + rng.choice(["", "", " (Document: 1): d."]))
        answers.append("\n".join(lines))
    responses = spark.createDataFrame(list(enumerate(answers)), "prompt_idx long, topics string")
    grown = Sub.fold_subtopics(tree, responses)
    assert naive.dump_table(grown) == naive.dump(naive.fold_subtopics(root, answers)), answers


def test_tables_of_two_stretches_compose():
    rng = random.Random(5)
    for _ in range(300):
        budget = rng.randint(10, 40)
        sizes = [np.array([rng.randint(1, 15) for _ in range(rng.randint(1, 4))]) for _ in range(3)]
        tables = [packing._summary(s, budget) for s in sizes]
        whole = packing._then(packing._then(tables[0], tables[1]), tables[2])
        right = packing._then(tables[0], packing._then(tables[1], tables[2]))
        for fill in range(budget):
            step, closed = fill, 0
            for t in tables:
                step, more = packing._pass(t, step)
                closed += more
            assert packing._pass(whole, fill) == packing._pass(right, fill) == (step, closed)
