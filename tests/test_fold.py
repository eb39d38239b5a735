import random
import re

import pytest
from pyspark.sql import functions as F

from corpusgrove.operators import fold, ordering
from corpusgrove.operators.responses import level_gate, response_lines
from corpusgrove.plans.generate import fold_level1, fold_round
from corpusgrove.sources import documents
from tests import naive

NAMES = ["Trade", "trade", "Energy", "Health Care", "TAX", "Tax", "Law", "Art", "Sport"]


def random_responses(rng, n, errors=0.02):
    out = []
    for _ in range(n):
        lines = []
        for _ in range(rng.randint(0, 3)):
            kind = rng.random()
            if kind < 0.1:
                lines.append("not a topic")
            elif kind < 0.15:
                lines.append("[2] Lower: level")
            else:
                lines.append(f" [1] {rng.choice(NAMES)}: d{rng.randint(0, 9)}")
        failed = rng.random() < errors
        out.append(("Error", "error") if failed else ("\n".join(lines), "ok"))
    return out


def table(spark, responses):
    rows = [(i, text, status) for i, (text, status) in enumerate(responses)]
    return spark.createDataFrame(rows, "doc_idx bigint, responses string, status string").repartition(3)


@pytest.mark.parametrize("seed", range(8))
def test_fold_matches_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    responses = random_responses(rng, 60, errors=0.0 if seed % 2 else 0.03)
    patience = rng.choice([0, 1, 3, 8, 1000])
    seeds, root = None, None
    if seed % 3 == 0:
        root = naive.nest([(1, "TRADE", 1, ""), (2, "Deep", 1, ""), (1, "Art", 1, ""), (1, "art", 1, "")])
        seeds = naive.tree_rows(spark, root)
    tree, kept, _ = fold_level1(table(spark, responses), seeds, patience)
    want, n = naive.fold_level1(responses, patience, root)
    assert naive.dump_table(tree) == naive.dump(want)
    assert sorted(r.doc_idx for r in kept.collect()) == list(range(n))


@pytest.mark.parametrize("repeats,stops", [(4, False), (5, True)])
def test_stop_is_strictly_after_the_patience(spark, repeats, stops):
    responses = [("[1] Trade: d", "ok")] + [("[1] trade: d", "ok")] * repeats + [("[1] New: d", "ok")]
    tree, kept, stopped = fold_level1(table(spark, responses), None, 4)
    assert stopped == stops
    assert kept.count() == (5 if stops else len(responses))
    assert {r["name"]: r["count"] for r in tree.collect()} == ({"Trade": 6} if stops else {"Trade": 5, "New": 1})


def test_dense_index_carry_and_next(spark):
    rng = random.Random(5)
    keys = sorted(rng.sample(range(10_000), 200))
    rows = [(k, rng.choice("ab"), k if rng.random() < 0.2 else None) for k in keys]
    df = spark.createDataFrame(rows, "k bigint, g string, v bigint").repartition(3)
    bucket = F.expr("k div 100")
    dense = {r.k: r.i for r in ordering.dense_index(df, ["k"], "i", bucket=bucket).collect()}
    assert [dense[k] for k in keys] == list(range(len(keys)))
    grouped = {r.k: (r.g, r.i) for r in ordering.dense_index(df, ["k"], "i", keys=["g"], bucket=bucket).collect()}
    for g in "ab":
        mine = [k for k in keys if grouped[k][0] == g]
        assert [grouped[k][1] for k in mine] == list(range(len(mine)))
    after = {r.k: r.nxt for r in ordering.next_value(df, "k", "nxt", 100).collect()}
    assert [after[k] for k in keys] == [*keys[1:], None]
    carried = {r.k: r.c for r in ordering.carry_forward(df, "k", "v", "c", 100).collect()}
    last = None
    for k, _, v in rows:
        assert carried[k] == last
        last = v if v is not None else last


def lines_of(spark, responses):
    return fold.number_lines(level_gate(response_lines(table(spark, responses))))


@pytest.mark.parametrize("seed", range(6))
def test_any_cut_into_rounds_gives_the_same_tree(spark, seed):
    rng = random.Random(100 + seed)
    responses = random_responses(rng, 50, errors=0.0 if seed % 2 else 0.02)
    patience = rng.choice([0, 2, 5, 1000])
    seeds, root = None, None
    if seed % 3 == 0:
        root = naive.nest([(1, "TRADE", 1, ""), (1, "Art", 4, "")])
        seeds = naive.tree_rows(spark, root)
    want, n = naive.fold_level1(responses, patience, root)
    cuts = [0, *sorted(rng.sample(range(1, 50), 3)), 50]
    state, kept, seen = fold.start(spark, seeds), None, 0
    for low, high in zip(cuts, cuts[1:]):
        asked = table(spark, responses).filter(F.col("doc_idx").between(low, high - 1))
        state, kept = fold_round(state, asked, patience)
        seen += asked.count() if kept is None else asked.filter(kept).count()
        if kept is not None:
            break
    assert naive.dump_table(fold.topic_rows(state.topics, seeds)) == naive.dump(want)
    assert seen == n


def test_states_join_in_any_order(spark):
    rng = random.Random(9)
    responses = random_responses(rng, 45, errors=0.0)
    parts = [table(spark, responses).filter(F.col("doc_idx").between(a, a + 14)) for a in (0, 15, 30)]
    a, b, c = (fold.stretch(fold.number_lines(level_gate(response_lines(p)))) for p in parts)
    whole = fold.stretch(lines_of(spark, responses))
    for state in (fold.joined(fold.joined(a, b), c), fold.joined(a, fold.joined(b, c))):
        assert (state.lines, state.last_new) == (whole.lines, whole.last_new)
        assert sorted(state.topics.collect(), key=str) == sorted(whole.topics.select(*state.topics.columns).collect(), key=str)


def test_ranges_read_their_own_files(spark, monkeypatch):
    monkeypatch.setattr(documents, "FOLDER", 10)
    monkeypatch.setattr(documents, "RANGE", 40)
    monkeypatch.setattr(documents, "RANGE_GROWTH", 2)
    docs = spark.range(3, 300).select(F.col("id").alias("doc_idx"), F.concat(F.lit("t"), "id").alias("text"))
    scans = []
    store = documents.StoredRanges(docs)
    keep = store._store
    monkeypatch.setattr(store, "_store", lambda *a: (scans.append(a), keep(*a)))
    low, size = 3, 4
    while low < 300:
        rows = store.rows(low, low + size)
        assert sorted(r.doc_idx for r in rows.collect()) == list(range(low, min(low + size, 300)))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        first, last = low // 10, (low + size - 1) // 10
        assert re.search(rf"PartitionFilters: \[.*folder#\d+L? >= {first}\).*folder#\d+L? <= {last}\)", plan)
        low, size = low + size, min(size * 2, 16)
    assert [low for low, _ in scans] == [3, 31, 111, 271]
