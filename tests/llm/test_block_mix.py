"""Targets by repeated sharing, permutations, and word counts of the mix."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusgrove.llm import block_mix

from .helpers import corpus, documents, prose, words


def naive_targets(sizes):
    """Shares by weight, the excess over three times a source shared again until none is left."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full, left = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = 3 * sizes[s]
        left = sum(sizes.values()) - sum(full.values())


def source_sizes(docs):
    out = Counter()
    for r in docs.collect():
        out[r["source"]] += len(words(r["text"]))
    return out


@pytest.mark.parametrize("sources", [("a", "b", None, "Z"), ("big",) * 12 + ("é", "tiny", "z"), (None,), ("only",)])
def test_targets_and_taken_words(spark, sources):
    rows = corpus(60) + [(2000 + k, "w" * 5) for k in range(20)]
    docs = documents(spark, rows, sources)
    mix = block_mix.mix_sources(docs, block_words=16)
    got = block_mix.taken_words(mix).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in got) == sorted((i is None, i or 0, len(words(t))) for i, t in rows)
    sizes = source_sizes(docs)
    want, taken = naive_targets(sizes), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 24


def test_reruns_agree_and_seeds_differ(spark):
    docs = documents(spark, corpus(40))
    runs = [block_mix.taken_words(block_mix.mix_sources(d, block_words=16, seed=s)) for d, s in ((docs, 1), (docs.repartition(7, "text"), 1), (docs, 2))]
    assert runs[0].exceptAll(runs[1]).isEmpty() and not runs[0].exceptAll(runs[2]).isEmpty()


def test_draws_follow_urn_and_permutations(spark):
    mix = block_mix.mix_sources(documents(spark, corpus(60)), block_words=8, shard_slots=64)
    sources = {r["sid"]: r for r in mix.sources.collect()}
    draws = mix.draws.collect()
    assert sorted(r["slot"] for r in draws) == list(range(sum(s["slots"] for s in sources.values())))
    for sid, source in sources.items():
        uses = Counter(r["block"] for r in draws if r["sid"] == sid)
        assert sum(uses.values()) == source["slots"]
        rounds, rest = divmod(source["slots"], source["blocks"])
        # full rounds take every block; the open round takes ``rest`` different ones
        assert Counter(uses[b] for b in range(source["blocks"])) == Counter({rounds + 1: rest, rounds: source["blocks"] - rest}) + Counter()
    counts = block_mix.shard_counts(mix).groupBy("shard").agg(F.sum("blocks").alias("n")).orderBy("shard").collect()
    assert all(r["n"] == 64 for r in counts[:-1])


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 1000])
def test_swap_or_not_is_a_permutation(spark, n):
    made = spark.range(n).select(block_mix._swap_or_not(F.col("id"), F.lit(n), F.lit(7)).alias("x"))
    places = [r["x"] for r in made.collect()]
    assert sorted(places) == list(range(n)) and (n < 10 or places != list(range(n)))


def test_mixed_documents_hold_the_taken_words(spark):
    rows = [(i, t) for i, t in corpus(40)]
    docs = documents(spark, rows)
    mix = block_mix.mix_sources(docs, block_words=32)
    mixed = block_mix.mixed_documents(docs, mix)
    assert mixed.columns == docs.columns
    found, whole = Counter(), {t for _, t in rows}
    for r in mixed.collect():
        found[r["doc_id"], r["source"]] += len(words(r["text"]))
        assert r["n_chars"] == len(r["text"])
        assert r["text"] in whole or any(r["text"].split() and r["text"].split()[0] in (t or "") for t in whole)
    want = Counter()
    for r in block_mix.taken_words(mix).collect():
        want[r["doc_id"], r["source"]] += r["taken"]
    assert found == +want


def test_empty_table_and_texts(spark):
    assert block_mix.taken_words(block_mix.mix_sources(documents(spark, []))).count() == 0
    docs = documents(spark, [(1, None), (2, ""), (2, "")])
    assert [(r["size"], r["target"], r["taken"]) for r in block_mix.taken_words(block_mix.mix_sources(docs)).collect()] == [(0, 0.0, 0)] * 3
    assert block_mix.mixed_documents(docs, block_mix.mix_sources(docs)).count() == 0


def test_a_block_size_for_the_smallest_target_loses_no_source(spark):
    rng = random.Random(8)
    sizes = {"big": 90_000, "small": 3_000, "tiny": 20, "none": 0}
    rows, names = [], []
    for name, n in sizes.items():
        for k in range(max(1, n // 500)):
            rows.append((len(rows), prose(rng, min(n, 500)) if n else ""))
            names.append(name)
    docs = spark.createDataFrame([(i, t, s) for (i, t), s in zip(rows, names)], "doc_id long, text string, source string")
    mix = block_mix.mix_sources(docs, weights=(9000.0, 1.0, 90.0, 0.2), block_words=None, least_slots=1)
    assert mix.block_words == block_mix.LEAST_BLOCK
    taken = Counter()
    for r in block_mix.taken_words(mix).collect():
        taken[r["source"]] += r["taken"]
    targets = {r["source"]: r["target"] for r in mix.sources.collect()}
    assert set(taken) == set(sizes) and all(taken[s] > 0 for s in sizes if sizes[s])
    assert all(abs(taken[s] - targets[s]) <= block_mix.LEAST_BLOCK for s in sizes)
    held = {s for s in (r["source"] for r in block_mix.mixed_documents(docs, mix).collect())}
    assert held == {"big", "small", "tiny"}
    coarse = block_mix.mix_sources(docs, weights=(1.0,), block_words=None)
    smallest = min(r["target"] for r in coarse.sources.collect() if r["target"])
    assert coarse.block_words == max(64, min(2048, int(smallest / 256)))
