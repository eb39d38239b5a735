import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgrove.functions import grammar as G, text as X, vectors as V
from corpusgrove.operators import pairs, prompts as P, similarity as S
from tests import naive

ENCODE = V.hashed_terms(64)


def cos(a, b):
    a, b = np.asarray(a, float), np.asarray(b, float)
    n = np.linalg.norm(a) * np.linalg.norm(b)
    return float(a @ b / n) if n else 0.0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    topics = [(i, f"L{i}", int(rng.integers(1, 9)), rng.normal(size=6).tolist()) for i in range(23)]
    topics[7] = (7, "L7", 3, topics[4][3])
    docs = [(i, rng.normal(size=6).tolist(), int(rng.integers(0, 60))) for i in range(30)]
    docs[0] = (0, [0.0] * 6, 20)
    return (
        topics,
        docs,
        spark.createDataFrame(topics, "ord bigint, label string, tokens bigint, embedding array<double>"),
        spark.createDataFrame(docs, "doc_idx bigint, embedding array<double>, budget int"),
    )


@pytest.mark.parametrize("block", [2, 5, 100])
def test_ranking_per_document(vectors, block):
    topics, docs, t, d = vectors
    budgeted = {r.doc_idx: [x.label for x in r.ranked] for r in S.budgeted_topics(d, t, F.col("budget"), block_rows=block).collect()}
    floored = {r.doc_idx: [x.label for x in r.ranked] for r in S.half_context_topics(d, t, 60, 4, block_rows=block).collect()}
    top = {r.doc_idx: [x.label for x in r.ranked] for r in S.similar_topics(d, t, 3, block_rows=block).collect()}
    for i, vector, budget in docs:
        scored = [(round(cos(vector, v), 12), size, label) for _, label, size, v in topics]
        assert budgeted[i] == naive.budget_prefix(scored, budget)
        assert floored[i] == naive.floor_prefix(scored, 30, 4)
        assert top[i] == [x[2] for x in sorted(scored, key=lambda x: -x[0])[:3]]


def test_tasks_hold_one_block_of_topics_at_a_time(vectors, monkeypatch):
    topics, docs, t, d = vectors
    monkeypatch.setattr(S, "BLOCK_BYTES", 3 * 6 * 8)
    monkeypatch.setattr(S.DataFrame, "toPandas", lambda self: pytest.fail("topics came to the driver"))
    ranked = S.similar_topics(d, t, 4, block_rows=100)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    for r in ranked.collect():
        scored = [(round(cos(docs[r.doc_idx][1], v), 12), -i, label) for i, label, _, v in topics]
        assert [x.label for x in r.ranked] == [label for _, _, label in sorted(scored, reverse=True)[:4]]


@pytest.mark.parametrize("block,group", [(2, 1), (4, 2), (256, 16)])
def test_pairs_across_blocks(vectors, monkeypatch, block, group):
    monkeypatch.setattr(pairs, "BLOCK", block)
    monkeypatch.setattr(pairs, "GROUP", group)
    topics, _, t, _ = vectors
    scored = {(a[0], b[0]): round(cos(a[3], b[3]), 12) for a in topics for b in topics if a[0] < b[0]}
    for threshold in (0.4, -0.2):
        got = S.topic_pairs(t.select("ord", "embedding"), threshold).collect()
        want = {p for p, s in scored.items() if s > threshold}
        assert {(r.i, r.j) for r in got} == want and len(got) == len(want)
    best = sorted((-s, p) for p, s in scored.items() if s > 0.1)[:4]
    got = pairs.closest_pairs(t.select("ord", "embedding"), 4, 0.1, wave=1)
    assert [(r.i, r.j) for r in got.collect()] == [p for _, p in best]


@pytest.mark.parametrize("block_bytes", [0, 1 << 20])
def test_listed_topics_are_the_ranked_ones_as_text(spark, monkeypatch, block_bytes):
    rng = random.Random(5)
    words = ["tax", "art", "sea", "law", "sun"]
    labels = sorted({" ".join(rng.choices(words, k=rng.randint(0, 4))) for _ in range(40)})
    made = [(k, f"{label} #", len(label) % 7 + 1, ENCODE([label])[0].tolist()) for k, label in enumerate(labels)]
    topics = spark.createDataFrame(made, "ord bigint, label string, tokens int, embedding array<double>")
    texts = [None, "", *[" ".join(rng.choices(words, k=9)) for _ in range(20)]]
    docs = spark.createDataFrame([(i, None if t is None else ENCODE([t])[0].tolist()) for i, t in enumerate(texts)], "id int, v array<double>")
    budget = F.col("id") * 7
    for line, ranked in ((True, S.budgeted_topics(docs, topics, budget, "v")), (False, S.half_context_topics(docs, topics, 50, 3, "v"))):
        want = {r.id: ("".join(t.label + "\n" for t in r.ranked) if line else "\n".join(t.label for t in r.ranked), sum(t.tokens for t in r.ranked)) for r in ranked.collect()}
        want[0] = (None, None)
        with monkeypatch.context() as m:
            m.setattr(S, "BLOCK_BYTES", block_bytes)
            m.setattr(S, "TEXT_BYTES", 100)
            listed = S.budgeted_list(docs, topics, budget, "v") if line else S.half_context_list(docs, topics, 50, 3, "v")
            assert {r.id: (r.listed, r.listed_tokens) for r in listed.collect()} == want


def clustered(spark, n=600, clusters=12):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(clusters, 24))
    rows = [(k, (centres[k % clusters] + 0.05 * rng.normal(size=24)).tolist()) for k in range(n)]
    return rows, spark.createDataFrame(rows, "ord bigint, embedding array<double>")


def test_clusters_out_of_reach_are_never_joined(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 10)
    monkeypatch.setattr(pairs, "GROUP", 2)
    rows, df = clustered(spark)
    stored, width, _ = pairs.stored(df)
    laid = pairs.layout(stored, width)
    bounds = laid.group_pairs().collect()
    assert len(bounds) == laid.groups * (laid.groups + 1) // 2
    near = sum(r.bound > 0.9 for r in bounds)
    assert near < 0.25 * len(bounds)
    got = {(r.i, r.j) for r in pairs.topic_pairs(df, 0.9).collect()}
    m = pairs.unit_rows([v for _, v in rows])
    s = np.round(m @ m.T, 12)
    assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(s > 0.9)) if i < j}


def test_best_pairs_visit_few_groups(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 10)
    monkeypatch.setattr(pairs, "GROUP", 1)
    rows, df = clustered(spark)
    visited = []
    product = pairs._products
    monkeypatch.setattr(pairs, "_products", lambda laid, turn, *a: (visited.append(turn.count()), product(laid, turn, *a))[1])
    copies = df.unionByName(df.filter("ord < 40").withColumn("ord", F.col("ord") + 1000))
    got = pairs.closest_pairs(copies, 5, 0.5, wave=8)
    assert [(r.i, r.j) for r in got.collect()] == [(k, k + 1000) for k in range(5)]
    stored, width, _ = pairs.stored(copies)
    groups = pairs.layout(stored, width).groups
    assert sum(visited) < 0.25 * groups * (groups + 1) / 2


def test_groups_of_best_pairs_grow_with_the_vectors(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 2)
    monkeypatch.setattr(pairs, "GROUP", 1)
    monkeypatch.setattr(pairs, "GROUPS", 3)
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=6).tolist()) for k in range(150)]
    df = spark.createDataFrame(rows, "ord bigint, embedding array<float>")
    numbers = []
    products = pairs._products
    monkeypatch.setattr(pairs, "_products", lambda laid, *a: (numbers.append(laid.groups), products(laid, *a))[1])
    got = [(r.i, r.j) for r in pairs.closest_pairs(df, 4, 0.1).collect()]
    m = pairs.unit_rows([np.float32(v).astype(float) for _, v in rows])
    s = np.round(m @ m.T, 12)
    assert got == sorted(((i, j) for i in range(150) for j in range(i + 1, 150)), key=lambda p: (-s[p], p))[:4]
    assert max(numbers) <= 8


def test_best_pairs_count_a_label_pair_once(spark):
    rows = [(0, "a", [1.0, 0.0]), (1, "a", [1.0, 0.0]), (2, "b", [1.0, 0.01]), (3, "c", [1.0, 0.5]), (4, "d", [0.0, 0.0]), (5, "e", None)]
    t = spark.createDataFrame(rows, "ord bigint, label string, embedding array<double>")
    got = [(r.i, r.j, r.a, r.b) for r in S.best_label_pairs(t, 3, 0.1).orderBy(F.desc("score"), "i", "j").collect()]
    assert got == [(0, 1, "a", "a"), (0, 2, "a", "b"), (2, 3, "b", "c")]
    assert [(r.i, r.j) for r in pairs.topic_pairs(t, -0.5).filter("j = 4").orderBy("i").collect()] == [(0, 4), (1, 4), (2, 4), (3, 4)]
    assert pairs.closest_pairs(t.limit(0), 3, 0.1).collect() == pairs.topic_pairs(t.limit(0), 0.1).collect() == []


def test_top_pairs_skip_asked_ones(spark):
    pairs = spark.createDataFrame(
        [(0, 1, 0.9, "a", "b"), (0, 2, 0.9, "a", "c"), (1, 2, 0.8, "b", "c"), (3, 4, 0.95, "b", "a")],
        "i bigint, j bigint, score double, a string, b string",
    ).withColumn("pair", F.array_sort(F.array("a", "b")))
    assert [(r.i, r.j) for r in S.top_pairs(pairs, 2).collect()] == [(3, 4), (0, 2)]
    asked = S.prompted_pairs(None, pairs.filter("i = 0 and j = 1"))
    assert [(r.i, r.j) for r in S.top_pairs(S.unprompted_pairs(pairs, asked), 5).collect()] == [(0, 2), (1, 2)]


def test_embedding_and_cosine(spark):
    df = spark.createDataFrame([("Trade and trade", "trade"), (None, "x"), ("", "")], "a string, b string")
    rows = df.select(V.embed(F.col("a"), ENCODE).alias("a"), V.embed(F.col("b"), ENCODE).alias("b")).withColumn("c", V.cosine(F.col("a"), F.col("b"))).collect()
    assert sum(rows[0].a) == 3 and rows[0].c == pytest.approx(cos(rows[0].a, rows[0].b)) and rows[1].c == 0 and rows[2].c == 0 and rows[1].a is None


def test_term_counts_are_the_encoder_without_a_worker(spark):
    texts = ["Trade and trade_2 and TRADE", "", "  ", "Ünï çødé 12 ½ 中文 don't", None, "a " * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", V.embed(F.col("t")).alias("v"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    encode = V.hashed_terms()
    for r in df.collect():
        assert r.v == (None if texts[r.i] is None else encode([texts[r.i]])[0].tolist())


TREE = [(1, w, 1, f"about {w} and {v}") for w, v in zip("Trade Energy Law Art Sport Health Water Tax".split(), "goods power courts paint games care rivers money".split())]
DOCS = ["trade goods " * 3, "power and energy " * 10, "water rivers " * 60, "courts law tax money " * 20, "x", "games " * 200]


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(DOCS)], "doc_idx bigint, text string")
    return docs, naive.tree_rows(spark, naive.nest(TREE))


def scored(doc, labels):
    vd = ENCODE([doc])[0]
    return [(round(cos(vd, ENCODE([x])[0]), 12), naive.count(x), x) for x in labels]


@pytest.mark.parametrize("context,with_desc", [(1000, False), (130, False), (130, True), (70, False)])
def test_generation_prompts(corpus, context, with_desc):
    docs, tree = corpus
    template = "Topics:\n{Topics}\nDocument:\n{Document}"
    bare = [f"[1] {n}" for _, n, _, _ in TREE]
    labels = [f"[1] {n}: {d}" for _, n, _, d in TREE] if with_desc else bare
    rows = P.generation_prompts(docs, tree, template, context, with_desc, max_topic_tokens=10, encode=ENCODE).orderBy("doc_idx").collect()
    room = context - naive.count(template)
    fits = set()
    for row, doc in zip(rows, DOCS):
        topics = "\n".join(bare)
        if naive.count(doc) + naive.count(topics) > room:
            if naive.count(doc) > room - 10:
                doc, fit = naive.truncate(doc, room - 10), "cut_document"
            else:
                fit = "prune_topics"
                topics = "".join(x + "\n" for x in naive.budget_prefix(scored(doc, labels), room - naive.count(doc)))
        else:
            fit = "whole"
        fits.add(fit)
        assert (row.fit, row.prompt) == (fit, template.format(Topics=topics, Document=doc))
    assert context == 1000 or len(fits) > 1


@pytest.mark.parametrize("context", [1000, 150, 40])
def test_assign_prompts(corpus, context):
    docs, tree = corpus
    template = "Tree {tree} Doc {Document}"
    labels = [f"[1] {n}: {d}" for _, n, _, d in TREE]
    rows = P.assign_prompts(docs, tree, template, context, encode=ENCODE).orderBy("doc_idx").collect()
    for row, doc in zip(rows, DOCS):
        shown = "\n".join(labels)
        if naive.count(shown) > context:
            shown = "".join(x + "\n" for x in naive.budget_prefix(scored(doc, labels), context))
        doc = naive.truncate(doc, context - naive.count(template) - naive.count(shown))
        assert (row.prompted_docs, row.prompt) == (doc, template.format(tree=shown, Document=doc))


@pytest.mark.parametrize("context", [2000, 160, 60])
def test_correct_prompts(corpus, context):
    docs, tree = corpus
    template = "Tree {tree} Doc {Document} {Message}"
    labels = [f"[1] {n}: {d}" for _, n, _, d in TREE]
    asked = docs.select("doc_idx", F.col("text").alias("prompted_docs"), F.lit("[1] Old: x").alias("responses"))
    rows = P.correct_prompts(asked, tree, template, context, floor=3, encode=ENCODE).orderBy("doc_idx").collect()
    message = "Previously, this document was assigned to: [1] Old: x. Please reassign it to an existing topic in the hierarchy."
    for row, doc in zip(rows, DOCS):
        shown = "\n".join(labels)
        if naive.count(doc) + naive.count(template) + naive.count(shown) > context:
            shown = "\n".join(naive.floor_prefix(scored(doc, labels), context // 2, 3))
            doc = naive.truncate(doc, context - naive.count(template) - naive.count(shown))
        assert row.prompt == template.format(tree=shown, Document=doc, Message=message)


def test_context_lengths():
    assert [G.context_length(m) for m in ("gpt-4", "gpt-3.5-turbo", "")] == [7000, 3096, 127000]
    assert G.REASSIGN_MESSAGE[1].startswith(". Please")
    assert X.DEFAULT_TOKENS.count is X.count_tokens


@pytest.mark.parametrize("context", [15, 40, 90, 100_000])
def test_prompts_bring_their_tokens_along(corpus, context):
    docs, tree = corpus
    docs = docs.unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    made = [P.generation_prompts(docs, tree, "Known:\n{Topics}\nText {Document}.", context, max_topic_tokens=8), P.assign_prompts(docs, tree, "{tree}#{Document}", context)]
    again = docs.select("doc_idx", F.col("text").alias("prompted_docs"), F.lit("[1] Ghost: x").alias("responses"))
    made.append(P.correct_prompts(again, tree, "{tree}#{Document}#{Message}", context, floor=2))
    for prompts in made:
        rows = prompts.select("prompt", P.PROMPT_TOKENS, X.count_tokens(F.col("prompt")).alias("n")).collect()
        assert [r[1] for r in rows if r.prompt is not None] == [r.n for r in rows if r.prompt is not None]
    assert P.PROMPT_TOKENS not in P.assign_prompts(docs, tree, "{tree}{Document}", context).columns
    assert X.template_fields("a{x} {y}") is None and X.template_fields("{x}b") is None and X.template_fields("a {x}: {x}") == ["x", "x"]


def test_cosines_of_counts_are_one_quotient():
    rng = np.random.default_rng(4)
    topics, vector = rng.integers(0, 3, (200, 16)).astype(float), rng.integers(0, 50, 16).astype(float)
    sizes, slots = (topics > 0).sum(1), np.nonzero(topics)[1]
    lengths = np.sqrt((topics**2).sum(1))
    block = S.Sparse(np.append(0, np.cumsum(sizes)), slots, topics[topics > 0], lengths, np.array(["x"] * 200), np.ones(200))
    assert (block.similarities(vector) == topics @ vector / (lengths * np.sqrt((vector**2).sum()))).all()


def test_encoder_hashes_a_word_once_and_remembers_few(monkeypatch):
    hashed = []
    md5 = V.hashlib.md5
    monkeypatch.setattr(V.hashlib, "md5", lambda b: hashed.append(b) or md5(b))
    encode = V.hashed_terms(16)
    first = encode(["trade and trade", "law"])
    assert (encode(["trade and trade", "law"]) == first).all() and first.sum() == 4 and len(hashed) == 3
    monkeypatch.setattr(V, "WORDS", 2)
    assert (V.hashed_terms(16)(["trade and trade", "law"]) == first).all()


def test_corrections_rank_topics_in_one_worker_and_only_where_a_text_may_not_fit(spark):
    tree = spark.createDataFrame([([i], lvl, name, 1, desc) for i, (lvl, name, _, desc) in enumerate(TREE)], "path array<long>, lvl int, name string, count long, desc string")
    docs = spark.createDataFrame([(i, d, f"[1] Other {i}: no") for i, d in enumerate(DOCS)], "doc_idx long, prompted_docs string, responses string")
    template = "Pick.\n{tree}\n#\n{Document}\n#\n{Message}"
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    cut = P.correct_prompts(docs, tree, template, 130, 2)
    assert "ArrowEvalPython" not in plan(cut) and plan(cut).count("MapInArrow") == 1
    longest = max(map(len, DOCS))
    for context in (130, 100_000):
        known = P.correct_prompts(docs, tree, template, context, 2, longest=longest)
        assert ("MapInArrow" in plan(known)) == (context == 130)
        want = P.correct_prompts(docs, tree, template, context, 2)
        pick = lambda df: {r.doc_idx: (r.prompt, r[P.PROMPT_TOKENS]) for r in df.collect()}
        assert pick(known) == pick(want)


@pytest.mark.parametrize("keep", [S._within_budget, S._with_floor(7)])
def test_topics_of_one_vector_are_ranked_once_and_only_as_far_as_they_fit(keep):
    rng = np.random.default_rng(8)
    vectors = np.where(rng.random((900, 12)) < 0.2, rng.integers(1, 3, (900, 12)), 0).astype(float)
    vectors[:300] = vectors[0]
    sizes, slots = (vectors > 0).sum(1), np.nonzero(vectors)[1].astype(np.int32)
    tokens, labels = rng.integers(0, 5, 900), np.array([f"[1] ñ{k}" for k in range(900)], dtype=object)
    block = S.Sparse(np.append(0, np.cumsum(sizes)), slots, vectors[vectors > 0], np.sqrt((vectors**2).sum(1)), labels, tokens)
    of, members, counts, upto, distinct, *rest = S._ranking(block)
    ranking = S.Ranking(of, members, counts, upto, S.Sparse(*distinct), *rest)
    assert len(counts) == len({v.tobytes() for v in vectors}) < 600
    for budget in (-3, 0, 1, 9, 60, 200, 900, 1e9):
        document = rng.integers(0, 3, 12).astype(float)
        order = S._order(block.similarities(document))
        want = order[: keep(tokens[order], budget)]
        got = ranking.kept(document, budget, keep)
        assert got.tolist() == want.tolist()
        assert ranking.text(got, "join").decode() == "\n".join(labels[want])
        assert ranking.text(got, "line").decode() == "".join(f"{x}\n" for x in labels[want])


def test_asked_pairs_are_told_apart_in_one_shuffle(spark):
    pairs = spark.createDataFrame([(["a", "b"], 1), (["a", "c"], 2), (["a", "b"], 3)], "pair array<string>, i int")
    asked = spark.createDataFrame([(["a", "c"],), (["c", "d"],)], "pair array<string>")
    grown = S.prompted_pairs(asked, pairs)
    assert sorted(r.pair for r in grown.collect()) == [["a", "b"], ["a", "c"], ["c", "d"]]
    assert grown._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") + grown._jdf.queryExecution().sparkPlan().toString().count("SortAggregate") == 2
    assert sorted(r.pair for r in S.prompted_pairs(None, pairs).collect()) == [["a", "b"], ["a", "c"]]
