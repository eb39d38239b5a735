import json
import time
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgrove.functions import vectors as V
from corpusgrove.operators import backend as B, grounding as R, metrics as M, tree as T
from corpusgrove.plans import assign
from corpusgrove.plans.assign import assign_topics, correct_topics
from corpusgrove.plans.generate import generate_topics_level1, generate_topics_level2
from corpusgrove.plans.refine import refine_topics
from corpusgrove.plans import stages
from corpusgrove.plans.stages import align, run_stages
from corpusgrove.sources import documents as SD, topics as ST
from corpusgrove.storage import materialize, path_exists, release_scratch, scratch_path
from corpusgrove.streaming import assign_stream
from tests import naive

ENCODE = V.hashed_terms(64)


def one(fn, **options):
    return B.Backend(B.one_by_one(fn), **options)


# ------------------------------------------------------------ completion


def test_retries_errors_and_skips(spark, tmp_path):
    marker = str(tmp_path / "calls")

    def flaky(prompts):
        with open(marker, "a") as f:
            f.write("x")
        if prompts[0] == "bad" or (prompts[0] == "twice" and open(marker).read().count("x") < 2):
            raise RuntimeError
        return [p.upper() for p in prompts]

    df = spark.createDataFrame([(0, "twice"), (1, "bad"), (2, None), (3, "ok")], "i int, p string").coalesce(1)
    rows = materialize(B.complete(df, "p", flaky, wait=0.0), "answers").orderBy("i").collect()
    assert [(r.response, r.status, r.attempts) for r in rows] == [
        ("TWICE", "ok", 2), ("Error", "error", 3), (None, "skipped", 0), ("OK", "ok", 1)
    ]


def test_prompts_put_together_in_the_worker_are_those_of_a_column(spark):
    fields = {"Topics": ("__topics", "[1] Tråde\n[1] Law"), "Document": ("__document", None)}
    parts = B.Parts("Known {{all}}:\n{Topics}\nText: {Document}.", fields)
    rows = [(0, None, "eins"), (1, "[1] Own", "zwei"), (2, "", "drei"), (3, None, None), (4, "[1] Own", None)]
    df = spark.createDataFrame(rows, "i int, __topics string, __document string").withColumn("__prompt_tokens", F.col("i").cast("long")).coalesce(1)
    echo = lambda prompts: [f"{len(prompts)} {p}" for p in prompts]
    made = B.complete(df, parts, echo, batch_size=2)
    assert "prompt" not in made.columns and "__document" not in made.columns
    whole = B.complete(df.withColumn("prompt", parts.column()), "prompt", echo, batch_size=2)
    columns = ["i", "response", "status", "attempts", "prompt_hash", "error", "prompt_tokens", "response_tokens"]
    got = [tuple(r) for r in made.select(columns).orderBy("i").collect()]
    assert got == [tuple(r) for r in whole.select(columns).orderBy("i").collect()]
    assert got[0][1] == "2 Known {all}:\n[1] Tråde\n[1] Law\nText: eins." and [r[2] for r in got] == ["ok"] * 3 + ["skipped"] * 2
    # tokens that are not known are counted in the prompt
    assert B.complete(df.drop("__prompt_tokens"), parts, echo).orderBy("i").first()["prompt_tokens"] == 17


def test_batches_reach_the_completer_whole(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) p").coalesce(1)
    rows = B.complete(df, "p", lambda ps: [f"{p}/{len(ps)}" for p in ps], batch_size=4).orderBy("id").collect()
    assert [r.response for r in rows] == [f"{i}/{4 if i < 8 else 2}" for i in range(10)]
    short = B.complete(df, "p", lambda ps: ps[: len(ps) - 1], batch_size=4, wait=0.0).collect()
    assert {(r.status, r.error) for r in short} == {("error", "ValueError: a completer must answer every prompt of its batch")}


def test_one_bad_prompt_does_not_fail_its_batch(spark):
    def picky(prompts):
        if "3" in prompts:
            raise RuntimeError("no threes")
        return prompts

    df = spark.range(8).selectExpr("id", "cast(id as string) p").coalesce(1)
    rows = B.complete(df, "p", picky, batch_size=4, wait=0.0).orderBy("id").collect()
    assert [r.status for r in rows] == ["ok"] * 3 + ["error"] + ["ok"] * 4
    assert [r.attempts for r in rows] == [4] * 4 + [1] * 4
    assert [r.error for r in B.failed_calls(B.complete(df, "p", picky, batch_size=4, wait=0.0)).collect()] == ["RuntimeError: no threes"]


def test_prompts_sent_one_by_one_cost_little_more_than_batches(spark):
    df = spark.range(4000).coalesce(1).select("id", F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("p"))

    def seconds(size):
        begin = time.time()
        rows = B.complete(df, "p", lambda ps: [p + "!" for p in ps], batch_size=size).collect()
        assert all((r.response, r.status) == ((f"{r.id}!", "ok") if r.p else (None, "skipped")) for r in rows)
        return time.time() - begin

    seconds(1000)
    assert seconds(1) < seconds(1000) + 3


def test_settings_reach_completers_that_take_them(spark):
    df = spark.createDataFrame([(0, "p")], "i int, p string")
    say = lambda p, settings: f"{settings.temperature} {settings.top_p} {settings.max_tokens} {settings.system}"
    assert B.Backend(B.one_by_one(say)).answer(df, "p", B.CORRECTION).first().response == "0.6 0.9 1000 You are a helpful assistant."
    own = B.Backend(B.one_by_one(say), settings=B.Settings(temperature=0.3, max_tokens=5, system="s"))
    assert own.answer(df, "p").first().response == "0.3 1.0 5 s"


def test_store_answers_a_prompt_once(spark, tmp_path):
    marker = tmp_path / "calls"

    def answer(prompts):
        with open(marker, "a") as f:
            f.write("".join(f"{p}\n" for p in prompts))
        if prompts == ["bad"] and marker.read_text().count("bad") == 1:
            raise RuntimeError("first time")
        return [p.upper() for p in prompts]

    backend = B.Backend(answer, store=str(tmp_path / "store"), tries=1, wait=0.0)
    df = spark.createDataFrame([(0, "a"), (1, "a"), (2, "bad"), (3, None), (4, "b")], "i int, p string")
    first = [(r.response, r.status) for r in backend.answer(df, "p").orderBy("i").collect()]
    assert first == [("A", "ok"), ("A", "ok"), ("Error", "error"), (None, "skipped"), ("B", "ok")]
    again = [(r.response, r.status) for r in backend.answer(df, "p").orderBy("i").collect()]
    assert again == [("A", "ok"), ("A", "ok"), ("BAD", "ok"), (None, "skipped"), ("B", "ok")]
    assert sorted(marker.read_text().split()) == ["a", "b", "bad", "bad"]
    backend.answer(df, "p", B.CORRECTION).collect()  # other settings, other answers
    assert marker.read_text().split().count("a") == 2


def test_replay_takes_one_of_several_recordings(spark):
    asked = spark.createDataFrame([(0, "p"), (1, "p")], "i int, prompt string")
    recorded = spark.createDataFrame([("p", "Error"), ("p", "yes"), ("p", "yes"), ("p", "zes")], "p string, response string")
    rows = B.replay_responses(asked, "prompt", recorded.select(B.prompt_hash(F.col("p")).alias("prompt_hash"), "response")).collect()
    assert [(r.response, r.status) for r in rows] == [("yes", "ok")] * 2


def test_replay_and_usage(spark):
    asked = spark.createDataFrame([(0, "p"), (1, "q"), (2, None)], "i int, prompt string")
    recorded = spark.createDataFrame([("p", "[1] A: x")], "p string, response string").select(B.prompt_hash(F.col("p")).alias("prompt_hash"), "response")
    rows = B.Backend(recorded=recorded).answer(asked, "prompt").orderBy("i").collect()
    assert [(r.response, r.status) for r in rows] == [("[1] A: x", "ok"), ("Error", "error"), (None, "skipped")]
    calls = spark.createDataFrame([("a", "x y", "z"), ("b", "x", "z z")], "stage string, prompt string, response string")
    report = {r.stage: r for r in B.usage_report(calls).collect()}
    assert (report[None].prompt_tokens, report[None].response_tokens) == (3, 3)
    assert report["a"].cost == pytest.approx((2 * 5 + 15) / 1e6)


# ------------------------------------------------------------ files


def test_corpus_index_follows_file_order(spark, tmp_path):
    rows = [{"id": f"00{i}", "text": f"line {i} " + "x" * 50, "label": None if i % 3 else "L"} for i in range(500)]
    lines = [json.dumps(r) for r in rows]
    lines.insert(100, "")
    (tmp_path / "c.jsonl").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        df = SD.read_corpus(spark, str(tmp_path / "c.jsonl"))
        assert df.rdd.getNumPartitions() > 3
        got = df.orderBy("doc_idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.doc_idx, r.id, r.label) for r in got] == [(i, r["id"], r["label"]) for i, r in enumerate(rows)]


def test_corpus_index_survives_other_splits(spark, tmp_path):
    rows = [{"id": str(i), "text": "x" * (i % 90), "label": None} for i in range(500)]
    for k in range(3):
        part = rows[k * 200 : k * 200 + 200]
        (tmp_path / f"part-{k}.json").write_text("".join(json.dumps(r) + "\n" for r in part))
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    try:
        df = SD.read_corpus(spark, str(tmp_path))
        for size in ("8000", "4000", "1000000"):
            for n in names:
                spark.conf.set(n, size)
            got = df.orderBy("doc_idx").collect()
            assert [(r.doc_idx, r.id) for r in got] == [(i, str(i)) for i in range(500)]
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_sinks_replace_what_is_there(spark, tmp_path):
    docs = spark.createDataFrame([(0, "a", "t", "l")], "doc_idx long, id string, text string, label string")
    mapping = spark.createDataFrame([(0, "A0", "B0"), (1, 'q"', "x")], "seq long, old string, new string")
    for path in (str(tmp_path / "m.json"), str(tmp_path / "m")):
        for table in (mapping.limit(0), mapping):
            ST.write_mapping(table, path)
            assert [tuple(r) for r in ST.read_mapping(spark, path).orderBy("seq").collect()] == [tuple(r) for r in table.orderBy("seq").collect()]
    for _ in range(2):
        SD.write_documents(docs, str(tmp_path / "d.jsonl"))
    assert SD.read_corpus(spark, str(tmp_path / "d.jsonl")).count() == 1


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_idx")
    for n in (0, 1, 777, 5000):
        first = sorted(r.doc_idx for r in SD.sample_corpus(df, n, seed=3).collect()) if n else []
        assert len(first) == len(set(first)) == n
        if n:
            assert first == sorted(r.doc_idx for r in SD.sample_corpus(df.repartition(7), n, seed=3).collect())
    with pytest.raises(ValueError):
        SD.sample_corpus(df, 5001)


# ------------------------------------------------------------ grounding and metrics

# Labels and topics of the published sample.
GOLDEN = [("Public Lands", "Environment"), ("Public Lands", "Environment"), ("Energy", "Environment"), ("Transportation", "Environment"), ("Immigration", "Immigration")]


def test_scores_of_the_sample_run(spark):
    rows = [(i, t, f"[1] {p}: reason (\"quote\")") for i, (t, p) in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "doc_idx bigint, label string, responses string")
    cells = M.contingency(M.with_first_topic(df, "responses"), "label", "pred").cache()
    assert M.purity(cells).first()[0] == pytest.approx(0.6)
    assert M.inverse_purity(cells).first()[0] == pytest.approx(1.0)
    assert [round(x, 6) for x in align(df).first()] == [0.626667, 0.137931, 0.546118]
    bad = df.withColumn("responses", F.lit("None"))
    with pytest.raises(Exception, match="names no topic"):
        align(bad).collect()


def naive_scores(pairs):
    n = len(pairs)
    same = [(a[0] == b[0], a[1] == b[1]) for i, a in enumerate(pairs) for j, b in enumerate(pairs) if i != j]
    tp, fn = sum(x and y for x, y in same), sum(x and not y for x, y in same)
    fp, tn = sum(y and not x for x, y in same), sum(not x and not y for x, y in same)
    ari = 1.0 if fn == fp == 0 else 2.0 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn))

    def entropy(values):
        p = np.unique(values, return_counts=True)[1] / n
        return float(-(p * np.log(p)).sum())

    truth, pred = [p[0] for p in pairs], [p[1] for p in pairs]
    ht, hp, hj = entropy(truth), entropy(pred), entropy([f"{a}|{b}" for a, b in pairs])
    mi = max(ht + hp - hj, 0.0)
    nmi = 1.0 if len(set(truth)) == len(set(pred)) == 1 else (0.0 if mi < 1e-12 else mi / ((ht + hp) / 2))
    hpurity = sum(
        truth.count(t) * max(2 * pairs.count((t, p)) / (truth.count(t) + pred.count(p)) for p in set(pred)) for t in set(truth)
    ) / n
    return hpurity, ari, nmi


@pytest.mark.parametrize("case", ["random", "one", "each", "same"])
def test_scores_against_pair_counting(spark, case):
    rng = random.Random(4)
    pairs = {
        "random": [(rng.choice("abc"), rng.choice("wxyz")) for _ in range(40)],
        "one": [("a", "x")] * 5,
        "each": [(str(i), "x") for i in range(6)],
        "same": [(k, k) for k in "aabbc"],
    }[case]
    df = spark.createDataFrame(pairs, "truth string, pred string")
    got = M.alignment_report(M.contingency(df)).first()
    assert list(got) == pytest.approx(list(naive_scores(pairs)), abs=1e-9)


def test_grounding(spark):
    rows = ["[1] Law: r", "[1] law: r", "None", "[1] Law: r\n[2] Ghost: r", "[1] R&D's: r", "[1] C++: r", "", " [1] Law: lead"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "doc_idx bigint, responses string")
    names = spark.createDataFrame([("Law",), ("R&D's",), ("C++",)], "name string")
    got = {r.doc_idx: r.reason for r in R.reprompt_set(df, names).collect()}
    assert got == {1: "hallucinated", 2: "error", 3: "hallucinated", 5: "error", 6: "error", 7: "error"}
    assert {r.doc_idx: r.reason for r in R.with_reason(df, names).collect() if r.reason} == got
    assert tuple(R.grounding_report(df, names).first()) == (4, 2)
    assert {r.topic: r.docs for r in R.ungrounded_topics(df, names).collect()} == {"law": 1, "Ghost": 1}
    assert R.grounding_report(df.filter("doc_idx = 0"), names).first().errors == 0


# ------------------------------------------------------------ stages

WORDS = ["trade", "energy", "court", "paint", "river"]


def corpus(spark, n=30):
    rows = [(i, f"{WORDS[i * i % 5]} {WORDS[i % 3]} text {i}") for i in range(n)]
    return spark.createDataFrame(rows, "doc_idx bigint, text string")


def name_first(prompt):
    return f"[1] {prompt.split('D:')[1].split()[0].capitalize()}: from {prompt.split()[-1]}"


@pytest.mark.parametrize("first,growth", [(1, 1), (4, 2), (100, 2)])
def test_level1_does_not_depend_on_rounds(spark, first, growth):
    docs = corpus(spark, 9 if first == 1 else 30)
    tree, kept = generate_topics_level1(docs, one(name_first), "T:{Topics} D:{Document}", early_stop=6, first_round=first, growth=growth)
    answers = [(name_first(f"D:{r.text}"), "ok") for r in docs.orderBy("doc_idx").collect()]
    want, n = naive.fold_level1(answers, 6)
    assert naive.dump_table(tree) == naive.dump(want) and kept.count() == n


def test_single_document_rounds_show_the_latest_tree(spark):
    docs = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "doc_idx bigint, text string")
    fn = lambda p: f"[1] {p.split('D:')[1]}: seen {p.split('D:')[0].strip()!r}".replace(":", ";").replace("; seen", ": seen")
    tree, _ = generate_topics_level1(docs, one(fn), "{Topics} D:{Document}", first_round=1, growth=1)
    assert [r.desc for r in tree.orderBy("path").collect()] == ["seen ''", "seen '[1] a'", "seen '[1] a\\n[1] b'"]


def test_level1_stops_at_a_failing_call(spark):
    def fail(prompt):
        if prompt.endswith("text 7"):
            raise RuntimeError
        return name_first(prompt)

    tree, kept = generate_topics_level1(corpus(spark), one(fail, wait=0.0), "T:{Topics} D:{Document}")
    rows = kept.orderBy("doc_idx").collect()
    assert [r.doc_idx for r in rows] == list(range(8)) and rows[-1].responses == "Error"
    assert sum(r["count"] for r in tree.collect()) == 7


def test_level2(spark):
    root = naive.nest([(1, "Trade", 5, "x"), (1, "Energy", 4, "x"), (1, "Rare", 0, "x")])
    rows = [(i, f"doc {i} " + "w " * 20, ["[1] Trade: a", "[1] Energy: b", "None"][i % 3]) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_idx bigint, text string, responses string")
    template = "{Topic}|{Document}"
    budget = 60

    def answer(prompt):
        topic, text = prompt.split("|", 1)
        if "Energy" in topic and "doc 1 " in text:
            raise RuntimeError
        return f"{topic}\n  [2] {topic[4:]} Sub (Document: 1): {text.count('Document')} documents."

    start = naive.tree_rows(spark, root)
    tree, prompts = generate_topics_level2(docs, start, one(answer, wait=0.0), template, budget + 13, max_tokens=10)
    got = prompts.orderBy("prompt_idx").collect()
    room = budget + 13 - naive.count(template) - 10
    want, answers = [], []
    for topic, k in (("[1] Trade", 0), ("[1] Energy", 1)):
        texts = [r[1] for r in rows if r[0] % 3 == k]
        blocks = [f"Document {i + 1}\n" + naive.truncate(t, room // 5) + "\n" for i, t in enumerate(texts)]
        batches = naive.pack([naive.count(b) for b in blocks], room)
        want += [(topic, "".join(b for b, x in zip(blocks, batches) if x == n)) for n in range(batches[-1] + 1)]
    assert [(r.topic, r.text) for r in got] == want
    assert [r.status for r in got].count("error") == 1
    for r in got:
        if r.status == "ok":
            answers.append(r.topics)
    assert naive.dump_table(tree) == naive.dump(naive.fold_subtopics(root, answers))
    _, capped = generate_topics_level2(docs, start, one(lambda p: "None"), template, budget + 13, max_tokens=10, max_topics=1)
    assert {r.topic for r in capped.collect()} == {"[1] Trade"}


def naive_refine(root, answer, threshold):
    """Ask about the two best unseen pairs until none is left."""
    asked, mapping = [], {}
    while True:
        labels = [f"[{n.lvl}] {n.name}: {n.desc}" for n in naive.walk(root)]
        m = ENCODE(labels)
        unit = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        pairs = [(-round(float(unit[i] @ unit[j]), 12), i, j) for i in range(len(labels)) for j in range(i + 1, len(labels))]
        chosen = []
        for minus, i, j in sorted(pairs):
            key = sorted([labels[i], labels[j]])
            if len(chosen) < 4 and -minus > threshold and key not in asked:
                chosen += [labels[i], labels[j]]
                asked.append(key)
        if not chosen:
            return mapping
        for originals, name, desc in answer(chosen):
            naive.merge(root, originals, name, desc)
            for old, _ in originals:
                mapping[old] = name


def merge_if_even(labels):
    names = [x.split("] ")[1].split(":")[0] for x in labels[:2]]
    return [([(names[0], 1), (names[1], 1)], names[0], "merged, both")] if len(names[0]) % 2 == 0 else []


def test_refinement_loop(spark):
    names = ["Tax", "Taxes", "Duty", "Water", "Rain", "Law", "Court"]
    lines = [(1, n, 20 + i, f"shared words here {n.lower() if i % 2 else 'more'}") for i, n in enumerate(names)] + [(1, "Rare", 1, "alone")]
    root = naive.nest(lines)
    tree = naive.tree_rows(spark, root)

    def answer(prompt):
        merges = merge_if_even(prompt.split("\n")[1:])
        return "\n".join(f"[1] {n}: {d} ({', '.join(f'[{lvl}] {o}' for o, lvl in os)})" for os, n, d in merges) or "None"

    docs = spark.createDataFrame([(0, "[1] Duty: Duty and Taxes\n[1] Rain: x"), (1, "None")], "doc_idx bigint, responses string")
    got, mapping, rewritten = refine_topics(tree, one(answer), "Pairs\n{Topics}", docs, threshold=0.6, encode=ENCODE)
    want = naive_refine(root, merge_if_even, 0.6)
    kept = [n for n in root.kids if n.count >= 0.01 * sum(k.count for k in root.kids)]
    assert len(want) >= 2 and len(kept) < len(names)
    assert [(r.old, r.new) for r in mapping.orderBy("seq").collect()] == list(want.items())
    root.kids = kept
    assert naive.dump_table(got) == naive.dump(root)
    texts = {r.doc_idx: r.refined_responses for r in rewritten.collect()}
    assert texts == {0: naive.rewrite("[1] Duty: Duty and Taxes\n[1] Rain: x", list(want.items())), 1: "None"}


def test_assign_correct_and_stream(spark, tmp_path):
    tree = naive.tree_rows(spark, naive.nest([(1, "Trade", 5, "goods"), (1, "Energy", 4, "power")]))
    docs = corpus(spark, 6)
    template = "{tree}#{Document}"
    backend = one(lambda p: "[1] Ghost: x" if p.endswith("text 2") else ("None" if p.endswith("text 4") else "[1] Trade: x"))
    assigned = assign_topics(docs, tree, backend, template)
    fixed = correct_topics(assigned, tree, one(lambda p: "[1] Energy: " + p.split("Previously")[1][:3]), "{tree}#{Document}#{Message}")
    rows = {r.doc_idx: r.responses for r in fixed.collect()}
    assert [rows[i][:10] for i in range(6)] == ["[1] Trade:", "[1] Trade:", "[1] Energy", "[1] Trade:", "[1] Energy", "[1] Trade:"]
    clean = correct_topics(fixed, tree, one(lambda p: 1 / 0, tries=1), "{tree}#{Document}#{Message}")
    assert {r.doc_idx: r.responses for r in clean.collect()} == rows
    source, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    docs.write.parquet(source)
    query = assign_stream(spark.readStream.schema(docs.schema).parquet(source), tree, backend, template, out, str(tmp_path / "ckpt"))
    assert query.awaitTermination(120)
    assert spark.read.parquet(out).count() == 6


def test_all_stages_from_files(spark, tmp_path):
    rows = [{"id": f"d{i}", "text": f"{WORDS[i % 4]} matters {i}", "label": WORDS[i % 4]} for i in range(24)]
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    (tmp_path / "seed.md").write_text("[1] Seeded: idea\n")
    config = {"data_sample": str(tmp_path / "c.jsonl"), "refining_topics": True, "generate_subtopics": True, "options": {"generation_2": {"context_len": 300, "max_tokens": 10}}}
    placeholders = {"generation": "{Topics} D:{Document}", "refinement": "{Topics}", "generation_2": "{Topic}|{Document}", "assignment": "{tree}#{Document}", "correction": "{tree}#{Document}#{Message}"}
    for stage, template in placeholders.items():
        (tmp_path / f"{stage}.txt").write_text(template)
        config[stage] = {"prompt": str(tmp_path / f"{stage}.txt"), "output": str(tmp_path / f"{stage}.jsonl"), "topic_output": str(tmp_path / f"{stage}.md"), "mapping_file": str(tmp_path / "map"), "seed": str(tmp_path / "seed.md")}

    def pick(prompt):
        word = prompt.split("#")[1].split()[0].capitalize()
        return f"[1] {'Ghost' if word == 'Court' else word}: because"

    calls = tmp_path / "calls"

    def paid(fn):
        def call(prompt):
            with open(calls, "a") as f:
                f.write("x")
            return fn(prompt)

        return one(call, store=str(tmp_path / "answers"))

    config["refinement"]["mapping_file"] = str(tmp_path / "map.json")
    backends = {
        "generation": paid(name_first),
        "generation_2": paid(lambda p: f"{p.split('|')[0]}\n[2] Part of {p.split('|')[0][4:]} (Document: 1): A part."),
        "assignment": paid(pick),
        "correction": paid(lambda p: "[1] Court: repaired"),
        "default": paid(lambda p: "None"),
    }
    run_stages(spark, config, backends)
    first = len(calls.read_text())
    out = run_stages(spark, config, backends)
    assert len(calls.read_text()) == first  # everything asked before is in the store
    assert out["ungrounded"].isEmpty()
    usage = {r.stage: r.calls for r in out["usage"].collect()}
    assert usage["generation"] == usage["assignment"] == 24 and usage["correction"] == 6
    names = {r.name for r in out["topics"].collect()}
    assert names == {w.capitalize() for w in WORDS[:4]} | {f"Part of {w.capitalize()}" for w in WORDS[:4]}
    scores = align(out["corrected"]).first()
    assert list(scores) == pytest.approx([1.0, 1.0, 1.0])
    written = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "correction.jsonl")).collect()]
    assert len(written) == 24 and {"id", "text", "label", "prompted_docs", "responses"} <= set(written[0])
    assert T.topic_names(out["topics"]).count() == 8


def test_a_run_goes_on_where_it_was_ended(spark, tmp_path, monkeypatch):
    rows = [{"id": f"d{i}", "text": f"{WORDS[i % 4]} matters {i}", "label": WORDS[i % 4]} for i in range(12)]
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    config = {"data_sample": str(tmp_path / "c.jsonl"), "manifest": str(tmp_path / "manifest"), "options": {}}
    for stage, template in {"generation": "{Topics} D:{Document}", "assignment": "{tree}#{Document}", "correction": "{tree}#{Document}#{Message}"}.items():
        (tmp_path / f"{stage}.txt").write_text(template)
        config[stage] = {"prompt": str(tmp_path / f"{stage}.txt"), "output": str(tmp_path / f"{stage}.jsonl"), "topic_output": str(tmp_path / f"{stage}.md")}
    asked = tmp_path / "asked"

    def paid(stage, fn):
        def call(prompt):
            with open(asked, "a") as f:
                f.write(stage[0])
            return fn(prompt)

        return one(call)

    backends = {stage: paid(stage, fn) for stage, fn in {
        "generation": name_first, "assignment": lambda p: f"[1] {p.split('#')[1].split()[0].capitalize()}: because", "correction": lambda p: "None"}.items()}

    def run():
        asked.write_text("")
        out = run_stages(spark, config, backends)
        return asked.read_text(), sorted(tuple(r) for r in out["corrected"].select("id", "responses").collect())

    correct = stages.correct_topics
    monkeypatch.setattr(stages, "correct_topics", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run()
    assert set(asked.read_text()) == {"g", "a"}
    monkeypatch.setattr(stages, "correct_topics", correct)
    calls, first = run()
    assert calls == "" and run() == ("", first)
    # other options of a stage: it and those behind it run again
    config["options"] = {"assignment": {"context_len": 1000}}
    calls, again = run()
    assert set(calls) == {"a"} and again == first
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps(r) for r in rows[:8]) + "\n")
    calls, fewer = run()
    assert set(calls) == {"g", "a"} and len(fewer) == 8


def test_scratch_tables_can_be_released(spark):
    kept = materialize(spark.range(3), "released")
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert path_exists(spark, path) and release_scratch(spark) > 0 and not path_exists(spark, path)


def test_texts_of_stages_are_written_once_and_compressed(spark, tmp_path):
    rows = [(0, "a text", "a text"), (1, "a longer text", "a longer"), (2, None, None), (3, "text", None), (4, "", "")]
    df = spark.createDataFrame(rows, "doc_idx long, text string, prompted_docs string")
    stored = assign.kept(df, "assignments")
    assert stored.columns == df.columns and sorted(map(tuple, stored.collect())) == rows
    raw = spark.read.parquet(stored.inputFiles()[0].rsplit("/", 1)[0])
    assert sorted((r.doc_idx, r.prompted_docs) for r in raw.collect()) == [(0, None), (1, "a longer"), (2, None), (3, None), (4, None)]

    docs = spark.createDataFrame([(k, str(k), "the same words again " * 200, "x") for k in range(20)], "doc_idx long, id string, text string, label string").coalesce(1)
    SD.write_documents(docs, str(tmp_path / "d.jsonl"))
    (part,) = (tmp_path / "d.jsonl").glob("part-*")
    assert part.name.endswith(".json.gz") and part.stat().st_size < 20 * 4200 / 10
    assert [tuple(r) for r in SD.read_corpus(spark, str(tmp_path / "d.jsonl")).orderBy("doc_idx").collect()] == [tuple(r) for r in docs.collect()]


@pytest.mark.parametrize("few", [0, 2, 1 << 16])
def test_documents_are_copied_only_where_many_were_corrected(spark, monkeypatch, few):
    labels = []
    monkeypatch.setattr(assign, "FEW", few)
    monkeypatch.setattr(assign, "materialize", lambda df, label, *more: labels.append(label) or materialize(df, label, *more))
    tree = spark.createDataFrame([([1], 1, "Trade", 1, "x"), ([2], 1, "Law", 1, "y")], "path array<long>, lvl int, name string, count long, desc string")
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(8)], "doc_idx long, text string")
    template = "Pick.\n{tree}\n#####\n{Document}"
    wrong = lambda p: "[1] Unknown: no" if p[-1] in "136" else "[1] Law: yes"
    again = one(lambda p: "[1] Trade: now")
    assigned = assign_topics(docs, tree, one(wrong), template)
    got = assign.correct_topics(assigned, tree, again, template + "\n#####\n{Message}", stored=True)
    assert ("stage-corrected" in labels) == (few < 3)
    assert {r.doc_idx: r.responses for r in got.collect()} == {k: "[1] Trade: now" if k in (1, 3, 6) else "[1] Law: yes" for k in range(8)}
    assert got.columns == assigned.columns and {r.prompted_docs for r in got.collect()} == {f"text {k}" for k in range(8)}
    clean = assign_topics(docs, tree, one(lambda p: "[1] Law: yes"), template)
    assert assign.correct_topics(clean, tree, again, template + "\n#####\n{Message}", stored=True) is clean
