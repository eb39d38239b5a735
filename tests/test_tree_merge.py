import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusgrove.operators import merge as Mg, tree as T
from corpusgrove.schema import CREATED_BASE
from corpusgrove.sources import topics as ST
from corpusgrove.storage import scratch_path
from tests import naive

NAMES = ["A", "a", "B", "C", "D d", "E"]


def random_lines(rng, n, deepest=3):
    return [(rng.randint(1, deepest), rng.choice(NAMES), rng.randint(1, 9), f"d{i}") for i in range(n)]


@pytest.mark.parametrize("seed", range(5))
def test_nesting_matches_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    lines = random_lines(rng, 40, deepest=4)
    if seed == 0:
        lines = [(2, "Orphan", 1, "x"), (1, "A", 1, "x"), (3, "Too deep", 1, "x"), *lines]
    df = spark.createDataFrame([(i, *line) for i, line in enumerate(lines)], "line_no bigint, lvl int, name string, count bigint, desc string")
    assert naive.dump_table(T.resolve_parents(df)) == naive.dump(naive.nest(lines))


def test_topic_file_round_trip_drops_empty_descriptions(spark):
    root = naive.nest([(1, "A", 3, "first"), (2, "Sub", 1, "inner"), (1, "Seed", 5, ""), (1, "Naïve (Count: 1)", 2, "odd")])
    path = scratch_path(spark, "tree")
    ST.write_topics(naive.tree_rows(spark, root), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert sorted(lines) == sorted(["[1] A (Count: 3): first", "    [2] Sub (Count: 1): inner", "[1] Naïve (Count: 1) (Count: 2): odd"])
    assert [row[1:] for row in naive.dump_table(ST.read_topics(spark, path))] == [(1, 3, "first"), (2, 1, "inner"), (1, 2, "odd")]


def test_topic_file_rejects_and_seed_file(spark, tmp_path):
    (tmp_path / "t.md").write_text("[1] A (Count: 2): x\n\nbroken\n    [2] B (Count: 1):\n[2] C (Count: 99999999999999999999): y\n")
    assert [r.line for r in ST.topic_rejects(spark, str(tmp_path / "t.md")).orderBy("line_no").collect()] == [
        "broken", "[2] C (Count: 99999999999999999999): y"
    ]
    assert [r[0] for r in naive.dump_table(ST.read_topics(spark, str(tmp_path / "t.md")))] == [("A",), ("A", "B")]
    (tmp_path / "s.md").write_text("[1] Trade: Mentions goods.\n[1] Law\n")
    assert naive.dump_table(ST.read_seed(spark, str(tmp_path / "s.md"))) == [
        (("Trade: Mentions goods.",), 1, 1, ""), (("Law",), 1, 1, "")
    ]
    assert naive.dump_table(ST.read_seed(spark, str(tmp_path / "s.md"), split_desc=True))[0] == (("Trade",), 1, 1, "Mentions goods.")
    assert ST.read_seed(spark, None).count() == 0


def merges_table(spark, merges):
    rows = []
    for i, (originals, name, desc) in enumerate(merges):
        if not originals:
            rows.append((i, None, name, desc, None, None))
        rows += [(i, p, name, desc, old, lvl) for p, (old, lvl) in enumerate(originals)]
    return spark.createDataFrame(rows, "merge_id bigint, pos int, new_name string, new_desc string, old_name string, old_lvl int")


@pytest.mark.parametrize("seed", range(8))
def test_merges_match_the_sequential_rule(spark, seed):
    rng = random.Random(100 + seed)
    lines = random_lines(rng, 25)
    root = naive.nest(lines)
    tree = naive.tree_rows(spark, root)
    merges = []
    for _ in range(3):
        lvl = rng.choice([1, 2, 2, 3])
        originals = [(rng.choice(NAMES + ["Unknown"]), lvl) for _ in range(rng.randint(0, 3))]
        merges.append((originals, rng.choice([*NAMES, "New", "b"]), f"m{rng.randint(0, 99)}"))
    got = Mg.apply_merges(tree, merges_table(spark, merges))
    for originals, name, desc in merges:
        naive.merge(root, originals, name, desc)
    assert naive.dump_table(got) == naive.dump(root), (lines, merges)


@pytest.mark.parametrize("seed", range(3))
def test_disjoint_merges_in_one_pass(spark, seed):
    rng = random.Random(seed)
    names = [f"T{i}" for i in range(20)]
    root = naive.nest([(1, n, rng.randint(1, 9), "d") for n in names])
    root.kids[0].put("child", 2, 1, "c")
    tree = naive.tree_rows(spark, root)
    rng.shuffle(names)
    merges = []
    for k in range(4):
        mine = names[4 * k : 4 * k + 4]
        merges.append(([(n, 1) for n in mine[:3]], rng.choice([f"New{k}", mine[0], mine[3], mine[1].lower()]), "m"))
    got = Mg.apply_disjoint_merges(tree, merges_table(spark, merges))
    for originals, name, desc in merges:
        naive.merge(root, originals, name, desc)
    assert naive.dump_table(got) == naive.dump(root), merges


def test_mapping_keeps_first_place_and_latest_name(spark):
    earlier = spark.createDataFrame([(0, "a", "x"), (1, "b", "y")], "seq bigint, old string, new string")
    added = spark.createDataFrame([(0, "c", "z"), (1, "a", "w"), (2, "c", "v")], "seq bigint, old_name string, new_name string")
    rows = Mg.merge_mapping(earlier, added).orderBy("seq").collect()
    assert [(r.old, r.new) for r in rows] == [("a", "w"), ("b", "y"), ("c", "v")]
    assert rows[2].seq >= CREATED_BASE


@pytest.mark.parametrize("slice_rows,few", [(1, 32), (2, 0), (4, 1), (100, 32), (100, 0)])
def test_rewrite_follows_mapping_order(spark, monkeypatch, slice_rows, few):
    monkeypatch.setattr(Mg, "FEW", few)
    mapping = [("Trade", "Commerce"), ("Commerce", "Business"), ("Same", "Same"), ("Tax", "Tax Law"), ("Tax Law", "Levy"), ("Art", "Arts"), ("Tax", "Taxed")]
    texts = ["[1] Trade: about Trade and Commerce\n[1] Tax: Taxes", "None", "[1] Art: Party", "Same\n\nTrade", "", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_idx bigint, responses string")
    table = spark.createDataFrame([(i, o, n) for i, (o, n) in enumerate(mapping)], "seq bigint, old string, new string")
    got = Mg.rewrite_documents(docs, table, "responses", slice_rows=slice_rows).orderBy("doc_idx").collect()
    assert [r.refined_responses for r in got] == [None if t is None else naive.rewrite(t, mapping) for t in texts]


def test_rewrite_with_chains_and_substrings_of_many_keys(spark):
    rng = random.Random(11)
    parts = ["ab", "ba", "a", "b", "abc", "c a", "é", "b\tb"]
    keys = {"".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(400)}
    mapping = [(k, "".join(rng.choices([*parts, "x", ""], k=2))) for k in rng.sample(sorted(keys), len(keys))]
    mapping += [(f"absent {k}", "never") for k in range(100_000)]
    rng.shuffle(mapping)
    texts = ["\n".join("".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(3)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_idx bigint, responses string")
    table = spark.createDataFrame(pd.DataFrame({"seq": range(len(mapping)), "old": [o for o, _ in mapping], "new": [n for _, n in mapping]}))
    got = {r.doc_idx: r.refined_responses for r in Mg.rewrite_documents(docs, table, "responses").collect()}
    present = [(o, n) for o, n in mapping if not o.startswith("absent")]
    assert got == {i: naive.rewrite(t, present) for i, t in enumerate(texts)}


@pytest.mark.parametrize("seed", range(4))
def test_many_overlapping_merges_match_the_sequential_rule(spark, seed):
    rng = random.Random(500 + seed)
    lines = random_lines(rng, 40)
    root = naive.nest(lines)
    tree = naive.tree_rows(spark, root)
    merges = []
    for k in range(7):
        originals = [(rng.choice(NAMES + ["Unknown", f"M{rng.randint(0, k)}"]), rng.choice([1, 2, 3])) for _ in range(rng.randint(1, 3))]
        merges.append((originals, rng.choice([*NAMES, f"M{k}", "m1"]), f"d{k}"))
    got = Mg.apply_merges(tree, merges_table(spark, merges))
    for originals, name, desc in merges:
        naive.merge(root, originals, name, desc)
    assert naive.dump_table(got) == naive.dump(root), (lines, merges)


@pytest.mark.parametrize("seed,together", [(1, 100_000), (2, 100_000), (3, 4)])
def test_groups_of_long_chains_match_the_sequential_rule(spark, monkeypatch, seed, together):
    monkeypatch.setattr(Mg, "LAYERS", 1)
    monkeypatch.setattr(Mg, "TOGETHER", together)
    rng = random.Random(900 + seed)
    root = naive.nest([*random_lines(rng, 30), *[row for k in range(8) for row in ((1, f"Z{k}", k, "d"), (2, f"Kid {k}", 1, ""))]])
    tree = naive.tree_rows(spark, root)
    merges = [([(rng.choice([*NAMES, "M0", "M1"]), rng.choice([1, 2])) for _ in range(2)], rng.choice([*NAMES, "M0", "M1", "m1"]), f"d{k}") for k in range(5)]
    merges += [([("Z0" if k == 1 else "Zed", 1), (f"Z{k}", 1), ("Unknown", 1)], "Zed", f"z{k}") for k in range(1, 8)]
    layers = []
    layer = Mg._apply_layer
    monkeypatch.setattr(Mg, "_apply_layer", lambda t, m, last: (layers.append(1), layer(t, m, last))[1])
    got = Mg.apply_merges(tree, merges_table(spark, merges))
    for originals, name, desc in merges:
        naive.merge(root, originals, name, desc)
    assert naive.dump_table(got) == naive.dump(root), merges
    assert len(layers) == 1 or together == 4


def test_layers_follow_the_longest_chain(spark, monkeypatch):
    root = naive.nest([row for k in range(12) for row in ((1, f"P{k % 3}x{k}", 4, "d"), (2, f"c{k}", 1, ""), (2, f"e{k}", 1, ""))])
    tree = naive.tree_rows(spark, root)
    # all under different parents, three of them one after another
    merges = [([(f"c{k}", 2), (f"e{k}", 2)], f"both{k}", "m") for k in range(9)]
    merges += [([("both0", 2), ("new", 2)], "again", "m"), ([("again", 2)], "third", "m")]
    applied = []
    layer = Mg._apply_layer
    monkeypatch.setattr(Mg, "_apply_layer", lambda t, m, last: (applied.append(m.select("merge_id").distinct().count()), layer(t, m, last))[1])
    got = Mg.apply_merges(tree, merges_table(spark, merges))
    for originals, name, desc in merges:
        naive.merge(root, originals, name, desc)
    assert naive.dump_table(got) == naive.dump(root)
    assert applied == [9, 1, 1]


def test_mapping_files(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"b": "x", "a": "y"}')
    read = ST.read_mapping(spark, str(tmp_path / "m.json")).orderBy("seq")
    assert [(r.old, r.new) for r in read.collect()] == [("b", "x"), ("a", "y")]
    assert ST.read_mapping(spark, str(tmp_path / "absent.json")).count() == 0
    path = scratch_path(spark, "mapping")
    ST.write_mapping(read, path)
    assert ST.read_mapping(spark, path).orderBy("seq").collect() == read.collect()
    assert [r.value for r in ST.mapping_lines(read).collect()] == ['{"b":"x",', '"a":"y"}']


@pytest.mark.parametrize("indent,parts", [(None, 1), (2, 1), (2, 3), ("spread", 1)])
def test_mapping_objects_of_any_layout(spark, tmp_path, indent, parts):
    pairs = [("b {", "x,"), ("a}", '"q"}'), ("é\n", "y\\"), ("b", ""), ("c:", "{}")]
    text = json.dumps(dict(pairs), indent=indent, ensure_ascii=False) if indent != "spread" else json.dumps(dict(pairs)).replace(": ", ":\n ")
    folder = tmp_path / "m.json"
    folder.mkdir()
    lines = text.split("\n")
    size = -(-len(lines) // parts)
    for k in range(0, len(lines), size):
        (folder / f"part-{k:05}").write_text("\n".join(lines[k : k + size]) + "\n")
    read = ST.read_mapping(spark, str(folder)).orderBy("seq").collect()
    assert [(r.seq, r.old, r.new) for r in read] == [(k, *p) for k, p in enumerate(pairs)]


def test_a_long_mapping_keeps_its_order_in_many_parts(spark):
    n = 1_000_000
    mapping = spark.range(n).select((F.col("id") * 3).alias("seq"), F.concat(F.lit('k"'), F.pmod(F.col("id") * 7919, F.lit(n))).alias("old"), F.concat(F.lit("n"), "id").alias("new"))
    path = scratch_path(spark, "mapping") + ".json"
    ST.write_mapping(mapping.repartition(5), path)
    read = ST.read_mapping(spark, path)
    both = read.join(mapping.select(F.expr("seq div 3").alias("seq"), F.col("old").alias("o"), F.col("new").alias("n")), "seq")
    assert both.filter("old = o and new = n").count() == read.count() == n
    assert json.loads("".join(r.value for r in spark.read.text(path).filter("value like '{%'").collect()).rstrip(",") + "}")


def test_rare_topics_go_with_their_subtrees(spark):
    root = naive.nest([(1, "Big", 98, "x"), (2, "Kid", 1, "x"), (1, "Small", 1, "x"), (2, "Lost", 50, "x"), (1, "Edge", 1, "x")])
    tree = naive.tree_rows(spark, root)
    kept = {r[0][-1] for r in naive.dump_table(T.remove_rare_topics(tree, 0.01))}
    assert kept == {"Big", "Kid", "Small", "Lost", "Edge"}
    assert {r[0][-1] for r in naive.dump_table(T.remove_rare_topics(tree, 0.011))} == {"Big", "Kid"}


def test_leaves_and_remove(spark):
    root = naive.nest([(1, "A", 9, "x"), (2, "B", 5, "x"), (1, "C", 3, "x"), (2, "B", 4, "x"), (1, "D", 2, "x")])
    tree = naive.tree_rows(spark, root)
    leaves = T.leaves(tree).orderBy("path").collect()
    assert [(r.name, r["count"]) for r in leaves] == [("B", 5), ("B", 4), ("D", 2)]
    assert [r["count"] for r in T.expandable_topics(tree, F.lit(300), 0.01, 1).collect()] == [5]
    keys = spark.createDataFrame([("B", 2), ("D", 2)], "name string, lvl int")
    assert [r[0] for r in naive.dump_table(T.remove_topic(tree, keys))] == [("A",), ("C",), ("C", "B"), ("D",)]


def test_sixty_levels_nest_without_a_cap(spark):
    lines = [(k, k + 1, f"n{k}", 1, "") for k in range(60)] + [(60, 70, "orphan", 1, "")]
    df = spark.createDataFrame(lines, "line_no long, lvl int, name string, count long, desc string")
    tree = T.resolve_parents(df)
    assert sorted((r.lvl, len(r.path)) for r in tree.collect()) == [(k, k) for k in range(1, 61)]
