"""Merging topics in the tree and keeping the old-to-new mapping."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from corpusgrove.functions import text as X
from corpusgrove.llm.components import connected_components
from corpusgrove.operators.ordering import dense_index
from corpusgrove.operators.tree import NODE, ordinal, parent_path, without_subtrees
from corpusgrove.schema import CREATED_BASE
from corpusgrove.storage import materialize


LAYERS = 4
TOGETHER = 100_000  # nodes and originals that a task holds at once
RESULT = "path array<long>, lvl int, name string, count long, desc string"
RESULT_ARROW = pa.schema([("path", pa.list_(pa.int64())), ("lvl", pa.int32()), ("name", pa.string()), ("count", pa.int64()), ("desc", pa.string())])


def merge_nodes(tree: DataFrame, merges: DataFrame) -> DataFrame:
    """Nodes each original names: same level, same name in any case.

    ``merges`` holds ``merge_id, pos, new_name, new_desc, old_name, old_lvl``.
    An original listed twice matches twice.
    """
    keyed = merges.select("*", F.lower("old_name").alias("key"))
    nodes = tree.select(
        F.lower("name").alias("key"),
        F.col("lvl").alias("old_lvl"),
        F.col("path"),
        F.col("name"),
        F.col("count"),
    )
    return keyed.join(nodes, ["key", "old_lvl"])


def merge_counts(tree: DataFrame, merges: DataFrame) -> DataFrame:
    """Per merge: summed count of the matched nodes and the first match's parent."""
    matched = (
        merge_nodes(tree, merges)
        .groupBy("merge_id")
        .agg(
            F.sum("count").alias("count"),
            F.min_by(parent_path(), F.struct("pos", "path")).alias("parent"),
        )
    )
    named = merges.groupBy("merge_id").agg(
        F.first("new_name").alias("new_name"), F.first("new_desc").alias("new_desc")
    )
    return named.join(matched, "merge_id", "left").select(
        "merge_id",
        "new_name",
        "new_desc",
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("parent", F.array().cast("array<bigint>")).alias("parent"),
    )


def _last_children(tree: DataFrame) -> DataFrame:
    return tree.groupBy(parent_path().alias("parent")).agg(F.max(ordinal()).alias("last"))


def _placed(tree: DataFrame, merges: DataFrame, last: DataFrame | None = None) -> DataFrame:
    """Each merge with the sibling it reuses, or a fresh last position.

    Fresh positions follow the merges' order behind ``last``, the last child of
    every parent before the first merge.
    """
    totals = merge_counts(tree, merges)
    siblings = tree.select(parent_path().alias("parent"), F.col("name").alias("new_name"), F.col("path").alias("reused"))
    last = _last_children(tree) if last is None else last
    level = F.when(F.size("parent") == 0, F.lit(1)).otherwise(F.col("above_lvl") + 1)
    above = tree.select(F.col("path").alias("parent"), F.col("lvl").alias("above_lvl"))
    return (
        totals.join(siblings, ["parent", "new_name"], "left")
        .join(last, "parent", "left")
        .join(above, "parent", "left")
        .withColumn("fresh_path", F.concat("parent", F.array(F.coalesce("last", F.lit(-1)) + 1 + F.col("merge_id"))))
        .select(
            "merge_id",
            F.coalesce("reused", "fresh_path").alias("path"),
            F.col("reused").isNotNull().alias("reuses"),
            level.cast("int").alias("lvl"),
            "new_name",
            "count",
            "new_desc",
        )
    )


def _with_merged(tree: DataFrame, placed: DataFrame) -> DataFrame:
    """Overwrite reused siblings and add the fresh nodes."""
    update = placed.filter("reuses").select("path", F.col("count").alias("c"), F.col("new_desc").alias("d"))
    kept = tree.join(update, "path", "left").select(
        "path", "lvl", "name", F.coalesce("c", "count").alias("count"), F.coalesce("d", "desc").alias("desc")
    )
    fresh = placed.filter("not reuses").select(
        "path", "lvl", F.col("new_name").alias("name"), "count", F.col("new_desc").alias("desc")
    )
    return kept.unionByName(fresh)


def _remove_occurrences(tree: DataFrame, hits: DataFrame) -> DataFrame:
    """Remove, per exact ``(name, lvl)``, as many first nodes as it has hits."""
    wanted = hits.groupBy("name", "lvl").agg(F.count(F.lit(1)).alias("hits"))
    rank = F.row_number().over(W.partitionBy("name", "lvl").orderBy("path"))
    gone = (
        tree.join(wanted, ["name", "lvl"])
        .withColumn("rank", rank)
        .filter(F.col("rank") <= F.col("hits"))
        .select("path")
    )
    return without_subtrees(tree, gone)


def _nested(tree: DataFrame, keys: DataFrame) -> bool:
    """Whether a node of some ``(name, lvl)`` lies below another one of them."""
    hits = tree.join(keys, ["name", "lvl"], "left_semi").select("path")
    above = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda n: F.slice("path", 1, n))
    higher = hits.filter(F.size("path") > 1).select(F.explode(above).alias("path"))
    return not higher.join(hits, "path", "left_semi").isEmpty()


def _apply_layer(tree: DataFrame, merges: DataFrame, last: DataFrame | None = None) -> DataFrame:
    """Apply merges of which none changes what another one names.

    Matches go in one pass unless one of them may lie below another: then the
    originals of all merges go by their place in the line, first ones first.
    """
    placed = materialize(_placed(tree, merges, last), "merged-nodes")
    matched = merge_nodes(tree, merges).select("pos", "path", "name", F.col("old_lvl").alias("lvl"))
    doomed = materialize(matched.join(placed.filter("reuses").select("path"), "path", "left_anti"), "merged-old")
    result = _with_merged(tree, placed)
    if not _nested(result, doomed.select("name", "lvl").distinct()):
        return materialize(_remove_occurrences(result, doomed).select(*NODE), "merged-tree")
    places = doomed.agg(F.max("pos")).first()[0]
    for pos in range(places + 1):
        result = _remove_occurrences(result, doomed.filter(F.col("pos") == pos))
    return materialize(result.select(*NODE), "merged-tree")


def apply_merge(tree: DataFrame, merge: DataFrame) -> DataFrame:
    """Replace the originals of ONE merge by one node.

    The merged node takes the summed count and sits under the first match's
    parent (the root when nothing matched).  A child of that parent already
    named so is reused: its count and description are overwritten.  Every other
    match goes, with its subtree, looked up by exact name and level.
    """
    return _apply_layer(tree, materialize(merge, "merge"))


def merge_order(tree: DataFrame, merges: DataFrame) -> DataFrame:
    """Pairs of merges (``before, after``) that have to keep their order.

    A merge changes the names it lists, its new name and all names below nodes
    so named, and relies on the names above them.  Two merges may change places
    unless one changes a name that the other changes or relies on.  Pairs
    implied by others are left out.
    """
    own = merges.select("merge_id", F.lower("old_name").alias("key")).unionByName(merges.select("merge_id", F.lower("new_name").alias("key")))
    own = materialize(own.filter("key is not null").distinct(), "merge-names")
    keyed = tree.select(F.lower("name").alias("key"), "path")
    above = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda n: F.slice("path", 1, n))
    higher = keyed.filter(F.size("path") > 1).select("key", F.explode(above).alias("path"))
    # name, and the name of a node above it
    lines = higher.join(keyed.withColumnRenamed("key", "upper"), "path").select("key", "upper").distinct()
    relies = own.join(lines, "key").select("merge_id", F.col("upper").alias("key"), F.lit(False).alias("changes"))
    below = own.join(lines.select(F.col("upper").alias("key"), F.col("key").alias("lower")), "key").select("merge_id", F.col("lower").alias("key"), F.lit(True).alias("changes"))
    touched = own.withColumn("changes", F.lit(True)).unionByName(below).unionByName(relies).groupBy("merge_id", "key").agg(F.max("changes").alias("changes"))
    change = F.when(F.col("changes"), F.col("merge_id"))
    earlier = W.partitionBy("key").orderBy("merge_id").rowsBetween(W.unboundedPreceding, -1)
    later = W.partitionBy("key").orderBy(F.desc("merge_id")).rowsBetween(W.unboundedPreceding, -1)
    near = touched.select("merge_id", F.last(change, True).over(earlier).alias("before"), F.last(change, True).over(later).alias("after"))
    pairs = near.select("before", F.col("merge_id").alias("after")).unionByName(near.select(F.col("merge_id").alias("before"), "after"))
    return pairs.dropna().distinct()


def apply_disjoint_merges(tree: DataFrame, merges: DataFrame) -> DataFrame:
    """Apply many level-1 merges at once.

    Needs merges that share no name, old or new; then their order does not
    matter and one pass over the tree equals applying them one by one.
    """
    placed = _placed(tree, merges)
    kept = placed.filter("reuses").select("path")
    gone = merge_nodes(tree, merges).select("path").distinct().join(kept, "path", "left_anti")
    return without_subtrees(_with_merged(tree, placed), gone)


def _one_after_another(nodes: list[dict], merges: list[dict]) -> list[dict]:
    """Merges that depend on one another, in ``merge_id`` order, on all nodes they can name or remove."""
    tree = {tuple(n["path"]): n for n in nodes}
    named: dict[tuple, set[tuple]] = {}
    kids: dict[tuple, set[tuple]] = {}

    def put(path: tuple, node: dict) -> None:
        tree[path] = node
        named.setdefault((node["key"], node["lvl"]), set()).add(path)
        kids.setdefault(path[:-1], set()).add(path)

    def drop(path: tuple) -> None:
        node = tree.pop(path)
        named[node["key"], node["lvl"]].discard(path)
        kids[path[:-1]].discard(path)
        for below in list(kids.get(path, ())):
            drop(below)

    for path, node in list(tree.items()):
        put(path, node)
    lines: dict[int, list[dict]] = {}
    for row in merges:
        lines.setdefault(row["merge_id"], []).append(row)
    for merge_id in sorted(lines):
        rows = sorted(lines[merge_id], key=lambda r: -1 if r["pos"] is None else r["pos"])
        new, new_key, desc = (rows[0][c] for c in ("new_name", "new_key", "new_desc"))
        hits = [(r["pos"], path) for r in rows if r["key"] is not None for path in named.get((r["key"], r["old_lvl"]), ())]
        first = min(hits)[1] if hits else None
        parent = first[:-1] if hits else ()
        count = sum(tree[path]["count"] for _, path in hits)
        spared = [path for path in kids.get(parent, ()) if new is not None and tree[path]["name"] == new]
        wanted: dict[int, dict[tuple, int]] = {}
        for pos, path in hits:
            if path not in spared:
                each = wanted.setdefault(pos, {})
                kind = tree[path]["key"], tree[path]["lvl"], tree[path]["name"]
                each[kind] = each.get(kind, 0) + 1
        for path in spared:
            tree[path] |= {"count": count, "desc": tree[path]["desc"] if desc is None else desc}
        if not spared:
            above, last = (tree[first]["above_lvl"], tree[first]["last"]) if hits else (0, rows[0]["root_last"])
            lvl = None if above is None else above + 1
            put((*parent, last + 1 + merge_id), {"key": new_key, "lvl": lvl, "name": new, "count": count, "desc": desc, "above_lvl": above, "last": last})
        for pos in sorted(wanted):
            gone = []
            for (key, lvl, name), hit in wanted[pos].items():
                gone += sorted(path for path in named[key, lvl] if tree[path]["name"] == name)[:hit]
            for path in gone:
                if path in tree:
                    drop(path)
    return [{**{c: node[c] for c in NODE[1:]}, "path": list(path)} for path, node in tree.items()]


def _by_component(tree: DataFrame, merges: DataFrame, order: DataFrame, last: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Applies merges a group at a time, in parallel; a group holds those linked by ``order``.

    A group comes with all nodes that it names and those below them, which no
    other group names or removes.  Returns the tree, and the merges and order of
    the groups too large for a task.
    """
    linked = connected_components(order.select(F.col("before").alias("a"), F.col("after").alias("b")))
    grouped = merges.join(linked.withColumnRenamed("id", "merge_id"), "merge_id", "left").withColumn("grp", F.coalesce("component", "merge_id")).drop("component")
    grouped = materialize(grouped.withColumns({"key": F.lower("old_name"), "new_key": F.lower("new_name")}), "merge-groups")
    keys = grouped.select("grp", "key").unionByName(grouped.select("grp", F.col("new_key").alias("key"))).dropna().distinct()
    above = F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", 1, n))
    heads = tree.select(F.lower("name").alias("key"), F.col("path").alias("above")).join(keys, "key").select("above", "grp")
    held = tree.select("path", F.explode(above).alias("above")).join(heads, "above").select("path", "grp").distinct()
    parents = tree.select(F.col("path").alias("parent"), F.col("lvl").alias("above_lvl"))
    nodes = tree.join(held, "path").withColumn("parent", parent_path()).join(parents, "parent", "left").join(last, "parent", "left")
    level = F.when(F.size("parent") == 0, F.lit(0)).otherwise(F.col("above_lvl"))
    nodes = nodes.select("grp", F.lower("name").alias("key"), *NODE, level.cast("int").alias("above_lvl"), F.coalesce("last", F.lit(-1)).alias("last"))
    nodes = materialize(nodes, "merge-group-nodes")
    sizes = nodes.select("grp").unionByName(grouped.select("grp")).groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    large = materialize(sizes.filter(F.col("n") > TOGETHER).select("grp"), "merge-groups-large")
    root = last.filter(F.size("parent") == 0).agg(F.coalesce(F.max("last"), F.lit(-1))).first()[0]
    lines = grouped.join(large, "grp", "left_anti").select("grp", "merge_id", "pos", "new_name", "new_key", "new_desc", "key", "old_lvl", F.lit(root).cast("long").alias("root_last"))
    small = nodes.join(large, "grp", "left_anti")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(_one_after_another(left.to_pylist(), right.to_pylist()), RESULT_ARROW)

    done = small.groupBy("grp").cogroup(lines.groupBy("grp")).applyInArrow(run, RESULT)
    tree = materialize(tree.join(small.select("path"), "path", "left_anti").select(*NODE).unionByName(done.select(*NODE)), "merged-tree")
    rest = materialize(grouped.join(large, "grp", "left_semi").select(*merges.columns), "merges")
    return tree, rest, materialize(order.join(rest.select(F.col("merge_id").alias("after")).distinct(), "after", "left_semi"), "merge-order")


def apply_merges(tree: DataFrame, merges: DataFrame) -> DataFrame:
    """Apply merges in ``merge_id`` order, a layer at a time.

    A layer holds the merges whose predecessors in ``merge_order`` are done;
    merges that share no name are one pass over the tree.  What ``LAYERS``
    layers leave over, longer chains of merges that depend on one another, is
    split into groups without a link between them, and a task applies those of a
    group one after another.  Groups larger than a task holds go on in layers.
    """
    merges = materialize(merges, "merges")
    names = merges.select("merge_id", F.lower("old_name").alias("key")).unionByName(
        merges.select("merge_id", F.lower("new_name").alias("key"))
    )
    shared = names.distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    deeper = merges.filter("old_lvl <> 1")
    if shared.isEmpty() and deeper.isEmpty():
        return apply_disjoint_merges(tree, merges)
    order = materialize(merge_order(tree, merges), "merge-order")
    last = materialize(_last_children(tree), "last-children")
    for layer in itertools.count():
        if layer == LAYERS and not order.isEmpty():
            tree, merges, order = _by_component(tree, merges, order, last)
            if merges.isEmpty():
                return tree
        waiting = order.select(F.col("after").alias("merge_id")).distinct()
        ready = merges.join(waiting, "merge_id", "left_anti")
        if order.isEmpty():
            return _apply_layer(tree, ready, last)
        ready = materialize(ready, "merge-layer")
        tree = _apply_layer(tree, ready, last)
        merges = materialize(merges.join(waiting, "merge_id", "left_semi"), "merges")
        done = ready.select(F.col("merge_id").alias("before")).distinct()
        order = materialize(order.join(done, "before", "left_anti"), "merge-order")


def merge_mapping(earlier: DataFrame | None, originals: DataFrame) -> DataFrame:
    """``seq, old, new`` after adding originals (``seq, old_name, new_name``).

    The latest new name wins; a key keeps the place where it first appeared.
    """
    rows = originals.select("seq", F.col("old_name").alias("old"), F.col("new_name").alias("new"), F.lit(1).alias("age"))
    if earlier is not None:
        rows = rows.unionByName(earlier.select("seq", "old", "new", F.lit(0).alias("age")))
    at = F.struct("age", "seq")
    latest = rows.groupBy("old").agg(F.min(at).alias("first"), F.max_by("new", at).alias("new"))
    seq = F.col("first.age") * F.lit(CREATED_BASE) + F.col("first.seq")
    return latest.select(seq.alias("seq"), "old", "new")


MAPPING_SLICE = 500_000
FEW = 32


def _by_trie(pairs: list[tuple[str, str]], text: Column) -> Column:
    """Apply pairs in order, looking only at keys that occur.

    A trie of all keys finds those in a line.  The first one is replaced and the
    line looked through again, for keys behind it in the mapping: a replacement
    may have made or broken them.
    """
    shared = SparkSession.getActiveSession().sparkContext.broadcast(pairs)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        ordered = shared.value
        places: dict[str, list[int]] = {}
        for at, (old, _) in enumerate(ordered):
            places.setdefault(old, []).append(at)
        trie = ahocorasick.Automaton()
        for old, found in places.items():
            trie.add_word(old, found)
        trie.make_automaton()

        def one(line: str) -> str:
            done = -1
            while True:
                at = min((k for _, found in trie.iter(line) for k in found if k > done), default=None)
                if at is None:
                    return line
                line, done = line.replace(*ordered[at]), at

        for batch in batches:
            yield batch.map(lambda text: "\n".join(map(one, text.split("\n"))), na_action="ignore")

    return run(text)


def rewrite_documents(df: DataFrame, mapping: DataFrame, column: str, out: str = "refined_responses", slice_rows: int = MAPPING_SLICE) -> DataFrame:
    """Apply a mapping (``seq, old, new``) to every response of a corpus.

    Map-only over the documents.  The mapping has one row per merged topic and
    travels whole: ``FEW`` pairs or less as a literal of the plan, more as a
    trie, ``slice_rows`` at a time.  Slices follow one another, which gives the
    same result because pairs apply in order.
    """
    changing = materialize(mapping.filter("old <> new and old <> ''").select("seq", "old", "new"), "mapping")
    numbered = materialize(dense_index(changing, ["seq"], "at", bucket=F.expr("seq div 65536")), "mapping-order")
    total = numbered.count()
    df = df.withColumn(out, F.col(column))
    for start in range(0, total, slice_rows):
        part = numbered.filter(F.col("at").between(start, start + slice_rows - 1)).select("at", "old", "new").toArrow().sort_by("at")
        pairs = list(zip(part.column("old").to_pylist(), part.column("new").to_pylist()))
        if len(pairs) <= FEW:
            literal = F.array(*[F.struct(F.lit(old).alias("old"), F.lit(new).alias("new")) for old, new in pairs])
            df = df.withColumn(out, X.rewrite_topics(F.col(out), literal))
        else:
            df = df.withColumn(out, _by_trie(pairs, F.col(out)))
    return df
