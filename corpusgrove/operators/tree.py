"""Topic trees as tables: building, viewing and pruning.

A node is identified by ``path``.  The implicit root has the empty path.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, functions as F

from corpusgrove.functions import text as X
from corpusgrove.functions.grammar import RARE_SHARE
from corpusgrove.operators.ordering import carry_forward, dense_index
from corpusgrove.schema import CREATED_BASE, LINE_BITS
from corpusgrove.storage import materialize

NODE = ["path", "lvl", "name", "count", "desc"]


def parent_path(path: Column | None = None) -> Column:
    p = F.col("path") if path is None else path
    return F.slice(p, 1, F.size(p) - 1)


def ordinal() -> Column:
    return F.element_at("path", -1)


def _stretch(head: Column) -> Column:
    """Bucket of a first-level ordinal: 65,536 file lines, or as many documents."""
    created = F.shiftright(head, LINE_BITS + 16)
    return F.when(head >= CREATED_BASE, created).otherwise(F.shiftright(head, 16))


def topic_labels(tree: DataFrame) -> DataFrame:
    """The four renderings of every node."""
    return tree.select(
        "path",
        X.label_of().alias("label"),
        X.label_of(desc=True).alias("label_desc"),
        X.label_of(count=True).alias("label_count"),
        X.label_of(desc=True, count=True).alias("label_count_desc"),
    )


def topic_list(tree: DataFrame, desc: bool = True, count: bool = True) -> DataFrame:
    """``position, path, label`` in depth-first order, positions from 0.

    Positions are dense and computed per bucket of first-level ordinals, so a
    large tree is numbered by many tasks.
    """
    labelled = tree.select("path", X.label_of(desc, count).alias("label"))
    return dense_index(labelled, ["path"], "position", bucket=_stretch(F.col("path")[0])).select("position", "path", "label")


def topic_names(tree: DataFrame) -> DataFrame:
    """Distinct names at any level."""
    return tree.select("name").distinct()


def tree_view(tree: DataFrame) -> DataFrame:
    """Tab-indented ``[lvl] name`` lines with their path."""
    indent = F.repeat(F.lit("\t"), F.col("lvl") - 1)
    return tree.select("path", F.concat(indent, X.label_of()).alias("line"))


def list_text(tree: DataFrame, desc: bool, count: bool = False, strip_desc: bool = False) -> Column:
    """All labels of a tree as one newline-joined text, for a prompt.

    A scalar subquery: one row as long as the topic list a prompt carries.
    Callers use it only where the list is known to fit the context, or where
    the list goes whole into the prompt anyway.
    """
    label = X.label_of(desc, count)
    if strip_desc:
        label = X.strip_topic_desc(label)
    ordered = F.sort_array(F.collect_list(F.struct("path", label.alias("label"))))
    joined = F.array_join(F.transform(ordered, lambda t: t["label"]), "\n")
    return F.coalesce(tree.agg(joined).scalar(), F.lit(""))


def resolve_parents(lines: DataFrame) -> DataFrame:
    """Nest parsed topic lines (``line_no, lvl, name, count, desc``).

    A line goes under the node created last on the level above it, wherever
    that node sits; a level is never reset.  Repeating a sibling's exact name
    adds to its count and creates nothing.  Lines without a parent are dropped.
    Levels are resolved one after the other over the whole table, as many as there are.
    """
    lines = materialize(lines.select("line_no", "lvl", "name", "count", "desc"), "tree-lines")
    root = F.array().cast("array<bigint>")
    level = lines.filter("lvl = 1").withColumn("above", root)
    tree = None
    for lvl in itertools.count(1):
        created = (
            level.groupBy("above", "name")
            .agg(F.min("line_no").alias("at"), F.sum("count").alias("count"), F.min_by("desc", "line_no").alias("desc"))
            .select(
                F.concat("above", F.array("at")).alias("path"),
                F.lit(lvl).alias("lvl"),
                "name",
                "count",
                "desc",
            )
        )
        created = materialize(created, f"tree-level-{lvl}")
        tree = created if tree is None else tree.unionByName(created)
        below = lines.filter(F.col("lvl") == lvl + 1)
        if below.isEmpty() or created.isEmpty():
            break
        marks = created.select(ordinal().alias("line_no"), F.col("path").alias("mark"))
        merged = marks.unionByName(below, allowMissingColumns=True)
        level = carry_forward(merged, "line_no", "mark", "above").filter(
            F.col("mark").isNull() & F.col("above").isNotNull()
        )
    return tree.select(*NODE)


def add_topics(tree: DataFrame, additions: DataFrame) -> DataFrame:
    """Insert ``parent, lvl, name, count, desc, ordinal`` rows.

    The exact name under the same parent adds its count to that node; a new
    name becomes the parent's last child.  First come, first kept.
    """
    existing = tree.select(
        parent_path().alias("parent"), "lvl", "name", "count", "desc", ordinal().alias("ordinal"), F.lit(0).alias("new")
    )
    added = additions.select("parent", "lvl", "name", "count", "desc", "ordinal", F.lit(1).alias("new"))
    rank = F.struct("new", "ordinal")
    return (
        existing.unionByName(added)
        .groupBy("parent", "name")
        .agg(
            F.min_by(F.struct("ordinal", "lvl", "desc"), rank).alias("first"),
            F.sum("count").alias("count"),
        )
        .select(
            F.concat("parent", F.array("first.ordinal")).alias("path"),
            F.col("first.lvl").alias("lvl"),
            "name",
            "count",
            F.col("first.desc").alias("desc"),
        )
    )


def without_subtrees(tree: DataFrame, removed: DataFrame) -> DataFrame:
    """Drop the nodes whose ``path`` is listed and everything below them."""
    ancestors = F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", 1, n))
    gone = (
        tree.select("path", F.explode(ancestors).alias("above"))
        .join(removed.select(F.col("path").alias("above")), "above", "left_semi")
        .select("path")
        .distinct()
    )
    return tree.join(gone, "path", "left_anti").select(*NODE)


def remove_topic(tree: DataFrame, keys: DataFrame) -> DataFrame:
    """Remove, per exact ``(name, lvl)`` key, the first node in depth-first order."""
    hit = tree.join(keys.select("name", "lvl").distinct(), ["name", "lvl"], "left_semi")
    first = hit.groupBy("name", "lvl").agg(F.min("path").alias("path"))
    return without_subtrees(tree, first.select("path"))


def level1_total(tree: DataFrame) -> DataFrame:
    """Sum of counts of the root's children."""
    return tree.filter(F.size("path") == 1).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"))


def remove_rare_topics(tree: DataFrame, share: float = RARE_SHARE) -> DataFrame:
    """Drop level-1 children of the root below ``share`` of all counts, with their subtrees."""
    total = level1_total(tree).scalar()
    rare = tree.filter((F.size("path") == 1) & (F.col("lvl") == 1) & (F.col("count") < total * F.lit(share)))
    roots = rare.select(F.col("path")[0].alias("head"))
    return (
        tree.withColumn("head", F.col("path")[0]).join(roots, "head", "left_anti").select(*NODE)
    )


def leaves(tree: DataFrame) -> DataFrame:
    parents = tree.filter(F.size("path") > 1).select(parent_path().alias("path")).distinct()
    return tree.join(parents, "path", "left_anti").select(*NODE)


def expandable_topics(tree: DataFrame, docs_with_topics: Column, share: float, max_topics: int | None = None) -> DataFrame:
    """Leaves counted more often than ``share`` of the documents with topics.

    ``max_topics`` keeps the first ones in depth-first order.
    """
    frequent = leaves(tree).filter(F.col("count") > docs_with_topics * F.lit(share))
    return cap_parents(frequent, max_topics)


def cap_parents(topics: DataFrame, max_topics: int | None) -> DataFrame:
    return topics if max_topics is None else topics.orderBy("path").limit(max_topics)
