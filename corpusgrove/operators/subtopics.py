"""Documents per topic, and folding second-level responses into the tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from corpusgrove.functions import text as X
from corpusgrove.operators.responses import parse_subtopic_lines
from corpusgrove.operators.tree import add_topics, parent_path
from corpusgrove.schema import SUBTOPIC_BASE, node_ordinal
from corpusgrove.storage import materialize


def topic_mentions(df: DataFrame, labels: DataFrame, column: str | None = None) -> DataFrame:
    """Listed labels each response names: ``doc_idx, pos, topic``.

    Only ids and labels meet in the join; adaptive execution broadcasts the
    labels when they are few and splits hot ones when they are not.
    """
    column = column or X.response_column(df)
    named = df.select("doc_idx", F.posexplode(X.doc_topic_labels(F.col(column))).alias("pos", "topic"))
    return named.join(labels.select(F.col("label").alias("topic")).distinct(), "topic", "left_semi").select(
        "doc_idx", "pos", "topic"
    )


def doc_topics(df: DataFrame, labels: DataFrame, column: str | None = None) -> DataFrame:
    """``doc_idx, topics``: the listed labels in line order, ``["None"]`` if none."""
    per_doc = topic_mentions(df, labels, column).groupBy("doc_idx").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "topic"))), lambda t: t["topic"]).alias("found")
    )
    none = F.array(F.lit("None"))
    return df.select("doc_idx").join(per_doc, "doc_idx", "left").select(
        "doc_idx", F.coalesce("found", none).alias("topics")
    )


def docs_with_topics(df: DataFrame) -> DataFrame:
    return df.filter(F.col("topics") != F.array(F.lit("None")))


def docs_for_topics(mentions: DataFrame, topics: DataFrame) -> DataFrame:
    """``topic, doc_idx`` of every listed topic at once, each document once."""
    return mentions.join(topics.select(F.col("label").alias("topic")).distinct(), "topic", "left_semi").select(
        "topic", "doc_idx"
    ).distinct()


def doc_frequency(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("topic").agg(F.countDistinct("doc_idx").alias("docs"))


def subtopic_parent(lines: DataFrame, lookups: DataFrame, prompt: str = "prompt_idx") -> DataFrame:
    """Lines that add a subtopic, with the node they go under.

    Until a line names an existing node, every line of a response is a lookup;
    after that the lines with a colon add under the node found last and the
    others keep looking up.  ``lookups`` holds ``prompt, line_idx, found``.
    """
    seen = lines.join(lookups, [prompt, "line_idx"], "left")
    response = W.partitionBy(prompt)
    first = F.min(F.when(F.col("found").isNotNull(), F.col("line_idx"))).over(response)
    armed = seen.withColumn("first", first)
    looks = (F.col("line_idx") <= F.col("first")) | ~F.col("adds")
    before = response.orderBy("line_idx").rowsBetween(W.unboundedPreceding, -1)
    return (
        armed.withColumn("parent", F.last(F.when(looks, F.col("found")), True).over(before))
        .filter(F.col("adds") & (F.col("line_idx") > F.col("first")))
        .drop("first", "found")
    )


def _static_lookups(lines: DataFrame, tree: DataFrame, prompt: str) -> DataFrame:
    nodes = tree.groupBy(F.lower("name").alias("key"), "lvl").agg(F.min("path").alias("found"))
    return lines.withColumn("key", F.lower("name")).join(nodes, ["key", "lvl"]).select(
        prompt, "line_idx", "found"
    )


def _created_lookups(lines: DataFrame, created: DataFrame, prompt: str) -> DataFrame:
    """The first path among the subtopics added before a line under the name the line looks up.

    Births and lookups of a name meet as rows: each stretch of a name's
    ordinals carries its running least path, and one row for each stretch
    carries the least path of the stretches before, so a name that most lines
    use is no quadratic join and no single task.
    """
    rows = lines.filter("lvl = 2").select(
        F.lower("name").alias("key"), F.col("ordinal").alias("at"), F.lit(None).cast("array<bigint>").alias("path"), prompt, "line_idx"
    )
    births = created.select(F.lower("name").alias("key"), F.element_at("path", -1).alias("at"), "path")
    both = births.unionByName(rows, allowMissingColumns=True).withColumn("stretch", F.shiftright("at", 36))
    least = both.groupBy("key", "stretch").agg(F.min("path").alias("p"))
    before = W.partitionBy("key").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = least.select("key", "stretch", F.min("p").over(before).alias("carried"))
    inside = W.partitionBy("key", "stretch").orderBy("at").rangeBetween(W.unboundedPreceding, -1)
    return (
        both.withColumn("own", F.min("path").over(inside))
        .filter(F.col(prompt).isNotNull())
        .join(carried, ["key", "stretch"])
        .select(prompt, "line_idx", F.least("own", "carried").alias("found"))
        .filter("found is not null")
    )


def likely_subtopics(tree: DataFrame, lines: DataFrame, static: DataFrame, prompt: str) -> DataFrame:
    """Subtopics as they come into being if every line that names one means the first line that may add it.

    A line that names a subtopic refers to the first line that may add that
    name; a line that adds refers to the line before it that names its parent.
    These references form paths that end at nodes of the tree.  They are
    followed by doubling, so a path of n links takes log n joins.
    """
    named = lines.join(static, [prompt, "line_idx"], "left").withColumn("key", F.lower("name"))
    births = lines.filter("adds").groupBy(F.lower("name").alias("key")).agg(F.min("ordinal").alias("birth"))
    refers = F.when(F.col("found").isNull() & (F.col("lvl") == 2) & (F.col("birth") < F.col("ordinal")), F.col("birth"))
    named = named.join(births, "key", "left").select(prompt, "line_idx", "ordinal", "adds", "name", "found", refers.alias("birth"))
    usable = F.col("found").isNotNull() | F.col("birth").isNotNull()
    response = W.partitionBy(prompt)
    before = response.orderBy("line_idx").rowsBetween(W.unboundedPreceding, -1)
    first = F.min(F.when(usable, F.col("line_idx"))).over(response)
    looks = usable & ((F.col("line_idx") <= F.col("first")) | ~F.col("adds"))
    named = named.withColumn("first", first).withColumn("under", F.last(F.when(looks, F.col("ordinal")), True).over(before)).withColumn("looks", looks)
    named = materialize(named, "subtopic-references")
    added = named.filter("adds and line_idx > first and under is not null").select("ordinal", "name", "under")
    steps = named.filter("looks").select("ordinal", "found", "birth").join(
        added.select(F.col("ordinal").alias("birth"), F.col("under").alias("next")), "birth", "left"
    )
    here = F.when(F.col("found").isNull(), F.array("birth")).otherwise(F.array().cast("array<bigint>"))
    steps = materialize(steps.select("ordinal", F.col("found").alias("path"), "next", here.alias("rest")), "subtopic-steps")
    while not steps.filter("path is null and next is not null").isEmpty():
        ahead = steps.select(F.col("ordinal").alias("next"), F.col("path").alias("p"), F.col("next").alias("n"), F.col("rest").alias("r"))
        steps = steps.join(ahead, "next", "left").select(
            "ordinal",
            F.coalesce("path", F.concat("p", "rest")).alias("path"),
            F.when(F.col("path").isNull() & F.col("p").isNull(), F.col("n")).alias("next"),
            F.when(F.col("path").isNull() & F.col("p").isNull(), F.concat("r", "rest")).otherwise(F.col("rest")).alias("rest"),
        )
        steps = materialize(steps, "subtopic-steps")
    parents = steps.filter("path is not null").select(F.col("ordinal").alias("under"), F.col("path").alias("parent"))
    return _created(tree, added.join(parents, "under").select("parent", "name", "ordinal"))


def fold_subtopics(tree: DataFrame, responses: DataFrame, column: str = "topics", prompt: str = "prompt_idx") -> DataFrame:
    """The tree after all second-level responses, taken in ``prompt`` order.

    Every prompt is folded at once, given the subtopics that come into being.  A
    fold that reproduces the subtopics it was given is the sequential one, by
    induction over the lines, whatever they were; so it starts from the likely
    ones and repeats with those it finds until they no longer change.
    """
    lines = parse_subtopic_lines(responses, column, [prompt]).withColumn(
        "ordinal", node_ordinal(SUBTOPIC_BASE, F.col(prompt), F.col("line_idx"))
    )
    lines = materialize(lines, "subtopic-lines")
    static = materialize(_static_lookups(lines, tree, prompt), "subtopic-lookups")
    additions = created = None
    while True:
        lookups = static
        if created is not None:
            dynamic = _created_lookups(lines, created, prompt)
            lookups = static.unionByName(dynamic).groupBy(prompt, "line_idx").agg(F.min("found").alias("found"))
        additions = materialize(
            subtopic_parent(lines, lookups, prompt).select(
                "parent", F.lit(2).alias("lvl"), "name", F.lit(1).cast("long").alias("count"), "desc", "ordinal"
            ),
            "subtopic-additions",
        )
        if created is None:
            # nothing looks up a name that may be added: the first pass is final
            names = lines.filter("adds").select(F.lower("name").alias("key")).distinct()
            asked = lines.filter("lvl = 2").join(additions.select("ordinal"), "ordinal", "left_anti")
            if asked.withColumn("key", F.lower("name")).join(names, "key", "left_semi").isEmpty():
                break
            created = materialize(likely_subtopics(tree, lines, static, prompt), "subtopics")
            continue
        grown = materialize(_created(tree, additions), "subtopics")
        if _same(grown, created):
            break
        created = grown
    return add_topics(tree, additions)


def _created(tree: DataFrame, additions: DataFrame) -> DataFrame:
    """Nodes the additions bring into being."""
    known = tree.select(parent_path().alias("parent"), "name")
    return (
        additions.join(known, ["parent", "name"], "left_anti")
        .groupBy("parent", "name")
        .agg(F.min("ordinal").alias("ordinal"))
        .select(F.concat("parent", F.array("ordinal")).alias("path"), "name")
    )


def _same(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
