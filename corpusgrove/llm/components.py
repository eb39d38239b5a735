"""Connected components of a graph held in DataFrames.

Labels and edges stay distributed.  Each round every node takes the smallest
label among its neighbours and then the label of that label's node, so the
number of rounds is about logarithmic in the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusgrove.storage import materialize

TASK_ROWS = 1 << 15


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a table of about ``rows`` short rows, in as many tasks as that takes, eight at least.

    A round writes one file a task, and every file costs an executor more than a few rows do.
    """
    return df.coalesce(max(8, -(-rows // TASK_ROWS)))


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (a, b); component is its smallest id."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.where("a != b").distinct(), "edges")
    rows = both.count()  # no fewer than there are nodes
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "id")
    labels = materialize(few_files(labels, rows), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        taken = labels.join(near, labels["id"] == near["a"]).select("id", "label", F.least("label", "near").alias("next"))
        roots = labels.select(F.col("id").alias("next"), F.col("label").alias("root"))
        moved = taken.join(roots, "next").select("id", F.col("label").alias("old"), F.least("next", "root").alias("label"))
        moved = materialize(few_files(moved, rows), "labels")
        labels = moved.select("id", "label")
        if moved.where("old != label").isEmpty():
            return labels.withColumnRenamed("label", "component")


def merge_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (id, component) after more ``edges`` (a, b); only the components they join are walked through again."""
    a = labels.select(F.col("id").alias("a"), F.col("component").alias("left"))
    b = labels.select(F.col("id").alias("b"), F.col("component").alias("right"))
    ends = edges.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("left", "a").alias("a"), F.coalesce("right", "b").alias("b"))
    joined = connected_components(ends)
    moved = joined.select(F.col("id").alias("component"), F.col("component").alias("to"))
    old = labels.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    new = joined.join(labels.select("id"), "id", "left_anti")
    return materialize(few_files(old.unionByName(new), labels.count() + joined.count()), "components")
