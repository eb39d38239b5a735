"""Checking assignments against the tree, and writing corrections back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusgrove.functions import text as X


def assignment_names(df: DataFrame, column: str = "responses") -> DataFrame:
    """Adds ``topics``: the names an assignment response mentions."""
    return df.withColumn("topics", X.assigned_topics(F.col(column)))


def grounding_errors(df: DataFrame, column: str = "responses") -> DataFrame:
    """Documents whose response names no topic."""
    return df.filter(F.size(X.assigned_topics(F.col(column))) == 0)


def _mentions(df: DataFrame, column: str) -> DataFrame:
    named = df.select("doc_idx", F.array_distinct(X.assigned_topics(F.col(column))).alias("topics"))
    return named.select("doc_idx", F.explode("topics").alias("topic"))


def _known(names: DataFrame) -> DataFrame:
    return names.select(F.col("name").alias("topic")).distinct()


def ungrounded_topics(df: DataFrame, names: DataFrame, column: str = "responses") -> DataFrame:
    """Distinct mentioned names absent from the tree, exact case, any level.

    Mentions collapse to distinct names before the anti-join, so a name used by
    most documents is one row there.
    """
    mentioned = _mentions(df, column).groupBy("topic").agg(F.count(F.lit(1)).alias("docs"))
    return mentioned.join(_known(names), "topic", "left_anti")


def grounding_hallucinated(df: DataFrame, names: DataFrame, column: str = "responses") -> DataFrame:
    """Document ids with at least one mentioned name that is not in the tree.

    Only ids and names meet in the join.  A tree below the broadcast threshold
    keeps it map-side; above it adaptive execution splits hot names.
    """
    return _mentions(df, column).join(_known(names), "topic", "left_anti").select("doc_idx").distinct()


def reprompt_set(df: DataFrame, names: DataFrame, column: str = "responses") -> DataFrame:
    """``doc_idx, reason`` of every document to ask again: ``error`` or ``hallucinated``.

    Only ids and names meet: a tree small enough for Spark to broadcast keeps
    the check map-side, a larger one joins by name.
    """
    errors = grounding_errors(df, column).select("doc_idx", F.lit("error").alias("reason"))
    unlisted = grounding_hallucinated(df, names, column).select("doc_idx", F.lit("hallucinated").alias("reason"))
    return errors.unionByName(unlisted)


def with_reason(df: DataFrame, names: DataFrame, column: str = "responses") -> DataFrame:
    """Adds ``reason``: ``error``, ``hallucinated`` or null for a grounded row."""
    return df.join(reprompt_set(df, names, column), "doc_idx", "left")


def grounding_report(df: DataFrame, names: DataFrame, column: str = "responses") -> DataFrame:
    """One row: numbers of documents without a topic and with an unlisted one."""
    return reprompt_set(df, names, column).agg(
        F.count_if(F.col("reason") == "error").alias("errors"),
        F.count_if(F.col("reason") == "hallucinated").alias("hallucinated"),
    )


def apply_corrections(df: DataFrame, corrections: DataFrame, column: str = "responses") -> DataFrame:
    """Overwrite responses of the corrected documents (``doc_idx, response``)."""
    new = corrections.select("doc_idx", F.col("response").alias("__new"))
    order = df.columns
    return (
        df.join(new, "doc_idx", "left")
        .withColumn(column, F.coalesce("__new", column))
        .drop("__new")
        .select(*order)
    )


def error_rows(df: DataFrame) -> DataFrame:
    return df.filter("status = 'error'")
