"""Folding level-1 responses into a topic table, in document order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from corpusgrove.operators.ordering import dense_index, next_value
from corpusgrove.schema import CREATED_BASE, node_ordinal
from corpusgrove.storage import materialize

STOP_BUCKET = 1 << 16


def line_ordinal(doc: str = "doc_idx", line: str = "line_idx") -> Column:
    """Order-preserving number of a response line; ordinal of the node it makes."""
    return node_ordinal(CREATED_BASE, F.col(doc), F.col(line))


def name_counts(lines: DataFrame) -> DataFrame:
    """Per name in any case: ``key, n`` lines, ``ordinal, name, desc`` of the first one, and its ``g`` if lines are numbered."""
    number = ["g"] if "g" in lines.columns else []
    ordered = lines.select(F.lower("name").alias("key"), line_ordinal().alias("ordinal"), "name", "desc", *number)
    # numbers only, so Spark counts by hash; names are fetched for the first lines alone
    found = ordered.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("ordinal"))
    return ordered.join(found, ["key", "ordinal"]).select("key", "n", "ordinal", "name", "desc", *number)


def topic_rows(counts: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """The tree that counted names make on top of ``seeds``.

    The first level-1 node of a name among the seeds absorbs the lines of that
    name on top of its own count, and every other seed stays as it is.
    """
    made = counts.select("key", F.array("ordinal").alias("path"), F.lit(1).alias("lvl"), "name", F.col("n").alias("count"), "desc")
    if seeds is None:
        return made.drop("key")
    level1 = seeds.filter("lvl = 1").withColumn("key", F.lower("name"))
    owner = level1.groupBy("key").agg(F.min("path").alias("owner"))
    marked = level1.join(owner, "key").withColumn("owns", F.col("path") == F.col("owner"))
    lines_of = counts.select("key", "n")
    grown = marked.filter("owns").join(lines_of, "key", "left").select(
        "path", F.lit(1).alias("lvl"), "name", (F.col("count") + F.coalesce("n", F.lit(0))).alias("count"), "desc"
    )
    others = marked.filter("not owns").unionByName(seeds.filter("lvl <> 1"), allowMissingColumns=True)
    new = made.join(owner.select("key"), "key", "left_anti").drop("key")
    return new.unionByName(grown).unionByName(others.select("path", "lvl", "name", "count", "desc"))


def topic_counts(lines: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Topic rows from level-1 lines: first spelling and description, line count.

    A name matches case-insensitively; ``seeds`` is a tree that exists before
    the first line.
    """
    return topic_rows(name_counts(lines), seeds)


def match_existing(lines: DataFrame, topics: DataFrame) -> DataFrame:
    """The node each line counts towards: same level, same name in any case.

    The join is an equi-join on the folded name; adaptive execution broadcasts
    the topic side when it is small and splits hot names when it is not.
    """
    nodes = (
        topics.groupBy(F.lower("name").alias("key"), "lvl")
        .agg(F.min_by(F.struct("path", "name"), "path").alias("node"))
    )
    return (
        lines.withColumn("key", F.lower("name"))
        .join(nodes, ["key", "lvl"], "left")
        .drop("key")
        .withColumn("node_path", F.col("node.path"))
        .withColumn("node_name", F.col("node.name"))
        .drop("node")
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Dense line index ``g`` over the accepted lines, in document order."""
    return dense_index(lines, ["doc_idx", "line_idx"], "g")


def early_stop_position(numbered: DataFrame, patience: int, seeds: DataFrame | None = None) -> DataFrame:
    """The line at which generation stops, as at most one row.

    It is the line that makes more than ``patience`` repeats in a row since the
    last new topic (or since the start).  Only the table of first mentions is
    ordered; the stop line is looked up by its index afterwards.
    """
    firsts = numbered.groupBy(F.lower("name").alias("key")).agg(F.min("g").alias("g"))
    if seeds is not None:
        known = seeds.filter("lvl = 1").select(F.lower("name").alias("key"))
        firsts = firsts.join(known, "key", "left_anti")
    before = numbered.sparkSession.range(1).select(F.lit(-1).cast("long").alias("g"))
    candidate = stop_line(firsts.select("g").unionByName(before), patience)
    return numbered.join(candidate, "g", "left_semi")


@dataclass(frozen=True)
class FoldState:
    """What the lines of consecutive documents leave behind.

    ``topics`` is ``name_counts`` with ``g`` counted from the first line of the
    stretch, ``lines`` their number, ``last_new`` the ``g`` of the last line with
    a new name, -1 if there is none.  States of neighbouring stretches join into
    the state of both, whatever the cuts.
    """

    topics: DataFrame
    lines: int
    last_new: int


def start(spark: SparkSession, seeds: DataFrame | None = None) -> FoldState:
    """Before the first line; the level-1 names of ``seeds`` are not new to any line."""
    nothing = spark.createDataFrame([], "key string, n long, ordinal long, name string, desc string, g long")
    if seeds is None:
        return FoldState(nothing, 0, -1)
    keys = seeds.filter("lvl = 1").select(F.lower("name").alias("key")).distinct()
    known = keys.select("key", F.lit(0).cast("long").alias("n"), *[F.lit(None).cast(nothing.schema[c].dataType).alias(c) for c in ("ordinal", "name", "desc")], F.lit(-1).cast("long").alias("g"))
    return FoldState(materialize(known, "level1-state"), 0, -1)


def stretch(numbered: DataFrame) -> FoldState:
    """The state of some numbered lines by themselves."""
    found = materialize(name_counts(numbered), "level1-stretch")
    lines, newest = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("g"), F.lit(-1))).first()
    return FoldState(found, lines, newest)


def joined(a: FoldState, b: FoldState) -> FoldState:
    """The state of stretch ``a`` with stretch ``b`` behind it; reads the two tables of names, no lines."""
    later = b.topics.select("key", *[F.col(c).alias(f"b_{c}") for c in ("n", "ordinal", "name", "desc")], (F.col("g") + a.lines).alias("b_g"))
    first = lambda c: F.when(F.col("g").isNotNull(), F.col(c)).otherwise(F.col(f"b_{c}")).alias(c)
    both = a.topics.join(later, "key", "full").select(
        "key", (F.coalesce("n", F.lit(0)) + F.coalesce("b_n", F.lit(0))).alias("n"), *map(first, ("ordinal", "name", "desc", "g"))
    )
    both = materialize(both, "level1-state")
    newest = both.filter(F.col("g") >= a.lines).agg(F.max("g")).first()[0]
    return FoldState(both, a.lines + b.lines, a.last_new if newest is None else newest)


def advance(state: FoldState, numbered: DataFrame, patience: int) -> tuple[FoldState, Row | None]:
    """The state after more lines (numbered from 0), and the line that stops the run (``doc_idx, g``).

    Lines behind the stop do not count.  Only the new lines are read; of the
    state, only its names.
    """
    more = stretch(numbered)
    stop = None
    # with fewer lines since the last new one no run can be long enough
    if state.lines + more.lines - state.last_new - 1 > patience:
        spark = numbered.sparkSession
        fresh = more.topics.join(state.topics.select("key"), "key", "left_anti").select("g")
        before = spark.range(1).select(F.lit(state.last_new - state.lines).cast("long").alias("g"))
        at = stop_line(fresh.unionByName(before), patience).first()[0]
        if at is not None and at < more.lines:
            stop = numbered.filter(F.col("g") == at).select("doc_idx", "g").first()
            more = stretch(numbered.filter(F.col("g") <= at))
    return joined(state, more), stop


def stop_line(marks: DataFrame, patience: int) -> DataFrame:
    """One row: the ``g`` of the line that would be one repeat too many, from the ``g`` of new lines."""
    following = next_value(marks, "g", "next_g", STOP_BUCKET)
    stop = F.col("g") + patience + 1
    return following.filter(F.col("next_g").isNull() | (stop < F.col("next_g"))).agg(F.min(stop).alias("g"))


def first_error(responses: DataFrame) -> DataFrame:
    """One row: the first document whose completion failed, or null."""
    return responses.filter("status = 'error'").agg(F.min("doc_idx").alias("doc_idx"))


def stop_on_error(responses: DataFrame) -> DataFrame:
    """Documents up to and including the first failing one."""
    error = first_error(responses).scalar()
    return responses.filter(error.isNull() | (F.col("doc_idx") <= error))


def early_stop_kept_docs(responses: DataFrame, stop: DataFrame) -> DataFrame:
    """Documents before the one that holds the stop line."""
    at = stop.agg(F.min("doc_idx")).scalar()
    return responses.filter(at.isNull() | (F.col("doc_idx") < at))


def lines_until(numbered: DataFrame, stop: DataFrame) -> DataFrame:
    """Lines that count: everything up to and including the stop line."""
    at = stop.agg(F.min("g")).scalar()
    return numbered.filter(at.isNull() | (F.col("g") <= at))


def first_seen_desc(lines: DataFrame) -> DataFrame:
    """Spelling and description each topic keeps, with the line it came from."""
    ordered = lines.select(F.lower("name").alias("key"), line_ordinal().alias("ordinal"), "doc_idx", "line_idx", "name", "desc")
    firsts = ordered.groupBy("key").agg(F.min("ordinal").alias("ordinal"))
    return ordered.join(firsts, ["key", "ordinal"]).select("key", "doc_idx", "line_idx", "name", "desc")
