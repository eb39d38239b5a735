"""Responses to topic rows: line parsing and line-level filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusgrove.functions import grammar as G, text as X


def response_lines(df: DataFrame, column: str = "responses", stripped: bool = True) -> DataFrame:
    """One row per response line: ``doc_idx, line_idx, line``."""
    out = df.select("doc_idx", F.posexplode(X.lines(F.col(column))).alias("line_idx", "line"))
    return out.withColumn("line", X.strip(F.col("line"))) if stripped else out


def parse_level1_lines(lines: DataFrame) -> DataFrame:
    """Adds ``lvl, name, desc`` and ``valid`` (false: the line has no topic)."""
    line = F.col("line")
    lvl = X.group(line, G.LEVEL1_LINE, 1).try_cast("int")
    return lines.select(
        "*",
        lvl.alias("lvl"),
        X.strip(X.group(line, G.LEVEL1_LINE, 2)).alias("name"),
        X.strip(X.group(line, G.LEVEL1_LINE, 3)).alias("desc"),
        (X.matches(line, G.LEVEL1_LINE) & lvl.isNotNull()).alias("valid"),
    )


def level1_rejects(lines: DataFrame) -> DataFrame:
    return parse_level1_lines(lines).filter(~F.col("valid")).select("doc_idx", "line_idx", "line")


def level_gate(lines: DataFrame) -> DataFrame:
    """Topic lines the first stage accepts: valid and on level 1."""
    return (
        parse_level1_lines(lines)
        .filter(F.col("valid") & (F.col("lvl") == 1))
        .select("doc_idx", "line_idx", "name", "desc")
    )


def parse_merge_lines(df: DataFrame, column: str = "responses", key: str = "doc_idx") -> DataFrame:
    """Merge lines of refinement responses with their originals."""
    line = F.col("line")
    parsed = (
        df.select(key, F.posexplode(X.lines(F.col(column))).alias("line_idx", "line"))
        .withColumn("line", X.strip(line))
        .filter(X.matches(line, G.MERGE_LINE))
    )
    originals = X.strip(X.group(line, G.MERGE_LINE, 4))
    return parsed.select(
        key,
        "line_idx",
        X.group(line, G.MERGE_LINE, 1).try_cast("int").alias("lvl"),
        X.strip(X.group(line, G.MERGE_LINE, 2)).alias("name"),
        X.strip(X.group(line, G.MERGE_LINE, 3)).alias("desc"),
        originals.alias("originals"),
    ).filter(F.col("lvl").isNotNull())


def explode_originals(merges: DataFrame, key: str = "doc_idx") -> DataFrame:
    """One row per original of a merge line, in order; one null row if none."""
    return merges.select(
        key,
        "line_idx",
        "name",
        "desc",
        F.posexplode_outer(X.merge_originals(F.col("originals"))).alias("pos", "o"),
    ).select(
        key,
        "line_idx",
        "pos",
        F.col("name").alias("new_name"),
        F.col("desc").alias("new_desc"),
        F.col("o.name").alias("old_name"),
        F.col("o.lvl").alias("old_lvl"),
    )


def parse_subtopic_lines(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Matching lines of second-level responses.

    ``documents`` holds the document numbers named in brackets, ``desc`` the
    text behind them, ``adds`` whether the line has a colon.
    """
    line = F.col("line")
    parsed = (
        df.select(*keys, F.posexplode(X.lines(X.strip(F.col(column)))).alias("line_idx", "line"))
        .withColumn("line", X.strip(line))
        .filter(X.matches(line, G.SUBTOPIC_LINE))
    )
    return parsed.select(
        *keys,
        "line_idx",
        X.group(line, G.SUBTOPIC_LINE, 1).try_cast("int").alias("lvl"),
        X.strip(X.group(line, G.SUBTOPIC_LINE, 2)).alias("name"),
        F.transform(
            F.regexp_extract_all(X.group(line, G.SUBTOPIC_LINE, 4), F.lit(r"(\d+)"), F.lit(1)),
            lambda n: n.try_cast("int"),
        ).alias("documents"),
        X.strip_chars(X.group(line, G.SUBTOPIC_LINE, 5), " :").alias("desc"),
        F.contains(line, F.lit(":")).alias("adds"),
    ).filter(F.col("lvl").isNotNull())
