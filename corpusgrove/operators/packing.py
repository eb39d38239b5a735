"""Packing the documents of each topic into prompts of bounded size.

Documents of a topic are packed in order; a batch closes when the next document
would bring it to the budget.  That is a sequential rule, and one topic may
hold a third of the corpus, so a topic is cut into chunks of consecutive
documents.  What a chunk does depends on earlier ones only through the tokens
already in the open batch, hence:

1. each chunk, in parallel, tabulates entry fill -> exit fill and closed batches;
2. tables of ``FAN`` consecutive chunks compose into one, those again, up to one table
   a topic, and the fills go back down the same levels, so no task holds more than
   ``FAN`` tables;
3. each chunk, in parallel, numbers its batches from its now known entry fill.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpusgrove.functions import text as X
from corpusgrove.functions.grammar import PACK_FRACTION
from corpusgrove.operators.ordering import dense_index
from corpusgrove.storage import materialize

CHUNK = 20_000
FAN = 64


def _next_starts(sizes: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums, and for each start the document that closes its batch."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    closes = np.searchsorted(total, total[:-1] + budget, side="left") - 1
    # a document starting a batch always stays in it, however large
    return total, np.maximum(closes, np.arange(len(sizes)) + 1)


def _summary(sizes: np.ndarray, budget: int) -> list[tuple[int, int, int, int]]:
    """Rows (lowest entry fill, exit fill, batches closed, tokens passed through).

    A row holds from its lowest fill up to the next row's.  Exit fill is -1 when
    the open batch survives the whole chunk; it then grows by the tokens.
    """
    total, nxt = _next_starts(sizes, budget)
    n = len(sizes)
    fill, closed = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for p in range(n - 1, -1, -1):
        if nxt[p] >= n:
            fill[p], closed[p] = total[n] - total[p], 1
        else:
            fill[p], closed[p] = fill[nxt[p]], closed[nxt[p]] + 1
    rows = []
    if total[n] < budget:
        rows.append((0, -1, 0, int(total[n])))
    reach = int(min(n, np.searchsorted(total, budget, side="left")))
    for p in range(reach - 1, -1, -1):
        lowest = max(0, int(budget - total[p + 1]))
        row = (lowest, int(fill[p]), int(closed[p]), 0)
        if rows and rows[-1][0] == lowest:
            rows[-1] = row
        elif not rows or rows[-1][1:] != row[1:]:
            rows.append(row)
    return rows


Table = list[tuple[int, int, int, int]]


def _pass(table: Table, fill: int) -> tuple[int, int]:
    """Exit fill and closed batches for an entry fill."""
    row = table[bisect_right(table, fill, key=lambda r: r[0]) - 1]
    return (fill + row[3] if row[1] < 0 else row[1]), row[2]


def _then(first: Table, second: Table) -> Table:
    """The table of two consecutive stretches."""
    out: Table = []
    for k, (lowest, leaves, closed, passed) in enumerate(first):
        if leaves >= 0:
            fill, more = _pass(second, leaves)
            rows = [(lowest, fill, closed + more, 0)]
        else:
            # the open batch comes through: cut where the second table changes
            end = first[k + 1][0] if k + 1 < len(first) else None
            at = bisect_right(second, lowest + passed, key=lambda r: r[0]) - 1
            rows = [
                (max(lowest, low - passed), fill, more, passed + grown if fill < 0 else 0)
                for low, fill, more, grown in second[at:]
                if end is None or low - passed < end
            ]
        for row in rows:
            if not out or out[-1][1:] != row[1:]:
                out.append(row)
    return out


def _number(sizes: np.ndarray, budget: int, fill: int, batch: int) -> np.ndarray:
    """Batch of every document, entering with ``fill`` tokens in ``batch``."""
    total, nxt = _next_starts(sizes, budget)
    out = np.full(len(sizes), batch, dtype=np.int64)
    p = int(np.searchsorted(total, budget - fill, side="left")) - 1
    while p < len(sizes):
        batch += 1
        out[p : nxt[p]] = batch
        p = int(nxt[p])
    return out


def number_batches(sized: DataFrame, keys: list[str], budget: int, chunk: int = CHUNK) -> DataFrame:
    """Adds ``batch_id`` (0, 1, ...) to ``keys, n, n_tokens`` rows, ``n`` from 0."""
    if budget < 2 * PACK_FRACTION:
        raise ValueError(f"a prompt budget of {budget} tokens holds no document")
    slim = sized.select(*keys, "n", F.col("n_tokens").cast("long").alias("n_tokens"), F.expr(f"n div {chunk}").alias("chunk"))
    kinds = dict(slim.dtypes)
    key_schema = ", ".join(f"{k} {kinds[k]}" for k in keys)

    def summarise(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows.sort_values("n")["n_tokens"].to_numpy()
        table = pd.DataFrame(_summary(sizes, budget), columns=["lowest", "exit", "closed", "passed"])
        for name, value in zip([*keys, "chunk"], key):
            table[name] = [value] * len(table)
        return table

    def tables_of(rows: pd.DataFrame, by: str) -> dict[int, Table]:
        ordered = rows.sort_values([by, "lowest"])
        columns = ["lowest", "exit", "closed", "passed"]
        return {unit: [tuple(map(int, r)) for r in part[columns].to_numpy()] for unit, part in ordered.groupby(by, sort=True)}

    def compose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        whole = reduce(_then, tables_of(rows, "unit").values())
        table = pd.DataFrame(whole, columns=["lowest", "exit", "closed", "passed"])
        for name, value in zip([*keys, "unit"], key):
            table[name] = [value] * len(table)
        return table

    def descend(key: tuple, rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        fill, batch = (int(entry["fill"].iloc[0]), int(entry["batch"].iloc[0])) if len(entry) else (0, 0)
        out = []
        for unit, table in tables_of(rows, "unit").items():
            out.append((*key[:-1], unit, fill, batch))
            fill, closed = _pass(table, fill)
            batch += closed
        return pd.DataFrame(out, columns=[*keys, "unit", "fill", "batch"])

    def number(key: tuple, rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n")
        fill, batch = int(entry["fill"].iloc[0]), int(entry["batch"].iloc[0])
        rows["batch_id"] = _number(rows["n_tokens"].to_numpy(), budget, fill, batch)
        return rows[[*keys, "n", "batch_id"]]

    table_schema = "lowest bigint, exit bigint, closed bigint, passed bigint"
    tables = slim.groupBy(*keys, "chunk").applyInPandas(summarise, f"{key_schema}, chunk bigint, {table_schema}")
    levels = [materialize(tables.withColumnRenamed("chunk", "unit"), "chunk-tables")]
    last = levels[0].agg(F.max("unit")).first()[0] or 0
    while last >= FAN:
        numbered = levels[-1].withColumn("above", F.expr(f"unit div {FAN}"))
        up = numbered.groupBy(*keys, "above").applyInPandas(compose, f"{key_schema}, unit bigint, {table_schema}")
        levels.append(materialize(up, "chunk-tables"))
        last //= FAN
    entries = sized.sparkSession.createDataFrame([], f"{key_schema}, unit bigint, fill bigint, batch bigint")
    for level in reversed(levels):
        grouped = level.withColumn("above", F.expr(f"unit div {FAN}")).groupBy(*keys, "above")
        above = entries.withColumnRenamed("unit", "above").groupBy(*keys, "above")
        entries = grouped.cogroup(above).applyInPandas(descend, f"{key_schema}, unit bigint, fill bigint, batch bigint")
        entries = materialize(entries, "entries")
    entries = entries.withColumnRenamed("unit", "chunk")
    return (
        slim.groupBy(*keys, "chunk")
        .cogroup(entries.groupBy(*keys, "chunk"))
        .applyInPandas(number, f"{key_schema}, n bigint, batch_id bigint")
    )


def size_documents(docs: DataFrame, doc_topics: DataFrame, keys: list[str], budget: int, tokens: X.TokenCounter = X.DEFAULT_TOKENS) -> DataFrame:
    """Number each topic's documents and size their prompt blocks.

    ``docs`` has ``doc_idx, text``; ``doc_topics`` has ``keys, doc_idx``.  Text
    stays out of the numbering shuffle: sizes are computed once per document.
    """
    cap = budget // PACK_FRACTION
    whole = tokens.count(F.col("text"))
    sizes = docs.select("doc_idx", whole.alias("whole")).select(
        "doc_idx", "whole", F.least("whole", F.lit(cap)).alias("body")
    )
    numbered = dense_index(doc_topics.select(*keys, "doc_idx"), ["doc_idx"], "n", keys=keys)
    header = tokens.count(F.concat(F.lit("Document "), F.col("n") + 1, F.lit("\n")))
    return numbered.join(sizes, "doc_idx").select(
        *keys, "doc_idx", "n", (F.col("whole") >= cap).alias("cut"), (header + F.col("body")).alias("n_tokens")
    )


def document_block(cut_to: int, tokens: X.TokenCounter = X.DEFAULT_TOKENS):
    """One numbered document as it stands in a prompt."""
    body = F.when(F.col("cut"), tokens.truncate(F.col("text"), F.lit(cut_to))).otherwise(
        X.flatten_newlines(F.col("text"))
    )
    return F.concat(F.lit("Document "), F.col("n") + 1, F.lit("\n"), body, F.lit("\n"))


def pack_documents(docs: DataFrame, doc_topics: DataFrame, keys: list[str], budget: int, tokens: X.TokenCounter = X.DEFAULT_TOKENS, chunk: int = CHUNK) -> DataFrame:
    """Packed prompts: ``keys, batch_id, n_docs, n_tokens, text``.

    A batch holds fewer than ``budget`` tokens, so collecting its documents is
    bounded whatever the size of the topic.
    """
    sized = materialize(size_documents(docs, doc_topics, keys, budget, tokens), "sized")
    batches = number_batches(sized, keys, budget, chunk)
    placed = sized.join(batches, [*keys, "n"])
    blocks = placed.join(docs.select("doc_idx", "text"), "doc_idx").select(
        *keys, "batch_id", "n", "n_tokens", document_block(budget // PACK_FRACTION, tokens).alias("block")
    )
    ordered = F.sort_array(F.collect_list(F.struct("n", "block")))
    return blocks.groupBy(*keys, "batch_id").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_tokens").alias("n_tokens"),
        F.array_join(F.transform(ordered, lambda b: b["block"]), "").alias("text"),
    )
