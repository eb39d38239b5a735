"""Similarity of documents to topics and of topics to each other.

Documents against topics: topic vectors that fit one block (a checked number of
rows and bytes) are broadcast and each Arrow batch of documents is multiplied
with them.  More topics are blocks that meet parts of the documents' vectors by
number, one of each a task.  Only what a document keeps leaves the task, never
the document x topic pairs.

Topics against topics: see ``pairs``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusgrove.functions.vectors import embed
from corpusgrove.operators.pairs import closest_pairs, topic_pairs, unit_rows
from corpusgrove.storage import materialize, rows_within

BLOCK_ROWS = 20_000
BLOCK_BYTES = 64 << 20
CELLS_AT_ONCE = 4_000_000
LABELS = 1 << 20

RANKED = T.ArrayType(
    T.StructType(
        [
            T.StructField("ord", T.LongType()),
            T.StructField("label", T.StringType()),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("tokens", T.LongType()),
        ]
    )
)


def _order(sim: np.ndarray) -> np.ndarray:
    """Most similar first; ties, up to rounding noise, in tree order."""
    return np.argsort(-np.round(sim, 12), kind="stable")


def _within_budget(tokens: np.ndarray, budget: float) -> int:
    """How many topics, in order, fit the budget; the first misfit ends it."""
    total = np.cumsum(tokens)
    fits = (total <= budget) & (total - tokens < budget)
    return len(fits) if fits.all() else int(np.argmin(fits))


def _first_k(tokens: np.ndarray, budget: float) -> int:
    return min(len(tokens), int(budget))


def _with_floor(floor: int):
    """How many topics fit the budget, but at least ``floor``."""

    def keep(tokens: np.ndarray, budget: float) -> int:
        return min(len(tokens), max(int(np.searchsorted(np.cumsum(tokens), budget, side="right")), floor))

    return keep


def _ranks(vectors: list, budgets: np.ndarray, ords: list, labels: list, tokens: np.ndarray, matrix: np.ndarray, keep, extra: int) -> list[list[dict]]:
    """Per vector the topics of one block that it keeps, most similar first, and ``extra`` more."""
    out: list[list[dict]] = []
    step = max(1, CELLS_AT_ONCE // max(1, len(ords)))
    for start in range(0, len(vectors), step):
        scores = unit_rows(vectors[start : start + step]) @ matrix.T
        for budget, sim in zip(budgets[start : start + step], scores):
            order = _order(sim)
            order = order[: keep(tokens[order], budget) + extra]
            out.append([{"ord": ords[i], "label": labels[i], "similarity": float(sim[i]), "tokens": int(tokens[i])} for i in order])
    return out


def _by_broadcast(docs: DataFrame, topics: DataFrame, embedding: str, keep, out: str) -> DataFrame:
    """Ranks a single block, map-only over the documents."""
    block = topics.orderBy("ord").toPandas()
    shared = docs.sparkSession.sparkContext.broadcast(
        (block["ord"].tolist(), block["label"].tolist(), block["tokens"].to_numpy(), unit_rows(list(block["embedding"])))
    )

    @F.pandas_udf(RANKED)
    def rank(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for vectors, budgets in batches:
            found: list[list[dict]] = [[] for _ in range(len(vectors))]
            present = np.flatnonzero(vectors.notna().to_numpy())
            if len(present):
                ranked = _ranks(list(vectors.iloc[present]), budgets.to_numpy()[present], *shared.value, keep, 0)
                for row, topics in zip(present, ranked):
                    found[row] = topics
            yield pd.Series(found)

    return docs.withColumn(out, rank.asNondeterministic()(F.col(embedding), F.col("__budget")))


def _by_blocks(docs: DataFrame, topics: DataFrame, embedding: str, keep, out: str, block_rows: int) -> DataFrame:
    """Ranks blocks of topics one at a time and merges what they keep.

    A topic kept overall is kept in its block, because fewer topics precede it
    there; the first topic a block gives up comes along, since it may be the one
    that ends the merged list.  Vectors and budgets of the documents, dealt into
    parts, meet each block; a task holds one part and one block.
    """
    spark = docs.sparkSession
    docs = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "ranked-documents")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = topics.withColumn("block", F.expr(f"ord div {block_rows}"))
    last = blocks.agg(F.max("block")).first()[0]
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("block")
    vectors = docs.filter(F.col(embedding).isNotNull()).select(
        "__row", F.col(embedding).cast("array<double>").alias("v"), "__budget", F.pmod(F.xxhash64("__row"), F.lit(parts)).alias("part"), each
    )
    offered = blocks.select("ord", "label", "tokens", F.col("embedding").cast("array<double>").alias("embedding"), "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, ranked = left.column("__row"), []
        if left.num_rows and right.num_rows:
            right = right.sort_by("ord")
            matrix = unit_rows(right.column("embedding").to_pylist())
            ranked = _ranks(
                left.column("v").to_pylist(), left.column("__budget").to_numpy(), right.column("ord").to_pylist(), right.column("label").to_pylist(),
                right.column("tokens").to_numpy(), matrix, keep, 1,
            )
        else:
            rows = rows.slice(0, 0)
        kinds = pa.list_(pa.struct([("ord", pa.int64()), ("label", pa.string()), ("similarity", pa.float64()), ("tokens", pa.int64())]))
        return pa.table([rows, pa.array(ranked, kinds)], ["__row", "kept"])

    schema = T.StructType([T.StructField("__row", T.LongType()), T.StructField("kept", RANKED)])
    found = vectors.groupBy("part", "block").cogroup(offered.groupBy("part", "block")).applyInArrow(rank, schema)
    lists = found.groupBy("__row").agg(F.flatten(F.collect_list("kept")).alias("__kept"))

    @F.pandas_udf(RANKED)
    def again(candidates: pd.Series, budgets: pd.Series) -> pd.Series:
        merged = []
        for rows, budget in zip(candidates, budgets):
            rows = [] if rows is None else sorted(rows, key=lambda r: r["ord"])
            order = _order(np.array([r["similarity"] for r in rows]))
            tokens = np.array([r["tokens"] for r in rows])
            merged.append([rows[i] for i in order[: keep(tokens[order], budget)]] if len(rows) else [])
        return pd.Series(merged)

    joined = docs.join(lists, "__row", "left")
    return joined.withColumn(out, again.asNondeterministic()(F.col("__kept"), F.col("__budget"))).drop("__row", "__kept")


def _rank(docs: DataFrame, topics: DataFrame, embedding: str, budget: Column, keep, out: str, block_rows: int) -> DataFrame:
    """Adds ``out``: per document the kept topics, most similar first; none
    for a document without a vector.
    """
    topics = materialize(topics.select("ord", "label", F.col("tokens").cast("long").alias("tokens"), "embedding"), "ranked-topics")
    last, dims = topics.agg(F.max("ord"), F.max(F.size("embedding"))).first()
    docs = docs.withColumn("__budget", budget.cast("double"))
    if last is None:
        return docs.withColumn(out, F.array().cast(RANKED)).drop("__budget")
    block_rows = max(1, min(block_rows, BLOCK_BYTES // (8 * max(dims, 1))))
    if last < block_rows:
        return _by_broadcast(docs, topics, embedding, keep, out).drop("__budget")
    return _by_blocks(docs, topics, embedding, keep, out, block_rows).drop("__budget")


TEXT_BYTES = 16 << 20  # listed text that a task holds at once
ROWS_AT_ONCE = 256


@dataclass(frozen=True)
class Sparse:
    """Vectors of the topics in tree order, without their zeros, and their lengths, labels and tokens.

    Products of counts are whole numbers, so topics that are equally similar get the very same cosine.
    """

    starts: np.ndarray
    slots: np.ndarray
    weights: np.ndarray
    lengths: np.ndarray
    labels: np.ndarray
    tokens: np.ndarray

    def similarities(self, vector: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.labels))
        sizes = np.diff(self.starts)
        if len(self.slots):
            out[sizes > 0] = np.add.reduceat(self.weights * vector[self.slots], self.starts[:-1][sizes > 0])
        lengths = self.lengths * np.sqrt(np.sum(vector * vector))
        return np.divide(out, lengths, out=np.zeros(len(out)), where=lengths > 0)


def _sparse_block(topics: DataFrame) -> Sparse | None:
    """All topics (``ord, label, tokens, embedding``) if they fit one block."""
    filled = F.size(F.filter("embedding", lambda x: x != 0))
    held = topics.agg(F.coalesce(F.sum(filled * 16 + F.octet_length("label") + 64), F.lit(0))).first()[0]
    if held > BLOCK_BYTES:
        return None
    at = F.transform("embedding", lambda x, i: F.when(x != 0, F.struct(i.cast("int").alias("i"), x.cast("double").alias("x"))))
    rows = topics.select("ord", "label", "tokens", F.array_compact(at).alias("v")).toArrow().sort_by("ord").combine_chunks()
    lists = rows.column("v").combine_chunks()
    flat = lists.flatten()
    starts = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
    slots, weights = flat.field("i").to_numpy(), flat.field("x").to_numpy()
    owner = np.repeat(np.arange(len(lists)), np.diff(starts))
    lengths = np.sqrt(np.bincount(owner, weights * weights, len(lists)))
    labels = np.array(rows.column("label").to_pylist(), dtype=object)
    return Sparse(starts, slots, weights, lengths, labels, rows.column("tokens").to_numpy())


@dataclass(frozen=True)
class Ranking:
    """A block by its distinct vectors: topics with one vector are equally similar to any document.

    ``of`` numbers the vector of each topic, ``members`` are the topics by vector, up to ``upto``, ``lines`` their labels.
    """

    of: np.ndarray
    members: np.ndarray
    sizes: np.ndarray
    upto: np.ndarray
    vectors: Sparse
    tokens: np.ndarray
    lines: pa.Array

    def _first(self, rank: np.ndarray, count: int) -> np.ndarray:
        """``count`` topics or more in order, from the ranks of the vectors."""
        n = len(self.of)
        if 4 * count >= n:
            # numbers of 16 bits are sorted without comparing them
            return np.argsort((rank.astype(np.uint16) if len(rank) <= 1 << 16 else rank)[self.of], kind="stable")
        last = int(np.searchsorted(np.cumsum(np.bincount(rank, self.sizes)), count))
        near = np.flatnonzero(rank <= last)
        each = [self.members[a:b] for a, b in zip((self.upto - self.sizes)[near].tolist(), self.upto[near].tolist())]
        order = np.repeat(rank[near] * n, self.sizes[near]) + np.concatenate(each)
        if len(order) > count:
            order = np.partition(order, count - 1)[:count]
        return np.sort(order) % n

    def kept(self, vector: np.ndarray, budget: float, keep) -> np.ndarray:
        """The topics that ``keep`` leaves, most similar first; ties, up to rounding noise, in tree order."""
        rank = np.unique(-np.round(self.vectors.similarities(vector), 12), return_inverse=True)[1]
        n, count = len(self.of), 64
        if budget > 0 and n:
            count += int(min(budget / max(self.tokens.mean(), 1e-9), n))
        while True:
            order = self._first(rank, count)
            have = keep(self.tokens[order], budget)
            # more behind the last of them may fit as well
            if have < len(order) or len(order) == n:
                return order[:have]
            count *= 4

    def text(self, order: np.ndarray, end: str) -> bytes:
        """Labels as one text, a line each or joined by line ends."""
        if not len(order):
            return b""
        taken = self.lines.take(pa.array(order))
        data = taken.buffers()[2][: int(np.frombuffer(taken.buffers()[1], np.int64)[len(order)])].to_pybytes()
        return data if end == "line" else data[:-1]


def _ranking(block: Sparse) -> tuple:
    """Fields of a ``Ranking``, as plain data for a broadcast."""
    bounds, numbers = block.starts.tolist(), {}
    keys = (block.slots[a:b].tobytes() + block.weights[a:b].tobytes() for a, b in zip(bounds, bounds[1:]))
    of = np.fromiter((numbers.setdefault(key, len(numbers)) for key in keys), np.int64, len(block.labels))
    sizes, members = np.bincount(of, minlength=len(numbers)), np.argsort(of, kind="stable")
    upto = np.cumsum(sizes)
    firsts = members[upto - sizes]
    spans = [np.arange(bounds[k], bounds[k + 1]) for k in firsts.tolist()]
    rows = np.concatenate([np.zeros(0, np.int64), *spans])
    starts = np.append(0, np.cumsum([len(x) for x in spans], dtype=np.int64))
    vectors = (starts, block.slots[rows], block.weights[rows], block.lengths[firsts], firsts, firsts)
    return of, members, sizes, upto, vectors, block.tokens, pa.array([f"{label}\n" for label in block.labels], pa.large_string())


def _texts(docs: DataFrame, block: Sparse, embedding: str, keep, end: str, encode, where: str | None) -> DataFrame:
    """Adds ``listed`` and ``listed_tokens``; a long list never meets the others of its batch in one piece of memory.

    With ``encode`` the column holds texts, encoded here: they pass one worker, not two.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_ranking(block))
    schema = T.StructType([*docs.schema.fields, T.StructField("listed", T.StringType()), T.StructField("listed_tokens", T.LongType())])

    def run(batches):
        of, members, sizes, upto, vectors, tokens, lines = shared.value
        topics = Ranking(of, members, sizes, upto, Sparse(*vectors), tokens, lines)

        def one(vector, budget: float) -> tuple[bytes, int]:
            order = topics.kept(np.asarray(vector, dtype=float), budget, keep)
            return topics.text(order, end), int(topics.tokens[order].sum())

        for batch in batches:
            vectors, budgets = batch.column(embedding), batch.column("__budget")
            wanted = batch.column(where) if where else None
            first, texts, sums, held = 0, [], [], 0

            def rows(start: int):
                part = batch.slice(start, len(texts))
                return pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string()), pa.array(sums, pa.int64())], [*batch.schema.names, "listed", "listed_tokens"])

            for k in range(batch.num_rows):
                text, total = None, None
                if vectors[k].is_valid and (wanted is None or wanted[k].as_py()):
                    vector = encode([vectors[k].as_py()])[0] if encode else vectors[k].values.to_numpy(zero_copy_only=False)
                    text, total = one(vector, budgets[k].as_py())
                texts.append(text)
                sums.append(total)
                held += len(text or b"")
                if held > TEXT_BYTES or len(texts) == ROWS_AT_ONCE:
                    yield rows(first)
                    first, texts, sums, held = k + 1, [], [], 0
            if texts:
                yield rows(first)

    return docs.mapInArrow(run, schema)


def _listed(docs: DataFrame, topics: DataFrame, embedding: str, budget: Column, keep, end: str, encode=None, where: str | None = None) -> DataFrame:
    """Adds ``listed``, the labels of the kept topics as one text, and ``listed_tokens``, their tokens; null without a vector.

    ``embedding`` names a column of vectors, or of texts for ``encode``; ``where`` names the rows that want a list.

    The text is made where the topics are ranked; lists as long as the tree never
    become rows of labels.  ``end`` is ``line`` (a line end behind each) or ``join``.
    """
    topics = materialize(topics.select("ord", "label", F.col("tokens").cast("long").alias("tokens"), F.col("embedding").cast("array<double>").alias("embedding")), "ranked-topics")
    block = _sparse_block(topics)
    if block is not None:
        return _texts(docs.withColumn("__budget", budget.cast("double")), block, embedding, keep, end, encode, where).drop("__budget")
    if encode or where:
        wanted = F.when(F.col(where), F.col(embedding)) if where else F.col(embedding)
        docs, embedding = docs.withColumn("__vector", embed(wanted, encode) if encode else wanted), "__vector"
    ranked = _rank(docs, topics, embedding, budget, keep, "__ranked", BLOCK_ROWS)
    labels = F.transform("__ranked", lambda r: F.concat(r["label"], F.lit("\n")) if end == "line" else r["label"])
    total = F.aggregate("__ranked", F.lit(0).cast("long"), lambda acc, r: acc + r["tokens"])
    there = F.col(embedding).isNotNull()
    listed = ranked.withColumn("listed", F.when(there, F.array_join(labels, "" if end == "line" else "\n"))).withColumn("listed_tokens", F.when(there, total))
    return listed.drop("__ranked", "__vector")


def budgeted_list(docs: DataFrame, topics: DataFrame, budget: Column, embedding: str, encode=None, where: str | None = None) -> DataFrame:
    """``budgeted_topics`` as a text, a line each."""
    return _listed(docs, topics, embedding, budget, _within_budget, "line", encode, where)


def half_context_list(docs: DataFrame, topics: DataFrame, context_len: int, floor: int, embedding: str, encode=None, where: str | None = None) -> DataFrame:
    """``half_context_topics`` as a text, joined by line ends."""
    return _listed(docs, topics, embedding, F.lit(context_len // 2), _with_floor(floor), "join", encode, where)


def similar_topics(docs: DataFrame, topics: DataFrame, k: int, embedding: str = "embedding", out: str = "ranked", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` most similar topics of each document; ties in tree order."""
    return _rank(docs, topics, embedding, F.lit(k), _first_k, out, block_rows)


def budgeted_topics(docs: DataFrame, topics: DataFrame, budget: Column, embedding: str = "embedding", out: str = "ranked", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Longest run of most similar topics whose tokens stay within ``budget``.

    It ends at the first topic that does not fit; nothing behind it is tried.
    """
    return _rank(docs, topics, embedding, budget, _within_budget, out, block_rows)


def half_context_topics(docs: DataFrame, topics: DataFrame, context_len: int, floor: int, embedding: str = "embedding", out: str = "ranked", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Least similar topics go while the list exceeds half the context, down to ``floor``."""
    return _rank(docs, topics, embedding, F.lit(context_len // 2), _with_floor(floor), out, block_rows)


def label_pairs(pairs: DataFrame, topics: DataFrame) -> DataFrame:
    """Labels of the pairs, and the order-free key that tells repeats apart.

    Up to ``LABELS`` labels go to the pairs, which are many more.
    """
    topics = topics.select("ord", "label")
    few = rows_within(topics, LABELS)
    a = topics.select(F.col("ord").alias("i"), F.col("label").alias("a"))
    b = topics.select(F.col("ord").alias("j"), F.col("label").alias("b"))
    return (
        pairs.join(F.broadcast(a) if few else a, "i")
        .join(F.broadcast(b) if few else b, "j")
        .select("i", "j", "score", "a", "b", F.array_sort(F.array("a", "b")).alias("pair"))
    )


def unprompted_pairs(pairs: DataFrame, prompted: DataFrame) -> DataFrame:
    """Pairs not asked before, whichever way round (``prompted``: ``pair``)."""
    return pairs.join(prompted.select("pair"), "pair", "left_anti")


def top_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best pairs, equal scores in tree order; a label pair counts once."""
    best = F.min(F.struct((-F.col("score")).alias("s"), "i", "j", "a", "b")).alias("best")
    once = pairs.groupBy("pair").agg(best)
    return (
        once.select("best.i", "best.j", (-F.col("best.s")).alias("score"), "best.a", "best.b", "pair")
        .orderBy(F.desc("score"), "i", "j")
        .limit(k)
    )


def best_label_pairs(topics: DataFrame, k: int, threshold: float) -> DataFrame:
    """``top_pairs`` of ``topics`` (``ord, label, embedding``) without making all pairs first."""
    same = topics.groupBy("label").agg(F.min("ord").alias("key"))
    keyed = topics.join(same, "label").select("ord", "key", "embedding")
    return label_pairs(closest_pairs(keyed, k, threshold), topics.select("ord", "label"))


def prompted_pairs(prompted: DataFrame | None, new: DataFrame) -> DataFrame:
    new = new.select("pair")
    return (new if prompted is None else prompted.select("pair").unionByName(new)).distinct()

