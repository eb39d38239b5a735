"""Merging near-duplicate topics and dropping rare ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusgrove.functions import grammar as G, text as X
from corpusgrove.functions.vectors import embed
from corpusgrove.operators import prompts as P, similarity as S
from corpusgrove.operators.backend import GENERATION, Backend, Settings
from corpusgrove.operators.pairs import unit_rows
from corpusgrove.operators.merge import apply_merges, merge_mapping, rewrite_documents
from corpusgrove.operators.responses import explode_originals, parse_merge_lines
from corpusgrove.operators.tree import remove_rare_topics, topic_list
from corpusgrove.storage import materialize, scratch_path

LINE_ROOM = 1 << 15
AHEAD = 512  # pairs that wait on the driver
NEW = 2048  # new labels that a task holds at once
VECTORS = "path array<long>, label string, embedding array<double>"
FOUND = "score double, path_a array<long>, path_b array<long>, a string, b string"
FOUND_ARROW = pa.schema([("score", pa.float64()), ("path_a", pa.list_(pa.int64())), ("path_b", pa.list_(pa.int64())), ("a", pa.string()), ("b", pa.string())])
ORIGINALS = "seq long, old_name string, new_name string"


class UnseenPairs:
    """Pairs of topic labels above a threshold that were not asked about, best first, while the tree changes.

    All pairs are made once.  When the tree changes, only labels that are new
    meet the others; their pairs are appended to the stored ones, and pairs of
    labels that went are left out where pairs are read.  The best ``AHEAD`` pairs
    wait on the driver, so a round that changes nothing reads no table.
    """

    def __init__(self, tree: DataFrame, threshold: float, encode=None):
        self.spark, self.threshold, self.encode = tree.sparkSession, threshold, encode
        self.pairs, self.vectors, self.prompted = (scratch_path(self.spark, f"refine-{x}") for x in ("pairs", "vectors", "prompted"))
        self.asked: set[tuple[str, str]] = set()
        self.stored = self.number = 0
        self.nodes = self._nodes(tree)
        listed = materialize(topic_list(tree, desc=True, count=False).select(F.col("position").alias("ord"), "path", "label"), "topic-labels")
        made = listed.select("ord", "path", "label", embed(F.col("label"), encode).alias("embedding"))
        made.drop("ord").write.parquet(f"{self.vectors}/round=0")
        placed = listed.join(self._read(self.vectors, VECTORS), ["path", "label"])
        # nodes with one path and label cannot be told apart, so either's vector will do
        near = S.topic_pairs(placed.select("ord", "embedding").dropDuplicates(["ord"]), threshold)
        a = listed.select(F.col("ord").alias("i"), F.col("path").alias("path_a"), F.col("label").alias("a"))
        b = listed.select(F.col("ord").alias("j"), F.col("path").alias("path_b"), F.col("label").alias("b"))
        self._append(near.join(a, "i").join(b, "j"))
        self._refill()

    def _read(self, path: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path).drop("round")

    @staticmethod
    def _nodes(tree: DataFrame) -> DataFrame:
        return materialize(tree.select("path", X.label_of(desc=True).alias("label")), "refine-nodes")

    def _append(self, pairs: DataFrame) -> DataFrame:
        self.number += 1
        path = f"{self.pairs}/round={self.number}"
        pairs.select("score", "path_a", "path_b", "a", "b").write.parquet(path)
        return self._read(path, FOUND)

    def _open(self, pairs: DataFrame) -> list[tuple]:
        """The best ``AHEAD`` of some stored pairs whose nodes are there and whose labels were not asked about."""
        if self.asked:
            # kept on the driver since the last time only
            rows = [(sorted(pair),) for pair in self.asked]
            self.spark.createDataFrame(rows, "pair array<string>").write.mode("append").parquet(self.prompted)
            self.asked, self.stored = set(), self.stored + len(rows)
        for side in ("a", "b"):
            there = self.nodes.select(F.col("path").alias(f"path_{side}"), F.col("label").alias(side))
            pairs = pairs.join(there, [f"path_{side}", side], "left_semi")
        if self.stored:
            pair = F.array_sort(F.array("a", "b"))
            pairs = pairs.withColumn("pair", pair).join(self._read(self.prompted, "pair array<string>"), "pair", "left_anti")
        best = pairs.select("score", "path_a", "path_b", "a", "b").orderBy(F.desc("score"), "path_a", "path_b").limit(AHEAD)
        return [(-r["score"], list(r["path_a"]), list(r["path_b"]), r["a"], r["b"]) for r in best.collect()]

    def _refill(self) -> None:
        self.ahead = self._open(self._read(self.pairs, FOUND))
        self.last = self.ahead[-1][:3] if len(self.ahead) == AHEAD else None

    def take(self, k: int) -> list[tuple[float, str, str]]:
        """The ``k`` best pairs as ``score, a, b``, now asked about; equal scores in tree order, a label pair once."""
        chosen: list[tuple[float, str, str]] = []
        while len(chosen) < k:
            for at, (minus, _, _, a, b) in enumerate(self.ahead):
                key = tuple(sorted((a, b)))
                if key not in self.asked:
                    self.asked.add(key)
                    chosen.append((-minus, a, b))
                    if len(chosen) == k:
                        self.ahead = self.ahead[at + 1 :]
                        return chosen
            self.ahead = []
            if self.last is None:
                break
            self._refill()
        return chosen

    def update(self, tree: DataFrame) -> None:
        """Takes over a changed tree."""
        before, self.nodes = self.nodes, self._nodes(tree)
        self._forget()
        new = materialize(self.nodes.exceptAll(before).distinct().select("path", "label"), "refine-new")
        count = new.count()
        if not count:
            return
        made = new.select("path", "label", embed(F.col("label"), self.encode).alias("embedding"))
        known = self._read(self.vectors, VECTORS)
        slices = -(-count // NEW)
        made.withColumn("slice", F.pmod(F.xxhash64("path", "label"), F.lit(slices))).write.parquet(f"{self.vectors}/round={self.number + 1}")
        fresh = self._read(f"{self.vectors}/round={self.number + 1}", f"{VECTORS}, slice long")
        others = known.join(self.nodes, ["path", "label"], "left_semi").dropDuplicates(["path", "label"])
        found = None
        for k in range(slices):
            rows = fresh.filter(F.col("slice") == k).collect()
            some = self._against(others.join(new, ["path", "label"], "left_anti").unionByName(fresh.drop("slice")), rows)
            found = some if found is None else found.unionByName(some)
        more = self._open(self._append(found))
        if len(more) == AHEAD:
            self.last = more[-1][:3] if self.last is None else min(self.last, more[-1][:3])
        self.ahead = sorted(p for p in self.ahead + more if self.last is None or p[:3] <= self.last)

    def _forget(self) -> None:
        """Drops waiting pairs whose nodes went."""
        keys = {(tuple(p[k]), p[k + 2]) for p in self.ahead for k in (1, 2)}
        if keys:
            waiting = self.spark.createDataFrame([(list(path), label) for path, label in keys], "path array<long>, label string")
            there = {(tuple(r["path"]), r["label"]) for r in waiting.join(self.nodes, ["path", "label"], "left_semi").collect()}
            self.ahead = [p for p in self.ahead if (tuple(p[1]), p[3]) in there and (tuple(p[2]), p[4]) in there]

    def _against(self, others: DataFrame, rows: list) -> DataFrame:
        """Pairs of some new labels with the others and among themselves; ``rows`` are ``NEW`` at most, by their slice."""
        threshold = self.threshold
        paths, labels = [list(r["path"]) for r in rows], [r["label"] for r in rows]
        units = unit_rows([r["embedding"] for r in rows]) if rows else None
        mine = {(tuple(p), label): k for k, (p, label) in enumerate(zip(paths, labels))}

        def run(batches):
            for batch in batches:
                if not batch.num_rows or units is None:
                    continue
                there, names, vectors = (batch.column(k).to_pylist() for k in range(3))
                scores = np.round(unit_rows(vectors) @ units.T, 12)
                out = []
                for x, y in zip(*np.nonzero(scores > threshold)):
                    own = mine.get((tuple(there[x]), names[x]))
                    # two new labels of one slice meet twice
                    if own is None or own < y:
                        left, right = sorted(((there[x], names[x]), (paths[y], labels[y])))
                        out.append({"score": float(scores[x, y]), "path_a": left[0], "path_b": right[0], "a": left[1], "b": right[1]})
                yield pa.RecordBatch.from_pylist(out, FOUND_ARROW)

        return others.select("path", "label", "embedding").mapInArrow(run, FOUND)


def merges_of(answered: DataFrame, first_id: int) -> DataFrame:
    """Merge rows of a response, numbered from ``first_id`` by line."""
    merges = explode_originals(parse_merge_lines(answered, "response", "round"), "round")
    room = F.col("line_idx") < LINE_ROOM
    number = F.when(room, F.lit(first_id) + F.col("line_idx").cast("long")).otherwise(F.raise_error(F.lit("a merge answer has too many lines")).cast("long"))
    return merges.withColumn("merge_id", number).drop("line_idx", "round")


def refine_topics(
    tree: DataFrame,
    backend: Backend,
    template: str,
    documents: DataFrame | None = None,
    mapping: DataFrame | None = None,
    remove: bool = True,
    threshold: float = G.PAIR_THRESHOLD,
    pairs_per_prompt: int = G.PAIRS_PER_PROMPT,
    share: float = G.RARE_SHARE,
    encode=None,
    settings: Settings = GENERATION,
    max_rounds: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Refined tree, mapping (``seq, old, new``) and rewritten documents.

    Each round asks about the best unseen pairs and applies the merges of the
    answer; it ends when no pair is left, or after ``max_rounds``.  A failed
    call uses its pairs up.
    """
    spark = tree.sparkSession
    tree = materialize(tree, "refine-tree")
    pairs = UnseenPairs(tree, threshold, encode)
    path, number, merged = scratch_path(spark, "refine-originals"), 0, False
    while (max_rounds is None or number < max_rounds) and (best := pairs.take(pairs_per_prompt)):
        rows = spark.createDataFrame([(score, k, k, a, b) for k, (score, a, b) in enumerate(best)], "score double, i int, j int, a string, b string")
        asked = P.refine_prompt(rows, template).withColumn("round", F.lit(number))
        answered = materialize(backend.answer(asked, "prompt", settings).select("round", "response", "status"), "refine-answer")
        merges = materialize(merges_of(answered.filter("status = 'ok'"), number * LINE_ROOM), "refine-merges")
        if not merges.isEmpty():
            tree = materialize(apply_merges(tree, merges), "refine-tree")
            pairs.update(tree)
            fits = F.col("pos") < LINE_ROOM
            seq = F.when(fits, F.col("merge_id") * LINE_ROOM + F.col("pos")).otherwise(F.raise_error(F.lit("a merge line has too many originals")).cast("long"))
            named = merges.filter(F.col("old_name").isNotNull()).select(seq.alias("seq"), "old_name", "new_name")
            named.write.parquet(f"{path}/round={number}")
            merged = True
        number += 1
    originals = spark.read.schema(ORIGINALS).parquet(path).drop("round") if merged else spark.createDataFrame([], ORIGINALS)
    mapping = materialize(merge_mapping(mapping, originals), "refine-mapping")
    if remove:
        tree = materialize(remove_rare_topics(tree, share), "refine-pruned")
    if documents is not None:
        documents = rewrite_documents(documents, mapping, X.response_column(documents))
    return tree, mapping, documents
