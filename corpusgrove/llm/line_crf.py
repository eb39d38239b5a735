"""Document quality from a linear-chain conditional random field over lines.

Every line that has a word is a node with the states bad and good.  What a line
looks like (letter, digit and symbol shares, word lengths, repeated words and
lines) is cut into bins; a node's features are the bins of its line and of both
neighbouring lines, an edge carries one weight for each pair of states.
Forward-backward gives each line the probability of being good; the
length-weighted mean of a document's lines, put through a fitted logistic curve,
is its score.

Labels exist for documents only.  Training starts from each document's label on
all its lines and then, twice, lets lines of bad documents that the model takes
for good be good, so that a bad document may hold good lines.  It runs on a bounded sample of
``sample`` labelled documents of each label (the smallest hashes of their ids,
whole texts); scoring reads every text.

Defined results: a text without words has score 0; null text is empty; without
both labels to learn from every other text scores 0.5; labels null or other
than 0 and 1 are not used, and of several labels of one document the smallest
is; rows that repeat score alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusgrove.llm.hashing import SPACES, WordHasher, pieces, text_bytes
from corpusgrove.storage import materialize

N_RAW = 16
BINS = 8


def _classes() -> np.ndarray:
    """Byte classes counted for every line, one column each."""
    out = np.zeros((256, 7), np.float32)
    out[65:91, 0] = 1  # capitals
    out[48:58, 1] = 1  # digits
    for c in b"#$%&*+/<=>@\\^_`{|}~[]":
        out[c, 2] = 1  # symbols
    for c in b"!?":
        out[c, 3] = 1
    for c in b".,;:":
        out[c, 4] = 1
    out[[9, 11, 12, 13, 32], 5] = 1
    out[128:, 6] = 1
    return out


CLASSES = _classes()


def line_features(column: pa.Array, hasher: WordHasher) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece of rows: lines of each row (bounds), raw features of lines, bytes of lines."""
    data, offsets = text_bytes(column)
    for first, last in pieces(offsets):
        part = data[offsets[first] : offsets[last]]
        cuts = offsets[first : last + 1] - offsets[first]
        yield _piece_features(part, cuts, hasher)


def _piece_features(part, cuts, hasher):
    rows = len(cuts) - 1
    starts, ends, words = hasher.words(part, cuts) if len(part) else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    breaks = np.unique(np.concatenate((np.flatnonzero(part == 10) + 1, cuts[:-1])))
    # lines as runs of words: the line a word lies in, then only lines with words
    line_of_word = np.searchsorted(breaks, starts, "right") - 1
    if not len(words):
        return np.zeros(rows + 1, np.int64), np.zeros((0, N_RAW), np.float32), np.zeros(0)
    new = np.flatnonzero(np.concatenate(([True], line_of_word[1:] != line_of_word[:-1])))
    stop = np.append(new[1:], len(words))
    n_words = (stop - new).astype(np.float64)
    low, high = starts[new], ends[stop - 1]
    size = (high - low).astype(np.float64)
    line = np.repeat(np.arange(len(new)), stop - new)
    row_of_line = np.searchsorted(cuts, low, "right") - 1
    bounds = np.searchsorted(row_of_line, np.arange(rows + 1))

    counts = np.stack([_between(CLASSES[:, k], part, low, high) for k in range(CLASSES.shape[1])], 1) / size[:, None]
    same = np.concatenate(([False], (words[1:] == words[:-1]) & (line[1:] == line[:-1])))
    order = np.lexsort((words, line))
    sorted_words, sorted_line = words[order], line[order]
    fresh = np.concatenate(([True], (sorted_words[1:] != sorted_words[:-1]) | (sorted_line[1:] != sorted_line[:-1])))
    distinct = np.bincount(sorted_line[fresh], minlength=len(new))
    runs = np.diff(np.append(np.flatnonzero(fresh), len(words)))
    top = np.zeros(len(new))
    np.maximum.at(top, sorted_line[fresh], runs)
    length = ends - starts
    longest = np.maximum.reduceat(length, new)
    single = np.add.reduceat((length == 1).astype(np.float64), new)
    # lines that occur again in their document
    print_ = np.add.reduceat(words * (np.arange(len(words), dtype=np.uint64) - np.repeat(new, stop - new).astype(np.uint64) + np.uint64(7)), new)
    key = np.lexsort((print_, row_of_line))
    differs = np.concatenate(([True], (print_[key][1:] != print_[key][:-1]) | (row_of_line[key][1:] != row_of_line[key][:-1])))
    group = np.cumsum(differs) - 1
    copies = np.empty(len(new))
    copies[key] = np.bincount(group)[group]
    final = part[high - 1]
    ends_well = np.isin(final, np.frombuffer(b".!?:;\"'", np.uint8))
    capital = (part[low] >= 65) & (part[low] <= 90) | (part[low] >= 128)
    features = np.column_stack(
        [
            counts, np.log1p(size), size / n_words, longest, distinct / n_words, np.add.reduceat(same.astype(float), new) / n_words,
            top / n_words, single / n_words, np.log2(copies), ends_well + 2.0 * capital,
        ]
    )
    return bounds, features.astype(np.float32), size


def _between(weights: np.ndarray, data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Sums of ``weights`` of the bytes in each [low, high)."""
    sums = np.concatenate(([0], np.cumsum(weights.astype(bool)[data], dtype=np.int64)))
    return (sums[high] - sums[low]).astype(np.float64)


# ------------------------------------------------------------ field


@dataclass
class Field:
    """Bin edges, node weights, edge weights and the logistic curve of the score."""

    edges: list[np.ndarray]
    node: np.ndarray
    pair: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def columns(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For every line the indexes of its features: own bins, then both neighbours'."""
        own = np.stack([np.searchsorted(e, raw[:, k], "left") + k * (BINS + 1) for k, e in enumerate(self.edges)], 1)
        width = N_RAW * (BINS + 1) + 1
        none = width - 1  # the neighbour before the first and after the last line
        before, after = np.full_like(own, none), np.full_like(own, none)
        before[1:], after[:-1] = own[:-1], own[1:]
        first, last = bounds[:-1][np.diff(bounds) > 0], bounds[1:][np.diff(bounds) > 0] - 1
        before[first], after[last] = none, none
        return np.concatenate((own, before + width, after + 2 * width), 1)

    def good(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The probability of every line being good."""
        if not len(raw):
            return np.zeros(0)
        return forward_backward(self.node[self.columns(raw, bounds)].sum(1), self.pair, bounds)[0]

    def scores(self, raw: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        mean = weighted_mean(self.good(raw, bounds), size, bounds)
        z = self.slope * _logit(mean) + self.shift
        return np.where(np.diff(bounds) > 0, 1 / (1 + np.exp(-z)), 0.0)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def weighted_mean(good: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    some = np.flatnonzero(np.diff(bounds) > 0)
    out = np.zeros(len(bounds) - 1)
    if len(some):
        # sums of each row by itself, so that equal texts score alike wherever they stand
        out[some] = np.add.reduceat(good * size, bounds[some]) / np.add.reduceat(size, bounds[some])
    return out


def _times(rows: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Rows of two times a 2 x 2 matrix, summed in one order whatever the number of rows."""
    return rows[:, :1] * matrix[0] + rows[:, 1:] * matrix[1]


def forward_backward(unary: np.ndarray, pair: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of good, expected counts of state pairs and the log partition sum.

    All rows move through their lines together, step by step, longest first.
    """
    n = np.diff(bounds)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    start, n = bounds[:-1][order], n[order]
    alive = [int(np.searchsorted(-n, -t, "left")) for t in range(int(n[0]))]
    scale = np.exp(pair - pair.max())
    potential = np.exp(np.stack([-np.maximum(unary, 0), unary - np.maximum(unary, 0)], 1))
    forward, norm = np.empty_like(potential), np.empty(len(unary))
    for t, m in enumerate(alive):
        at = start[:m] + t
        f = potential[at] if t == 0 else _times(forward[at - 1], scale) * potential[at]
        norm[at] = f.sum(1)
        forward[at] = f / norm[at][:, None]
    backward, pairs = np.ones_like(potential), np.zeros((2, 2))
    for t in range(len(alive) - 1, 0, -1):
        at = start[: alive[t]] + t
        right = potential[at] * backward[at]
        joint = forward[at - 1][:, :, None] * scale * right[:, None, :]
        pairs += (joint / norm[at][:, None, None]).sum(0)
        backward[at - 1] = _times(right, scale.T) / norm[at][:, None]
    steps = len(unary) - len(start)
    total = np.log(norm).sum() + np.maximum(unary, 0).sum() + steps * pair.max()
    marginal = forward * backward
    return marginal[:, 1] / marginal.sum(1), pairs, float(total)


def _fit_field(field: Field, columns, bounds, labels, lines_weight, steps: int) -> None:
    """Adam on the penalised log-likelihood of the lines' labels."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    linked = rows[1:] == rows[:-1]
    seen = np.zeros((2, 2))
    hard = labels.astype(int)
    np.add.at(seen, (hard[:-1][linked], hard[1:][linked]), 1.0)
    moments = [np.zeros_like(field.node), np.zeros_like(field.node), np.zeros((2, 2)), np.zeros((2, 2))]
    n, width = len(labels), len(field.node)
    for step in range(1, steps + 1):
        good, pairs, _ = forward_backward(field.node[columns].sum(1), field.pair, bounds)
        error = (good - labels) * lines_weight
        node = np.bincount(columns.ravel(), np.repeat(error, columns.shape[1]), width) / n + 1e-4 * field.node
        edge = (pairs - seen) / n + 1e-4 * field.pair
        for k, (gradient, weights) in enumerate(((node, field.node), (edge, field.pair))):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient**2 - v)
            weights -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps, with a small penalty."""
    w = np.array([1.0, 0.0])
    design = np.column_stack((x, np.ones(len(x))))
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (p - y) + 1e-2 * (w - [1.0, 0.0])
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(hessian, gradient)
    return float(max(w[0], 1e-3)), float(w[1])


def fit(raw: np.ndarray, size: np.ndarray, bounds: np.ndarray, quality: np.ndarray, steps: int = 80) -> Field:
    """A field from lines of documents with labels 0 and 1."""
    width = 3 * (N_RAW * (BINS + 1) + 1)
    edges = [np.unique(np.quantile(raw[:, k], np.arange(1, BINS + 1) / (BINS + 1))) for k in range(N_RAW)]
    field = Field(edges, np.zeros(width), np.zeros((2, 2)))
    columns = field.columns(raw, bounds)
    per_doc = np.diff(bounds)
    doc_label = np.repeat(quality, per_doc).astype(float)
    # both labels weigh alike, and a document's lines together as one document
    share = np.where(quality == 1, 0.5 / max(1, (quality == 1).sum()), 0.5 / max(1, (quality == 0).sum()))
    weight = np.repeat(share / np.maximum(per_doc, 1), per_doc) * size
    weight *= len(doc_label) / weight.sum()
    weight = np.minimum(weight, 10.0)
    labels = doc_label.copy()
    for again in range(3):
        _fit_field(field, columns, bounds, labels, weight, steps)
        good = field.good(raw, bounds)
        if again < 2:
            labels = np.where((doc_label == 0) & (good > 0.5), 1.0, doc_label)
            # a bad document keeps its worst line bad
            worst = np.array([bounds[k] + int(np.argmin(good[bounds[k] : bounds[k + 1]])) for k in np.flatnonzero((quality == 0) & (per_doc > 0))], np.int64)
            labels[worst] = 0.0
    some = per_doc > 0
    field.slope, field.shift = _fit_curve(_logit(weighted_mean(good, size, bounds)[some]), quality[some].astype(float))
    return field


# ------------------------------------------------------------ Spark


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_lines(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Lines of the sample: one row per document with its raw features as bytes."""
    usable = labels.where("quality in (0, 1)").where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    key = F.xxhash64("doc_id", F.lit("sample"))
    chosen = [usable.where(F.col("quality") == q).orderBy(key, "doc_id").limit(sample) for q in (0, 1)]
    # at most twice ``sample`` short rows
    wanted = F.broadcast(chosen[0].unionByName(chosen[1]))

    def extract(batches):
        hasher = WordHasher(~SPACES)
        for batch in batches:
            features, sizes = [], []
            for bounds, raw, size in line_features(batch.column(2), hasher):
                for a, b in zip(bounds[:-1], bounds[1:]):
                    features.append(raw[a:b].tobytes())
                    sizes.append(size[a:b].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(features, pa.binary()), pa.array(sizes, pa.binary())],
                ["doc_id", "quality", "features", "sizes"],
            )

    rows = docs.select("doc_id", "text").join(wanted, "doc_id").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("text").alias("text"))
    return rows.mapInArrow(extract, "doc_id long, quality int, features binary, sizes binary")


def train(docs: DataFrame, labels: DataFrame, sample: int = 1500) -> Field | None:
    """The field learned from the sample; None if a label is missing from it."""
    rows = training_lines(docs, labels.select("doc_id", F.col("quality").cast("int").alias("quality")), sample).orderBy("doc_id").collect()
    rows = [r for r in rows if r["features"]]
    quality = np.array([r["quality"] for r in rows], int)
    if len(set(quality.tolist())) < 2:
        return None
    raw = np.concatenate([np.frombuffer(r["features"], np.float32).reshape(-1, N_RAW) for r in rows])
    size = np.concatenate([np.frombuffer(r["sizes"], np.float32) for r in rows]).astype(np.float64)
    bounds = np.concatenate(([0], np.cumsum([len(r["sizes"]) // 4 for r in rows])))
    return fit(raw, size, bounds, quality)


def _scores(column: pa.Array, field: Field | None, hasher: WordHasher) -> Iterator[tuple[int, np.ndarray]]:
    """First row and scores of each piece of a column of texts."""
    first = 0
    for bounds, raw, size in line_features(column, hasher):
        yield first, np.where(np.diff(bounds) > 0, 0.5, 0.0) if field is None else field.scores(raw, size, bounds)
        first += len(bounds) - 1


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id and score of every document."""

    def run(batches):
        hasher = WordHasher(~SPACES)
        for batch in batches:
            scores = [s for _, s in _scores(batch.column(1), field, hasher)]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = 1500) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted (1 from ``threshold``)."""
    scored = score(docs, train(docs, labels, sample))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = 1500) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns as they are; no shuffle of texts.

    Without a field, when the usable labels lack a class, nothing tells good from bad: all rows with words stay.
    """
    field = train(docs, labels, sample)
    place = docs.columns.index("text")

    def run(batches):
        hasher = WordHasher(~SPACES)
        for batch in batches:
            for first, scores in _scores(batch.column(place), field, hasher):
                yield batch.slice(first, len(scores)).filter(pa.array(scores > 0 if field is None else scores >= threshold))

    return docs.mapInArrow(run, docs.schema)
