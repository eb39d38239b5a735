"""Benchmark decontamination by SimHash windows of item size and multi-index Hamming blocks.

A document leaks an item if a window of as many words as the item is similar to
it: weighted Jaccard of their word shingles, each shingle weighing as often as it
occurs, at least 0.75.  Windows slide word by word.  Such a window holds a shingle of the item, so only
windows around shared shingles are looked at, all of them.  Each gets a 64-bit
SimHash; items of its size within the radius are found through eight blocks of
eight bits, of which one at least differs in few enough bits; similarity then
confirms them.

At similarity 0.75 a bit differs with probability 0.17, so fewer than one pair
in 10**9 lies outside the radius of 31 bits.

The benchmark goes to every task.  Its bytes are counted first: beyond ``slice_bytes`` it
is taken in slices, each a pass over the documents.

Words are runs of letters and digits in lower case (A-Z), all bytes beyond ASCII
count as letters.

Defined results: null, empty or wordless texts and items match nothing; a text
or item of fewer than five words has one shingle, all its words, and such an
item is also found inside longer texts; equal items are one, with the smallest
id; items with a null id match like others and report null; rows that repeat
are judged each; empty tables give an empty result; other columns are ignored
or, in ``decontaminate``, kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusgrove.llm.hashing import LETTERS_DIGITS, WordHasher, batch_words, constants, shingle_hashes

WIDTH = 5
BLOCKS = 8
RADIUS = 31
NEAR = RADIUS // BLOCKS
SLICE_BYTES = 16 << 20
POPCOUNT = np.array([bin(x).count("1") for x in range(256)], np.uint8)
CLOSE = POPCOUNT[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= NEAR
BITS = np.arange(64, dtype=np.uint64)


def fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every window of ``size`` shingles, as eight bytes each."""
    signs = ((hashes[:, None] >> BITS) & np.uint64(1)).astype(np.int32) * 2 - 1
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(signs, axis=0, out=sums[1:])
    return np.packbits(sums[size:] - sums[: len(sums) - size] > 0, axis=1)


@dataclass
class Item:
    item_id: int | None
    shingles: np.ndarray
    ids: np.ndarray = field(init=False)
    counts: np.ndarray = field(init=False)

    def __post_init__(self):
        self.ids, self.counts = np.unique(self.shingles, return_counts=True)

    def overlap(self, window: np.ndarray) -> int:
        """Weight shared with a window: the smaller of both counts of every shingle."""
        at = np.searchsorted(self.ids, window)
        at[at == len(self.ids)] = 0
        mine = np.bincount(at[self.ids[at] == window], minlength=len(self.ids))
        return int(np.minimum(mine, self.counts).sum())


class Sizes:
    """The items of one size: their fingerprints in a multi-index."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.size = len(items[0].shingles)
        self.prints = np.concatenate([fingerprints(i.shingles, self.size) for i in items])
        self.blocks = [[np.flatnonzero(CLOSE[value][self.prints[:, b]]) for value in range(256)] for b in range(BLOCKS)]

    def near(self, window: np.ndarray) -> np.ndarray:
        """Items whose fingerprint differs from that of ``window`` in at most RADIUS bits."""
        hit = np.unique(np.concatenate([self.blocks[b][window[b]] for b in range(BLOCKS)]))
        return hit[POPCOUNT[self.prints[hit] ^ window].sum(1) <= RADIUS]


class Benchmark:
    """Items of a slice, indexed by shingle and by size."""

    def __init__(self, rows: list[tuple[int | None, str | None]], similarity: float):
        self.similarity = similarity
        self.multipliers = constants(WIDTH, 2)
        hasher = WordHasher(LETTERS_DIGITS)
        known: dict[bytes, Item] = {}
        self.by_width: dict[int, dict[int, list[Item]]] = defaultdict(lambda: defaultdict(list))
        texts = pa.array([t for _, t in rows], pa.string())
        for first, bounds, _, words in batch_words(hasher, texts):
            for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                if a == b or words[a:b].tobytes() in known:
                    continue
                item = Item(rows[first + k][0], shingle_hashes(words[a:b], WIDTH, self.multipliers))
                known[words[a:b].tobytes()] = item
                for shingle in item.ids.tolist():
                    self.by_width[min(WIDTH, b - a)][shingle].append(item)
        sizes = defaultdict(list)
        for width, holders in self.by_width.items():
            for item in {id(i): i for held in holders.values() for i in held}.values():
                sizes[width, len(item.shingles)].append(item)
        self.sizes = {key: Sizes(items) for key, items in sizes.items()}
        self.known = {width: np.array(sorted(holders), np.uint64) for width, holders in self.by_width.items()}
        self.sieve = {}
        for width, known_shingles in self.known.items():
            self.sieve[width] = np.zeros(1 << 20, bool)
            self.sieve[width][known_shingles >> np.uint64(44)] = True

    def leaks(self, column: pa.Array) -> Iterator[tuple[int, int | None, float, int, int]]:
        """Row, item id, similarity, first word and words of the best window, for every leak."""
        hasher = WordHasher(LETTERS_DIGITS)
        for first, bounds, _, words in batch_words(hasher, column):
            for width, known in self.known.items():
                if len(words) < width:
                    continue
                runs = shingle_hashes(words, width, self.multipliers)
                at = np.flatnonzero(self.sieve[width][runs >> np.uint64(44)])
                place = np.minimum(np.searchsorted(known, runs[at]), len(known) - 1)
                at = at[known[place] == runs[at]]
                row = np.searchsorted(bounds, at, "right") - 1
                inside = at + width <= bounds[row + 1]
                at, row = at[inside], row[inside]
                cuts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1], [True]))) if len(row) else np.zeros(1, int)
                for a, b in zip(cuts[:-1], cuts[1:]):
                    low, high = int(bounds[row[a]]), int(bounds[row[a] + 1])
                    for item, similarity, start, n in self._row_leaks(runs[low : high - width + 1], at[a:b] - low, width):
                        yield first + int(row[a]), item, similarity, start, n + width - 1

    def _row_leaks(self, runs: np.ndarray, seeds: np.ndarray, width: int):
        """Leaks of one text, from the places of shingles it shares with items."""
        best: dict[int, tuple] = {}
        holders = self.by_width[width]
        wanted = defaultdict(list)
        for seed in seeds.tolist():
            for size in {len(i.shingles) for i in holders[int(runs[seed])]}:
                wanted[size].append(seed)
        for size, places in wanted.items():
            index, m = self.sizes[width, size], min(size, len(runs))
            # starts of all windows that hold a place, as runs of starts
            starts = np.array(places)
            low, high = np.maximum(starts - m + 1, 0), np.minimum(starts, len(runs) - m)
            new = np.flatnonzero(np.concatenate(([True], low[1:] > np.maximum.accumulate(high)[:-1] + 1)))
            for a, b in zip(low[new].tolist(), np.maximum.reduceat(high, new).tolist()):
                prints = fingerprints(runs[a : b + m], m)
                for k in range(len(prints)):
                    window = runs[a + k : a + k + m]
                    for number in index.near(prints[k]).tolist():
                        item = index.items[number]
                        shared = item.overlap(window)
                        similarity = shared / (m + size - shared)
                        if similarity >= self.similarity and similarity > best.get(id(item), (None, 0.0))[1]:
                            best[id(item)] = (item.item_id, similarity, a + k, m)
        return best.values()


def _slices(benchmark: DataFrame, slice_bytes: int) -> Iterator[list]:
    """The items, collected in slices of about ``slice_bytes`` of text."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").groupBy("text").agg(F.min("item_id").alias("item_id"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // slice_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k) if n > 1 else items
        rows = part.select("item_id", "text").orderBy("item_id", "text").collect()
        yield [(r["item_id"], r["text"]) for r in rows]


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.75, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row for every document and item it leaks: doc_id, item_id, similarity, first_word, n_words."""
    out = None
    for rows in _slices(benchmark, slice_bytes):
        found = _find(docs, rows, similarity)
        out = found if out is None else out.unionByName(found)
    return out


def _find(docs: DataFrame, rows: list, similarity: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        index = Benchmark(shared.value, similarity)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                found = list(index.leaks(batch.column(1)))
                columns = list(zip(*found)) if found else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64()),
                     pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())],
                    ["doc_id", "item_id", "similarity", "first_word", "n_words"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, similarity double, first_word long, n_words long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.75, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns as they are; no shuffle."""
    place = docs.columns.index("text")
    for rows in _slices(benchmark, slice_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def run(batches, shared=shared):
            index = Benchmark(shared.value, similarity)
            for whole in batches:
                for at in range(0, whole.num_rows, 1024):
                    batch = whole.slice(at, 1024)
                    clean = np.ones(batch.num_rows, bool)
                    clean[[row for row, *_ in index.leaks(batch.column(place))]] = False
                    yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
