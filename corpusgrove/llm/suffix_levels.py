"""Removal of repeated passages with a logarithmic family of suffix arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts in a
document with a smaller doc_id.  Strings are found in three steps.

1.  Every string has a fingerprint, the least hash of the 20-byte strings in it
    (a minimizer).  Equal strings have equal fingerprints; ``shared_prints``
    says which occur in several documents.
2.  Runs of strings with one shared fingerprint are cut out as passages of some
    70 bytes.  A task sends each distinct passage once, for the smallest of its
    documents; in all others the passage goes already.
3.  Passages meet by fingerprint.  Their strings enter an index in batches of
    ascending doc_id: a batch is put in suffix order, scanned against every
    level of the index for strings that an earlier document holds, and becomes a
    level itself; levels of equal size merge, so there are few of them.

A passage that very many documents share travels once for each task, not once
for each document, and whole copies of a document send none.

Defined results: null text is empty; a null doc_id is neither smaller nor larger
than others, such a document stays whole and removes nothing; rows that repeat a
doc_id do not remove each other's strings; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusgrove.llm.batches import small_batches
from corpusgrove.llm.hashing import GOLDEN, constants, mix, pieces, text_bytes
from corpusgrove.llm.shared_prints import bucket_count, buckets_of, is_shared, shared_prints
from corpusgrove.llm.spans import packed_texts, row_key, unpacked_text, without_spans
from corpusgrove.storage import materialize

LENGTH = 50
GRAM = 20
SEGMENT = 1 << 20
PASSAGE_STRINGS = 64
BATCH_STRINGS = 1 << 17
SLICE = 1 << 14
SENT_BYTES = 5 << 20
INDEX_BYTES = 1 << 20
SLICE_PASSAGES = 1 << 14
PASSAGES = "bucket int, size long, pack binary, doc_id long, row_key long, spans binary"
REMOVED = "doc_id long, row_key long, spans binary"


class Minimizer:
    """Fingerprints of all strings of ``length`` bytes: least hashes of their grams."""

    def __init__(self, length: int):
        self.length = length
        self.gram = min(GRAM, length)
        self.values = constants(256, 6)
        step = GOLDEN | 1
        self.step, self.back = np.uint64(step), np.uint64(pow(step, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def prints(self, data: np.ndarray) -> np.ndarray:
        """One for each start of a string in ``data``."""
        n = len(data) - self.gram + 1
        if len(data) < self.length:
            return np.zeros(0, np.uint64)
        if len(self.up) < len(data):
            up, down = np.full(len(data), self.step), np.full(len(data), self.back)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        low = mix((sums[self.gram :] - sums[:n]) * self.down[:n])
        width, have = self.length - self.gram + 1, 1
        while have < width:  # the least of ``have`` grams becomes that of up to twice as many
            by = min(have, width - have)
            low = np.minimum(low[: len(low) - by], low[by:])
            have += by
        # least hashes are small numbers: mixed once more (one to one), all buckets get as many
        return mix(low)


def segments(data: np.ndarray, offsets: np.ndarray, overlap: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Pieces of texts: first row, bytes, cuts between rows, place in the text of a long row."""
    for first, last in pieces(offsets):
        low, high = int(offsets[first]), int(offsets[last])
        if high - low <= 2 * SEGMENT:
            yield first, data[low:high], offsets[first : last + 1] - low, 0
            continue
        for at in range(low, high, SEGMENT):
            part = data[at : min(at + SEGMENT + overlap, high)]
            yield first, part, np.array([0, len(part)]), at - low


def string_prints(column: pa.Array, length: int, maker: Minimizer) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row, place in its text, bytes and fingerprints of all strings, in pieces."""
    data, offsets = text_bytes(column)
    for first, part, cuts, at in segments(data, offsets, length - 1):
        prints = maker.prints(part)
        for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if b - a >= length:
                yield first + k, at, part[a:b], prints[a : b - length + 1]


def distinct_prints(length: int):
    """Per text, its distinct fingerprints."""

    def run(column: pa.Array) -> Iterator[np.ndarray]:
        maker = Minimizer(length)
        rows = [[] for _ in range(len(column))]
        for row, _, _, prints in string_prints(column, length, maker):
            rows[row].append(prints[np.concatenate(([True], prints[1:] != prints[:-1]))])
        for parts in rows:
            yield np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)

    return run


Passage = tuple[bytes, int, int, int, list[int]]


def pack_passages(rows: list[Passage]) -> tuple[int, bytes]:
    """Passages (text, 32 bits of fingerprint, doc_id, row_key, places in the document) as one compressed string, and its size before."""
    header = np.array([len(rows)], np.int64)
    columns = [
        np.array([r[2] for r in rows], np.int64), np.array([r[1] for r in rows], np.uint32), np.array([r[3] for r in rows], np.uint32),
        np.array([len(r[4]) for r in rows], np.uint32), np.array([len(r[0]) for r in rows], np.uint32),
        np.array([p for r in rows for p in r[4]], np.int64),
    ]
    blob = b"".join([header.tobytes(), *(c.tobytes() for c in columns), *(r[0] for r in rows)])
    return len(blob), pa.compress(blob, codec="zstd", asbytes=True)


def passage_columns(size: int, pack: bytes) -> tuple[bytes, list[np.ndarray]]:
    """The passages of ``pack_passages``: all their bytes, and as columns fingerprints, documents, row keys, numbers of places, ends and sizes in the bytes, all places."""
    blob = pa.decompress(pack, decompressed_size=size, codec="zstd", asbytes=True)
    n, at = int(np.frombuffer(blob, np.int64, 1)[0]), 8
    columns = []
    for kind, width in ((np.int64, 8), (np.uint32, 4), (np.uint32, 4), (np.uint32, 4), (np.uint32, 4)):
        columns.append(np.frombuffer(blob, kind, n, at))
        at += width * n
    docs, prints, keys, counts, sizes = columns
    places = np.frombuffer(blob, np.int64, int(counts.sum()), at)
    at += 8 * len(places)
    return blob[at:], [prints, docs, keys, counts, np.cumsum(sizes, dtype=np.int64), sizes, places]


def unpack_passages(size: int, pack: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The passages of ``pack_passages`` as columns: texts, fingerprints, documents, row keys, numbers of places, all places."""
    blob, (prints, docs, keys, counts, ends, sizes, places) = passage_columns(size, pack)
    return [blob[e - k : e] for e, k in zip(ends.tolist(), sizes.tolist())], prints, docs, keys, counts, places


def passages(docs: DataFrame, shared: DataFrame, length: int, n_buckets: int) -> DataFrame:
    """Distinct passages of shared strings, packed by bucket, and the spans that go without another look."""

    def cut(batches):
        maker = Minimizer(length)
        held: dict[bytes, list] = {}  # passage: its smallest document so far
        others: list[tuple] = []  # the same passage in other rows with that doc_id
        gone: dict[tuple[int, int], list] = {}
        size = 0

        def rows():
            every = [(v[3], v[4], text, v[0], v[1], v[2]) for text, v in held.items()] + others
            every.sort(key=lambda r: r[:3])
            packs = [
                (bucket, *pack_passages([(text, print_, doc, key, places) for _, print_, text, doc, key, places in group]))
                for bucket, group in groupby(every, key=lambda r: r[0])
            ]
            n, m = len(packs), len(gone)
            spans = [np.array(v, np.int64).tobytes() for v in gone.values()]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([p[0] for p in packs] + [(k[0] + k[1]) % n_buckets for k in gone], pa.int32()),
                    "size": pa.array([p[1] for p in packs] + [None] * m, pa.int64()),
                    "pack": pa.array([p[2] for p in packs] + [None] * m, pa.binary()),
                    "doc_id": pa.array([None] * n + [k[0] for k in gone], pa.int64()),
                    "row_key": pa.array([None] * n + [k[1] for k in gone], pa.int64()),
                    "spans": pa.array([None] * n + spans, pa.binary()),
                }
            )

        def add(doc_id, row_key, place, passage, bucket, print_):
            known = held.get(passage)
            if known is None:
                held[passage] = [doc_id, row_key, [place], bucket, print_]
            elif (known[0], known[1]) == (doc_id, row_key):
                known[2].append(place)
            elif known[0] == doc_id:
                others.append((bucket, print_, passage, doc_id, row_key, [place]))
            else:
                later = [(place, place + len(passage))]
                if doc_id < known[0]:
                    later = [(p, p + len(passage)) for p in known[2]]
                    held[passage], doc_id, row_key = [doc_id, row_key, [place], bucket, print_], known[0], known[1]
                gone.setdefault((doc_id, row_key), []).extend(later)

        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                ids, keys, known = (batch.column(k).to_pylist() for k in (0, 1, 3))
                texts = pa.array([unpacked_text(t) for t in batch.column(2).to_pylist()], pa.large_binary())
                for row, at, data, prints in string_prints(texts, length, maker):
                    change = np.flatnonzero(np.concatenate(([True], prints[1:] != prints[:-1])))
                    hit = is_shared(prints[change], known[row], n_buckets)
                    if not hit.any():
                        continue
                    stop = np.append(change[1:], len(prints))
                    text = data.tobytes()
                    buckets = buckets_of(prints[change], n_buckets).tolist()
                    short = (prints[change] & np.uint64(0xFFFFFFFF)).tolist()
                    for k in np.flatnonzero(hit).tolist():
                        for a in range(int(change[k]), int(stop[k]), PASSAGE_STRINGS):
                            b = min(a + PASSAGE_STRINGS, int(stop[k]))
                            add(ids[row], keys[row], at + a, text[a : b + length - 1], buckets[k], short[k])
                            size += b - a + length
                if size >= SENT_BYTES:
                    yield from rows()
                    held.clear()
                    others.clear()
                    gone.clear()
                    size = 0
        if held:
            yield from rows()

    joined = packed_texts(docs).join(shared.hint("shuffle_hash"), "doc_id").select("doc_id", "row_key", "text", "shared")
    return joined.mapInArrow(cut, PASSAGES)


def _words(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The strings that start at ``at`` as rows of 64-bit numbers that sort like them."""
    if length < 8:
        rows = np.zeros((len(at), 8), np.uint8)
        rows[:, :length] = data[at[:, None] + np.arange(length)]
        return rows.view(">u8").astype(np.uint64)
    # the numbers at every byte of the data; the last one of a string overlaps
    every = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    steps = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    out = np.empty((len(at), len(steps)), np.uint64)
    for k, step in enumerate(steps):
        out[:, k] = every[at + step]
    return out


def _compare(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """-1, 0 or 1 for each pair of rows."""
    first = (a != b).argmax(1)
    rows = np.arange(len(a))
    x, y = a[rows, first], b[rows, first]
    return (x > y).astype(np.int8) - (x < y)


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the string of ``length`` bytes at every place, by prefix doubling; strings end with the data."""
    rank, have = data.astype(np.int64), 1
    while have < length:
        step = min(have, length - have)  # the last step overlaps
        behind = np.zeros(len(rank), np.int64)
        behind[: len(rank) - step] = rank[step:] + 1
        rank = np.unique(rank * (len(rank) + 258) + behind, return_inverse=True)[1]
        have += step
    return rank


class Level:
    """A suffix array: places in a buffer in the order of the strings there, each with its smallest document."""

    def __init__(self, data: np.ndarray, at: np.ndarray, owner: np.ndarray, length: int):
        self.data, self.at, self.owner, self.length = data, at, owner, length
        self.head = np.concatenate([np.zeros(0, np.uint64), *(self.words(k, k + SLICE)[:, 0] for k in range(0, len(at), SLICE))])

    def words(self, low: int, high: int) -> np.ndarray:
        """The strings from ``low`` to ``high`` in suffix order."""
        return _words(self.data, self.at[low:high], self.length)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each string belongs, and whether it is there."""
        low = np.searchsorted(self.head, words[:, 0], "left")
        high = np.searchsorted(self.head, words[:, 0], "right")
        there = np.zeros(len(words), bool)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            side = _compare(words[open_], _words(self.data, self.at[middle], self.length))
            there[open_[side == 0]] = True
            low[open_] = np.where(side > 0, middle + 1, np.where(side == 0, middle, low[open_]))
            high[open_] = np.where(side > 0, high[open_], middle)
        return low, there

    def merged(self, later: Level) -> Level:
        """Both levels as one; of equal strings the smaller document stays."""
        parts = [self.find(later.words(k, k + SLICE)) for k in range(0, len(later.at), SLICE)]
        place, there = (np.concatenate(p) for p in zip(*parts))
        owner = self.owner.copy()
        owner[place[there]] = np.minimum(owner[place[there]], later.owner[there])
        new = np.flatnonzero(~there)
        to = place[new] + np.arange(len(new))
        rest = np.ones(len(self.at) + len(new), bool)
        rest[to] = False
        at, owners = np.empty(len(rest), self.at.dtype), np.empty(len(rest), np.int64)
        at[rest], at[to] = self.at, later.at[new] + len(self.data)
        owners[rest], owners[to] = owner, later.owner[new]
        return Level(np.concatenate((self.data, later.data)), at, owners, self.length)


class Levels:
    """Levels of falling size."""

    def __init__(self):
        self.levels: list[Level] = []

    def owners(self, batch: Level) -> np.ndarray:
        """Scans a batch against all levels: the smallest document of each of its strings."""
        out = batch.owner.copy()
        for k in range(0, len(out) if self.levels else 0, SLICE):
            words, part = batch.words(k, k + SLICE), out[k : k + SLICE]
            for level in self.levels:
                place, there = level.find(words)
                part[there] = np.minimum(part[there], level.owner[place[there]])
        return out

    def add(self, level: Level) -> None:
        """Takes a new level; levels not smaller than the next one merge with it."""
        if not len(level.at):
            return
        self.levels.append(level)
        while len(self.levels) > 1 and len(self.levels[-2].at) <= len(self.levels[-1].at):
            self.levels[-2:] = [self.levels[-2].merged(self.levels[-1])]


def repeated_strings(texts: list[bytes], documents: np.ndarray, length: int, batch_strings: int = BATCH_STRINGS) -> Iterator[tuple[int, np.ndarray]]:
    """For texts in ascending order of document: which of their strings an earlier document holds."""
    family, at = Levels(), 0
    while at < len(texts):
        stop, n = at, 0
        while stop < len(texts) and (n == 0 or n < batch_strings):
            n += len(texts[stop]) - length + 1
            stop += 1
        batch = texts[at:stop]
        data = np.frombuffer(b"".join(batch), np.uint8)
        sizes = np.array([len(t) for t in batch])
        counts = sizes - length + 1
        starts = np.repeat(np.cumsum(sizes) - sizes, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        holder = np.repeat(documents[at:stop], counts)
        rank = suffix_ranks(data, length)[starts]
        order = np.argsort(rank, kind="stable")  # suffix order; equal strings stay by document
        fresh = np.concatenate(([True], rank[order[1:]] != rank[order[:-1]]))
        least = Level(data, starts[order[fresh]].astype(np.int32), holder[order[fresh]], length)
        known = family.owners(least)
        owner = np.empty(len(starts), np.int64)
        owner[order] = known[np.cumsum(fresh) - 1]
        new = known == least.owner
        family.add(Level(data, least.at[new], least.owner[new], length))
        earlier = owner < holder
        for k, (a, n_strings) in enumerate(zip((np.cumsum(counts) - counts).tolist(), counts.tolist())):
            yield at + k, earlier[a : a + n_strings]
        at = stop


def _runs(flags: np.ndarray, length: int) -> np.ndarray:
    """Byte spans covered by flagged strings."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return np.column_stack((edges[::2], edges[1::2] + length - 1))


def passage_slices(prints: np.ndarray, size: int = SLICE_PASSAGES) -> Iterator[np.ndarray]:
    """Rows in slices of at least ``size``; rows of one fingerprint are in one slice."""
    order = np.argsort(prints, kind="stable")
    ranked = prints[order]
    at = 0
    while at < len(order):
        stop = min(at + size, len(order))
        stop = int(np.searchsorted(ranked, ranked[stop - 1], "right"))
        yield np.sort(order[at:stop])
        at = stop


def bucket_spans(table: pa.Table, length: int) -> pa.Table:
    """Spans to remove, from the packs of one bucket and spans that are known already.

    Strings of different passages can only be equal if their fingerprints are,
    so the passages of a few fingerprints at a time become objects.
    """
    ids, keys, spans = array("q"), array("q"), []
    blobs, columns = [], [[np.zeros(0, kind)] for kind in (np.uint32, np.int64, np.uint32, np.uint32, np.int64, np.uint32, np.int64)]
    pack_of = [np.zeros(0, np.int32)]
    for _, size, pack, doc_id, key, done in zip(*(c.to_pylist() for c in table.columns)):
        if pack is None:
            ids.append(doc_id)
            keys.append(key)
            spans.append(done)
            continue
        blob, arrays = passage_columns(size, pack)
        pack_of.append(np.full(len(arrays[0]), len(blobs), np.int32))
        blobs.append(blob)
        for column, part in zip(columns, arrays):
            column.append(part)
    prints, doc, key_of, counts, ends, sizes, places = (np.concatenate(c) for c in columns)
    pack_of = np.concatenate(pack_of)
    del columns
    first_place = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))

    def remove(row: int, runs: np.ndarray) -> None:
        ids.append(int(doc[row]))
        keys.append(int(key_of[row]))
        spans.append((places[first_place[row] : first_place[row + 1], None, None] + runs[None]).tobytes())

    for rows in passage_slices(prints):
        rows = rows[np.argsort(doc[rows], kind="stable")]
        first, same = {}, {}
        for row, pack, end, n in zip(*(c[rows].tolist() for c in (np.arange(len(doc)), pack_of, ends, sizes))):
            known = first.setdefault(blobs[pack][end - n : end], row)
            if known != row and doc[known] < doc[row]:
                remove(row, np.array([[0, n]]))
            elif known != row:  # another row with the same doc_id
                same.setdefault(known, []).append(row)
        texts = {row: text for text, row in first.items()}
        del first

        def settle(some: list[int]) -> None:
            some.sort(key=lambda row: doc[row])
            for k, flags in repeated_strings([texts[r] for r in some], doc[some], length):
                if flags.any():
                    runs = _runs(flags, length)
                    for row in (some[k], *same.get(some[k], ())):
                        remove(row, runs)

        distinct = np.fromiter(texts, np.int64, len(texts))
        distinct = distinct[np.argsort(prints[distinct], kind="stable")]
        ranked = prints[distinct].astype(np.int64)
        cuts = np.flatnonzero(np.diff(ranked, prepend=-1, append=-1))
        waiting, strings = [], 0
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a > 1:
                members = distinct[a:b].tolist()
                waiting += members
                strings += sum(len(texts[r]) for r in members)
                if strings >= INDEX_BYTES:
                    settle(waiting)
                    waiting, strings = [], 0
        if waiting:
            settle(waiting)
    return pa.table([pa.array(np.array(ids)), pa.array(np.array(keys)), pa.array(spans, pa.binary())], ["doc_id", "row_key", "spans"])


def removed_spans(sent: DataFrame, length: int) -> DataFrame:
    """Spans to remove, from passages that meet by fingerprint."""
    # packs are small for the work they hold: a fixed number of tasks, not one that follows their bytes
    width = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sent.repartition(width, "bucket").groupBy("bucket").applyInArrow(lambda table: bucket_spans(table, length), REMOVED)


def exact_copies(docs: DataFrame) -> DataFrame:
    """doc_id, row_key and bytes of the documents whose whole text a smaller doc_id has.

    What such a document holds, its first copy holds as well, so it needs no
    passages: all of it goes that a string of the least length covers.
    """
    texts = docs.where("doc_id is not null").select("doc_id", row_key().alias("row_key"), F.md5("text").alias("text_md5"), F.octet_length("text").alias("n"))
    first = texts.groupBy("text_md5").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    return texts.join(first, "text_md5").where("doc_id > first").select("doc_id", "row_key", "n")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, row_key (hash of the text) and spans (pairs of 64-bit numbers as bytes) that go."""
    n_buckets = bucket_count(docs)
    copies = materialize(exact_copies(docs), "copies")
    shared = shared_prints(docs, distinct_prints(length), n_buckets)
    # a doc_id stays in if one of its rows is no copy; rows that repeat a doc_id have one list of prints each
    rows = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    whole = copies.groupBy("doc_id").agg(F.count(F.lit(1)).alias("gone")).join(rows, "doc_id").where("gone = rows").select("doc_id")
    lists = shared.join(whole, "doc_id", "left_anti").groupBy("doc_id").agg(F.array_sort(F.collect_list("shared")).alias("lists"))
    merged = lists.mapInArrow(_merge_lists, "doc_id long, shared binary")
    with small_batches(docs.sparkSession, 512):
        found = materialize(removed_spans(passages(docs, merged, length, n_buckets), length), "spans")
    return found.unionByName(copies.where(f"n >= {length}").mapInArrow(_whole_span, REMOVED))


def _whole_span(batches):
    for batch in batches:
        spans = [np.array([0, n], np.int64).tobytes() for n in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.binary())], ["doc_id", "row_key", "spans"])


def _merge_lists(batches):
    for batch in batches:
        out = []
        for lists in batch.column(1).to_pylist():
            out.append(lists[0] if len(lists) == 1 else np.unique(np.frombuffer(b"".join(lists), np.uint64)).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "shared"])


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and kept_sha256."""
    return without_spans(docs, repeated_spans(docs, length), packed=True)
