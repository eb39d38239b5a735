"""Byte-level BPE: the merges of a whole vocabulary of words at once, in rank order.

A word is one match of the splitting pattern; its ids depend on nothing else.
``Merges.replay`` holds many words as one chain of tokens and an inverted index
from the rank of a token pair to the places where the pair stands.  Ranks are
taken in order; each merges all its places, and only the pairs with the merged
token's neighbours enter the index anew.

Over a corpus this runs twice.  Spark counts the words of all documents, and the
words that occur most often, ``WORDS`` at most and of ``WORD_BYTES`` at most, are
replayed in partitions and become a table of bounded size that every task gets.
A task that meets other words replays those of its batch in the same way, so the
ids do not depend on what the table holds.

Long texts are cut where one space stands between two characters that are not
white space: the pattern always ends a match there.

Defined results: a null text is empty and has no ids; very long texts are encoded
and hashed part by part; repeated rows and rows without an id have their own
rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusgrove.storage import materialize

WORDS = 1 << 18
WORD_BYTES = 64
HELD = 1 << 18
PART = 1 << 21
NONE = np.int32(2**31 - 1)
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
ID = np.dtype("<u4")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from lines of base64 and number."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Merges:
    """The merges of a vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        found = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        self.keys = np.array(sorted(found), np.int64)
        self.values = np.array([found[k] for k in self.keys.tolist()], np.int32)
        size = max(ranks.values()) + 1
        self.bytes_of, self.digits = [b""] * size, [b""] * size
        for token, rank in ranks.items():
            self.bytes_of[rank], self.digits[rank] = token, b"%d" % rank

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it does not merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1) if len(self.keys) else np.zeros(len(key), np.int64)
        return np.where(self.keys[at] == key, self.values[at], NONE) if len(self.keys) else np.full(len(key), NONE)

    def one(self, word: bytes) -> list[int]:
        """Ids of one word, always merging the first pair of least rank."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
            k = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[k] == NONE:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[p] for p in parts]

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word, as 32-bit little-endian numbers."""
        out = [self.ranks.get(w) for w in words]
        rest = [k for k, known in enumerate(out) if known is None]
        ids, counts = self._replay([words[k] for k in rest])
        stops = np.cumsum(counts) * ID.itemsize
        data = ids.astype(ID).tobytes()
        for k, end, n in zip(rest, stops.tolist(), counts.tolist()):
            out[k] = data[end - n * ID.itemsize : end]
        return [x if isinstance(x, bytes) else int(x).to_bytes(4, "little") for x in out]

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(words), np.uint8)
        n, lengths = len(data), np.array([len(w) for w in words], np.int64)
        if not n:
            return np.zeros(0, np.int32), lengths
        ends = np.cumsum(lengths)
        # the place behind the last stands for the end of every word
        token = np.append(self.of_byte[data], np.int32(-1))
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends[lengths > 0] - 1] = n
        before[(ends - lengths)[lengths > 0]] = n
        alive = np.ones(n, bool)
        rank = np.append(self._rank(token[:n], token[after[:n]]), NONE)
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []
        odd: list[np.ndarray] = []

        def enter(places: np.ndarray) -> None:
            places = places[rank[places] != NONE]
            if not len(places):
                return
            order = np.argsort(rank[places], kind="stable")
            places = places[order]
            of = rank[places]
            cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
            begins = [0, *cuts.tolist()]
            for a, b, r in zip(begins, [*begins[1:], len(places)], of[begins].tolist()):
                if r not in index:
                    index[r] = []
                    heapq.heappush(queue, r)
                index[r].append(places[a:b])

        enter(np.arange(n))
        while queue:
            r = heapq.heappop(queue)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            at = at[rank[at] == r]
            if not len(at):
                continue
            if len(at) > 1:
                at = np.unique(at)
                # of pairs that overlap, every other one from the left
                chained = np.append(False, after[at[:-1]] == at[1:])
                if chained.any():
                    k = np.arange(len(at))
                    head = np.maximum.accumulate(np.where(chained, 0, k))
                    at = at[(k - head) % 2 == 0]
            gone = after[at]
            follow = after[gone]
            if (beside := follow[:-1] == at[1:]).any():
                # before the second of two neighbours merges, its first token may pair with the first
                heads = token[at[1:][beside]]
                if (early := self._rank(np.full(len(heads), r, np.int32), heads) < r).any():
                    odd.append(at[1:][beside][early])
            token[at] = r
            alive[gone] = False
            rank[gone] = NONE
            after[at] = follow
            before[follow] = at
            ahead = before[at]
            touched = np.concatenate((at, ahead[ahead < n]))
            new = self._rank(token[touched], token[after[touched]])
            rank[touched] = new
            if (early := new < r).any():
                odd.append(touched[early])
            enter(touched)
        counts = np.diff(np.append(0, np.cumsum(alive)[ends - 1] if lengths.all() else np.append(0, np.cumsum(alive))[ends]))
        ids = token[:n][alive]
        if odd:
            # a merge made a pair of lower rank: such words go one merge at a time
            again = set(np.searchsorted(ends, np.concatenate(odd), "right").tolist())
            split = np.split(ids, np.cumsum(counts)[:-1])
            split = [np.array(self.one(words[k]), np.int32) if k in again else s for k, s in enumerate(split)]
            ids, counts = np.concatenate(split), np.array([len(s) for s in split])
        return ids, counts


def parts(text: str) -> Iterator[str]:
    """A text in parts of about ``PART`` characters, cut where no match goes across."""
    at = 0
    while at < len(text):
        cut = BETWEEN.search(text, at + PART)
        to = cut.start() if cut else len(text)
        yield text[at:to]
        at = to


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a pattern of ``\\p{L}``, ``\\p{N}`` and white space.

    The classes are spelt out as ranges for ``re``, which is faster; texts with
    characters that need more than 16 bits go to ``regex``.
    """
    import regex

    letters = "".join(map(chr, [*range(0xD800), *range(0xE000, 1 << 16)]))

    def ranges(name: str) -> str:
        runs = (m.group() for m in regex.finditer(f"{name}+", letters))
        return "".join(re.escape(r[0]) + "-" + re.escape(r[-1]) for r in runs)

    spelt, inside = [], False
    for sign in re.findall(r"\\p\{\w\}|\\.|.", pattern):
        if sign.startswith("\\p") or sign in (r"\s", r"\S"):
            name = ranges(sign)
            spelt.append(name if inside else f"[{name}]")
        else:
            inside = sign == "[" or inside and sign != "]"
            spelt.append(sign)
    plain, full = re.compile("".join(spelt)).findall, regex.compile(pattern).findall
    return lambda text: plain(text) if len(text.encode("utf-16-le")) == 2 * len(text) else full(text)


class Encoder:
    """Ids of texts through a table of words, which grows by the words it lacks."""

    def __init__(self, merges: Merges, pattern: str, words: dict[str, bytes]):
        self.merges, self.find, self.words = merges, splitter(pattern), words
        self.known = dict(words)

    def _group(self, held: list[tuple[int, str]]) -> Iterator[tuple[int, bytes]]:
        if len(self.known) > len(self.words) + HELD:
            self.known = dict(self.words)
        found = [self.find(part) for _, part in held]
        new = list(set().union(*found).difference(self.known))
        self.known.update(zip(new, self.merges.replay([w.encode() for w in new])))
        for (k, _), words in zip(held, found):
            yield k, b"".join(map(self.known.__getitem__, words))

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[int, bytes]]:
        """Number of a text and ids of one of its parts, in order; none for an empty text."""
        held: list[tuple[int, str]] = []
        size = 0
        for k, text in enumerate(texts):
            for part in parts(text):
                held.append((k, part))
                size += len(part)
                if size >= PART:
                    yield from self._group(held)
                    held, size = [], 0
        yield from self._group(held)


def corpus_words(docs: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """``word, n``: the words of all documents that occur twice or more in up to ``WORD_BYTES`` bytes."""

    def count(batches):
        find = splitter(pattern)
        words: Counter[str] = Counter()

        def emit():
            short = [(w, n) for w, n in words.items() if len(w.encode()) <= WORD_BYTES]
            words.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in short], pa.string()), pa.array([n for _, n in short], pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                for part in parts(text.as_py() or ""):
                    words.update(find(part))
                if len(words) > HELD:
                    yield emit()
        yield emit()

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1")


def frequent(counts: DataFrame, limit: int = WORDS) -> DataFrame:
    """The words above the least power of two that no more than ``limit`` words reach."""
    level = F.length(F.bin("n"))
    sizes = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()
    total, least = 0, 65
    for row in sorted(sizes, key=lambda r: -r["level"]):
        total += row["words"]
        if total > limit:
            break
        least = row["level"]
    return counts.filter(level >= least)


def word_table(counts: DataFrame, ranks: dict[bytes, int], limit: int = WORDS) -> dict[str, bytes]:
    """Ids of the frequent words: ``limit`` entries of ``WORD_BYTES`` bytes and as many ids at most."""

    def run(batches):
        merges = Merges(ranks)
        held: list[str] = []

        def emit():
            some, held[:] = held[:], []
            return pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array(merges.replay([w.encode() for w in some]), pa.binary())], ["word", "ids"])

        for batch in batches:
            held += batch.column(0).to_pylist()
            if len(held) > HELD:
                yield emit()
        yield emit()

    table = frequent(counts, limit).select("word").mapInArrow(run, "word string, ids binary").toArrow()
    return dict(zip(table.column(0).to_pylist(), table.column(1).to_pylist()))


def _encoded(docs: DataFrame, path: str, pattern: str, limit: int, result: Callable, schema: str, id_col: str, text_col: str) -> DataFrame:
    """``result(merges, ids, parts)`` of every batch of documents; ``parts`` yields row numbers and ids."""
    spark = docs.sparkSession
    ranks = read_ranks(path)
    counts = materialize(corpus_words(docs, pattern, text_col), "bpe-words")
    shared = spark.sparkContext.broadcast((ranks, word_table(counts, ranks, limit)))

    def run(batches):
        held, words = shared.value
        encoder = Encoder(Merges(held), pattern, words)
        for batch in batches:
            yield result(encoder.merges, batch.column(0), encoder.encode(t.as_py() or "" for t in batch.column(1)))

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, limit: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids of every text."""

    def result(merges, ids, found):
        parts = [[] for _ in range(len(ids))]
        for k, part in found:
            parts[k].append(part)
        arrays = [np.frombuffer(b"".join(p), ID).astype(np.int32) for p in parts]
        return pa.RecordBatch.from_arrays([ids, pa.array(arrays, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _encoded(docs, path, pattern, limit, result, "doc_id long, ids array<int>", id_col, text_col)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "data") -> DataFrame:
    """Adds the bytes that the ids of ``ids_col`` stand for; null where it is null."""
    ranks = read_ranks(path)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = Merges(ranks).bytes_of
        for batch in batches:
            yield pa.array([None if ids is None else b"".join(map(token.__getitem__, ids)) for ids in batch.to_pylist()], pa.binary())

    return rows.withColumn(out, run(F.col(ids_col)))


def round_trips(docs: DataFrame, path: str, pattern: str, limit: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids, and of the bytes decoded from them."""

    def result(merges, ids, found):
        counts = [0] * len(ids)
        of_ids, of_bytes = [hashlib.sha256() for _ in counts], [hashlib.sha256() for _ in counts]
        for k, part in found:
            numbers = np.frombuffer(part, ID).tolist()
            of_ids[k].update((b" " if counts[k] else b"") + b" ".join(map(merges.digits.__getitem__, numbers)))
            of_bytes[k].update(b"".join(map(merges.bytes_of.__getitem__, numbers)))
            counts[k] += len(numbers)
        hexes = [pa.array([h.hexdigest() for h in some], pa.string()) for some in (of_ids, of_bytes)]
        return pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), *hexes], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(docs, path, pattern, limit, result, schema, id_col, text_col)
