"""Token ids in files of independently decodable blocks, coded by range asymmetric numeral systems.

Tasks take the documents in ascending order of id.  The ids of several million
tokens share one frequency table, made of all of them; under it they are coded
in blocks of whole documents.  A block interleaves many coder states (lanes):
symbol i belongs to lane i mod lanes, so a step of the coder is a few array
operations.  Checkpoints hold all states at some steps, so that a reader can
start inside a block; checksums cover the coded words and the ids.

A folder of files holds ``groups`` (a frequency table with its blocks) and
``parts`` (how many ids the groups of each range of documents hold).

Defined results: null text is empty, an empty document is its end id alone;
documents sort by id with null first, then by text, and rows that repeat are
coded as often; an empty table gives files without blocks; a document longer
than a block makes that block longer; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from corpusgrove.llm.word_table import remembered

CHECKPOINT = pa.struct([("step", pa.int32()), ("word", pa.int64()), ("states", pa.binary())])
BLOCK = pa.struct(
    [
        ("first", pa.int64()), ("n_tokens", pa.int64()), ("lanes", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())), ("words", pa.binary()), ("states", pa.binary()),
        ("checkpoints", pa.list_(CHECKPOINT)), ("words_crc", pa.int64()), ("ids_crc", pa.int64()),
    ]
)
GROUP = pa.schema([("part", pa.int32()), ("n_tokens", pa.int64()), ("frequencies", pa.binary()), ("blocks", pa.list_(BLOCK))])
GROUPS = (
    "part int, n_tokens long, frequencies binary, blocks array<struct<first:long,n_tokens:long,lanes:int,doc_ids:array<long>,"
    "doc_tokens:array<long>,words:binary,states:binary,checkpoints:array<struct<step:int,word:long,states:binary>>,"
    "words_crc:long,ids_crc:long>>"
)
LOW = 1 << 31
ROWS = 1024


# ------------------------------------------------------------ tokens


def text_ids(path: str, by_words: bool) -> Callable[[pa.Array], Iterator[tuple[np.ndarray, np.ndarray]]]:
    """A function from a column of texts to the ids of some rows at a time, and how many each row has.

    ``by_words`` is for tokenizers as ``word_table`` describes them; others get whole texts.
    """
    if by_words:
        return remembered(path).encode
    import tokenizers

    made = tokenizers.Tokenizer.from_file(path)

    def whole(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for text in column.to_pylist():
            ids = np.array(made.encode(text or "", add_special_tokens=False).ids, np.uint32)
            yield ids, np.array([len(ids)])

    return whole


# ------------------------------------------------------------ coder


def frequencies(counts: np.ndarray, bits: int) -> np.ndarray:
    """Whole frequencies that sum to 2**bits, one at least for every id that occurs."""
    total = counts.sum()
    if total == 0:
        return np.zeros(len(counts), np.int64)
    room = (1 << bits) - np.count_nonzero(counts)
    exact = counts * (room / total)
    out = np.floor(exact).astype(np.int64) + (counts > 0)
    order = np.argsort(-(exact - np.floor(exact)), kind="stable")
    out[order[: (1 << bits) - out.sum()]] += 1
    return out


class Coder:
    def __init__(self, freq: np.ndarray, bits: int):
        self.bits = np.uint64(bits)
        self.mask = np.uint64((1 << bits) - 1)
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - bits)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray, lanes: int, every: int):
        """Words in reading order, first states, and (step, word, states) every so many steps."""
        steps = -(-len(ids) // lanes)
        x = np.full(lanes, LOW, np.uint64)
        out, marks, emitted = [], [], 0
        for t in range(steps - 1, -1, -1):
            s = ids[t * lanes : (t + 1) * lanes]
            m = len(s)
            f, y = self.freq[s], x[:m]
            big = y >= self.limit[s]
            words = y[big].astype(np.uint32)
            y = np.where(big, y >> np.uint64(32), y)
            q = y // f
            x[:m] = (q << self.bits) + (y - q * f) + self.start[s]
            out.append(words)
            emitted += len(words)
            if t and t % every == 0:
                marks.append((t, emitted, x.copy()))
        words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
        return words, x, [(t, len(words) - after, states) for t, after, states in marks[::-1]]

    def decode(self, n: int, lanes: int, words: np.ndarray, states: np.ndarray, step: int = 0, word: int = 0) -> np.ndarray:
        """The ids from ``step`` to the end of a block of ``n`` ids."""
        x, at = states.copy(), word
        out = np.empty(max(0, n - step * lanes), np.uint32)
        words = words.astype(np.uint64)
        low, shift = np.uint64(LOW), np.uint64(32)
        for begin in range(0, len(out), lanes):
            m = min(lanes, len(out) - begin)
            y = x[:m]
            slot = y & self.mask
            s = self.symbol[slot]
            out[begin : begin + m] = s
            y = self.freq[s] * (y >> self.bits) + slot - self.start[s]
            short = np.flatnonzero(y < low)
            y[short] = (y[short] << shift) | words[at : at + len(short)]
            at += len(short)
            x[:m] = y
        return out


def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, int]:
    """Frequencies of the ids 0 .. max and the number of bits they sum to."""
    counts = np.bincount(ids)
    bits = max(16, int(np.count_nonzero(counts)).bit_length() + 2)
    return frequencies(counts, bits), bits


def pack_frequencies(freq: np.ndarray) -> bytes:
    return zlib.compress(freq.astype("<u4").tobytes())


def unpack_coder(packed: bytes) -> Coder:
    freq = np.frombuffer(zlib.decompress(packed), "<u4").astype(np.int64)
    return Coder(freq, int(freq.sum()).bit_length() - 1)


def encode_block(coder: Coder, tokens: np.ndarray, lanes: int, checkpoint_steps: int) -> dict:
    """Coded words, states, checkpoints and checksums of a block of ids."""
    width = int(min(lanes, max(1, len(tokens) // 64)))
    words, states, marks = coder.encode(tokens, width, checkpoint_steps)
    words = words.astype("<u4").tobytes()
    return {
        "n_tokens": len(tokens), "lanes": width, "words": words, "states": states.astype("<u8").tobytes(),
        "checkpoints": [{"step": t, "word": w, "states": s.astype("<u8").tobytes()} for t, w, s in marks],
        "words_crc": zlib.crc32(words), "ids_crc": zlib.crc32(tokens.astype("<u4").tobytes()),
    }


def decode_block(coder: Coder, block: dict) -> np.ndarray:
    """All ids of a block; raises if a checksum does not hold."""
    if zlib.crc32(block["words"]) != block["words_crc"]:
        raise ValueError("the coded words of a block are damaged")
    words = np.frombuffer(block["words"], "<u4")
    states = np.frombuffer(block["states"], "<u8").astype(np.uint64)
    ids = coder.decode(block["n_tokens"], block["lanes"], words, states)
    if zlib.crc32(ids.astype("<u4").tobytes()) != block["ids_crc"]:
        raise ValueError("the ids of a block are damaged")
    return ids


def decode_from(coder: Coder, block: dict, token: int) -> np.ndarray:
    """The ids from ``token`` to the end, read from the last checkpoint before it."""
    lanes, step, word, states = block["lanes"], 0, 0, block["states"]
    for mark in block["checkpoints"]:
        if mark["step"] * lanes <= token:
            step, word, states = mark["step"], mark["word"], mark["states"]
    words = np.frombuffer(block["words"], "<u4")
    ids = coder.decode(block["n_tokens"], lanes, words, np.frombuffer(states, "<u8").astype(np.uint64), step, word)
    return ids[token - step * lanes :]


# ------------------------------------------------------------ files


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    by_words: bool = True,
    table_tokens: int = 1 << 21,
    block_tokens: int = 1 << 19,
    lanes: int = 1024,
    checkpoint_steps: int = 256,
) -> None:
    """Code the ids of ``docs`` (doc_id, text) into files under ``path``.

    A task holds the ids of one frequency table at a time, ``table_tokens`` and
    the document that goes beyond.
    """
    spark = docs.sparkSession

    def encode(batches):
        ids_of, part = text_ids(tokenizer, by_words), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        held, names, sizes, size, first = [], [], [], 0, 0

        def group():
            whole = np.concatenate(held)
            freq, bits = frequency_table(whole)
            coder, blocks = Coder(freq, bits), []
            ends = np.cumsum(sizes)
            at = low = 0
            while at < len(sizes):
                stop = min(int(np.searchsorted(ends, low + block_tokens)) + 1, len(sizes))
                high = int(ends[stop - 1])
                block = encode_block(coder, whole[low:high], lanes, checkpoint_steps)
                blocks.append(block | {"first": first + low, "doc_ids": names[at:stop], "doc_tokens": sizes[at:stop]})
                at, low = stop, high
            row = {"part": part, "n_tokens": size, "frequencies": pack_frequencies(freq), "blocks": blocks}
            return pa.RecordBatch.from_pylist([row], schema=GROUP)

        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                batch = whole.slice(begin, ROWS)
                doc_ids, row = batch.column(0).to_pylist(), 0
                for ids, counts in ids_of(batch.column(1)):
                    stops = np.cumsum(counts)
                    # the end id after each document
                    held.append(np.insert(ids, stops, end))
                    names.extend(doc_ids[row : row + len(counts)])
                    sizes.extend((counts + 1).tolist())
                    row += len(counts)
                    size += len(held[-1])
                    if size >= table_tokens:
                        yield group()
                        first += size
                        held, names, sizes, size = [], [], [], 0
        if held:
            yield group()

    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, GROUPS).write.mode("overwrite").option("compression", "none").parquet(f"{path}/groups")
    groups = spark.read.schema("part int, n_tokens long").parquet(f"{path}/groups")
    groups.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).write.mode("overwrite").parquet(f"{path}/parts")


def read_blocks(spark: SparkSession, path: str, schema: str, rows: Callable) -> DataFrame:
    """Decode every block and give what ``rows(block, ids)`` makes of it, plus the ids before its part.

    ``rows`` returns columns by name in the order of ``schema``; ``part_start`` is added.
    """

    def decode(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                part, packed = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                coder, blocks = unpack_coder(packed), batch.column(2)[at].values
                for k in range(len(blocks)):
                    block = blocks[k].as_py()
                    columns = rows(block, decode_block(coder, block))
                    n = len(next(iter(columns.values())))
                    yield pa.RecordBatch.from_pydict({"part": pa.array([part] * n, pa.int32())} | columns)

    parts = spark.read.schema("part int, n_tokens long").parquet(f"{path}/parts")
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("part_start"))
    groups = spark.read.schema(GROUPS).parquet(f"{path}/groups").select("part", "frequencies", "blocks")
    # one row for each part: no more than there are shuffle partitions
    return groups.mapInArrow(decode, f"part int, {schema}").join(F.broadcast(starts), "part").drop("part")


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: start, number and crc32 of its ids."""

    def rows(block, ids):
        sizes = np.array(block["doc_tokens"], np.int64)
        ends = np.cumsum(sizes)
        data = memoryview(ids.astype("<u4").tobytes())
        crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
        return {
            "doc_id": pa.array(block["doc_ids"], pa.int64()),
            "start": pa.array(ends - sizes + block["first"]),
            "n_tokens": pa.array(sizes),
            "ids_crc32": pa.array(crc, pa.int64()),
        }

    digests = read_blocks(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long", rows)
    return digests.withColumn("start", F.col("start") + F.col("part_start")).drop("part_start")
