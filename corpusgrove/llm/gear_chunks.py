"""Substring deduplication by content-defined chunks.

A gear rolling hash reads every byte; where its four top bits are zero, a chunk
ends, unless another such place lies within the 11 bytes before.  Both rules
look at nearby bytes only, so an insertion moves chunk ends near it and no
others.

In a run of one repeated piece (``PERIOD`` bytes at most, with a byte that is no
letter or digit, so words or lines; ``RUN`` bytes or more) these rules end a
chunk in every piece or in none.  Where in none, the run is cut into chunks of
12 to 23 bytes, counted from the least rotation of its piece, so they do not
depend on where it stands.  Chunks longer than ``LARGEST`` are cut further, counted from their start; those
are runs inside one word and of longer pieces.  A chunk is a copy if a document with a smaller doc_id has a chunk with
the same digest; runs of copies of ``least_bytes`` or more are removed.

Digests are compared for those chunks only whose 64-bit hash occurs in several
documents (``shared_prints``); their number per document is spread over tasks by
digest, and the smallest document of a digest is joined back to its chunks.

Defined results: null text is empty; a null doc_id is neither smaller nor larger
than others, such a document stays whole and removes nothing; rows that repeat a
doc_id do not remove each other's chunks; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusgrove.llm.hashing import GOLDEN, LETTERS_DIGITS, PIECE, constants, mix, pieces, text_bytes
from corpusgrove.llm.shared_prints import bucket_count, is_shared, shared_prints
from corpusgrove.llm.spans import merge_spans, row_key, without_spans

GEAR = (constants(256, 7) >> np.uint64(48)).astype(np.uint16)
WINDOW = 16
TOP = np.uint16(12)
NEAREST = 12
LARGEST = 256
RUN, PERIOD, ANCHOR = 96, 64, 24
VALUES = constants(256, 8)
STEP, BACK = np.uint64(GOLDEN | 1), np.uint64(pow(GOLDEN | 1, -1, 1 << 64))


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: h = 2 h + gear(byte), 16 bits, so over the last 16 bytes."""
    h = GEAR[data]
    have = 1
    while have < WINDOW:
        older = np.zeros_like(h)
        older[have:] = h[:-have] << np.uint16(have)
        h = h + older
        have *= 2
    return h


def repeated_runs(data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """Start, end and period of every longest run of ``RUN`` bytes or more inside one text.

    The first anchor of a run has ``PERIOD`` + 8 bytes of it behind it, so the 8
    bytes there and the last 8 of those come again one period on.
    """
    found: dict[tuple[int, int], int] = {}
    if len(data) < RUN:
        return []
    eights = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,))
    anchors = np.arange(0, len(eights) - PERIOD, ANCHOR)
    here, far = eights[anchors], eights[anchors + PERIOD]
    todo = np.ones(len(anchors), bool)
    for period in range(1, PERIOD + 1):
        hits = np.flatnonzero((here == eights[period : period + anchors[-1] + 1 : ANCHOR]) & todo)
        for k in hits[eights[anchors[hits] + PERIOD - period] == far[hits]].tolist():
            if not todo[k]:
                continue
            text = int(np.searchsorted(bounds, anchors[k], "right")) - 1
            a, b = _run_around(data, int(anchors[k]), period, int(bounds[text]), int(bounds[text + 1]))
            if b - a >= RUN:
                found.setdefault((a, b), period)
                todo[(anchors >= a) & (anchors <= b - PERIOD - 8)] = False
    return [(a, b, period) for (a, b), period in sorted(found.items())]


def _run_around(data: np.ndarray, at: int, period: int, low: int, high: int) -> tuple[int, int]:
    a, b = at, at + period
    if b > high:
        return at, at
    while b < high:
        part = data[b : min(b + 1024, high)]
        other = np.flatnonzero(part != data[b - period : b - period + len(part)])
        if len(other):
            b += int(other[0])
            break
        b += len(part)
    while a > low:
        n = min(1024, a - low)
        other = np.flatnonzero(data[a - n : a] != data[a - n + period : a + period])
        if len(other):
            a += int(other[-1]) + 1 - n
            break
        a -= n
    return a, b


def _with_run_ends(data: np.ndarray, bounds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The ends outside of runs of repeated words, and those of the runs' chunks."""
    inside, cuts = np.zeros(len(ends), bool), []
    for a, b, period in repeated_runs(data, bounds):
        unit = data[a : a + period]
        if LETTERS_DIGITS[unit].all():
            continue
        settled = a + WINDOW + NEAREST
        if len(range(*np.searchsorted(ends, (settled, settled + period)))):
            continue
        unit = unit.tobytes()
        turn = min(range(period), key=lambda k: unit[k:] + unit[:k])
        step = -(-NEAREST // period) * period
        parts = step // NEAREST
        places = (np.arange(a + turn - step, b, step)[:, None] + np.arange(parts) * step // parts).ravel()
        places = places[(places > a) & (places < b)]
        cuts.append(places)
        text = int(np.searchsorted(bounds, a, "right")) - 1
        low, high = max(places[0] - NEAREST, bounds[text]), min(places[-1] + NEAREST, bounds[text + 1])
        inside[np.searchsorted(ends, low, "right") : np.searchsorted(ends, high, "left")] = True
    return np.unique(np.concatenate((ends[~inside], *cuts))) if cuts else ends


def chunk_ends(data: np.ndarray, runs: bool = False) -> np.ndarray:
    """Ends of the chunks of one text; ``runs``: with the rule for repeated pieces, as the operator cuts."""
    raw = []
    for at in range(0, len(data), 4 * PIECE):
        low = max(0, at - WINDOW)
        part = gear_hash(data[low : at + 4 * PIECE])
        found = np.flatnonzero(part >> TOP == 0) + low + 1
        raw.append(found[found > at])
    ends = np.concatenate(raw) if raw else np.zeros(0, np.int64)
    apart = np.diff(ends, prepend=-NEAREST) >= NEAREST
    ends = ends[apart]
    if runs:
        ends = _with_run_ends(data, np.array([0, len(data)]), ends)
    if len(data) and (not len(ends) or ends[-1] != len(data)):
        ends = np.append(ends, len(data))
    sizes = np.diff(ends, prepend=0)
    if (sizes > LARGEST).any():
        parts = -(-sizes // LARGEST)
        starts = np.repeat(ends - sizes, parts)
        number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.minimum(starts + (number + 1) * LARGEST, np.repeat(ends, parts))
    return ends


def chunk_hashes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the chunks of one text."""
    out, k = [], 0
    while k < len(ends):
        low = int(ends[k - 1]) if k else 0
        stop = max(k + 1, int(np.searchsorted(ends, low + 4 * PIECE, "right")))
        part = data[low : int(ends[stop - 1])]
        up, down = np.full(len(part), STEP), np.full(len(part), BACK)
        up[0] = down[0] = 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(VALUES[part] * np.multiply.accumulate(up), out=sums[1:])
        b = ends[k:stop] - low
        a = np.concatenate(([0], b[:-1]))
        out.append(mix((sums[b] - sums[a]) * np.multiply.accumulate(down)[a]))
        k = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def batch_chunks(column: pa.Array, runs: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per text: its bytes, ends and hashes of its chunks.

    Short texts are taken together, 16 zero bytes apart, which the window of
    the rolling hash does not reach across.
    """
    data, offsets = text_bytes(column)
    for first, last in pieces(offsets):
        low, high = int(offsets[first]), int(offsets[last])
        if last - first == 1:
            text = data[low:high]
            ends = chunk_ends(text, runs)
            yield text, ends, chunk_hashes(text, ends)
            continue
        yield from _piece_chunks(data[low:high], offsets[first : last + 1] - low, runs)


def _piece_chunks(part: np.ndarray, cuts: np.ndarray, runs: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    rows = len(cuts) - 1
    sizes = np.diff(cuts)
    apart = np.zeros(len(part) + WINDOW * rows, np.uint16)
    place = np.arange(len(part)) + np.repeat(np.arange(rows) * WINDOW, sizes)
    apart[place] = GEAR[part]
    have = 1
    while have < WINDOW:
        apart[have:] = apart[have:] + (apart[:-have] << np.uint16(have))
        have *= 2
    raw = np.flatnonzero(apart[place] >> TOP == 0) + 1
    row = np.searchsorted(cuts, raw, "left") - 1
    far = np.concatenate(([True], (np.diff(raw) >= NEAREST) | (row[1:] != row[:-1]))) if len(raw) else np.zeros(0, bool)
    ends = _with_run_ends(part, cuts, raw[far]) if runs else raw[far]
    ends = np.unique(np.concatenate((ends, cuts[1:][sizes > 0])))
    begins = np.concatenate(([0], ends[:-1]))
    long = -(-(ends - begins) // LARGEST)
    if (long > 1).any():
        number = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
        ends = np.minimum(np.repeat(begins, long) + (number + 1) * LARGEST, np.repeat(ends, long))
    hashes = chunk_hashes(part, ends)
    bounds = np.searchsorted(ends, cuts, "right")
    for k in range(rows):
        a, b = int(bounds[k]), int(bounds[k + 1])
        yield part[cuts[k] : cuts[k + 1]], ends[a:b] - cuts[k], hashes[a:b]


def _distinct(column: pa.Array) -> Iterator[np.ndarray]:
    for _, _, hashes in batch_chunks(column, runs=True):
        yield np.unique(hashes)


def shared_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, place, size and digest of the chunks that other documents may have."""
    n_buckets = bucket_count(docs)
    shared = shared_prints(docs, _distinct, n_buckets)
    shared = shared.groupBy("doc_id").agg(F.array_sort(F.collect_list("shared")).alias("lists"))

    def cut(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids, keys, known = (batch.column(k).to_pylist() for k in (0, 1, 3))
                out = [[], [], [], [], []]
                for row, (data, ends, hashes) in enumerate(batch_chunks(batch.column(2), runs=True)):
                    lists = known[row]
                    mine = lists[0] if len(lists) == 1 else np.unique(np.frombuffer(b"".join(lists), np.uint64)).tobytes()
                    hit = np.flatnonzero(is_shared(hashes, mine, n_buckets)) if len(hashes) else []
                    text = data.tobytes()
                    for k in hit:
                        a, b = int(ends[k - 1]) if k else 0, int(ends[k])
                        for column, value in zip(out, (ids[row], keys[row], a, b - a, hashlib.blake2b(text[a:b], digest_size=16).digest())):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "row_key", "place", "size", "digest"])

    keyed = docs.select("doc_id", row_key().alias("row_key"), "text")
    joined = keyed.join(shared.hint("shuffle_hash"), "doc_id").select("doc_id", "row_key", "text", "lists")
    return joined.mapInArrow(cut, "doc_id long, row_key long, place long, size int, digest binary")


def copied_spans(docs: DataFrame, least_bytes: int) -> DataFrame:
    """doc_id, row_key, spans (pairs of 64-bit numbers as bytes) and source, the smallest document with the chunks."""
    from corpusgrove.storage import materialize

    chunks = materialize(shared_chunks(docs), "chunks")
    first = chunks.groupBy("digest").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
    copies = chunks.join(first.where("source < last").drop("last"), "digest").where("source < doc_id")
    listed = copies.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_list(F.struct("place", "size", "source"))).alias("chunks"))

    def runs(batches):
        for batch in batches:
            out = [[], [], [], []]
            for doc_id, row_key, chunks in zip(*(c.to_pylist() for c in batch.columns)):
                spans = np.array([(c["place"], c["place"] + c["size"]) for c in chunks], np.int64)
                whole = merge_spans(spans)
                whole = whole[whole[:, 1] - whole[:, 0] >= least_bytes]
                for span in whole:
                    inside = (spans[:, 0] >= span[0]) & (spans[:, 1] <= span[1])
                    for source in sorted({c["source"] for c, keep in zip(chunks, inside) if keep}):
                        for column, value in zip(out, (doc_id, row_key, span.tobytes(), source)):
                            column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "row_key", "spans", "source"])

    return listed.mapInArrow(runs, "doc_id long, row_key long, spans binary, source long")


def without_copies(docs: DataFrame, least_bytes: int = 96) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and sources (where the copies come from)."""
    return without_spans(docs, copied_spans(docs, least_bytes), sources=True)
