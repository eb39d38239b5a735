"""Removing byte spans from documents, and what is left of them."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def row_key(text: str = "text") -> Column:
    """32 bits that tell rows with one doc_id apart."""
    return F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))


def packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, row_key and ``text`` compressed on its own, for a shuffle; null stays null."""

    def run(batches):
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            out = []
            for text in batch.column(2):
                data = text.as_py().encode() if text.is_valid else None
                out.append(None if data is None else len(data).to_bytes(8, "little") + codec.compress(data, asbytes=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["doc_id", "row_key", "text"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), "text")
    return keyed.mapInArrow(run, "doc_id long, row_key long, text binary")


def unpacked_text(data: bytes | None) -> bytes:
    """The bytes of a packed text; null is empty."""
    if data is None:
        return b""
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def merge_spans(spans: np.ndarray) -> np.ndarray:
    """Maximal runs covered by (from, to) rows; spans that touch or overlap are one."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    last = np.append(np.flatnonzero(first)[1:] - 1, len(spans) - 1)
    return np.column_stack((spans[first, 0], reach[last]))


def kept_bytes(text: bytes, spans: np.ndarray) -> bytes:
    """``text`` without merged spans."""
    if not len(spans):
        return text
    starts, ends = [0, *spans[:, 1].tolist()], [*spans[:, 0].tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(starts, ends))


def without_spans(docs: DataFrame, removed: DataFrame, sources: bool = False, packed: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and kept_sha256; texts are shuffled compressed if ``packed``.

    ``removed``: doc_id, row_key (hash of the text), spans (pairs of 64-bit
    numbers as bytes) and, with ``sources``, the documents that keep the spans.
    """
    spans = removed.groupBy("doc_id", "row_key").agg(
        F.collect_list("spans").alias("spans"), *([F.sort_array(F.collect_set("source")).alias("sources")] if sources else [])
    )

    def cut(batches):
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                rows = []
                for text, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    data = unpacked_text(text) if packed else (text or "").encode()
                    merged = merge_spans(np.frombuffer(b"".join(parts or []), np.int64).reshape(-1, 2))
                    kept = kept_bytes(data, merged)
                    rows.append((len(data), len(data) - len(kept), len(merged), hashlib.sha256(kept).hexdigest()))
                columns = list(zip(*rows)) if rows else [[]] * 4
                kinds = [pa.int64()] * 3 + [pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds)), *batch.columns[3:]],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["sources"] if sources else [])],
                )

    keyed = packed_texts(docs) if packed else docs.select("doc_id", "text", row_key().alias("row_key"))
    joined = keyed.join(spans.hint("shuffle_hash"), ["doc_id", "row_key"], "left")
    extra = [F.coalesce("sources", F.expr("cast(array() as array<bigint>)")).alias("sources")] if sources else []
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", sources array<long>" if sources else "")
    return joined.select("doc_id", "text", "spans", *extra).mapInArrow(cut, schema)
