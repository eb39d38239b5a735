"""Which fingerprints of each document occur in another document too.

A filter before an exact comparison: it moves six bytes for each fingerprint
instead of text.  Tasks pack the fingerprints of many documents into chunks, by
bucket of the fingerprint; a bucket finds those it holds twice and sends them
back to the chunk, which knows its documents.  32 bits and the bucket stand for
a fingerprint, so a few are reported without need, none is missed.

The input must be read from files (or be materialised): chunks number their
documents in reading order, which a repeated task must find again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

CHUNK_PRINTS = 1 << 20
CHUNK_DOCS = 1 << 16
ROWS = 512
SENT = "kind int, chunk long, bucket int, prints binary, docs binary"


def buckets_of(prints: np.ndarray, n: int) -> np.ndarray:
    return ((prints >> np.uint64(40)) * np.uint64(n)) >> np.uint64(24)


def short_prints(prints: np.ndarray, n: int) -> np.ndarray:
    """What is kept of a fingerprint: its bucket and 32 bits."""
    return (buckets_of(prints, n) << np.uint64(32)) | (prints & np.uint64(0xFFFFFFFF))


def bucket_count(docs: DataFrame) -> int:
    """Four buckets for each shuffle partition, so that their sizes even out."""
    return 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shared_prints(docs: DataFrame, prints_of: Callable[[pa.Array], Iterator[np.ndarray]], n_buckets: int) -> DataFrame:
    """doc_id and its shared short prints, sorted, as bytes; no row where there are none.

    ``prints_of`` gives, for a column of texts, the distinct fingerprints of
    each.  Documents with a null doc_id take no part.
    """

    def pack(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ids, prints, ordinals, held = [], [], [], 0

        def rows():
            chunk = (part << 24) | seq
            every, doc = np.concatenate(prints), np.concatenate(ordinals)
            bucket = buckets_of(every, n_buckets).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            every, doc, bucket = every[order].astype(np.uint32), doc[order], bucket[order]
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            table = {"kind": [1], "chunk": [chunk], "bucket": [int(chunk % n_buckets)], "prints": [None], "docs": [np.array(ids, np.int64).tobytes()]}
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                table["kind"].append(0)
                table["chunk"].append(chunk)
                table["bucket"].append(int(bucket[a]))
                table["prints"].append(every[a:b].tobytes())
                table["docs"].append(doc[a:b].tobytes())
            kinds = {"kind": pa.int32(), "chunk": pa.int64(), "bucket": pa.int32(), "prints": pa.binary(), "docs": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array(table[k], t) for k, t in kinds.items()], list(kinds))

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                for doc_id, got in zip(batch.column(0).to_pylist(), prints_of(batch.column(1))):
                    if doc_id is None or not len(got):
                        continue
                    prints.append(got)
                    ordinals.append(np.full(len(got), len(ids), np.uint16))
                    ids.append(doc_id)
                    held += len(got)
                    if held >= CHUNK_PRINTS or len(ids) == CHUNK_DOCS:
                        yield rows()
                        seq += 1
                        ids, prints, ordinals, held = [], [], [], 0
        if ids:
            yield rows()

    def find(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        lists = table.filter(pa.array(kinds == 1))
        sent = table.filter(pa.array(kinds == 0))
        data = [np.frombuffer(p, np.uint32) for p in sent.column("prints").to_pylist()]
        if not data:
            return lists
        every = np.concatenate(data)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        same = np.concatenate(([False], ranked[1:] == ranked[:-1]))
        twice = same.copy()
        twice[:-1] |= same[1:]
        flag = np.zeros(len(every), bool)
        flag[order[twice]] = True
        prints, docs, at = [], [], 0
        for p, d in zip(data, sent.column("docs").to_pylist()):
            mine = flag[at : at + len(p)]
            at += len(p)
            prints.append(p[mine].tobytes())
            docs.append(np.frombuffer(d, np.uint16)[mine].tobytes())
        found = pa.table([sent.column(0), sent.column(1), sent.column(2), pa.array(prints, pa.binary()), pa.array(docs, pa.binary())], table.schema.names)
        found = found.filter(pa.array([len(p) > 0 for p in prints]))
        return pa.concat_tables([lists.cast(found.schema), found])

    def unpack(table: pa.Table) -> pa.Table:
        names, short, doc = None, [], []
        for kind, _, bucket, prints, docs in zip(*(c.to_pylist() for c in table.columns)):
            if kind == 1:
                names = np.frombuffer(docs, np.int64)
            else:
                short.append(np.frombuffer(prints, np.uint32).astype(np.uint64) | np.uint64(bucket << 32))
                doc.append(np.frombuffer(docs, np.uint16))
        if not short:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.binary())], ["doc_id", "shared"])
        short, doc = np.concatenate(short), np.concatenate(doc)
        order = np.lexsort((short, doc))
        short, doc = short[order], doc[order]
        cuts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1], [True])))
        rows = [short[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        return pa.table([pa.array(names[doc[cuts[:-1]]]), pa.array(rows, pa.binary())], ["doc_id", "shared"])

    sent = docs.select("doc_id", "text").mapInArrow(pack, SENT)
    found = sent.groupBy("bucket").applyInArrow(find, SENT)
    return found.groupBy("chunk").applyInArrow(unpack, "doc_id long, shared binary")


def is_shared(prints: np.ndarray, shared: bytes, n_buckets: int) -> np.ndarray:
    """Which ``prints`` are among a document's shared short prints."""
    known = np.frombuffer(shared, np.uint64)
    short = short_prints(prints, n_buckets)
    at = np.minimum(np.searchsorted(known, short), len(known) - 1)
    return known[at] == short
