"""MinHash near-duplicates by one-permutation hashing, banded buckets and star edges.

A document is the set of its distinct word shingles.  One hash of each shingle
fills one of ``bands * rows`` bins (one-permutation hashing); an empty bin copies
a bin chosen by a hash of its own number and the attempt (optimal
densification), so small sets stay comparable.  Documents with the same set
are one class from the start.  In each bucket of a band all classes are
compared with one of them, a star instead of all pairs, and pairs are confirmed
on the full sets.  A bucket is finished when the classes that have not been its
centre lie in one component.  The others get a second star, around the class
with the largest share of shingles that others have too, the likeliest hub;
that share also bounds how similar a class can be to any other of a given size.

What is then still in other components than most of its neighbours is a query
set: it is compared with all classes of the open buckets it is connected to, in
blocks of bounded size that give back links only.  So a star loses no link.

At similarity 0.75 a pair shares no bucket with probability
(1 - 0.75**rows)**bands, 1e-6 with the default 50 bands of 5.

Defined results: null, empty or blank text has an empty set and is linked with
nothing; rows that repeat a doc_id are one node, so they share a component, and
what is linked with any of them is in it; a null doc_id is linked with nothing and kept, with a null component; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusgrove.llm.batches import small_batches
from corpusgrove.llm.components import connected_components, merge_components
from corpusgrove.llm.hashing import SPACES, WordHasher, batch_shingle_sets, constants, mix
from corpusgrove.storage import materialize

WORD_BYTES = ~SPACES


def fill_bins(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Signatures of non-empty sets: the least hash of every bin, empty bins densified."""
    out = np.zeros((len(sets), bins), np.uint64)
    full = np.zeros((len(sets), bins), bool)
    for row, hashes in enumerate(sets):
        # sets are sorted and bins ascend with the hash: the first of a bin is its least
        at = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        out[row, at[first]] = hashes[first]
        full[row, at[first]] = True
    rows, cols = np.nonzero(~full)
    attempt = 0
    while len(rows):
        attempt += 1
        key = cols.astype(np.uint64) * np.uint64(0x100000001B3) + np.uint64(attempt)
        source = (mix(key) % np.uint64(bins)).astype(np.int64)
        hit = full[rows, source]
        out[rows[hit], cols[hit]] = out[rows[hit], source[hit]]
        rows, cols = rows[~hit], cols[~hit]
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket key for each band; keys of different bands differ."""
    parts = signatures.reshape(len(signatures), bands, rows) * constants(rows, 3)
    return mix(parts.sum(axis=2, dtype=np.uint64) + constants(bands, 4)).view(np.int64)


def signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit print of the set (null if empty) and its band keys."""

    def sign(batches):
        hasher = WordHasher(WORD_BYTES)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sets = list(batch_shingle_sets(hasher, batch.column(1), width))
                sizes = np.array([len(s) for s in sets], np.int64)
                some = [s for s in sets if len(s)]
                keys = band_keys(fill_bins(some, bands * rows), bands, rows).ravel()
                counts = np.where(sizes > 0, bands, 0)
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                prints = [mix(s).sum(dtype=np.uint64).tobytes() + (mix(s ^ np.uint64(5)) * s).sum(dtype=np.uint64).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes), pa.array(prints, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(keys))],
                    ["doc_id", "n_shingles", "print", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, n_shingles long, print binary, bands array<long>")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id and its sorted shingle hashes as bytes."""

    def sets(batches):
        hasher = WordHasher(WORD_BYTES)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                data = [s.tobytes() for s in batch_shingle_sets(hasher, batch.column(1), width)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "hashes"])

    return docs.select("doc_id", "text").mapInArrow(sets, "doc_id long, hashes binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""

    def test(batches):
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = []
            last, left = None, None
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x = x.as_buffer()
                if last is None or not x.equals(last):
                    last, left = x, np.frombuffer(x, np.uint64)
                right = np.frombuffer(y.as_buffer(), np.uint64)
                if len(left) > len(right):
                    at = np.searchsorted(left, right)
                    same = int((left[np.minimum(at, len(left) - 1)] == right).sum())
                else:
                    at = np.searchsorted(right, left)
                    same = int((right[np.minimum(at, len(right) - 1)] == left).sum())
                if 100 * same >= percent * (len(left) + len(right) - same):
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("right"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return both.mapInArrow(test, "a long, b long").distinct()


def common_shingles(sets: DataFrame) -> DataFrame:
    """doc_id and how many shingles of it (common) occur in other documents of ``sets``."""

    def flat(batches):
        for batch in batches:
            for doc_id, hashes in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(hashes.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), doc_id)), pa.array(values)], ["doc_id", "shingle"])

    each = sets.mapInArrow(flat, "doc_id long, shingle long").distinct()
    common = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle")
    return each.join(common, "shingle").groupBy("doc_id").agg(F.count(F.lit(1)).alias("common"))


def _unfinished(members: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame:
    """Members with their component, of the buckets that hold several components.

    An intersection of i needs sets of (100 + percent) * i / percent shingles
    together at most, so a class whose common shingles do not suffice even for
    the smallest class of its bucket is left out.
    """
    known = members.drop("component")
    if labels is None:
        known = known.withColumn("component", F.col("doc_id"))
    else:
        known = known.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    spread = known.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least"))
    open_ = known.join(spread.where("low < high").select("bucket", "least"), "bucket")
    return open_.where(f"common * {100 + percent} >= {percent} * (n + greatest(least, n * {percent} div 100))").drop("least")


def _star(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of each bucket's likeliest hub with the members of other components, and the rest of the members."""
    order = F.struct((-F.col("common") / F.col("n")).alias("order"), "doc_id", "n", "common", "component")
    hubs = members.groupBy("bucket").agg(F.min(order).alias("c"))
    hubs = hubs.select("bucket", *(F.col(f"c.{x}").alias(f"hub_{x}") for x in ("doc_id", "n", "common", "component")))
    enough = f"least(common, hub_common) * {100 + percent} >= {percent} * (n + hub_n)"
    alike = f"component != hub_component and least(n, hub_n) * 100 >= greatest(n, hub_n) * {percent} and {enough}"
    met = members.join(hubs, "bucket").where(alike)
    pairs = met.select(F.least("doc_id", "hub_doc_id").alias("a"), F.greatest("doc_id", "hub_doc_id").alias("b")).distinct()
    rest = members.join(hubs.select("bucket", F.col("hub_doc_id").alias("doc_id")), ["bucket", "doc_id"], "left_anti")
    return pairs, rest


BLOCK_SHINGLES = 1 << 15


def _rest_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the classes outside the main component of their neighbourhood, block by block.

    A neighbourhood is what open buckets connect.  Queries and classes go in
    packs of about ``BLOCK_SHINGLES`` shingles; a pack of queries meets every
    pack of its neighbourhood.
    """
    # components are the nodes of this graph, and a bucket links all of its own to the least of them
    parts = members.select("bucket", "component").distinct()
    first = parts.groupBy("bucket").agg(F.min("component").alias("a"))
    hoods = connected_components(parts.join(first, "bucket").select("a", F.col("component").alias("b")).distinct())
    nodes = members.select("doc_id", "n", "common", "component").distinct()
    nodes = materialize(nodes.join(hoods.select(F.col("id").alias("component"), F.col("component").alias("hood")), "component"), "nodes")
    sizes = nodes.groupBy("hood").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("packs"))
    counts = nodes.groupBy("hood", "component").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("hood").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    placed = nodes.join(sizes.join(main, "hood"), "hood").withColumn("pack", F.pmod(F.xxhash64("doc_id"), "packs"))
    full = placed.join(sets, "doc_id").withColumn("x", F.struct("doc_id", "n", "common", "component", "hashes"))
    packs = full.groupBy("hood", "pack").agg(F.collect_list("x").alias("classes"))
    asking = full.where("component != main").groupBy("hood", "pack", "packs").agg(F.collect_list("x").alias("queries"))
    asking = asking.withColumn("pack", F.explode(F.expr("sequence(0L, packs - 1)")))

    def compare(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                found = block_links(batch.column(0)[at].as_py(), batch.column(1)[at].as_py(), percent)
                yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())], ["a", "b"])

    met = asking.select("hood", "pack", "queries").join(packs, ["hood", "pack"]).select("queries", "classes")
    return met.mapInArrow(compare, "a long, b long").distinct()


def block_links(queries: list[dict], classes: list[dict], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) between queries and classes of other components, from counts of all their intersections."""
    sides = []
    for rows in (queries, classes):
        hashes = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
        every = np.concatenate(hashes)
        order = np.argsort(every, kind="stable")
        owner = np.repeat(np.arange(len(rows)), [len(h) for h in hashes])[order]
        sides.append((every[order], owner, *(np.array([r[x] for r in rows], np.int64) for x in ("doc_id", "component"))))
    (q, q_owner, q_id, q_part), (c, c_owner, c_id, c_part) = sides
    low, high = np.searchsorted(c, q, "left"), np.searchsorted(c, q, "right")
    same = np.zeros((len(queries), len(classes)), np.int64)
    for begin in range(0, len(q), 1 << 12):
        n = (high - low)[begin : begin + (1 << 12)]
        place = np.repeat(low[begin : begin + (1 << 12)] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pair = np.repeat(q_owner[begin : begin + (1 << 12)], n) * len(classes) + c_owner[place]
        same += np.bincount(pair, minlength=same.size).reshape(same.shape)
    total = np.array([len(r["hashes"]) // 8 for r in queries])[:, None] + np.array([len(r["hashes"]) // 8 for r in classes])[None, :]
    linked = (100 * same >= percent * (total - same)) & (q_part[:, None] != c_part[None, :])
    i, j = np.nonzero(linked)
    return np.minimum(q_id[i], c_id[j]), np.maximum(q_id[i], c_id[j])


def _classes_of_repeated_ids(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """doc_id and rep of each of its classes, for ids whose rows have different sets."""
    prints = signed.where("doc_id is not null").groupBy("doc_id")
    prints = prints.agg(F.min("print").alias("low"), F.max("print").alias("high"), F.count("print").alias("sets"), F.count(F.lit(1)).alias("n"))
    several = materialize(prints.where("low < high or (sets > 0 and sets < n)").select("doc_id"), "repeated")
    if several.isEmpty():
        return several.withColumn("rep", F.col("doc_id"))
    owners = signed.where("print is not null").join(several, "doc_id").join(classes, "print")
    return materialize(owners.select("doc_id", "rep").distinct(), "owners")


def _near_duplicates(docs: DataFrame, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    signed = materialize(signatures(docs, width, bands, rows), "signatures")
    some = signed.where("print is not null and doc_id is not null")
    classes = some.groupBy("print").agg(F.min("doc_id").alias("rep"))
    reps = some.join(classes, "print").where("doc_id = rep").dropDuplicates(["doc_id", "print"])
    buckets = reps.select("doc_id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    members = buckets.join(shared.select("bucket"), "bucket").withColumn("common", F.col("n"))
    members = materialize(_unfinished(members, None, percent), "members")
    # all comparisons are among the members of these buckets
    sets = materialize(shingle_sets(docs.join(members.select("doc_id").distinct(), "doc_id", "left_semi"), width), "sets")

    pairs, rest = _star(members, percent)
    labels = connected_components(materialize(confirmed(pairs, sets, percent), "links"))
    rest = materialize(_unfinished(rest, labels, percent), "members")
    open_sets = sets.join(rest.select("doc_id").distinct(), "doc_id", "left_semi")
    rest = rest.drop("common").join(common_shingles(open_sets), "doc_id")
    rest = materialize(_unfinished(rest, labels, percent), "members")
    if not rest.isEmpty():
        pairs, rest = _star(rest, percent)
        labels = merge_components(labels, materialize(confirmed(pairs, sets, percent), "links"))
        rest = materialize(_unfinished(rest, labels, percent), "members")
    if not rest.isEmpty():
        with small_batches(docs.sparkSession, 16):  # a row is two packs
            found = materialize(_rest_links(rest, sets, percent), "rest")
        if not found.isEmpty():
            labels = merge_components(labels, found)

    out = signed.select("doc_id", "n_shingles", "print").join(classes, "print", "left")
    owners = _classes_of_repeated_ids(signed, classes)
    if not owners.isEmpty():
        first = owners.groupBy("doc_id").agg(F.min("rep").alias("first"))
        links = owners.join(first, "doc_id").where("rep != first").select(F.col("first").alias("a"), F.col("rep").alias("b"))
        labels = merge_components(labels, materialize(links.distinct(), "links"))
        # a row without shingles goes with the other rows of its id
        out = out.join(first, "doc_id", "left").withColumn("rep", F.coalesce("rep", "first")).drop("first")
    out = out.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", own.cast("long").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, bands: int = 50, rows: int = 5) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id and kept.

    component_id is the smallest doc_id reachable over links, kept is true for
    the document that carries it.
    """
    with small_batches(docs.sparkSession):  # texts and sets of shingles are large rows
        return _near_duplicates(docs, width, percent, bands, rows)


def first_of_groups(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are, one for each doc_id that is not null."""
    found = materialize(near_duplicates(docs, **options), "groups")
    dropped = found.where("not kept").select("doc_id").distinct()
    repeated = found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    rest = docs.join(dropped, "doc_id", "left_anti")
    if repeated.isEmpty():
        return rest.select(*docs.columns)
    # the few ids with several rows: one row each
    single = rest.join(repeated, "doc_id", "left_anti")
    several = rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return single.unionByName(several).select(*docs.columns)
