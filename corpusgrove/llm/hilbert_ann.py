"""Nearest neighbours by cosine from shifted Hilbert curves, then an exact check.

Several random projections of the unit vectors, each shifted, are put on a
Hilbert curve.  Spark range-partitions and sorts each curve, and every 1,024
vectors in curve order make a block.  A query is compared with its own and both
neighbouring blocks on every curve; the merged candidates are reranked by exact
cosine.

Curves alone find few true neighbours where vectors fill many dimensions evenly.
So the exact check follows: every block of the first curve has a centre and the
largest angle from it, which bounds the cosine of any of its vectors with a
query.  A query also visits the blocks whose bound reaches its worst candidate.
The result is exact, and the closer the windows come, the fewer blocks are left.

Equal vectors are one class; a class keeps its smallest ids, as many as a result
can hold.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of different lengths are not compared; ties go
to the smaller id; rows that repeat an id count once; a query with no candidate
has no row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from corpusgrove.llm.batches import small_batches
from corpusgrove.storage import materialize

BLOCK = 1024
PACK = 256
SLACK = 1e-9
BLOCKS = "part int, place int, curve int, dim int, klasses array<binary>, vectors binary, asks array<boolean>, centre binary, angle double"
FOUND = "query binary, klass binary, score double"


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of whole coordinates, one row each (Skilling's transform)."""
    x = cells.T.astype(np.uint64).copy()
    n, one = len(x), np.uint64(1)
    q = np.uint64(1 << (bits - 1))
    while q > one:
        p = q - one
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = np.uint64(1 << (bits - 1))
    while q > one:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - one), t)
        q >>= one
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << one) | ((x[i] >> np.uint64(b)) & one)
    return out.astype(np.int64)


def curve_keys(unit: np.ndarray, curve: int, dims: int, bits: int, seed: int) -> np.ndarray:
    """Keys of unit vectors on one shifted curve through a random projection."""
    rng = np.random.default_rng([seed, curve, unit.shape[1]])
    low = unit @ rng.standard_normal((unit.shape[1], dims))  # about standard normal
    spread = 1 / (1 + np.exp(-1.6 * low))
    shifted = (spread + rng.random(dims)) / 2
    return hilbert_index(np.minimum((shifted * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str, every: int) -> DataFrame:
    """vec_id, is_query, dim, vector bytes and the digest of the vector, for usable vectors."""

    def check(batches):
        for batch in batches:
            ids, dims, data, klasses = [], [], [], []
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not vector.is_valid or vec_id is None or vector.values.null_count or not len(vector.values):
                    continue
                v = vector.values.to_numpy(zero_copy_only=False) + 0.0
                if not np.isfinite(v).all() or not v.any():
                    continue
                ids.append(vec_id)
                dims.append(len(v))
                data.append(v.tobytes())
                klasses.append(hashlib.blake2b(data[-1], digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(data, pa.binary()), pa.array(klasses, pa.binary())],
                ["vec_id", "dim", "vector", "klass"],
            )

    picked = rows.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>"))
    usable = picked.mapInArrow(check, "vec_id long, dim int, vector binary, klass binary")
    return usable.withColumn("is_query", F.col("vec_id") % every == 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def curve_blocks(classes: DataFrame, curves: int, dims: int, bits: int, seed: int) -> DataFrame:
    """Blocks of consecutive vectors of every curve, numbered along the curves."""

    def keys(batches):
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            for dim in np.unique(lengths).tolist():
                some = batch.filter(pa.array(lengths == dim))
                x = _matrix(some.column(2), dim)
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                for curve in range(curves):
                    made = curve_keys(unit, curve, dims, bits, seed)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([curve] * len(x), pa.int32()), pa.array(made), *some.columns], ["curve", "key", "klass", "dim", "vector", "is_query"]
                    )

    def pack(batches):
        part, place, held, same = TaskContext.get().partitionId(), 0, [], None

        def row():
            x = np.frombuffer(b"".join(h[1] for h in held), np.float64).reshape(len(held), -1)
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            centre = unit.mean(0)
            size = np.linalg.norm(centre)
            centre = centre / size if size > 1e-12 else unit[0]
            angle = float(np.arccos(np.clip((unit @ centre).min(), -1, 1)))
            columns = {
                "part": pa.array([part], pa.int32()), "place": pa.array([place], pa.int32()), "curve": pa.array([same[0]], pa.int32()),
                "dim": pa.array([same[1]], pa.int32()), "klasses": pa.array([[h[0] for h in held]], pa.list_(pa.binary())),
                "vectors": pa.array([x.tobytes()], pa.binary()), "asks": pa.array([[h[2] for h in held]], pa.list_(pa.bool_())),
                "centre": pa.array([centre.tobytes()], pa.binary()), "angle": pa.array([angle], pa.float64()),
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for curve, _, klass, dim, vector, asks in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (same != (curve, dim) or len(held) == BLOCK):
                    yield row()
                    held, place = [], place + 1
                same = (curve, dim)
                held.append((klass, vector, asks))
        if held:
            yield row()

    width = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["curve", "dim", "key", "klass"]
    on_curves = classes.select("klass", "dim", "vector", "is_query").mapInArrow(
        keys, "curve int, key long, klass binary, dim int, vector binary, is_query boolean"
    )
    packed = materialize(on_curves.repartitionByRange(width, *order).sortWithinPartitions(*order).mapInArrow(pack, BLOCKS), "blocks")
    # one row for each part: no more than there are shuffle partitions
    sizes = packed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    bases = sizes.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return packed.join(F.broadcast(bases), "part").withColumn("block", F.col("base") + F.col("place")).drop("part", "place", "base")


def _nearest(visits: DataFrame, k: int) -> DataFrame:
    """The k best classes of each visited block for each visiting query, itself left out.

    Visits: queries (classes), asking (their vectors), klasses and vectors of the block, dim.
    """

    def search(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                dim = batch.column(4)[at].as_py()
                queries, klasses = batch.column(0)[at].values, batch.column(2)[at].values
                q = np.frombuffer(batch.column(1)[at].as_buffer(), np.float64).reshape(-1, dim)
                x = np.frombuffer(batch.column(3)[at].as_buffer(), np.float64).reshape(-1, dim)
                score = (q @ x.T) / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None, :])
                place = {c: i for i, c in enumerate(klasses.to_pylist())}
                for i, own in enumerate(queries.to_pylist()):
                    if own in place:
                        score[i, place[own]] = -np.inf
                keep = min(k, score.shape[1])
                best = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
                got = np.take_along_axis(score, best, 1)
                # all that tie with the last kept may matter: their ids decide
                rows, cols = np.nonzero(score >= got.min(1)[:, None])
                real = np.isfinite(score[rows, cols])
                rows, cols = rows[real], cols[real]
                yield pa.RecordBatch.from_arrays(
                    [queries.take(pa.array(rows)), klasses.take(pa.array(cols)), pa.array(score[rows, cols])], ["query", "klass", "score"]
                )

    return visits.select("queries", "asking", "klasses", "vectors", "dim").mapInArrow(search, FOUND)


def _merge(found: DataFrame, smallest: DataFrame, k: int) -> DataFrame:
    """The k best distinct classes of every query, ties to the class with the smaller id."""
    known = found.groupBy("query", "klass").agg(F.max("score").alias("score")).join(smallest, "klass")
    order = W.partitionBy("query").orderBy(F.desc("score"), "rep")
    return known.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("rep")


def _window_visits(blocks: DataFrame) -> DataFrame:
    """Each block's queries visit it and its neighbours on the curve."""

    def asking(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                asks = np.array(batch.column(3)[at].as_py(), bool)
                if not asks.any():
                    continue
                dim = batch.column(4)[at].as_py()
                x = np.frombuffer(batch.column(2)[at].as_buffer(), np.float64).reshape(-1, dim)
                queries = batch.column(1)[at].values.filter(pa.array(asks)).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[at].as_py()], pa.int64()), pa.array([queries], pa.list_(pa.binary())), pa.array([x[asks].tobytes()], pa.binary()),
                     pa.array([dim], pa.int32()), pa.array([batch.column(5)[at].as_py()], pa.int32())],
                    ["own", "queries", "asking", "q_dim", "q_curve"],
                )

    sent = blocks.select("block", "klasses", "vectors", "asks", "dim", "curve").mapInArrow(
        asking, "own long, queries array<binary>, asking binary, q_dim int, q_curve int"
    )
    sent = sent.withColumn("block", F.explode(F.sequence(F.col("own") - 1, F.col("own") + 1)))
    return sent.join(blocks, "block").where("dim = q_dim and curve = q_curve")


def _bound_visits(blocks: DataFrame, queries: DataFrame) -> DataFrame:
    """Visits to the blocks of the first curve whose bound reaches a query's worst candidate.

    Queries go in packs against packs of block summaries (centre, angle).
    ``queries``: query, dim, vector, worst.
    """

    def query_packs(batches):
        held: dict[int, list] = {}

        def row(dim):
            q = held.pop(dim)
            return pa.RecordBatch.from_arrays(
                [pa.array([[x[0] for x in q]], pa.list_(pa.binary())), pa.array([b"".join(x[1] for x in q)], pa.binary()),
                 pa.array([[x[2] for x in q]], pa.list_(pa.float64())), pa.array([dim], pa.int32())],
                ["queries", "asking", "worst", "dim"],
            )

        for batch in batches:
            for query, dim, vector, worst in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(dim, []).append((query, vector, worst))
                if len(held[dim]) == PACK:
                    yield row(dim)
        for dim in list(held):
            yield row(dim)

    def reach(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                one = {name: batch.column(i)[at] for i, name in enumerate(batch.schema.names)}
                dim = one["dim"].as_py()
                q = np.frombuffer(one["asking"].as_buffer(), np.float64).reshape(-1, dim)
                worst = np.array(one["worst"].as_py())
                queries, numbers = one["queries"].as_py(), one["numbers"].as_py()
                centres = np.frombuffer(b"".join(one["centres"].as_py()), np.float64).reshape(-1, dim)
                away = np.arccos(np.clip((q / np.linalg.norm(q, axis=1, keepdims=True)) @ centres.T, -1, 1))
                bound = np.cos(np.maximum(away - np.array(one["angles"].as_py())[None, :], 0)) + SLACK
                hit = bound >= worst[:, None]
                for j in np.flatnonzero(hit.any(0)).tolist():
                    i = np.flatnonzero(hit[:, j])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([numbers[j]], pa.int64()), pa.array([[queries[x] for x in i]], pa.list_(pa.binary())), pa.array([q[i].tobytes()], pa.binary())],
                        ["block", "queries", "asking"],
                    )

    packs = queries.select("query", "dim", "vector", "worst").mapInArrow(
        query_packs, "queries array<binary>, asking binary, worst array<double>, dim int"
    )
    base = blocks.where("curve = 0")
    summaries = (
        base.select("block", "dim", "centre", "angle", F.expr(f"block div {BLOCK}").alias("bundle"))
        .groupBy("bundle", "dim")
        .agg(F.sort_array(F.collect_list(F.struct("block", "centre", "angle"))).alias("s"))
        .select("bundle", "dim", F.col("s.block").alias("numbers"), F.col("s.centre").alias("centres"), F.col("s.angle").alias("angles"))
    )
    # packs of 256 queries against bundles of 1,024 blocks; few rows on both sides
    bundles = summaries.select("bundle", "dim")
    pairs = packs.join(bundles, "dim").join(summaries, ["bundle", "dim"])
    visits = pairs.select("queries", "asking", "worst", "dim", "numbers", "centres", "angles").mapInArrow(
        reach, "block long, queries array<binary>, asking binary"
    )
    return visits.join(base.select("block", "klasses", "vectors", "dim"), "block")


def nearest_neighbours(
    rows: DataFrame, k: int = 5, every: int = 50, curves: int = 4, dims: int = 8, bits: int = 7, seed: int = 42,
    id_col: str = "vec_id", vector_col: str = "embedding", exact: bool = True,
) -> DataFrame:
    """The ``k`` nearest of every row whose id is divisible by ``every``: query_id, rank, vec_id, score.

    ``exact=False`` leaves the check out and returns what the curves found.
    """
    vectors = materialize(valid_vectors(rows, id_col, vector_col, every), "vectors")
    grouped = vectors.groupBy("klass").agg(F.min("vec_id").alias("rep"), F.max("is_query").alias("is_query"))
    grouped = materialize(grouped, "classes")
    smallest = grouped.select("klass", "rep")
    first = vectors.drop("is_query").join(grouped, "klass").where("vec_id = rep").dropDuplicates(["klass"])
    blocks = materialize(curve_blocks(first, curves, dims, bits, seed), "numbered")
    with small_batches(rows.sparkSession, 32):  # a row holds a block
        found = materialize(_merge(_nearest(_window_visits(blocks), k), smallest, k), "window")
    asked = first.where("is_query").select(F.col("klass").alias("query"), "dim", "vector")
    if exact:
        worst = found.groupBy("query").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
        worst = worst.select("query", F.when(F.col("n") >= k, F.col("low")).otherwise(-2.0).alias("low"))
        limits = asked.join(worst, "query", "left").withColumn("worst", F.coalesce("low", F.lit(-2.0)))
        more = _nearest(_bound_visits(blocks, limits), k)
        with small_batches(rows.sparkSession, 32):
            found = materialize(_merge(found.drop("place").unionByName(more), smallest, k), "checked")

    def own_score(batches):
        for batch in batches:
            data = [np.frombuffer(v, np.float64) for v in batch.column(1).to_pylist()]
            score = [float(v @ v / (np.linalg.norm(v) * np.linalg.norm(v))) for v in data]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(0), pa.array(score, pa.float64())], ["query", "klass", "score"])

    itself = asked.select("query", "vector").mapInArrow(own_score, FOUND)
    classes = found.select("query", "klass", "score").unionByName(itself)
    # a result holds k rows, so k + 1 ids of a class are enough, one may be the query
    ids = vectors.select("klass", "vec_id").distinct()
    few = ids.withColumn("n", F.row_number().over(W.partitionBy("klass").orderBy("vec_id"))).where(F.col("n") <= k + 1).drop("n")
    candidates = classes.join(few, "klass").select("query", "vec_id", "score")
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = candidates.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    queries = vectors.where("is_query").select(F.col("vec_id").alias("query_id"), F.col("klass").alias("query")).distinct()
    answers = queries.join(best, "query").where("vec_id != query_id")
    # best without the query itself: places above the query move up by one
    mine = best.select("query", F.col("vec_id").alias("query_id"), F.col("n").alias("own"))
    placed = answers.join(mine, ["query", "query_id"], "left")
    rank = F.col("n") - F.when(F.col("n") > F.col("own"), 1).otherwise(0)
    return placed.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
