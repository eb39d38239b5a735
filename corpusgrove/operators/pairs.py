"""Similar pairs of topics by branch and bound.

Unit vectors are sorted by the nearest of a few pivots (taken from a bounded
sample) and cut into blocks with a centre and an angle that holds all of them;
``GROUP`` blocks are a group.  Two blocks whose centres lie further apart than
the threshold and both angles allow hold no pair.  A pair of groups without a
pair of blocks within reach is never brought together, and within a pair of
groups only the blocks within reach are multiplied.  The result is exact.

Groups are sent to each other, so for the best pairs they grow with the vectors
(about ``GROUPS`` of them, ``GROUP_BYTES`` at most) and what is sent grows with
the vectors alone; only the best pairs so far are held.  Vectors that single
precision holds exactly are sent so.

For the best pairs the bound is the k-th best score so far: pairs of groups go
in waves, those with the highest bounds first, until no bound is left above it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from corpusgrove.storage import materialize

BLOCK = 256
GROUP = 16
GROUPS = 24
GROUP_BYTES = 64 << 20
PIVOTS = 64
SAMPLE = 2048
WAVE = 64
SLACK = 1e-5  # of an angle, far more than its rounding error
PLACED = "cell int, near double, ord long, key long, unit binary"
BLOCKS = "part int, place int, ords binary, keys binary, units binary, centre binary, angle double"
PAIRS = "i long, j long, score double"
KEYED = "i long, j long, score double, p long, q long"


def unit_rows(rows: list) -> np.ndarray:
    matrix = np.asarray(np.stack(rows), dtype=float)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def pivots_of(units: np.ndarray, count: int) -> np.ndarray:
    """Rows of ``units`` far from each other: each the farthest from those before it."""
    units = units[np.abs(units).any(1)]
    if not len(units):
        return np.zeros((1, units.shape[1]))
    picked = [0]
    near = units @ units[0]
    while len(picked) < count and near.min() < 1 - 1e-9:
        picked.append(int(near.argmin()))
        near = np.maximum(near, units @ units[picked[-1]])
    return units[picked]


def within_reach(centres_a: np.ndarray, angles_a: np.ndarray, centres_b: np.ndarray, angles_b: np.ndarray) -> np.ndarray:
    """The largest cosine that any two vectors of two blocks can have, for all pairs of blocks.

    Blocks that hold a zero vector have the angle pi: nothing is left out.
    """
    apart = np.arccos(np.clip(centres_a @ centres_b.T, -1, 1)) - angles_a[:, None] - angles_b[None, :] - SLACK
    return np.cos(np.clip(apart, 0, np.pi))


@dataclass(frozen=True)
class Layout:
    """Vectors in numbered groups of blocks (``grp, ords, keys, units, centre, angle``)."""

    blocks: DataFrame
    groups: int
    width: int

    def group_pairs(self) -> DataFrame:
        """``a, b, bound`` of all pairs of groups, ``a <= b``: the largest cosine that two of their vectors can have."""
        summary = self.blocks.groupBy("grp").agg(F.collect_list(F.struct("centre", "angle")).alias("s"))
        last = F.lit(self.groups - 1).cast("long")
        left = summary.select(F.col("grp").alias("a"), F.col("s").alias("left"), F.explode(F.sequence("grp", last)).alias("b"))
        both = left.join(summary.select(F.col("grp").alias("b"), F.col("s").alias("right")), "b").select("a", "b", "left", "right")
        width = self.width

        def bound(batches):
            def read(column):
                centres = np.frombuffer(b"".join(column.field("centre").to_pylist()), np.float64).reshape(-1, width)
                return centres, column.field("angle").to_numpy()

            for batch in batches:
                most = [float(within_reach(*read(a.values), *read(b.values)).max()) for a, b in zip(batch.column(2), batch.column(3))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(most, pa.float64())], ["a", "b", "bound"])

        return both.mapInArrow(bound, "a long, b long, bound double")


def stored(vectors: DataFrame) -> tuple[DataFrame, int, int]:
    """``ord, key, embedding`` of the vectors that are there, their length and number; ``key`` is the ord if there is none."""
    key = F.col("key" if "key" in vectors.columns else "ord").cast("long").alias("key")
    vectors = vectors.select(F.col("ord").cast("long"), key, F.col("embedding").cast("array<double>")).filter("embedding is not null")
    vectors = materialize(vectors, "pair-vectors")
    width, count = vectors.agg(F.max(F.size("embedding")), F.count(F.lit(1))).first()
    return vectors, width, count


def group_blocks(count: int, width: int) -> int:
    """Blocks of a group, so that ``count`` vectors are about ``GROUPS`` groups within ``GROUP_BYTES``."""
    return max(GROUP, min(-(-count // (BLOCK * GROUPS)), GROUP_BYTES // (8 * BLOCK * max(width, 1))))


def packed_vectors(rows: list[bytes], width: int) -> bytes:
    """Vectors of double precision, one after another; in single precision if nothing is lost."""
    whole = np.frombuffer(b"".join(rows), np.float64)
    with np.errstate(over="ignore"):
        short = whole.astype(np.float32)
    return short.tobytes() if np.array_equal(short, whole) else whole.tobytes()


def unpacked_units(data: bytes, count: int, width: int) -> np.ndarray:
    """Unit vectors of ``packed_vectors``."""
    kind = np.float32 if len(data) == 4 * count * width else np.float64
    return unit_rows(list(np.frombuffer(data, kind).reshape(-1, width).astype(np.float64)))


def layout(vectors: DataFrame, width: int, group: int | None = None) -> Layout:
    """Blocks of ``stored`` vectors, ``group`` of them a group."""
    group = group or GROUP
    sample = vectors.orderBy(F.xxhash64("ord"), "ord").limit(SAMPLE).select("embedding").collect()
    pivots = pivots_of(unit_rows([r["embedding"] for r in sample]), PIVOTS)

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                rows = batch.column(2).flatten().to_numpy().reshape(-1, width)
                units = unit_rows(list(rows))
                near = units @ pivots.T
                cell = near.argmax(1)
                columns = [pa.array(cell, pa.int32()), pa.array(-near[np.arange(len(cell)), cell]), batch.column(0), batch.column(1), pa.array([v.tobytes() for v in rows], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "near", "ord", "key", "unit"])

    def pack(batches):
        part, place, filled, held, cell = TaskContext.get().partitionId(), 0, 0, [], None

        def row():
            vectors = packed_vectors([h[2] for h in held], width)
            centre, angle = block_shape(unpacked_units(vectors, len(held), width))
            ords, keys = (np.array([h[k] for h in held], np.int64).tobytes() for k in (0, 1))
            values = [part, place, ords, keys, vectors, centre.tobytes(), angle]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [c.split()[0] for c in BLOCKS.split(", ")])

        for batch in batches:
            for own, *one in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4))):
                if held and (own != cell or len(held) == BLOCK):
                    yield row()
                    held, filled = [], filled + 1
                    if filled == group:
                        place, filled = place + 1, 0
                cell = own
                held.append(one)
        if held:
            yield row()

    order = ["cell", "near", "ord"]
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if group > GROUP:
        parts = min(parts, GROUPS)
    packed = vectors.mapInArrow(place, PLACED).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(pack, BLOCKS)
    packed = materialize(packed, "pair-blocks")
    # one row for each part: no more than there are shuffle partitions
    sizes = packed.groupBy("part").agg((F.max("place") + 1).alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = materialize(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), "n"), "pair-parts")
    groups = bases.agg(F.max(F.col("base") + F.col("n"))).first()[0]
    blocks = packed.join(F.broadcast(bases.drop("n")), "part").withColumn("grp", F.col("base") + F.col("place")).drop("part", "place", "base")
    return Layout(blocks, groups, width)


Block = tuple[np.ndarray, np.ndarray, np.ndarray]  # ords, keys, unit vectors


def block_shape(units: np.ndarray) -> tuple[np.ndarray, float]:
    """Centre of some unit vectors, and the largest angle from it."""
    centre = units.mean(0)
    size = np.linalg.norm(centre)
    centre = centre / size if size > 1e-9 else units[0]
    whole = np.abs(units).any(1).all() and np.abs(centre).any()
    return centre, float(np.arccos(np.clip((units @ centre).min(), -1, 1))) if whole else float(np.pi)


def found_pairs(a: list[Block], at: tuple, b: list[Block], to: tuple, floor: float, strict: bool, k: int | None) -> pa.Table:
    """Pairs of vectors of two groups of blocks (``at, to``: their centres and angles) with a score above ``floor``, or at it."""
    nothing = np.zeros(0, np.int64)
    found = [(nothing, nothing, np.zeros(0), nothing, nothing)]

    def gathered() -> list[np.ndarray]:
        """All found so far, in order; with ``k`` the ``k`` best alone."""
        i, j, score, p, q = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((j, i, -score))
        if k is not None:
            pair = np.stack((np.minimum(p, q), np.maximum(p, q)))[:, order]
            order = order[np.sort(np.unique(pair, axis=1, return_index=True)[1])[:k]]
        return [c[order] for c in (i, j, score, p, q)]

    reach = within_reach(*at, *to)
    near = np.argwhere(reach >= floor - 1e-9)
    if k is not None:
        near = near[np.argsort(-reach[tuple(near.T)], kind="stable")]
    for x, y in near:
        if reach[x, y] < floor - 1e-9:
            break
        (ords, keys, units), (others, names, vectors) = a[x], b[y]
        scores = np.round(units @ vectors.T, 12)
        m, n = np.nonzero(scores > floor if strict else scores >= floor)
        if not len(m):
            continue
        turned = ords[m] > others[n]
        i, j = np.minimum(ords[m], others[n]), np.maximum(ords[m], others[n])
        p, q = np.where(turned, names[n], keys[m]), np.where(turned, keys[m], names[n])
        found.append(tuple(c[i != j] for c in (i, j, scores[m, n], p, q)))
        if k is not None:
            best = gathered()
            found = [tuple(best)]
            if len(best[2]) == k:
                floor, strict = best[2][-1], False
    i, j, score, p, q = gathered()
    if k is None:
        # a group that meets itself gives every pair twice
        order = np.lexsort((j, i))
        order = order[np.append(True, (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0))[: len(order)]]
        i, j, score, p, q = (c[order] for c in (i, j, score, p, q))
    return pa.Table.from_arrays([pa.array(c) for c in (i, j, score, p, q)], ["i", "j", "score", "p", "q"])


def _products(laid: Layout, pairs: DataFrame, floor: float, strict: bool, k: int | None = None) -> DataFrame:
    """``found_pairs`` of the pairs of groups ``a, b``.

    With ``k``, the ``k`` best of each pair of groups alone; of several pairs of
    the same two keys ``p, q`` the best counts.
    """
    width = laid.width

    def side(name: str) -> DataFrame:
        rows = pairs.select("a", "b").join(laid.blocks.withColumnRenamed("grp", name), name)
        # new columns, as both sides come from the same table
        return rows.select(*[F.col(c).alias(c) for c in ("a", "b", "ords", "keys", "units", "centre", "angle")])

    def read(table: pa.Table) -> tuple[list[Block], tuple[np.ndarray, np.ndarray]]:
        rows = zip(*(table.column(c).to_pylist() for c in ("ords", "keys", "units")))
        blocks = [(np.frombuffer(o, np.int64), np.frombuffer(c, np.int64), unpacked_units(u, len(o) // 8, width)) for o, c, u in rows]
        centres = np.frombuffer(b"".join(table.column("centre").to_pylist()), np.float64).reshape(-1, width)
        return blocks, (centres, table.column("angle").to_numpy())

    def product(left: pa.Table, right: pa.Table) -> pa.Table:
        return found_pairs(*read(left), *read(right), floor, strict, k)

    return side("a").groupBy("a", "b").cogroup(side("b").groupBy("a", "b")).applyInArrow(product, KEYED)


def _one_group(vectors: DataFrame, width: int, floor: float, strict: bool, k: int | None = None) -> DataFrame:
    """``found_pairs`` of a single group: one task, ``BLOCK * GROUP`` vectors at most."""

    def run(batches):
        table = pa.Table.from_batches(batches)
        ords, keys = table.column("ord").to_numpy(), table.column("key").to_numpy()
        units = unit_rows(list(table.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, width)))
        order = np.argsort((units @ pivots_of(units[:SAMPLE], PIVOTS).T).argmax(1), kind="stable")
        cuts = [order[at : at + BLOCK] for at in range(0, len(order), BLOCK)]
        blocks = [(ords[c], keys[c], units[c]) for c in cuts]
        centres, angles = zip(*(block_shape(b[2]) for b in blocks))
        shape = np.stack(centres), np.array(angles)
        yield from found_pairs(blocks, shape, blocks, shape, floor, strict, k).to_batches()

    return vectors.select("ord", "key", "embedding").coalesce(1).mapInArrow(run, KEYED)


def topic_pairs(vectors: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``i < j`` with cosine above ``threshold``, from ``ord, embedding``; null vectors have none."""
    vectors, width, count = stored(vectors)
    if not count:
        return vectors.sparkSession.createDataFrame([], PAIRS)
    if count <= BLOCK * GROUP:
        return _one_group(vectors, width, threshold, True).select("i", "j", "score")
    laid = layout(vectors, width)
    near = materialize(laid.group_pairs().filter(F.col("bound") > threshold), "group-pairs")
    return _products(laid, near, threshold, True).select("i", "j", "score")


def closest_pairs(vectors: DataFrame, k: int, threshold: float, wave: int = WAVE) -> DataFrame:
    """The ``k`` best pairs above ``threshold``: ``i, j, score``, equal scores in order.

    ``vectors`` holds ``ord, embedding`` and may hold ``key``; of the pairs of
    the same two keys only the best counts.
    """
    vectors, width, count = stored(vectors)
    if not count:
        return vectors.sparkSession.createDataFrame([], PAIRS)
    if count <= BLOCK * GROUP:
        return _one_group(vectors, width, threshold, True, k).select("i", "j", "score")
    laid = layout(vectors, width, group_blocks(count, width))
    near = materialize(laid.group_pairs().filter(F.col("bound") > threshold), "group-pairs")
    floor, full, found = threshold, False, None
    while True:
        turn = materialize(near.filter(F.col("bound") >= floor - 1e-9).orderBy(F.desc("bound"), "a", "b").limit(wave), "wave")
        last = turn.agg(F.min(F.struct("bound", (-F.col("a")).alias("a"), (-F.col("b")).alias("b")))).first()[0]
        if last is None:
            break
        behind = (F.col("a") > -last["a"]) | ((F.col("a") == -last["a"]) & (F.col("b") > -last["b"]))
        near = near.filter((F.col("bound") < last["bound"]) | ((F.col("bound") == last["bound"]) & behind))
        got = _products(laid, turn, floor, not full, k)
        if found is not None:
            got = got.unionByName(found)
        best = F.min(F.struct((-F.col("score")).alias("s"), "i", "j", "p", "q")).alias("best")
        once = got.groupBy(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).agg(best)
        once = once.select("best.i", "best.j", (-F.col("best.s")).alias("score"), "best.p", "best.q")
        found = materialize(once.orderBy(F.desc("score"), "i", "j").limit(k), "closest")
        count, least = found.agg(F.count(F.lit(1)), F.min("score")).first()
        if count == k:
            floor, full = least, True
        wave *= 2
    if found is None:
        return vectors.sparkSession.createDataFrame([], PAIRS)
    return found.select("i", "j", "score")
