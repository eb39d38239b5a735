"""Hard negatives by angular triangle filtering.

A few reference directions are fitted on a bounded sample.  Every row stores its
angle to each of them.  By the triangle inequality the angle between two rows is
at least the difference of their angles to a reference and at most their sum, so
the references give an interval of the cosine, and with the norms an interval of
the inner product, widened for rounding.  Only pairs whose interval meets the
wanted window of scores are scored, in whole numbers.

Rows are range-partitioned by label, nearest reference and angle into blocks of
one label; blocks have intervals too.  Anchors are dealt into packs.  A search
brings packs and groups of blocks together by pack and group number, so a task
holds one pack and ``GROUP`` blocks at most: anchors of a label against the
groups of that label for the positives, all anchors against all groups for the
negatives.  Only the best few of each leave the task.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component take no part; an id that repeats counts once, with its
smallest label and vector; a shorter vector counts as padded with zeros; ties go
to the smaller id; anchors without another row of their label, and positives
without a row in the window, have no rows; an empty table gives an empty result;
other columns are ignored.  Whole numbers that do not fit 62 bits raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from corpusgrove.llm.whitening import MOST, matrix, padded, whole_vectors
from corpusgrove.storage import materialize

REFERENCES = 16
SAMPLE = 2048
BLOCK = 512
GROUP = 16
PACK = 1024
SLACK = 1e-5  # of an angle, far more than its rounding error
NOTHING = -MOST
POINTS = "label long, cell int, near double, vec_id long, x binary, angles binary"
BLOCKS = "part int, place int, label long, ids binary, x binary, angles binary"
FOUND = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def reference_directions(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Unit vectors near which the sample gathers: the farthest first, then moved to the means."""
    rows = sample[np.abs(sample).any(1)].astype(float)
    if not len(rows):
        return np.eye(1, sample.shape[1])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    picked = rows[:1]
    while len(picked) < count and (near := (rows @ picked.T).max(1)).min() < 1 - 1e-9:
        picked = np.vstack((picked, rows[near.argmin()]))
    for _ in range(rounds):
        own = (rows @ picked.T).argmax(1)
        for k in range(len(picked)):
            mean = rows[own == k].sum(0)
            if (size := np.linalg.norm(mean)) > 1e-9:
                picked[k] = mean / size
    return picked


def angles_to(x: np.ndarray, references: np.ndarray) -> np.ndarray:
    rows = x.astype(float)
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    unit = np.divide(rows, size, out=np.zeros_like(rows), where=size > 0)
    return np.arccos(np.clip(unit @ references.T, -1, 1))


class Rows:
    """Rows of one block or pack: ids, whole vectors, norms and angles."""

    def __init__(self, ids: bytes, x: bytes, angles: bytes, width: int, label: int | None = None):
        self.label = label
        self.ids = np.frombuffer(ids, np.int64)
        self.x = np.frombuffer(x, np.int64).reshape(-1, width)
        self.angles = np.frombuffer(angles, np.float64).reshape(len(self.ids), -1)
        self.norms = np.linalg.norm(self.x.astype(float), axis=1)


def score_bounds(near: np.ndarray, far: np.ndarray, short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product for angles in [near, far] and products of norms in [short, long]."""
    high, low = np.cos(np.clip(near - SLACK, 0, np.pi)), np.cos(np.clip(far + SLACK, 0, np.pi))
    room = long * 1e-9 + 1e-3
    return np.where(low > 0, short, long) * low - room, np.where(high > 0, long, short) * high + room


def block_bounds(a: Rows, b: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of every anchor's scores with any row of a block."""
    least, most = b.angles.min(0), b.angles.max(0)
    near = np.maximum(a.angles - most, least - a.angles).max(1)
    far = (a.angles + most).min(1)
    return score_bounds(near, far, a.norms * b.norms.min(), a.norms * b.norms.max())


def overlapping(a: Rows, which: np.ndarray, b: Rows, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Pairs whose score bounds meet the anchor's window [low, high], for the anchors ``which``."""
    near = np.zeros((len(which), len(b.ids)))
    far = np.full(near.shape, np.pi)
    for r in range(a.angles.shape[1]):
        p, q = a.angles[which, r][:, None], b.angles[:, r][None, :]
        np.maximum(near, np.abs(p - q), out=near)
        np.minimum(far, p + q, out=far)
    product = a.norms[which][:, None] * b.norms[None, :]
    least, most = score_bounds(near, far, product, product)
    return (most >= low[which, None]) & (least <= high[which, None])


def whole_scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of whole vectors, exact."""
    size = np.linalg.norm(x.astype(float), axis=1).max(initial=0) * np.linalg.norm(y.astype(float), axis=1).max(initial=0)
    if size < 1 << 52:  # every partial sum is a whole number that a double holds
        return (x.astype(float) @ y.astype(float).T).astype(np.int64)
    if size >= MOST:
        raise OverflowError("inner products are too large for exact 64-bit arithmetic")
    return x @ y.T


class Best:
    """The ``k`` best of every row so far: higher scores first, ties to smaller ids."""

    def __init__(self, rows: int, k: int):
        self.k, self.least = k, np.full(rows, NOTHING)
        self.rows, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        rows, ids, scores = (np.concatenate(pair) for pair in ((self.rows, rows), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, -scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        first = np.searchsorted(rows, rows)
        kept = np.arange(len(rows)) - first < self.k
        self.rows, self.ids, self.scores = rows[kept], ids[kept], scores[kept]
        last = (np.arange(len(rows)) - first == self.k - 1)[kept]
        self.least[self.rows[last]] = self.scores[last]


def search(a: Rows, blocks: list[Rows], bests: list[Best], low: np.ndarray, high: np.ndarray, allowed) -> int:
    """Fills ``bests``, one for each column of the windows [low, high]; returns how many pairs were scored.

    ``allowed`` gives the anchors that may meet a block.  Blocks go in order of
    the largest score they can hold, so that later ones are mostly left out.
    """
    scored = 0
    bounds = [block_bounds(a, b) for b in blocks]
    for k in sorted(range(len(blocks)), key=lambda k: -bounds[k][1].max()):
        b, (least, most) = blocks[k], bounds[k]
        floors = np.maximum(low, np.stack([best.least for best in bests], 1))
        open_ = floors <= high
        floor = np.where(open_, floors, MOST).min(1)
        ceiling = np.where(open_, high, NOTHING).max(1)
        which = np.flatnonzero(allowed(b) & open_.any(1) & (most >= floor) & (least <= ceiling))
        if not len(which):
            continue
        pairs = overlapping(a, which, b, floor, ceiling) & (a.ids[which][:, None] != b.ids[None, :])
        anchors, rows = np.flatnonzero(pairs.any(1)), np.flatnonzero(pairs.any(0))
        if not len(anchors):
            continue
        which, pairs = which[anchors], pairs[np.ix_(anchors, rows)]
        scored += int(pairs.sum())
        scores = whole_scores(a.x[which], b.x[rows])
        for w, best in enumerate(bests):
            at, to = np.nonzero(pairs & (scores >= floors[which, w][:, None]) & (scores <= high[which, w][:, None]))
            if len(at):
                best.add(which[at], b.ids[rows[to]], scores[at, to])
    return scored


def points(rows: DataFrame, scale: int, every: int, labels: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, x`` of the rows that take part, one for each id."""
    label = F.col(label_col).cast("long")
    vec_id = F.col(id_col).cast("long")
    moved = F.when(vec_id % every == 0, (label + 1) % labels).otherwise(label)
    usable = whole_vectors(rows, scale, 0, id_col, vector_col, moved.alias("label")).filter("vec_id is not null and label is not null")
    once = usable.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row"))
    return once.select("vec_id", "row.label", "row.x")


def blocks_of(placed: DataFrame) -> DataFrame:
    """Blocks of rows of one label, numbered by group: ``label, ids, x, angles, grp``."""

    def pack(batches):
        part, place, filled, held, label = TaskContext.get().partitionId(), 0, 0, [], None

        def row():
            some = sorted(held, key=lambda h: h[0])
            columns = [pa.array([part], pa.int32()), pa.array([place], pa.int32()), pa.array([label], pa.int64()), pa.array([np.array([h[0] for h in some], np.int64).tobytes()], pa.binary())]
            data = [pa.array([b"".join(h[k] for h in some)], pa.binary()) for k in (1, 2)]
            return pa.RecordBatch.from_arrays([*columns, *data], ["part", "place", "label", "ids", "x", "angles"])

        for batch in batches:
            for own, vec_id, x, angles in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4, 5))):
                if held and (own != label or len(held) == BLOCK):
                    yield row()
                    held, filled = [], filled + 1
                    if own != label or filled == GROUP:
                        place, filled = place + 1, 0
                label = own
                held.append((vec_id, x, angles))
        if held:
            yield row()

    width = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "cell", "near", "vec_id"]
    packed = materialize(placed.repartitionByRange(width, *order).sortWithinPartitions(*order).mapInArrow(pack, BLOCKS), "blocks")
    # one row for each part: no more than there are shuffle partitions
    sizes = packed.groupBy("part").agg((F.max("place") + 1).alias("n"))
    bases = sizes.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return packed.join(F.broadcast(bases), "part").withColumn("grp", F.col("base") + F.col("place")).drop("part", "place", "base")


def _pair_up(packs: DataFrame, blocks: DataFrame, keys: list[str], run) -> DataFrame:
    """``run(packs, blocks)`` for every pack and group that share ``keys``."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = ([], [], [], [], [])
        if left.num_rows and right.num_rows:
            for some in run(left, right):
                for column, values in zip(columns, some):
                    column.append(values)
        arrays = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in columns]
        return pa.Table.from_arrays(arrays, ["anchor_id", "positive_id", "positive_score", "vec_id", "score"])

    return packs.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(both, FOUND)


def _joined(table: pa.Table, width: int) -> Rows:
    """The rows of all packed rows of a table (columns ids, x, angles)."""
    return Rows(*(b"".join(table.column(c).to_pylist()) for c in ("ids", "x", "angles")), width)


def _blocks(table: pa.Table, width: int) -> list[Rows]:
    return [Rows(*row, width, label) for label, *row in zip(*(table.column(c).to_pylist() for c in ("label", "ids", "x", "angles")))]


def mine(
    rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, moved: int = 7, labels: int = 10,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """The hardest rows of another label for each anchor and positive.

    Anchors have ids divisible by ``every``.  A negative's score lies between
    ``low`` and ``high`` percent of the positive's.
    """
    spark = rows.sparkSession
    usable = materialize(points(rows, scale, moved, labels, id_col, vector_col, label_col), "points")
    width = usable.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return spark.createDataFrame([], SCHEMA)
    usable = padded(usable, width, 0)
    sample = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("x").toArrow()
    references = reference_directions(matrix(sample.column(0).combine_chunks(), width), REFERENCES)

    def measure(batches):
        for batch in batches:
            x = matrix(batch.column(2), width)
            angles = angles_to(x, references)
            cell = angles.argmin(1)
            data = [pa.array([row.tobytes() for row in some], pa.binary()) for some in (x, angles)]
            columns = [batch.column(1), pa.array(cell, pa.int32()), pa.array(angles[np.arange(len(x)), cell]), batch.column(0), *data]
            yield pa.RecordBatch.from_arrays(columns, ["label", "cell", "near", "vec_id", "x", "angles"])

    placed = materialize(usable.select("vec_id", "label", "x").mapInArrow(measure, POINTS), "placed")
    blocks = materialize(blocks_of(placed), "numbered")
    anchors = placed.filter(F.col("vec_id") % every == 0)
    deal = F.xxhash64("vec_id")
    as_ids = F.unhex(F.lpad(F.hex("vec_id"), 16, "0"))

    def ids_of(table: pa.Table) -> bytes:
        return np.frombuffer(b"".join(table.column("ids").to_pylist()), ">i8").astype(np.int64).tobytes()

    # positives: the anchors of a label against the groups of that label
    ranges = blocks.groupBy("label").agg(F.min("grp").alias("from"), F.max("grp").alias("to"))
    packs = anchors.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / PACK).alias("packs"))
    spans = materialize(ranges.join(packs, "label"), "label-spans")
    asked = anchors.join(spans, "label").select(
        F.pmod(deal, F.col("packs")).alias("pack"), F.explode(F.sequence("from", "to")).alias("grp"), "label", as_ids.alias("ids"), "x", "angles"
    )
    offered = blocks.join(spans.select("label", "packs"), "label").select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("packs") - 1)).alias("pack"), "grp", "label", "ids", "x", "angles")

    def same_label(left: pa.Table, right: pa.Table):
        a = _joined(left, width)
        a.ids = np.frombuffer(ids_of(left), np.int64)
        best, edge = Best(len(a.ids), positives), np.full((len(a.ids), 1), MOST)
        search(a, _blocks(right, width), [best], -edge, edge, lambda b: np.ones(len(a.ids), bool))
        nothing = np.zeros(len(best.rows), np.int64)
        yield a.ids[best.rows], nothing, nothing, best.ids, best.scores

    near = _pair_up(asked, offered, ["pack", "grp", "label"], same_label)
    order = W.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    chosen = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives)
    chosen = materialize(chosen.select("anchor_id", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # negatives: all anchors with positives against all groups
    wanted = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("wanted"))
    asked = anchors.join(wanted, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", as_ids.alias("ids"), "x", "angles", "wanted")
    asked = materialize(asked, "anchors")
    count, groups = asked.count(), blocks.agg(F.max("grp")).first()[0]
    n_packs = max(1, -(-count // PACK))
    asked = asked.select(F.pmod(deal, F.lit(n_packs)).alias("pack"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups).cast("long"))).alias("grp"), "label", "ids", "x", "angles", "wanted")
    offered = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_packs - 1).cast("long"))).alias("pack"), "grp", "label", "ids", "x", "angles")

    def other_label(left: pa.Table, right: pa.Table):
        a = _joined(left, width)
        a.ids = np.frombuffer(ids_of(left), np.int64)
        own = left.column("label").to_numpy()
        target = np.full((len(a.ids), positives), NOTHING)
        names = np.zeros((len(a.ids), positives), np.int64)
        for k, some in enumerate(left.column("wanted").to_pylist()):
            for w, one in enumerate(some):
                target[k, w], names[k, w] = one["positive_score"], one["positive_id"]
        real = target != NOTHING
        if real.any() and np.abs(target[real]).max() >= MOST // 100:
            raise OverflowError("scores are too large for exact percentages")
        shown = np.where(real, target, 0)
        least = np.where(real, -((-low * shown) // 100), MOST)
        most = np.where(real, (high * shown) // 100, NOTHING)
        bests = [Best(len(a.ids), negatives) for _ in range(positives)]
        search(a, _blocks(right, width), bests, least, most, lambda b: own != b.label)
        for w, best in enumerate(bests):
            yield a.ids[best.rows], names[best.rows, w], target[best.rows, w], best.ids, best.scores

    far = _pair_up(asked, offered, ["pack", "grp"], other_label)
    order = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    kept = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return kept.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
