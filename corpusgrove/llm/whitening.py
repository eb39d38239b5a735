"""Whitening of embeddings by a covariance over distinct vectors.

Entries become whole numbers, so equal vectors meet exactly and sums are exact.
Identical vectors are grouped once; their number, or one, is the weight of the
group in the fit.  Every task multiplies its centred, weighted rows into one
small matrix, the matrices are added in two steps, and the driver decomposes a
matrix whose size depends on the dimensions alone.  Each distinct vector is
whitened once and joined back to the rows that hold it; a vector that many rows
hold is a skewed key of a plain join, which adaptive execution splits.

Defined results: rows whose vector is null or holds null or non-finite entries
go; rows without an id, repeated ids and repeated rows are kept as they are; a
shorter vector counts as padded with zeros; components whose variance is under
1e-11 of the largest are constant up to rounding and have no rows, so a table
with one distinct vector, or with empty vectors alone, gives none; an empty
table gives an empty result; other columns are ignored.  Whole numbers that do
not fit 62 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusgrove.storage import materialize

OFFSET = 1_000_000
CONSTANT = 1e-11
ADDERS = 16
MOST = 1 << 62
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(rows: DataFrame, scale: int, offset: int, id_col: str, vector_col: str, *more: Column) -> DataFrame:
    """``vec_id, x`` of usable rows, x the entries as whole numbers ``floor(scale * c) + offset``, and ``more`` columns."""
    entry = lambda c: F.floor(c * scale) + offset
    limit = float(MOST >> 10) / scale
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    far = F.raise_error(F.lit("an entry is too large for exact whole numbers")).cast("long")
    vectors = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), *more)
    usable = vectors.filter(F.col("v").isNotNull() & ~F.exists("v", odd))
    return usable.withColumn("x", F.transform("v", lambda c: F.when(F.abs(c) < limit, entry(c)).otherwise(far))).drop("v")


def padded(vectors: DataFrame, width: int, filler: int) -> DataFrame:
    """Vectors of one length."""
    rest = F.array_repeat(F.lit(filler).cast("long"), F.greatest(F.lit(width) - F.size("x"), F.lit(0)))
    return vectors.withColumn("x", F.concat("x", rest))


def matrix(column: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def whole(value: np.ndarray) -> np.ndarray:
    """The value, if its magnitude allows for exact 64-bit arithmetic; ``value`` is a float estimate."""
    if value.size and np.abs(value).max() >= MOST:
        raise OverflowError("numbers are too large for exact 64-bit arithmetic")
    return value


def added(df: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], shape: tuple[int, ...], kind) -> np.ndarray:
    """Sum of ``part`` over all batches: one array a task, then ``ADDERS`` arrays, then one."""

    def total(batches, value):
        out = np.zeros(shape, kind)
        for batch in batches:
            for more in value(batch):
                if kind is np.int64:
                    whole(out.astype(float) + more)
                out += more
        return pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["data"])

    def first(batches):
        yield total(batches, lambda batch: [part(batch)] if batch.num_rows else [])

    def again(batches):
        yield total(batches, lambda batch: [np.frombuffer(d, kind).reshape(shape) for d in batch.column(0).to_pylist()])

    rows = df.mapInArrow(first, "data binary").repartition(ADDERS).mapInArrow(again, "data binary").collect()
    arrays = [np.frombuffer(r["data"], kind).reshape(shape) for r in rows]
    if kind is np.int64:
        whole(sum((a.astype(float) for a in arrays), np.zeros(shape)))
    return sum(arrays, np.zeros(shape, kind))


def covariance(df: DataFrame, centred: Callable[[pa.RecordBatch], np.ndarray], width: int, n: int) -> np.ndarray:
    """Covariance with divisor ``n``; the last column of ``df`` is the weight."""

    def gemm(batch):
        rows = centred(batch)
        weight = batch.column(batch.num_columns - 1).to_numpy()[:, None]
        return rows.T @ (rows * weight)

    return added(df, gemm, (width, width), np.float64) / n


def whiten(rows: DataFrame, components: int = 16, scale: int = 64, weight: str = "one", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each row on each component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``weight`` is ``one`` (each distinct vector counts once) or ``count``.
    ``deviation`` is the sum over dimensions of ``(n * x - S) ** 2``, exact.
    """
    spark = rows.sparkSession
    vectors = materialize(whole_vectors(rows, scale, OFFSET, id_col, vector_col), "vectors")
    width = vectors.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return spark.createDataFrame([], SCHEMA)
    vectors = padded(vectors, width, OFFSET)
    counted = F.count(F.lit(1)) if weight == "count" else F.lit(1).cast("long")
    distinct = materialize(vectors.groupBy("x").agg(counted.alias("weight")), "distinct-vectors")

    def sums(batch):
        x, w = matrix(batch.column(0), width), batch.column(1).to_numpy()
        whole(np.abs(x).astype(float).max(0, initial=0) * w.sum())
        return np.append(w @ x, w.sum())

    *total, n = added(distinct, sums, (width + 1,), np.int64).tolist()
    total = np.array(total, np.int64)

    def apart(x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        whole(np.array([np.abs(x).max(initial=0) * float(n) + np.abs(total.astype(float)).max()]))
        return x * n - total

    v = covariance(distinct, lambda batch: apart(matrix(batch.column(0), width)) / n, width, n)
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    kept = int(np.sum(e[:components] > max(e[0], 0) * CONSTANT))
    if not kept:
        return spark.createDataFrame([], SCHEMA)
    project = axes[:, :kept] / np.sqrt(e[:kept])

    def run(batches):
        for batch in batches:
            far = apart(matrix(batch.column(0), width))
            if np.abs(far).astype(float).max(initial=0) ** 2 * width < MOST:
                deviation = (far * far).sum(1).tolist()
            else:
                deviation = [sum(d * d for d in row) for row in far.tolist()]
            z = (far / n) @ project
            columns = [batch.column(0), pa.array(deviation, pa.int64()), pa.array(list(z), pa.list_(pa.float64())), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, ["x", "deviation", "z", "weight"])

    white = materialize(distinct.mapInArrow(run, "x array<long>, deviation long, z array<double>, weight long"), "whitened")
    points = white.select("z", "weight")
    mean = added(points, lambda b: b.column(1).to_numpy() @ matrix(b.column(0), kept, float), (kept,), np.float64) / n
    unit = covariance(points, lambda b: matrix(b.column(0), kept, float) - mean, kept, n)
    error = float(np.abs(unit - np.eye(kept)).max())
    shares = F.array(*[F.lit(float(s)) for s in e[:kept] / np.trace(v)])
    back = vectors.join(white.drop("weight"), "x").select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return back.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")
    )
