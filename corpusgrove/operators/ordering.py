"""Ordered operations over large tables without a single-partition window.

Rows carry a numeric order key.  They are cut into buckets of consecutive keys;
each bucket is a window partition of bounded width, and only one small row per
bucket meets in a global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BUCKET = 1 << 16


def _offsets(buckets: DataFrame, keys: list[str]) -> DataFrame:
    earlier = W.partitionBy(*keys).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    return buckets.select(
        *keys, "__bucket", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset")
    )


def dense_index(
    df: DataFrame,
    order: list[str],
    out: str,
    keys: list[str] | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Number rows 0, 1, 2, ... by ``order``, per ``keys`` group if given.

    ``bucket`` must not decrease along ``order``; by default it is the first
    order column in steps of 65,536, so one hot key group is still numbered by
    many tasks.
    """
    keys = keys or []
    tagged = df.withColumn("__bucket", bucket if bucket is not None else F.expr(f"{order[0]} div {BUCKET}"))
    counts = tagged.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    offsets = _offsets(counts, keys)
    within = F.row_number().over(W.partitionBy(*keys, "__bucket").orderBy(*order)) - 1
    return (
        tagged.withColumn("__rank", within)
        .join(offsets, [*keys, "__bucket"])
        .withColumn(out, F.col("__offset") + F.col("__rank"))
        .drop("__bucket", "__rank", "__offset")
    )


def next_value(df: DataFrame, order: str, out: str, width: int = BUCKET) -> DataFrame:
    """Add the next larger ``order`` value of the table, null on the last row."""
    tagged = df.withColumn("__bucket", F.expr(f"{order} div {width}"))
    heads = tagged.groupBy("__bucket").agg(F.min(order).alias("__head"))
    following = heads.select(
        "__bucket", F.lead("__head").over(W.orderBy("__bucket")).alias("__following")
    )
    inside = F.lead(order).over(W.partitionBy("__bucket").orderBy(order))
    return (
        tagged.withColumn("__inside", inside)
        .join(following, "__bucket")
        .withColumn(out, F.coalesce("__inside", "__following"))
        .drop("__bucket", "__inside", "__following")
    )


def carry_forward(df: DataFrame, order: str, value: str, out: str, width: int = BUCKET) -> DataFrame:
    """Add the last non-null ``value`` of any earlier row."""
    tagged = df.withColumn("__bucket", F.expr(f"{order} div {width}"))
    last = tagged.groupBy("__bucket").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("__tail")
    )
    earlier = W.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = last.select("__bucket", F.last("__tail", True).over(earlier).alias("__carried"))
    inside = F.last(value, True).over(
        W.partitionBy("__bucket").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        tagged.withColumn("__inside", inside)
        .join(carried, "__bucket")
        .withColumn(out, F.coalesce("__inside", "__carried"))
        .drop("__bucket", "__inside", "__carried")
    )
