"""Agreement between true labels and predicted topics, from pair counts.

The contingency table is built once with map-side aggregation; every score is a
further aggregation of it, so a label or topic holding most rows costs nothing
extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusgrove.functions.text import first_topic


def with_first_topic(df: DataFrame, column: str, out: str = "pred", unmatched: str = "error") -> DataFrame:
    """Adds the first assigned topic.  A response that names none raises
    (``error``) or counts as the topic ``None`` (``own``)."""
    found = df.withColumn(out, first_topic(F.col(column)))
    if unmatched == "own":
        return found.withColumn(out, F.coalesce(F.col(out), F.lit("None")))
    missing = F.raise_error(F.lit("a response names no topic")).cast("string")
    return found.withColumn(out, F.coalesce(F.col(out), missing))


def contingency(df: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _best_share(cells: DataFrame, by: str, out: str) -> DataFrame:
    best = cells.groupBy(by).agg(F.max("n").alias("best"), F.sum("n").alias("size"))
    return best.agg((F.sum("best").cast("double") / F.sum("size")).alias(out))


def purity(cells: DataFrame) -> DataFrame:
    """Share of rows in the majority label of their topic."""
    return _best_share(cells, "pred", "purity")


def inverse_purity(cells: DataFrame) -> DataFrame:
    """Share of rows in the majority topic of their label."""
    return _best_share(cells, "truth", "inverse_purity")


def harmonic_purity(cells: DataFrame) -> DataFrame:
    """Best F1 of each label over all topics, weighted by label size.

    F1 of a cell is 2n / (label size + topic size); empty cells score 0.
    """
    topics = cells.groupBy("pred").agg(F.sum("n").alias("pred_size"))
    labels = cells.groupBy("truth").agg(F.sum("n").alias("truth_size"))
    f1 = 2.0 * F.col("n") / (F.col("truth_size") + F.col("pred_size"))
    best = (
        cells.join(topics, "pred")
        .join(labels, "truth")
        .groupBy("truth")
        .agg(F.max(f1).alias("f1"), F.first("truth_size").alias("size"))
    )
    return best.agg((F.sum(F.col("f1") * F.col("size")) / F.sum("size")).alias("harmonic_purity"))


def _margins(cells: DataFrame) -> DataFrame:
    """Cells, label sizes, topic sizes and the total, tagged 0, 1, 2, 3."""
    return cells.groupingSets(
        [["truth", "pred"], ["truth"], ["pred"], []], "truth", "pred"
    ).agg(F.sum("n").cast("double").alias("n"), F.grouping_id().alias("kind"))


def _sums(cells: DataFrame) -> DataFrame:
    n, kind = F.col("n"), F.col("kind")

    def total(k: int, value: Column) -> Column:
        return F.sum(F.when(kind == k, value).otherwise(F.lit(0.0)))

    squares, entropies = n * n, n * F.log(n)
    return _margins(cells).agg(
        total(3, n).alias("n"),
        total(0, squares).alias("sq_cells"),
        total(1, squares).alias("sq_truth"),
        total(2, squares).alias("sq_pred"),
        total(0, entropies).alias("ln_cells"),
        total(1, entropies).alias("ln_truth"),
        total(2, entropies).alias("ln_pred"),
        total(1, F.lit(1.0)).alias("n_truth"),
        total(2, F.lit(1.0)).alias("n_pred"),
    )


def _rand_of_sums() -> Column:
    """Pair counting: pairs together in both, in one, and in neither."""
    n, both = F.col("n"), F.col("sq_cells") - F.col("n")
    only_truth = F.col("sq_truth") - F.col("sq_cells")
    only_pred = F.col("sq_pred") - F.col("sq_cells")
    neither = n * n - both - only_truth - only_pred - n
    spread = (both + only_truth) * (only_truth + neither) + (both + only_pred) * (only_pred + neither)
    return F.when((only_truth == 0) & (only_pred == 0), F.lit(1.0)).otherwise(
        F.try_divide(2.0 * (both * neither - only_truth * only_pred), spread)
    )


def _mi_of_sums() -> Column:
    n = F.col("n")
    h_truth = F.log(n) - F.col("ln_truth") / n
    h_pred = F.log(n) - F.col("ln_pred") / n
    shared = F.log(n) + (F.col("ln_cells") - F.col("ln_truth") - F.col("ln_pred")) / n
    one_cluster = (F.col("n_truth") <= 1) & (F.col("n_pred") <= 1)
    return (
        F.when(one_cluster, F.lit(1.0))
        .when(shared <= 1e-12, F.lit(0.0))
        .otherwise(F.try_divide(shared, (h_truth + h_pred) / 2.0))
    )


def adjusted_rand(cells: DataFrame) -> DataFrame:
    return _sums(cells).select(_rand_of_sums().alias("adjusted_rand"))


def normalized_mi(cells: DataFrame) -> DataFrame:
    """Mutual information over mean entropy, natural logarithm."""
    return _sums(cells).select(_mi_of_sums().alias("normalized_mi"))


def alignment_report(cells: DataFrame) -> DataFrame:
    """One row: harmonic purity, adjusted Rand index, normalised mutual information."""
    hp = harmonic_purity(cells).scalar()
    return _sums(cells).select(
        hp.alias("harmonic_purity"),
        _rand_of_sums().alias("adjusted_rand"),
        _mi_of_sums().alias("normalized_mi"),
    )
