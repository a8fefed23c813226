"""Orders and top-k over result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.expr import q


def sort_results(comparison: DataFrame, by: str) -> DataFrame:
    """Order a comparison by a score, models by name among equals."""
    return comparison.orderBy(q(by), "model")


def extreme_coefficients(weights: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest and ``k`` smallest signed weights: ``(side, feature, coef)``."""
    top = weights.orderBy(q("coef").desc(), "feature").limit(k).withColumn("side", F.lit("positive"))
    low = weights.orderBy(q("coef"), "feature").limit(k).withColumn("side", F.lit("negative"))
    return top.unionByName(low).select("side", "feature", "coef")


def top_importances(weights: DataFrame, k: int) -> DataFrame:
    """The ``k`` most important features."""
    return weights.orderBy(q("importance").desc(), "feature").limit(k)


def rank_models_within_dataset(comparison: DataFrame, by: str = "cv_rmse") -> DataFrame:
    """Rank 1..m of the models of each dataset."""
    order = Window.partitionBy("dataset").orderBy(q(by), "model")
    return comparison.withColumn("rank", F.row_number().over(order).cast("bigint"))


def rank_datasets_within_model(comparison: DataFrame, by: str = "cv_rmse") -> DataFrame:
    """Rank 1..d of the datasets for each model."""
    order = Window.partitionBy("model").orderBy(q(by), "dataset")
    return comparison.withColumn("rank", F.row_number().over(order).cast("bigint"))


def best_models(comparison: DataFrame, dataset: str, k: int, by: str = "cv_rmse") -> DataFrame:
    """The ``k`` best models of one dataset."""
    return comparison.filter(q("dataset") == dataset).orderBy(q(by), "model").limit(k)


def pivot_ranks(ranks: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """Ranks as one row per model and one column per dataset."""
    return ranks.groupBy("model").pivot("dataset", list(datasets)).agg(F.first("rank"))
