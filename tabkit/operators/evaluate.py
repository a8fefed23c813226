"""Errors and comparisons over long prediction tables ``(dataset, model, id, fold, y, p)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.expr import fold_of, q


def assign_folds(df: DataFrame, k: int = 5, key: str = "id", seed: int = 30011) -> DataFrame:
    """Add a fold number of near-equal sizes, fixed by the key."""
    return df.withColumn("fold", fold_of(q(key), k, seed))


def squared(y: str = "y", p: str = "p") -> Column:
    """Squared error of a prediction column."""
    return (q(y) - q(p)) * (q(y) - q(p))


def train_rmse(preds: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p") -> DataFrame:
    """Root mean squared error."""
    return preds.groupBy(*[q(b) for b in by]).agg(F.sqrt(F.avg(squared(y, p))).alias("rmse"))


def fold_errors(preds: DataFrame, by: Sequence[str] = ("dataset", "model")) -> DataFrame:
    """Mean squared error per fold."""
    return preds.groupBy(*[q(b) for b in by], "fold").agg(F.avg(squared()).alias("mse"))


def cv_rmse(preds: DataFrame, by: Sequence[str] = ("dataset", "model")) -> DataFrame:
    """Root of the mean over folds of the fold's mean squared error."""
    return fold_errors(preds, by).groupBy(*[q(b) for b in by]).agg(F.sqrt(F.avg("mse")).alias("cv_rmse"))


def compare_models(in_sample: DataFrame, held_out: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rows ``(dataset, model, train_rmse, cv_rmse)``; scores already known replace computed ones."""
    by = ["dataset", "model"]
    out = train_rmse(in_sample, by).withColumnRenamed("rmse", "train_rmse").join(cv_rmse(held_out, by), by, "full")
    if known is None:
        return out
    return out.join(known.select(*by, q("cv_rmse").alias("_known")), by, "full").select(
        *by, "train_rmse", F.coalesce("_known", "cv_rmse").alias("cv_rmse")
    )


def comparison_long(comparison: DataFrame) -> DataFrame:
    """Comparison as rows ``(dataset, model, metric, value)``."""
    return comparison.unpivot(["dataset", "model"], ["train_rmse", "cv_rmse"], "metric", "value")


def exclude_models(comparison: DataFrame, names: Sequence[str]) -> DataFrame:
    """Comparison without some models."""
    return comparison.filter(~q("model").isin(list(names)))


def back_transform(preds: DataFrame, col: str = "p", out: str | None = None) -> DataFrame:
    """Exponential of log-scale predictions."""
    return preds.withColumn(out or col, F.exp(q(col)))


def log_rmse(preds: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Root mean squared difference of logs."""
    d = F.ln(q(p)) - F.ln(q(y))
    return preds.agg(F.sqrt(F.avg(d * d)).alias("log_rmse"))


def error_band(scores: DataFrame, col: str) -> DataFrame:
    """Multiplicative band ``[exp(-e), exp(e)]`` of a log-scale error."""
    return scores.withColumn("low", F.exp(-q(col))).withColumn("high", F.exp(q(col)))


def predictions(
    df: DataFrame, fitted: Mapping[str, object], dataset: str, label: str, key: str = "id", fold: str | None = None
) -> DataFrame:
    """Long predictions of several fitted models on one table."""
    from tabkit.operators.regress import LinearFit

    keep = [F.lit(dataset).alias("dataset"), q(key), (q(fold) if fold else F.lit(0).cast("bigint")).alias("fold"),
            q(label).alias("y")]
    linear = {n: m for n, m in fitted.items() if isinstance(m, LinearFit)}
    out = None
    if linear:
        # all linear models from one scan
        each = F.array(*[F.struct(F.lit(n).alias("model"), m.column().alias("p")) for n, m in linear.items()])
        out = df.select(*keep, F.explode(each).alias("_e")).select("dataset", "_e.model", key, "fold", "y", "_e.p")
    for n, m in fitted.items():
        if n in linear:
            continue
        part = m.predict(df, "_p").select(*keep, F.lit(n).alias("model"), q("_p").alias("p")).select(
            "dataset", "model", key, "fold", "y", "p")
        out = part if out is None else out.unionByName(part)
    return out
