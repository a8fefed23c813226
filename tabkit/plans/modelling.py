"""Comparing models over dataset variants, tuning them, and scoring new rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators.evaluate import predictions
from tabkit.operators.moments import gram_by_fold, pooled, rest_by_fold
from tabkit.operators.ranking import best_models
from tabkit.operators.regress import Linear, boosted_trees
from tabkit.operators.search import (
    best_params, evaluate_kernel_trials, evaluate_ml_trials, evaluate_trials, kernel_of, resume_trials, trial_table,
)
from tabkit.session import discard, settle, store
from tabkit.sources.store import append_trials, read_trials
from tabkit.sources.tables import write_predictions

Variants = Mapping[str, tuple[DataFrame, Sequence[str]]]


def fit_all(
    variants: Variants, specs: Mapping[str, object], label: str, fold: str, key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Every model on every variant: in-sample and held-out predictions, both long.

    All linear models of a variant come from one scan for the fold moments, their predictions from
    one more; other models are fitted once in all and once per fold.
    """
    inside, outside = None, None
    for name, (df, features) in variants.items():
        df = df.filter(q(label).isNotNull())
        linear = {n: s for n, s in specs.items() if isinstance(s, Linear)}
        other = {n: s for n, s in specs.items() if n not in linear}
        grams = gram_by_fold(df, features, label, fold=q(fold))
        total, rest = pooled(list(grams.values())), rest_by_fold(grams)
        fitted = {n: s.from_gram(total, features) for n, s in linear.items()}
        fitted.update({n: s.fit(df, features, label) for n, s in other.items()})
        part = predictions(df, fitted, name, label, key, fold)
        inside = part if inside is None else inside.unionByName(part)

        keep = [F.lit(name).alias("dataset"), q(key), q(fold).alias("fold"), q(label).alias("y")]
        if linear:
            each = []
            for n, s in linear.items():
                e = None
                for f in grams:
                    c = s.from_gram(rest[f], features).column()
                    e = F.when(q(fold) == F.lit(f), c) if e is None else e.when(q(fold) == F.lit(f), c)
                each.append(F.struct(F.lit(n).alias("model"), e.alias("p")))
            held = df.select(*keep, F.explode(F.array(*each)).alias("_e")).select("dataset", "_e.model", key, "fold", "y", "_e.p")
            outside = held if outside is None else outside.unionByName(held)
        for n, s in other.items():
            for f in grams:
                m = s.fit(df.filter(q(fold) != f), features, label)
                held = predictions(df.filter(q(fold) == f), {n: m}, name, label, key, fold)
                outside = held if outside is None else outside.unionByName(held)
    return inside, outside


def tune_linear(
    variants: Variants, spaces: Mapping[str, Mapping], label: str, fold: str, trials: int = 100, log: str | None = None,
    resume: bool = False,
) -> tuple[DataFrame, dict[tuple[str, str], object]]:
    """Search each linear model on each variant: scored trials and the best model refitted on all rows.

    One scan per variant serves all models, trials and folds. With a ``log`` folder the scores are kept
    there; with ``resume`` only trials not in it are scored.
    """
    scores, fitted = None, {}
    for name, (df, features) in variants.items():
        grams = gram_by_fold(df.filter(q(label).isNotNull()), features, label, fold=q(fold))
        total, rest = pooled(list(grams.values())), rest_by_fold(grams)
        for kind, space in spaces.items():
            todo = trial_table(df.sparkSession, space, trials)
            if resume and log is not None:
                todo = resume_trials(read_trials(df.sparkSession, log, name, kind), todo)
            found = settle(evaluate_trials(grams, todo, kind))
            if log is not None:
                append_trials(found, log, name, kind)
                found = read_trials(df.sparkSession, log, name, kind).select("trial_id", "params", "cv_rmse")
            best = best_params(found, ["n_components"])
            fitted[name, kind] = Linear(kind, {**best}).from_gram(total, features)
            part = found.select(F.lit(name).alias("dataset"), F.lit(kind).alias("model"), "trial_id", "params", "cv_rmse")
            scores = part if scores is None else scores.unionByName(part)
    return scores, fitted


def _score_trees(df, features, label, fold, folds, todo):
    return evaluate_ml_trials(df, features, label, fold, todo, lambda p: boosted_trees(**p).estimator, folds)


def _score_kernel(df, features, label, fold, folds, todo):
    return evaluate_kernel_trials(df, features, label, fold, todo, folds)


#: Kinds of model that are not linear: how their trials are scored, and the model of the best parameters.
SEARCHED = {"svr": (_score_kernel, kernel_of), "xgb": (_score_trees, lambda p: boosted_trees(**p))}


def tune_models(
    variants: Variants, spaces: Mapping[str, Mapping], label: str, fold: str, folds: int, trials: int = 50,
    integers: Sequence[str] = ("max_depth", "min_child_weight", "n_estimators"), log: str | None = None, resume: bool = False,
) -> tuple[DataFrame, dict[tuple[str, str], object]]:
    """``tune_linear`` for the kernel model (``svr``) and boosted trees (``xgb``): scored trials and the best model refitted on all rows.

    Kernel trials and folds share their scans; tree trials are fitted side by side. With a ``log`` folder the scores are kept there, and
    with ``resume`` only trials not in it are scored. Rows without a label take no part.
    """
    scores, fitted = None, {}
    for name, (df, features) in variants.items():
        spark = df.sparkSession
        rows = store(df.filter(q(label).isNotNull()).select(*[q(c) for c in dict.fromkeys([*features, label, fold])]))
        for kind, space in spaces.items():
            score, make = SEARCHED[kind]
            todo = trial_table(spark, space, trials)
            if resume and log is not None:
                todo = resume_trials(read_trials(spark, log, name, kind), todo)
            found = score(rows, features, label, fold, folds, todo)
            if log is not None:
                append_trials(found, log, name, kind)
                found = read_trials(spark, log, name, kind).select("trial_id", "params", "cv_rmse")
            fitted[name, kind] = make(best_params(found, integers)).fit(rows, features, label)
            part = found.select(F.lit(name).alias("dataset"), F.lit(kind).alias("model"), "trial_id", "params", "cv_rmse")
            scores = part if scores is None else scores.unionByName(part)
        discard(rows)
    return scores, fitted


def known_scores(scores: DataFrame) -> DataFrame:
    """Best held-out error of every searched model, for ``compare_models(known=...)``."""
    return scores.groupBy("dataset", "model").agg(F.min("cv_rmse").alias("cv_rmse"))


def score_best(
    fitted: Mapping[str, object], comparison: DataFrame, rows: DataFrame, dataset: str, k: int, folder: str,
    key: str = "id", names: tuple[str, str] = ("Id", "SalePrice"),
) -> list[str]:
    """Write back-transformed predictions of the ``k`` best models of a dataset; returns their names."""
    top = [r["model"] for r in best_models(comparison, dataset, k).collect()]
    scored = predictions(rows.withColumn("_y", F.lit(None).cast("double")), {n: fitted[n] for n in top}, dataset, "_y", key)
    write_predictions(scored, folder, key, names)
    return top
