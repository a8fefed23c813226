"""Voting and stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators.moments import gram_by_fold, pooled, rest_by_fold, squared_error
from tabkit.operators.regress import Linear
from tabkit.operators.search import score_trials
from tabkit.session import settle, sized_join, store


def vote(preds: DataFrame, weights: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Weighted mean of member predictions per row; without weights every member counts alike."""
    if weights is None:
        return preds.groupBy("dataset", key).agg(F.avg("p").alias("p"))
    joined = sized_join(preds, settle(weights.select("dataset", "model", "weight")), ["dataset", "model"], "inner")
    return joined.groupBy("dataset", key).agg(
        F.try_divide(F.sum(q("weight") * q("p")), F.sum("weight")).alias("p")
    )


def out_of_fold(
    df: DataFrame, members: Mapping[str, object], features: Sequence[str], label: str, fold: str, keep: Sequence[str] = ("id",)
) -> DataFrame:
    """Each row's predictions by members not trained on its fold: ``(keep, fold, label, member...)``.

    Linear members of all folds come from one scan and are applied in one projection; other members
    are fitted once per fold.
    """
    df = df.filter(q(label).isNotNull())
    linear = {n: m for n, m in members.items() if isinstance(m, Linear)}
    other = {n: m for n, m in members.items() if n not in linear}
    grams = gram_by_fold(df, features, label, fold=q(fold))
    total, rest = pooled(list(grams.values())), rest_by_fold(grams)
    cols = {}
    for n, m in linear.items():
        e = None
        for f in grams:
            fitted = m.from_gram(rest[f], features).column()
            hit = q(fold) == F.lit(f)
            e = F.when(hit, fitted) if e is None else e.when(hit, fitted)
        cols[n] = e
    made = df.withColumns(cols) if cols else df
    if other:
        made = store(made)
        parts = []
        for f in grams:
            rest, part = made.filter(q(fold) != f), made.filter(q(fold) == f)
            for n, m in other.items():
                part = m.fit(rest, features, label).predict(part, n)
            parts.append(part)
        made = parts[0]
        for p in parts[1:]:
            made = made.unionByName(p)
    return made.select(*[q(k) for k in keep], q(fold), q(label), *[q(n) for n in members])


@dataclass(frozen=True)
class FittedStack:
    """Members fitted on all rows under a meta model."""

    members: Mapping[str, object]
    meta: object

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        made = df
        for n, m in self.members.items():
            made = m.predict(made, n)
        return self.meta.predict(made, out).drop(*self.members)


@dataclass(frozen=True)
class Stack:
    """Specification of a stacked model; it can itself be a member or be cross-validated."""

    members: Mapping[str, object]
    meta: object
    use_features: bool = False
    folds: int = 5
    key: str = "id"

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> FittedStack:
        from tabkit.functions.expr import fold_of

        inner = df.withColumn("_fold", fold_of(q(self.key), self.folds, seed=40503))
        carried = list(features) if self.use_features else []
        oof = store(out_of_fold(inner, self.members, features, label, "_fold", keep=[self.key, *carried]))
        meta = self.meta.fit(oof, [*self.members, *carried], label)
        return FittedStack({n: m.fit(df, features, label) for n, m in self.members.items()}, meta)


@dataclass(frozen=True)
class FittedVoter:
    """Members fitted on all rows with their weights."""

    members: Mapping[str, object]
    weights: Mapping[str, float]

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        made = df
        for n, m in self.members.items():
            made = m.predict(made, f"_{n}")
        total = sum(self.weights.values())
        blend = None
        for n, w in self.weights.items():
            term = q(f"_{n}") * F.lit(w / total)
            blend = term if blend is None else blend + term
        return made.withColumn(out, blend).drop(*[f"_{n}" for n in self.members])


@dataclass(frozen=True)
class Voter:
    """Specification of a voting model."""

    members: Mapping[str, object]
    weights: Mapping[str, float] | None = None

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> FittedVoter:
        fitted = {n: m.fit(df, features, label) for n, m in self.members.items()}
        return FittedVoter(fitted, self.weights or {n: 1.0 for n in self.members})


def search_weights(oof: DataFrame, members: Sequence[str], label: str, fold: str, trials: DataFrame) -> DataFrame:
    """Voting weights scored by the error of the blend; members stay as they are.

    One scan gives the prediction moments per fold; each trial is then a quadratic form.
    """
    grams = gram_by_fold(oof, members, label, fold=q(fold))

    def score(p: dict) -> float:
        w = np.array([p[f"voter{i + 1}"] for i in range(len(members))])
        return float(np.sqrt(np.mean([squared_error(g, 0.0, w / w.sum()) for g in grams.values()])))

    return score_trials(trials, score)
