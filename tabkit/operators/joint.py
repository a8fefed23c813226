"""Joint search of ensembles whose members may be of any kind.

Members that are not linear are fitted once for every setting that some trial asks for and every set of folds left out, several at a
time. Their predictions become columns of one stored table: ``of`` a row's own fold left out, and ``of ... and f`` with a second one. From one scan
of it come the moments of features, predictions and label per fold, and every trial, voter or stack, is small algebra on these.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import combinations
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tabkit.functions.expr import q
from tabkit.operators.moments import Moments, gram_by_fold, pooled, squared_error
from tabkit.operators.regress import LINEAR_FITS, fit_ridge
from tabkit.operators.search import _linear_args, score_trials
from tabkit.session import store

Makers = Mapping[str, Callable[[dict], object]]


def member_params(params: Mapping[str, float], member: str) -> dict[str, float]:
    """The parameters of one member, named ``<param>_<member>`` in a trial."""
    end = f"_{member}"
    return {n[: -len(end)]: v for n, v in params.items() if n.endswith(end) and not n.endswith("_meta")}


def setting(member: str, params: Mapping[str, float]) -> str:
    """Name of a member under its parameters: trials that agree in them share its fits."""
    return member + "".join(f" {n}={params[n]:.12g}" for n in sorted(params))


def fitted_columns(
    df: DataFrame, features: Sequence[str], label: str, fold: str, specs: Mapping[str, object], folds: Sequence[int],
    nested: bool = True, parallelism: int = 4,
) -> tuple[DataFrame, list[str]]:
    """A stored table ``features, fold, label, p...`` and its prediction columns: per spec one of the own fold left out and, when
    ``nested``, one per further fold left out (the own fold's column again where it is the own one)."""
    sets = [(f,) for f in folds] + (list(combinations(folds, 2)) if nested else [])
    todo = [(n, s) for n in specs for s in sets]

    def fit(at: tuple[str, tuple]):
        return specs[at[0]].fit(df.filter(~q(fold).isin(list(at[1]))), features, label)

    with ThreadPool(parallelism) as pool:
        models = dict(zip(todo, pool.map(inheritable_thread_target(df.sparkSession)(fit), todo, 1)))
    columns = [f"p{i} {x}" for i in range(len(specs)) for x in ("", *(folds if nested else ()))]
    made = None
    for f in folds:
        part = df.filter(q(fold) == f).select(*[q(c) for c in features], q(fold), q(label))
        for i, n in enumerate(specs):
            part = models[n, (f,)].predict(part, f"p{i} ")
            for g in folds if nested else ():
                part = part.withColumn(f"p{i} {g}", q(f"p{i} ")) if g == f else models[n, tuple(sorted((f, g)))].predict(part, f"p{i} {g}")
        part = part.select(*[q(c) for c in (*features, fold, label, *columns)])
        made = part if made is None else made.unionByName(part)
    return store(made), columns


class Folds:
    """Moments per fold of features, prediction columns and label, and the blends of members they can judge."""

    def __init__(self, moments: Mapping[int, Moments], features: int, places: Mapping[str, int], nested: bool):
        self.moments, self.d, self.places, self.nested = dict(moments), features, dict(places), nested
        self.folds = sorted(self.moments)
        self.width = len(self.moments[self.folds[0]].mean) - 1
        self.held: dict[tuple, tuple[float, np.ndarray]] = {}

    def member(self, kind: str, params: Mapping[str, float], out: tuple[int, ...]) -> tuple[float, np.ndarray]:
        """Constant and weights over features and columns of a member fitted without the folds ``out``.

        The first of ``out`` is the fold whose rows are predicted.
        """
        w = np.zeros(self.width)
        name = setting(kind, params)
        if name in self.places:
            step = 1 + (len(self.folds) if self.nested else 0)
            w[self.d + self.places[name] * step + (1 + self.folds.index(out[1]) if len(out) > 1 else 0)] = 1.0
            return 0.0, w
        key = (name, frozenset(out))
        if key not in self.held:
            rest = pooled([m for f, m in self.moments.items() if f not in out]).columns([*range(self.d), self.width])
            self.held[key] = LINEAR_FITS[kind](rest, **_linear_args(kind, params))
        w[: self.d] = self.held[key][1]
        return self.held[key][0], w

    def error(self, members: Mapping[str, Mapping[str, float]], blend: Callable[[int, Sequence], tuple[float, np.ndarray]]) -> float:
        errors = []
        for f, m in self.moments.items():
            parts = [self.member(k, p, (f,)) for k, p in members.items()]
            b, v = blend(f, parts)
            errors.append(squared_error(m, b + sum(x * c for x, (c, _) in zip(v, parts)), np.sum([x * w for x, (_, w) in zip(v, parts)], axis=0)))
        return float(np.sqrt(np.mean(errors)))

    def voter(self, members: Mapping[str, Mapping[str, float]], weights: Sequence[float]) -> float:
        v = np.array(weights, float)
        return self.error(members, lambda f, parts: (0.0, v / v.sum()))

    def stack(self, members: Mapping[str, Mapping[str, float]], alpha: float) -> float:
        """A ridge over the members' predictions, trained for each fold on what is out of a second fold too."""
        def meta(f: int, _) -> tuple[float, np.ndarray]:
            inner = []
            for g in self.folds:
                if g != f:
                    parts = [self.member(k, p, (g, f)) for k, p in members.items()]
                    label = np.eye(self.width + 1)[:, -1]
                    basis = np.column_stack([*[np.append(w, 0.0) for _, w in parts], label])
                    inner.append(self.moments[g].mapped(np.array([*[b for b, _ in parts], 0.0]), basis))
            return fit_ridge(pooled(inner), alpha)

        return self.error(members, meta)


def search_joint(
    df: DataFrame, features: Sequence[str], label: str, fold: str, trials: DataFrame, members: Sequence[str], makers: Makers,
    how: str = "voter", parallelism: int = 4,
) -> DataFrame:
    """Members of any kind and their weights (``voter``) or meta penalty (``stack``) scored together: ``trial_id, params, cv_rmse``.

    A member is a linear kind or a name in ``makers``, which gives the model of its parameters. Parameters are named ``<param>_<member>``,
    ``voter1..`` and ``alpha_ridge_meta``. A setting is fitted once however many trials ask for it.
    """
    if how not in ("voter", "stack"):
        raise ValueError(f"unknown ensemble {how}")
    unknown = [m for m in members if m not in makers and m not in LINEAR_FITS]
    if unknown:
        raise ValueError("no such member: " + ", ".join(unknown))
    df = store(df.filter(q(label).isNotNull()).select(*[q(c) for c in features], q(fold), q(label)))
    folds = sorted(r[0] for r in df.select(q(fold)).distinct().collect())
    asked = [r["params"] for r in trials.select("params").collect()]
    specs = {}
    for p in asked:
        for m in members:
            if m in makers:
                own = member_params(p, m)
                specs.setdefault(setting(m, own), makers[m](own))
    nested = how == "stack"
    table, columns = fitted_columns(df, features, label, fold, specs, folds, nested, parallelism) if specs else (df, [])
    found = gram_by_fold(table, [*features, *columns], label, fold=q(fold))
    held = Folds(found, len(features), {n: i for i, n in enumerate(specs)}, nested)

    def score(p: dict) -> float:
        own = {m: member_params(p, m) for m in members}
        if how == "stack":
            return held.stack(own, p.get("alpha_ridge_meta", 1.0))
        return held.voter(own, [p.get(f"voter{i + 1}", 1.0) for i in range(len(members))])

    return score_trials(trials, score)
