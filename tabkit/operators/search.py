"""Hyper-parameter search: hashed trial points, scoring from fold moments, resuming, choosing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tabkit.functions.expr import HASH_MULTIPLIERS, hash_uniform, q
from tabkit.operators.moments import Moments, held_out_rmse, pooled, rest_by_fold, squared_error
from tabkit.operators.regress import LINEAR_FITS, fit_ridge
from tabkit.operators.robust import RobustKernel, fit_robust
from tabkit.session import discard, settle, sized_join, store

Space = Mapping[str, tuple]

MANY_ROWS, PART = 2_000_000, 1 / 32  # rows from which a kernel search begins at the fits of a part, and that part
TRIAL_SCHEMA = "trial_id bigint, params map<string,double>, cv_rmse double"


def trial_points(ids: DataFrame, space: Space, id_col: str = "trial_id") -> DataFrame:
    """One point of the space for every id: ``(trial_id, params MAP)``.

    A range is ``('uniform', low, high)``, ``('loguniform', log low, log high)`` or
    ``('quniform', low, high, step)``. Each dimension has its own hash multiplier.
    """
    entries = []
    for dim, (name, (kind, low, high, *step)) in enumerate(space.items()):
        multiplier = HASH_MULTIPLIERS[dim] if dim < len(HASH_MULTIPLIERS) else 2 * (7919 + 4001 * dim) + 1
        x = F.lit(float(low)) + hash_uniform(q(id_col), multiplier) * F.lit(float(high - low))
        if kind == "loguniform":
            x = F.exp(x)
        elif kind == "quniform":
            x = F.round(x / F.lit(float(step[0]))) * F.lit(float(step[0]))
        elif kind != "uniform":
            raise ValueError(f"unknown range {kind}")
        entries += [F.lit(name), x]
    return ids.select(q(id_col).cast("bigint").alias("trial_id"), F.create_map(*entries).alias("params"))


def trial_table(spark: SparkSession, space: Space, n: int) -> DataFrame:
    """``n`` points of a search space."""
    return trial_points(spark.range(1, n + 1).withColumnRenamed("id", "trial_id"), space)


def score_trials(trials: DataFrame, score: Callable[[dict], float]) -> DataFrame:
    """Score each trial in the task that holds it; ``score`` carries only small matrices."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({
                "trial_id": pdf["trial_id"],
                "params": pdf["params"],
                "cv_rmse": [score(dict(p)) for p in pdf["params"]],
            })

    return trials.mapInPandas(run, TRIAL_SCHEMA)


def _linear_args(kind: str, params: Mapping[str, float]) -> dict:
    names = {"ridge": ("alpha",), "bridge": ("alpha_1", "alpha_2", "lambda_1", "lambda_2"), "pls": ("n_components",), "lasso": ("alpha",)}[kind]
    return {k: (int(v) if k == "n_components" else v) for k, v in params.items() if k in names}


def evaluate_trials(grams: dict[int, Moments], trials: DataFrame, kind: str) -> DataFrame:
    """Held-out error of a linear model for every trial, from the fold moments of one scan."""
    fit = LINEAR_FITS[kind]
    return score_trials(trials, lambda p: held_out_rmse(grams, lambda g: fit(g, **_linear_args(kind, p))))


def evaluate_ml_trials(
    df: DataFrame, features: Sequence[str], label: str, fold: str, trials: DataFrame,
    make: Callable[[dict], object], folds: int, parallelism: int = 4,
) -> DataFrame:
    """Held-out error of Spark ML models by cross validation on a given fold column.

    Every setting is one distributed fit per fold over the whole table, ``parallelism`` of them at a time, shared by the trials that
    ask for it; nothing is fitted on all folds. ``folds`` is the number of values of the fold column.
    """
    spark = df.sparkSession
    rows = settle(
        VectorAssembler(inputCols=list(features), outputCol="features")
        .transform(df.filter(q(label).isNotNull())).select(
            "features", q(label).cast("double").alias("label"), q(fold).cast("int").alias("fold"))
    )
    asked = trials.orderBy("trial_id").collect()
    settings = list({tuple(sorted(t["params"].items())): t["params"] for t in asked}.values())
    judge = RegressionEvaluator(metricName="mse")

    def error(at: tuple[int, int]) -> float:
        model = make(settings[at[0]]).fit(rows.filter(q("fold") != at[1]))
        return judge.evaluate(model.transform(rows.filter(q("fold") == at[1])))

    with ThreadPool(parallelism) as pool:
        errors = pool.map(inheritable_thread_target(spark)(error), [(i, f) for i in range(len(settings)) for f in range(folds)], 1)
    # the mean over folds of fold mean squared errors, then the root
    found = np.sqrt(np.array(errors).reshape(len(settings), folds).mean(1))
    of = {tuple(sorted(p.items())): float(e) for p, e in zip(settings, found)}
    return spark.createDataFrame([(t["trial_id"], t["params"], of[tuple(sorted(t["params"].items()))]) for t in asked], TRIAL_SCHEMA)


def kernel_of(params: Mapping[str, float], width: int = 64, seed: int = 27) -> RobustKernel:
    """The robust kernel model of a trial's ``gamma, C, epsilon``."""
    return RobustKernel(params["gamma"], params["C"], params["epsilon"], width, seed)


def evaluate_kernel_trials(
    df: DataFrame, features: Sequence[str], label: str, fold: str, trials: DataFrame, folds: int, width: int = 64, seed: int = 27
) -> DataFrame:
    """Held-out error of the robust kernel model for every trial: all trials and folds share each scan of the rows.

    Trials of one setting are fitted once. A fold without rows does not count. Fits of large tables begin at those of a part of the rows,
    which saves scans; they end where all rows say.
    """
    asked = trials.orderBy("trial_id").collect()
    specs = [kernel_of(t["params"], width, seed) for t in asked]
    distinct = list(dict.fromkeys(specs))
    rows = store(df.select(*[q(f).cast("double").alias(f) for f in features], q(label).cast("double").alias(label), q(fold).cast("int").alias(fold)).na.drop())
    cores = df.sparkSession.sparkContext.defaultParallelism
    # a round costs far more than moving a table of so few files
    spread = lambda t: t.repartition(cores) if t.rdd.getNumPartitions() < cores else t
    part = store(rows.sample(PART, seed)) if rows.count() >= MANY_ROWS else None
    fits = fit_robust(spread(rows), features, label, distinct, q(fold), range(folds), part=part if part is None else spread(part))
    discard(rows, *[part] if part is not None else [])
    errors: dict[int, list[float]] = {}
    for (i, _), fit in fits.items():
        if fit.error is not None:
            errors.setdefault(i, []).append(fit.error)
    found = {s: float(np.sqrt(np.mean(errors[i]))) if i in errors else None for i, s in enumerate(distinct)}
    return df.sparkSession.createDataFrame([(t["trial_id"], t["params"], found[s]) for t, s in zip(asked, specs)], TRIAL_SCHEMA)


def best_trial(trials: DataFrame, integers: Sequence[str] = ()) -> DataFrame:
    """Parameters of least error as rows ``(trial_id, cv_rmse, name, value)``, integer ones truncated."""
    best = trials.agg(F.min_by(F.struct("trial_id", "cv_rmse", "params"), F.struct("cv_rmse", "trial_id")).alias("_b"))
    rows = best.select("_b.trial_id", "_b.cv_rmse", F.explode("_b.params").alias("name", "value"))
    whole = F.when(q("value") >= 0, F.floor("value")).otherwise(F.ceil("value")).cast("double")
    return rows.withColumn("value", F.when(q("name").isin(list(integers)), whole).otherwise(q("value")))


def best_params(trials: DataFrame, integers: Sequence[str] = ()) -> dict[str, float]:
    """Parameters of least error on the driver (one number per parameter)."""
    return {
        r["name"]: int(r["value"]) if r["name"] in integers else r["value"]
        for r in best_trial(trials, integers).collect()
    }


def resume_trials(log: DataFrame, trials: DataFrame) -> DataFrame:
    """Trials not yet in the log."""
    return trials.join(log.select("trial_id"), "trial_id", "left_anti")


def narrow_space(scored: DataFrame, space: Space, share: float = 0.1) -> dict[str, tuple]:
    """The space shrunk to the range its best trials cover, for a second round."""
    total = scored.count()
    best = scored.orderBy("cv_rmse", "trial_id").limit(max(2, int(total * share)))
    got = best.select(F.explode("params").alias("name", "value")).groupBy("name").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    found = {r["name"]: (r["lo"], r["hi"]) for r in got}
    out = {}
    for name, (kind, low, high, *step) in space.items():
        lo, hi = found.get(name, (low, high))
        if kind == "loguniform" and name in found:
            lo, hi = float(np.log(lo)), float(np.log(hi))
        out[name] = (kind, lo, hi, *step)
    return out


def split_params(flat: DataFrame) -> DataFrame:
    """Route ``(trial, name, value)`` by suffix to ``(trial, level, member, param, value)``.

    ``_meta`` marks the second level, ``_ridge | _svr | _xgb`` the member; ``voterN`` is a weight.
    """
    member = "_(ridge|svr|xgb)$"
    base = F.regexp_replace("name", "_meta$", "")
    return flat.select(
        "trial", F.when(q("name").endswith("_meta"), "meta").otherwise("base").alias("level"),
        F.when(base.startswith("voter"), "weights").otherwise(F.regexp_extract(base, member, 1)).alias("member"),
        F.regexp_replace(base, member, "").alias("param"), "value",
    )


def normalise_weights(weights: DataFrame, by: Sequence[str], col: str = "weight") -> DataFrame:
    """Weights divided by their sum within each ensemble."""
    total = settle(weights.groupBy(*[q(b) for b in by]).agg(F.sum(q(col)).alias("_t")))
    return sized_join(weights, total, list(by), "inner").withColumn(col, F.try_divide(q(col), q("_t"))).drop("_t")


# --- joint search of ensembles of linear members -------------------------------------------------


def _members(params: Mapping[str, float], kinds: Sequence[str]) -> dict[str, dict]:
    return {
        k: _linear_args(k, {n[: -len(k) - 1]: v for n, v in params.items() if n.endswith(f"_{k}")}) for k in kinds
    }


def _stacked(parts: Mapping[int, Moments], kinds, args, alpha: float):
    """Linear model equal to a ridge stack of linear members, all from the moments of the folds ``parts``."""
    meta = []
    for f, rest in rest_by_fold(parts).items():
        fits = [LINEAR_FITS[k](rest, **args[k]) for k in kinds]
        label = np.eye(len(rest.mean))[:, -1]
        basis = np.column_stack([*[np.append(w, 0.0) for _, w in fits], label])
        meta.append(parts[f].mapped(np.array([*[b for b, _ in fits], 0.0]), basis))
    b0, v = fit_ridge(pooled(meta), alpha)
    fits = [LINEAR_FITS[k](pooled(list(parts.values())), **args[k]) for k in kinds]
    return b0 + sum(x * b for x, (b, _) in zip(v, fits)), np.sum([x * w for x, (_, w) in zip(v, fits)], axis=0)


def search_ensemble(
    grams: dict[int, Moments], trials: DataFrame, members: Sequence[str] = ("ridge", "pls"), how: str = "voter"
) -> DataFrame:
    """Members and weights (voter) or members and meta penalty (stack) scored together.

    A blend of linear members is linear, so each trial, inner folds included, needs nothing but the
    fold moments: the whole joint search is one scan of the data. Parameters are named
    ``<param>_<member>``, ``voter1..`` and ``alpha_ridge_meta``.
    """
    kinds = list(members)

    def score(p: dict) -> float:
        args = _members({n: v for n, v in p.items() if not n.endswith("_meta")}, kinds)
        errors, others = [], rest_by_fold(grams)
        for f, g in grams.items():
            rest = others[f]
            if how == "stack":
                b, w = _stacked({k: x for k, x in grams.items() if k != f}, kinds, args, p.get("alpha_ridge_meta", 1.0))
            else:
                v = np.array([p.get(f"voter{i + 1}", 1.0) for i in range(len(kinds))])
                v = v / v.sum()
                fits = [LINEAR_FITS[k](rest, **args[k]) for k in kinds]
                b = float(sum(x * c for x, (c, _) in zip(v, fits)))
                w = np.sum([x * c for x, (_, c) in zip(v, fits)], axis=0)
            errors.append(squared_error(g, b, w))
        return float(np.sqrt(np.mean(errors)))

    return score_trials(trials, score)
