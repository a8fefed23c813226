"""Invariants and closed forms of the fitted operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabkit.functions.expr import fold_of, q
from tabkit.operators.depend import correlations, kendall, spearman
from tabkit.operators.ensemble import Stack, Voter, out_of_fold
from tabkit.operators import impute, robust, search
from tabkit.operators.impute import impute_categorical, impute_categoricals, impute_chained, match_donors
from tabkit.operators.joint import search_joint
from tabkit.operators.moments import centred_moments, gram_by_fold, held_out_rmse, moments_by_weight, pooled, rest_by_fold
from tabkit.operators.regress import (
    KernelRobust, Linear, SparkML, boosted_trees, fit_bayesian_ridge, fit_lasso, fit_pls, fit_ridge, knn_regress, lasso, lasso_path, random_tree, tree,
)
from tabkit.operators.roles import Roles
from tabkit.operators.robust import RobustKernel, consistency, fit_robust
from tabkit.operators.search import best_params, evaluate_kernel_trials, evaluate_trials, kernel_of, narrow_space, resume_trials, search_ensemble, trial_table
from tabkit.plans import housing
from tabkit.plans.modelling import known_scores, score_best, tune_linear, tune_models
from tabkit.sources.store import append_trials, load_models, read_trials, save_models

WIDE = [f"f{i}" for i in range(15)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 15))
    y = x[:, 0] * 2 - x[:, 3] + 0.5 * x[:, 0] * x[:, 1] + rng.normal(scale=0.3, size=600) + 4
    pdf = pd.DataFrame(x, columns=WIDE).assign(id=np.arange(1, 601), y=y)
    df = spark.createDataFrame(pdf).withColumn("fold", fold_of(q("id"), 5)).repartition(5).cache()
    return df, pdf


def test_moments_two_ways(data):
    df, pdf = data
    wide = gram_by_fold(df, WIDE, "y", fold=q("fold"))
    narrow = gram_by_fold(df, WIDE[:4], "y", fold=q("fold"))
    for f in narrow:
        part = wide[f].columns([0, 1, 2, 3, 15])
        assert part.n == narrow[f].n and np.allclose(part.mean, narrow[f].mean) and np.allclose(part.c, narrow[f].c)
    full = pdf[[*WIDE, "y"]].to_numpy()
    every = pooled(list(wide.values()))
    assert every.n == 600 and np.allclose(every.mean, full.mean(0)) and np.allclose(every.c, 600 * np.cov(full.T, bias=True))
    rest = rest_by_fold(wide)
    for f, m in wide.items():
        assert np.allclose((rest[f] + m).c, every.c) and rest[f].n + m.n == 600


def test_moments_far_from_zero_keep_their_digits(spark):
    rng = np.random.default_rng(9)
    years, y = 1971 + rng.integers(0, 40, 5000), rng.normal(size=5000)
    for shift in (0, 10**9):
        df = spark.createDataFrame(pd.DataFrame({"x": (years + shift).astype(float), "y": y + shift, "k": np.arange(5000) % 7}))
        m = gram_by_fold(df, ["x"], "y")[0]
        expected = np.cov(np.stack([years, y]), bias=True) * 5000
        assert np.allclose(m.c, expected, rtol=1e-10 if not shift else 1e-6)
        native = {(r["a"], r["b"]): r["value"] for r in centred_moments(df.withColumn("fold", F.lit(0)), ["x"], "y", "fold").collect()}
        assert native["x", "x"] == pytest.approx(expected[0, 0], rel=1e-10 if not shift else 1e-6)


def test_moments_of_many_weightings_in_one_scan(data):
    df, pdf = data
    weights = [F.lit(1), q("id") % 3, F.when(q("id") > 300, 2).otherwise(0)]
    got = moments_by_weight(df, ["f0", "y"], weights)
    for i, w in enumerate([np.ones(600), (pdf["id"] % 3).to_numpy(), np.where(pdf["id"] > 300, 2, 0)]):
        m = got[0, i]
        assert m.n == w.sum() and np.allclose(m.mean, np.average(pdf[["f0", "y"]], axis=0, weights=w))
        assert np.allclose(m.c, np.cov(pdf[["f0", "y"]].T, aweights=w, bias=True) * w.sum())


def test_lasso_meets_the_conditions_of_the_optimum(data):
    df, pdf = data
    m = gram_by_fold(df, WIDE, "y")[0]
    x = (pdf[WIDE] - pdf[WIDE].mean()).to_numpy()
    sd = x.std(0)
    for alpha, (b, w) in zip((0.5, 0.01, 0.1), lasso_path(m, [0.5, 0.01, 0.1])):
        left = pdf["y"].to_numpy() - b - pdf[WIDE].to_numpy() @ w
        slope = (x / sd).T @ left / 600
        on = w != 0
        assert np.allclose(slope[on], alpha * np.sign(w[on])) and (np.abs(slope[~on]) <= alpha + 1e-9).all()
        assert np.allclose(w, fit_lasso(m, alpha)[1], atol=1e-9)
    assert (fit_lasso(m, 0.5)[1] != 0).sum() < 15
    constant = gram_by_fold(df.withColumn("k", F.lit(3.0)), ["k", "f0"], "y")[0]
    assert fit_lasso(constant, 0.01)[1][0] == 0


def test_ridge_agrees_with_spark_ml(data):
    df, pdf = data
    b, w = fit_ridge(gram_by_fold(df, WIDE, "y")[0], 3.0)
    scale = 3.0 * pdf["y"].std() / len(pdf)
    ml = SparkML(LinearRegression(elasticNetParam=0.0, standardization=False, regParam=float(scale), solver="normal")).fit(df, WIDE, "y")
    # Spark scales the label by its sample deviation before applying the penalty
    assert np.allclose(ml.model.coefficients.toArray(), w, atol=2e-3) and abs(ml.model.intercept - b) < 2e-3


def test_bayesian_ridge_is_a_ridge(data):
    df, pdf = data
    g = gram_by_fold(df, WIDE, "y")[0]
    _, w = fit_bayesian_ridge(g)
    x = pdf[WIDE].to_numpy() - pdf[WIDE].to_numpy().mean(0)
    y = pdf["y"].to_numpy() - pdf["y"].mean()
    # the implied penalty solves the normal equations
    implied = (x.T @ y - x.T @ x @ w) / w
    assert implied.std() / implied.mean() < 1e-6 and implied.mean() > 0


def test_pls_of_full_rank_is_least_squares(data):
    df, _ = data
    g = gram_by_fold(df, WIDE, "y")[0]
    b, w = fit_pls(g, 15)
    b0, w0 = fit_ridge(g, 0.0)
    assert np.allclose(w, w0, atol=1e-6) and abs(b - b0) < 1e-6


def test_held_out_error_equals_refitting(data):
    df, pdf = data
    grams = gram_by_fold(df, WIDE, "y", fold=q("fold"))
    quick = held_out_rmse(grams, lambda g: fit_ridge(g, 1.0))
    oof = out_of_fold(df, {"a": Linear("ridge", {"alpha": 1.0})}, WIDE, "y", "fold")
    slow = np.sqrt(oof.groupBy("fold").agg(F.avg((q("y") - q("a")) ** 2).alias("m")).toPandas()["m"].mean())
    assert quick == pytest.approx(slow)


def test_every_regressor_beats_the_mean(data):
    df, pdf = data
    specs = [Linear("ridge"), Linear("bridge"), Linear("pls", {"n_components": 3}), lasso(0.01), tree(4), random_tree(5),
             boosted_trees(3, 10), KernelRobust(gamma=0.02, width=64), Voter({"a": Linear(), "b": tree(3)}),
             Stack({"a": Linear(), "b": tree(3)}, Linear())]
    for spec in specs:
        got = spec.fit(df, WIDE, "y").predict(df).select("id", "y", "prediction").toPandas()
        assert len(got) == 600 and np.sqrt(((got["y"] - got["prediction"]) ** 2).mean()) < 0.8 * pdf["y"].std(), spec


def test_models_survive_storage(data, spark, tmp_path):
    df, _ = data
    fitted = {"ridge": Linear().fit(df, WIDE, "y"), "tree": tree(3).fit(df, WIDE, "y")}
    save_models(spark, fitted, str(tmp_path / "m"))
    for name, m in load_models(spark, str(tmp_path / "m")).items():
        a = fitted[name].predict(df).agg(F.sum("prediction")).first()[0]
        assert m.predict(df).agg(F.sum("prediction")).first()[0] == pytest.approx(a)


def robust_by_hand(spec, x, y, rounds=400):
    """Huber's second proposal by reweighting, on all rows at once."""
    z = spec.waves(x)
    w, scale = np.ones(len(y)), None
    for _ in range(rounds):
        mz, my = w @ z / w.sum(), w @ y / w.sum()
        zc = (z - mz) * w[:, None]
        coef = np.linalg.solve(zc.T @ (z - mz) + np.eye(spec.width) / spec.c, zc.T @ (y - my))
        b = my - mz @ coef
        r = np.abs(y - z @ coef - b)
        if scale is None:
            scale = np.sqrt((r**2).mean())
        else:
            scale = np.sqrt((np.minimum(before, spec.epsilon * scale) ** 2).mean() / consistency(spec.epsilon))
        before = r
        w = np.minimum(1.0, spec.epsilon * scale / np.maximum(r, 1e-300))
    return b, coef


def test_robust_kernel_by_hand(data, spark):
    df, pdf = data
    x, y, fold = pdf[WIDE[:3]].to_numpy(), pdf["y"].to_numpy().copy(), np.array([r[0] for r in df.orderBy("id").select("fold").collect()])
    y[::20] += 30
    spoiled = df.withColumn("y", F.when(q("id") % 20 == 1, q("y") + 30).otherwise(q("y"))).unionByName(df.limit(3).withColumn("y", F.lit(None).cast("double")))
    specs = [RobustKernel(0.05, 10.0, 1.35, 20), RobustKernel(0.2, 100.0, 2.5, 12)]
    fits = fit_robust(spoiled, WIDE[:3], "y", specs, q("fold"), range(5), rounds=200)
    assert len(fits) == 10
    for (i, f), fit in fits.items():
        b, coef = robust_by_hand(specs[i], x[fold != f], y[fold != f])
        held = specs[i].waves(x[fold == f])
        assert np.allclose(held @ fit.coef + fit.intercept, held @ coef + b, atol=1e-3)
        assert fit.error == pytest.approx(np.mean((y[fold == f] - held @ coef - b) ** 2), rel=1e-3)
    # few wild labels hardly move it
    got = specs[0].fit(spoiled, WIDE[:3], "y").predict(df).select("y", "prediction").toPandas()
    assert np.median(np.abs(got["y"] - got["prediction"])) < 0.8


def test_robust_kernel_needs_few_scans(data, spark):
    """Few wild labels, and half of them heavy-tailed: every scan is one round of all fits."""
    df, pdf = data
    x, plain = pdf[WIDE[:3]].to_numpy(), pdf["y"].to_numpy()
    rng = np.random.default_rng(3)
    wild, heavy = plain.copy(), plain + rng.standard_cauchy(len(plain)) * (np.arange(len(plain)) % 2)
    wild[::20] += 30
    specs = [RobustKernel(0.05, 10.0, 1.35, 20), RobustKernel(3.0, 100.0, 1.01, 20), RobustKernel(0.2, 0.01, 2.5, 12)]
    for y in (wild, heavy):
        rows = spark.createDataFrame(pd.DataFrame(x, columns=WIDE[:3]).assign(y=y))
        for (i, _), fit in fit_robust(rows, WIDE[:3], "y", specs, rounds=200).items():
            b, coef = robust_by_hand(specs[i], x, y, 3000)
            assert np.allclose(specs[i].waves(x) @ (fit.coef - coef) + fit.intercept - b, 0.0, atol=1e-5)
            assert fit.rounds <= 12 and fit.error is None


def heavy_rows(spark, n=4000):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, 3))
    y = 11 + x[:, 0] * 2 - x[:, 1] * x[:, 2] + rng.normal(size=n) + rng.standard_cauchy(n) * (np.arange(n) % 3 == 0)
    return spark.createDataFrame(pd.DataFrame(x, columns=WIDE[:3]).assign(id=np.arange(n), y=y, fold=np.arange(n) % 5)).repartition(4).cache(), x, y


def test_waves_are_cosines():
    x = np.random.default_rng(2).normal(size=(500, 3)) * 5
    for spec in (RobustKernel(gamma=g, width=40) for g in (0.0, 1e-3, 100.0)):
        rng = np.random.default_rng(spec.seed)
        frequency, shift = rng.normal(0.0, np.sqrt(2 * spec.gamma), (3, 40)), rng.uniform(0.0, 2 * np.pi, 40)
        assert np.allclose(spec.waves(x), np.sqrt(2 / 40) * np.cos(x @ frequency + shift), rtol=0.0, atol=1e-13)


def test_robust_fits_begin_at_those_of_a_part(spark, monkeypatch):
    """Few scans of all rows follow, each row counts in them, and the fits are those without a part, whatever the part says."""
    df, x, _ = heavy_rows(spark)
    specs = [RobustKernel(0.05, 10.0, 1.35, 20), RobustKernel(0.5, 0.1, 1.05, 12), RobustKernel(0.2, 100.0, 2.5, 12)]
    args = df, WIDE[:3], "y", specs, q("fold"), range(5)
    plain, scans, counted = fit_robust(*args), [], []
    scan, starts = robust._scan, robust._starts

    def spied(rows, *rest):
        out = scan(rows, *rest)
        scans.append(len(rest[2]))
        counted.extend(m.n for m in out[1].values())
        return out

    monkeypatch.setattr(robust, "_scan", spied)
    monkeypatch.setattr(robust, "_starts", lambda rows, *rest: scans.clear() or starts(rows, *rest))
    parts = {
        "good": df.filter("id % 4 = 1"), "empty": df.filter("id < 0"), "one fold": df.filter("fold = 2"), "no spread": df.filter("id % 4 = 1").withColumn("y", F.lit(3.0)),
        "far": df.filter("id % 4 = 1").withColumn("y", q("y") * 1000 - 9), "narrow": df.filter("id % 4 = 1").withColumn("y", q("y") / 1000 + 11),
        "other": df.filter("id % 4 = 1").withColumn("y", -q("y") + 22),
    }
    for name, part in parts.items():
        counted.clear()
        fits = fit_robust(*args, part=part)
        assert fits.keys() == plain.keys()
        for key, fit in fits.items():
            z = specs[key[0]].waves(x)
            assert np.allclose(z @ (fit.coef - plain[key].coef) + fit.intercept - plain[key].intercept, 0.0, atol=2e-5), name
            assert fit.error == pytest.approx(plain[key].error, rel=1e-5) and fit.rounds <= 20
        if name not in ("empty", "one fold"):
            assert counted == [3200.0] * 15
        if name == "good":
            assert max(f.rounds for f in fits.values()) < 1 + max(f.rounds for f in plain.values())


def test_large_kernel_search_begins_at_a_part(spark, monkeypatch):
    df, _, _ = heavy_rows(spark)
    trials = trial_table(spark, housing.SPACES["svr"], 3)
    scores = lambda: [r["cv_rmse"] for r in evaluate_kernel_trials(df, WIDE[:3], "y", "fold", trials, 5, width=12).orderBy("trial_id").collect()]
    small, sizes, starts = scores(), [], robust._starts
    monkeypatch.setattr(robust, "_starts", lambda rows, *rest: sizes.append(rows.count()) or starts(rows, *rest))
    monkeypatch.setattr(search, "MANY_ROWS", 4000)
    monkeypatch.setattr(search, "PART", 0.25)
    assert scores() == pytest.approx(small, rel=1e-6)
    assert len(sizes) == 1 and 800 < sizes[0] < 1200


def test_kernel_trials_and_storage(data, spark, tmp_path):
    df, _ = data
    trials = trial_table(spark, housing.SPACES["svr"], 4)
    some = trials.unionByName(trials.filter("trial_id = 1").withColumn("trial_id", F.lit(9).cast("bigint")))
    got = {r["trial_id"]: r["cv_rmse"] for r in evaluate_kernel_trials(df, WIDE, "y", "fold", some, 5, width=16).collect()}
    assert sorted(got) == [1, 2, 3, 4, 9] and got[1] == got[9]
    one = kernel_of(trials.first()["params"], 16)
    outside = [((r["y"] - r["prediction"]) ** 2, r["fold"]) for f in range(5)
               for r in one.fit(df.filter(q("fold") != f), WIDE, "y").predict(df.filter(q("fold") == f)).collect()]
    assert got[1] == pytest.approx(np.sqrt(np.mean([np.mean([e for e, f in outside if f == k]) for k in range(5)])), rel=1e-6)
    fitted = one.fit(df, WIDE, "y")
    save_models(spark, {"svr": fitted}, str(tmp_path / "m"))
    gap = df.limit(1).withColumn(WIDE[0], F.lit(None).cast("double"))
    assert load_models(spark, str(tmp_path / "m"))["svr"] == fitted and fitted.predict(gap).first()["prediction"] is None
    with pytest.raises(ValueError, match="epsilon"):
        RobustKernel(epsilon=1.0)


def test_tuning_of_kernels_and_trees(data, spark, tmp_path):
    df, _ = data
    log = str(tmp_path / "log")
    few = {"svr": housing.SPACES["svr"], "xgb": {"max_depth": ("quniform", 1, 2, 1), "n_estimators": ("quniform", 2, 4, 2)}}
    tune_models({"v": (df, WIDE)}, {"svr": few["svr"]}, "y", "fold", 5, trials=2, log=log)
    scores, fitted = tune_models({"v": (df, WIDE)}, few, "y", "fold", 5, trials=3, log=log, resume=True)
    assert sorted((r["model"], r["trial_id"]) for r in scores.collect()) == [(m, i) for m in ("svr", "xgb") for i in (1, 2, 3)]
    assert set(fitted) == {("v", "svr"), ("v", "xgb")}
    assert all(m.predict(df).filter("prediction is null").count() == 0 for m in fitted.values())


def test_search_resume_and_narrow(data, spark, tmp_path):
    df, _ = data
    grams = gram_by_fold(df, WIDE, "y", fold=q("fold"))
    space = {"alpha": ("loguniform", -6.9, 4.6)}
    first = evaluate_trials(grams, trial_table(spark, space, 20), "ridge")
    append_trials(first, str(tmp_path / "log"), "d", "ridge")
    log = read_trials(spark, str(tmp_path / "log"), "d", "ridge")
    rest = resume_trials(log, trial_table(spark, space, 30))
    assert sorted(r["trial_id"] for r in rest.collect()) == list(range(21, 31))
    kind, lo, hi = narrow_space(log, space)["alpha"]
    assert kind == "loguniform" and -6.9 <= lo < hi <= 4.6
    best = best_params(log)["alpha"]
    assert log.agg(F.min("cv_rmse")).first()[0] == pytest.approx(held_out_rmse(grams, lambda g: fit_ridge(g, best)))


def test_a_repeated_append_counts_once(spark, tmp_path):
    log = str(tmp_path / "log")
    scored = trial_table(spark, {"alpha": ("uniform", 0.0, 1.0)}, 6).withColumn("cv_rmse", F.col("trial_id") * 1.0)
    assert read_trials(spark, log, "d", "ridge").count() == 0
    append_trials(scored.filter("trial_id <= 4"), log, "d", "ridge")
    append_trials(scored.filter("trial_id >= 3").withColumn("cv_rmse", F.lit(9.0)), log, "d", "ridge")
    append_trials(scored, log, "7", "ridge")
    append_trials(scored.filter("false"), log, "d", "ridge")
    got = {r["trial_id"]: r["cv_rmse"] for r in read_trials(spark, log, "d", "ridge").collect()}
    assert got == {1: 1.0, 2: 2.0, 3: 9.0, 4: 9.0, 5: 9.0, 6: 9.0} and read_trials(spark, log, "d", "ridge").count() == 6
    assert read_trials(spark, log, "7", "ridge").count() == 6 and read_trials(spark, log, "7", "pls").count() == 0


def test_an_interrupted_append_leaves_the_log(spark, tmp_path):
    log = str(tmp_path / "log")
    scored = trial_table(spark, {"alpha": ("uniform", 0.0, 1.0)}, 6).withColumn("cv_rmse", F.lit(1.0))
    append_trials(scored.filter("trial_id <= 2"), log, "d", "ridge")
    broken = scored.withColumn("cv_rmse", F.when(F.col("trial_id") == 5, F.raise_error(F.lit("lost"))).otherwise(2.0))
    with pytest.raises(Exception, match="lost"):
        append_trials(broken, log, "d", "ridge")
    logged = read_trials(spark, log, "d", "ridge")
    assert {r["trial_id"]: r["cv_rmse"] for r in logged.collect()} == {1: 1.0, 2: 1.0}
    assert sorted(r["trial_id"] for r in resume_trials(logged, scored).collect()) == [3, 4, 5, 6]


def test_joint_stack_search_equals_refitting(data, spark):
    df, _ = data
    grams = gram_by_fold(df, WIDE, "y", fold=q("fold"))
    space = {"alpha_ridge": ("uniform", 2.0, 2.0), "n_components_pls": ("quniform", 3, 3, 1), "alpha_ridge_meta": ("uniform", 1.0, 1.0)}
    quick = search_ensemble(grams, trial_table(spark, space, 1), ["ridge", "pls"], "stack").first()["cv_rmse"]
    members = {"ridge": Linear("ridge", {"alpha": 2.0}), "pls": Linear("pls", {"n_components": 3})}
    errors = []
    for f in grams:
        rest = df.filter(q("fold") != f)
        oof = out_of_fold(rest, members, WIDE, "y", "fold")
        meta = Linear("ridge", {"alpha": 1.0}).fit(oof, list(members), "y")
        part = df.filter(q("fold") == f)
        for n, m in members.items():
            part = m.fit(rest, WIDE, "y").predict(part, n)
        errors.append(meta.predict(part).agg(F.avg((q("y") - q("prediction")) ** 2)).first()[0])
    assert quick == pytest.approx(np.sqrt(np.mean(errors)))


@pytest.mark.parametrize("block", [16, 4096])
def test_neighbours_against_all_pairs(spark, block):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(150, 3)), np.tile(rng.normal(size=(1, 3)), (80, 1)), rng.normal(5, 1, size=(70, 3))])
    y = rng.normal(size=300)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], float(y[i])) for i in range(300)], "id bigint, v array<double>, y double")
    got = {r["id"]: r["prediction"] for r in knn_regress(df.filter("id % 3 <> 0"), df.filter("id % 3 = 0"), "id", "v", "y", 5, block).collect()}
    train = [i for i in range(300) if i % 3]
    assert len(got) == 100
    for i in range(0, 300, 3):
        d = sorted((round(float(np.linalg.norm(x[i] - x[j])), 9), j) for j in train)[:5]
        assert got[i] == pytest.approx(np.mean([y[j] for _, j in d])), i


def test_rank_tests_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    n = 240
    x = np.where(np.arange(n) % 3 == 0, 4, rng.integers(0, 40, n)).astype(float)
    y = np.round(x / 10 + rng.normal(size=n), 1)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    s = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i in range(n) for j in range(i))
    tx = sum(c * (c - 1) / 2 for c in np.unique(x, return_counts=True)[1])
    ty = sum(c * (c - 1) / 2 for c in np.unique(y, return_counts=True)[1])
    m = n * (n - 1) / 2
    assert kendall(df, ["x"], "y").first()["stat"] == pytest.approx(s / np.sqrt((m - tx) * (m - ty)))
    rank = lambda v: pd.Series(v).rank().to_numpy()
    assert spearman(df, ["x"], "y").first()["stat"] == pytest.approx(np.corrcoef(rank(x), rank(y))[0, 1])


def test_tuning_flow(data, spark, tmp_path):
    df, _ = data
    spaces = {"ridge": {"alpha": ("loguniform", -6.9, 4.6)}, "pls": {"n_components": ("quniform", 1, 10, 1)}}
    log = str(tmp_path / "log")
    variants = {"full": (df, WIDE), "few": (df, WIDE[:5])}
    tune_linear(variants, spaces, "y", "fold", trials=5, log=log)
    scores, fitted = tune_linear(variants, spaces, "y", "fold", trials=12, log=log, resume=True)
    assert scores.count() == 2 * 2 * 12
    cmp = known_scores(scores)
    assert cmp.count() == 4
    models = {k: m for (d, k), m in fitted.items() if d == "full"}
    top = score_best(models, cmp, df, "full", 1, str(tmp_path / "out"))
    assert len(top) == 1
    got = spark.read.option("header", True).csv(str(tmp_path / "out")).select("Id", "SalePrice", "model").toPandas()
    assert len(got) == 600 and set(got["model"]) == set(top) and (got["SalePrice"].astype(float) > 0).all()


@pytest.mark.parametrize("n_cols", [5, 18])
def test_correlations_with_gaps(spark, n_cols):
    rng = np.random.default_rng(9)
    x = rng.normal(1e4, 1, size=(400, n_cols))
    x[:, 1] += x[:, 0]
    x[:, 2] = 3.0
    x[rng.random(x.shape) < 0.1] = np.nan
    pdf = pd.DataFrame(x, columns=[f"k {i}" for i in range(n_cols)])
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"`{c}` double" for c in pdf.columns))
    expected = pdf.corr()
    for r in correlations(df, list(pdf.columns)).collect():
        want = expected.loc[r["var1"], r["var2"]]
        if "k 2" in (r["var1"], r["var2"]):
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(want, abs=1e-7)


def test_joint_search_with_trees_equals_refitting(data, spark):
    """One trial of a stack and of a voter with a tree, against fitting everything anew."""
    df, _ = data
    xs = WIDE[:4]
    makers = {"tree": lambda p: tree(int(p["max_depth"]))}
    fixed = {"alpha_ridge": 2.0, "max_depth_tree": 3.0, "alpha_ridge_meta": 1.5, "voter1": 0.75, "voter2": 0.25}
    trials = trial_table(spark, {n: ("uniform", v, v) for n, v in fixed.items()}, 1)
    members = {"ridge": Linear("ridge", {"alpha": 2.0}), "tree": tree(3)}
    stack = search_joint(df, xs, "y", "fold", trials, list(members), makers, "stack").first()["cv_rmse"]
    voter = search_joint(df, xs, "y", "fold", trials, list(members), makers, "voter").first()["cv_rmse"]
    stacked, voted = [], []
    for f in range(5):
        rest, part = df.filter(q("fold") != f), df.filter(q("fold") == f)
        meta = Linear("ridge", {"alpha": 1.5}).fit(out_of_fold(rest, members, xs, "y", "fold"), list(members), "y")
        for n, m in members.items():
            part = m.fit(rest, xs, "y").predict(part, n)
        blend = 0.75 * q("ridge") + 0.25 * q("tree")
        got = meta.predict(part).agg(F.avg((q("y") - q("prediction")) ** 2), F.avg((q("y") - blend) ** 2)).first()
        stacked.append(got[0])
        voted.append(got[1])
    assert stack == pytest.approx(np.sqrt(np.mean(stacked)), rel=1e-5) and voter == pytest.approx(np.sqrt(np.mean(voted)), rel=1e-5)
    with pytest.raises(ValueError, match="forest"):
        search_joint(df, xs, "y", "fold", trials, ["forest"], makers)


def test_equal_settings_are_fitted_once(data, spark):
    df, _ = data
    asked = []
    makers = {"tree": lambda p: asked.append(p) or tree(int(p["max_depth"]))}
    space = {"max_depth_tree": ("quniform", 1, 2, 1), "alpha_ridge": ("uniform", 0.0, 9.0), "voter1": ("uniform", 0.0, 1.0)}
    got = search_joint(df, WIDE[:2], "y", "fold", trial_table(spark, space, 12), ["ridge", "tree"], makers).toPandas()
    assert len(got) == 12 and got["cv_rmse"].nunique() == 12 and {p["max_depth"] for p in asked} == {1.0, 2.0}


# --- imputation ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(7)
    n = 500
    x = rng.normal(size=n)
    rows = [
        (i + 1, "train" if i % 3 else "test", "A" if x[i] > 0.3 else "B" if x[i] > -0.5 else "C", int(round(x[i] * 2)), float(x[i]),
         float(np.round(3 * x[i] + rng.normal(scale=0.2), 3)), float(x[i] ** 2), float(i))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "id bigint, split string, c string, o bigint, x double, u double, v double, y double")
    return df.select("id", "split", F.when(q("id") % 11 != 0, q("c")).alias("c"), "o", "x",
                     F.when(q("id") % 7 != 0, q("u")).alias("u"), F.when(q("id") % 13 != 0, q("v")).alias("v"), "y").cache()


def test_classifier_fills_only_gaps(gappy):
    r = Roles(cat=("c",), ord=("o",), quant=("x", "u"), response="y")
    got = impute_categorical(gappy, "c", r, "y").toPandas().set_index("id")
    seen = gappy.toPandas().set_index("id")
    assert got["c"].notna().all() and set(got["c"]) <= {"A", "B", "C"}
    there = seen["c"].notna()
    assert (got.loc[there[there].index, "c"] == seen.loc[there[there].index, "c"]).all()
    # x decides the level, so the filled cells must mostly follow it
    filled = got.loc[~there]
    truth = np.where(filled["x"] > 0.3, "A", np.where(filled["x"] > -0.5, "B", "C"))
    assert (filled["c"] == truth).mean() > 0.9
    assert impute_categoricals(gappy, r, "y").filter("c is null").count() == 0


def donors_by_hand(donors, asked, k):
    """Per asked row the keys and values of its nearest donors, by ordering all of them."""
    ordered = sorted((p, d, v) for d, p, v in donors)
    out = {}
    for i, p in asked:
        at = sum(x[0] < p for x in ordered)
        near = ordered[max(0, at - k) : at + k]
        out[i] = [v for _, _, v in sorted((abs(p - x[0]), x[1], x[2]) for x in near)[:k]]
    return out


@pytest.mark.parametrize("k", [1, 3, 20])
def test_donors_by_brute_force(spark, monkeypatch, k):
    rng = np.random.default_rng(k)
    monkeypatch.setattr(impute, "GAP_BLOCK", 7)
    # a third of all predictions are alike, some lie far out, some bins are empty
    pred = np.round(np.where(rng.random(900) < 0.33, 0.5, rng.standard_t(2, 900)), 3)
    donors = [(int(i), float(p), float(i)) for i, p in enumerate(pred[:700])]
    asked = [(1000 + i, float(p)) for i, p in enumerate([*pred[700:], -1e6, 1e6, 0.5])]
    expected = donors_by_hand(donors, asked, k)
    d = spark.createDataFrame(donors, "id bigint, pred double, value double").repartition(6)
    a = spark.createDataFrame(asked, "id bigint, pred double").withColumn("extra", q("id") * 2)
    for pick in range(3):
        got = match_donors(d, a, "id", k, lambda c: F.lit(pick)).collect()
        assert {r["id"]: r["_drawn"] for r in got} == {i: v[pick % len(v)] for i, v in expected.items()}
        assert all(r["extra"] == 2 * r["id"] for r in got)
    few = match_donors(d.filter("id < 2"), a, "id", k, lambda c: F.lit(1))
    assert few.count() == len(asked) and match_donors(d.filter("id < 0"), a, "id", k, lambda c: F.lit(1)).count() == 0


def test_chained_steps_keep_their_size_estimate(gappy, spark):
    """Every step reads a table of its own: neither the plan nor its estimated size grows with the steps."""
    plan = lambda n: impute_chained(gappy, "id", ["u", "v"], ["x", "o"], iterations=n, donors=3)._jdf.queryExecution()
    short, long = plan(1), plan(10)
    size = lambda p: int(str(p.optimizedPlan().stats().sizeInBytes()))
    assert size(long) < 2**63 and size(long) < 4 * size(short)
    assert len(long.toString()) < 1.2 * len(short.toString())
    assert "Exchange rangepartitioning" not in long.toString()


def test_chained_values_come_from_the_observed(gappy, spark):
    run = lambda: impute_chained(gappy, "id", ["u", "v"], ["x", "o"], iterations=2, donors=5, seed=3).toPandas().set_index("id").sort_index()
    seen = gappy.toPandas().set_index("id").sort_index()
    got = run()
    for t in ("u", "v"):
        there = seen[t].notna()
        assert got[t].notna().all() and (got.loc[there, t] == seen.loc[there, t]).all()
        assert set(got.loc[~there, t]) <= set(seen.loc[there, t])
    hole = seen["u"].isna()
    assert np.corrcoef(got.loc[hole, "u"], got.loc[hole, "x"])[0, 1] > 0.95
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    try:
        assert run().equals(got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("kind", [int, float, str])
def test_donors_in_order_and_their_places(kind):
    """Ties of predictions go by key, of whatever type; places are counted within equal values."""
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"_d": [kind(k) for k in rng.permutation(300) + 100], "_dp": rng.integers(0, 20, 300) / 4.0})
    got = impute._in_order(pdf)
    assert [tuple(r) for r in got[["_dp", "_d"]].to_numpy()] == sorted(zip(pdf["_dp"], pdf["_d"]))
    before, after = impute._places(got["_dp"].to_numpy())
    groups = got.groupby("_dp")
    assert (before == groups.cumcount()).all() and (after == groups.cumcount(ascending=False)).all()
    at, nth = impute._repeated(np.array([2, 0, 3]))
    assert at.tolist() == [0, 0, 2, 2, 2] and nth.tolist() == [0, 1, 0, 1, 2]
    assert [len(x) for x in (*impute._places(np.zeros(0)), *impute._repeated(np.zeros(0, int)))] == [0, 0, 0, 0]
