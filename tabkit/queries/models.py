"""Queries of regression fitting and evaluation."""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import functions as F

from tabkit.functions.expr import fold_of, q
from tabkit.operators.ensemble import Stack, Voter, out_of_fold, search_weights, vote
from tabkit.operators.evaluate import (
    assign_folds, back_transform, compare_models, comparison_long, cv_rmse, error_band, exclude_models, log_rmse,
    predictions, train_rmse,
)
from tabkit.operators.joint import search_joint
from tabkit.operators.moments import centred_moments, gram_by_fold, moments
from tabkit.operators.ranking import top_importances
from tabkit.operators.regress import (
    KernelRobust, Linear, LinearFit, boosted_trees, fit_pls, knn_regress, lasso, lasso_path, random_tree, tree,
)
from tabkit.operators.robust import RobustKernel
from tabkit.operators.search import (
    best_trial, evaluate_kernel_trials, evaluate_ml_trials, evaluate_trials, normalise_weights, resume_trials, search_ensemble, split_params,
    trial_points, trial_table,
)
from tabkit.plans import housing
from tabkit.plans.modelling import fit_all
from tabkit.queries.obs import FEATURES, MODEL_SQL, model_obs, obs, with_obs
from tabkit.queries.registry import query, rnd, rounded, table, work_folder
from tabkit.session import settle, store
from tabkit.sources.store import append_trials, read_trials


def model_sql(body: str) -> str:
    return with_obs(MODEL_SQL + body)


def _moments_sql() -> str:
    names = ["1", "x4", "x5", "y"]
    return model_sql(" " + " UNION ALL ".join(
        f"SELECT CAST(fold AS BIGINT) AS fold, '{a}' AS a, '{b}' AS b, round(CAST(sum({a}*{b}) AS DOUBLE),4) AS value FROM m GROUP BY fold"
        for a, b in combinations_with_replacement(names, 2)))


_MEMBERS = {"a": Linear("ridge", {"alpha": 0.0}), "b": Linear("ridge", {"alpha": 500.0})}
_OOF = """, f AS (SELECT fold, count(*)::DOUBLE AS n, sum(x4) AS sx, sum(y) AS sy, sum(x4*x4) AS sxx, sum(x4*y) AS sxy FROM m GROUP BY fold)
, a AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM f)
, r AS (SELECT fold, a.n-f.n AS n, a.sx-f.sx AS sx, a.sy-f.sy AS sy, a.sxx-f.sxx AS sxx, a.sxy-f.sxy AS sxy FROM f, a)
, k AS (SELECT fold, sx/n AS mx, sy/n AS my, (sxy-sx*sy/n)/(sxx-sx*sx/n) AS wa, (sxy-sx*sy/n)/(sxx-sx*sx/n+500) AS wb FROM r)
, o AS (SELECT id, fold, y, my+wa*(x4-mx) AS a, my+wb*(x4-mx) AS b FROM m JOIN k USING (fold))"""


@query("i1_moments", _moments_sql())
def i1(spark, sf):
    return rounded(moments(model_obs(spark, sf), ["x4", "x5"], "y", "fold"), ["value"], 4)


def _centred_moments_sql() -> str:
    names = ["year_sold", "x4", "y"]
    m = "SELECT year_sold, qty/100 AS x4, ln(price) AS y, CAST((id*30011)%65521%5 AS BIGINT) AS fold FROM obs WHERE split='train' AND qty IS NOT NULL"
    return with_obs(f", m AS ({m}) " + " UNION ALL ".join(
        f"SELECT fold, '{a}' AS a, '{b}' AS b, count(*) AS n, round(avg({a}),8) AS mean_a, round(avg({b}),8) AS mean_b, round(covar_pop({a},{b})*count(*),6) AS value FROM m GROUP BY fold"
        for a, b in combinations_with_replacement(names, 2)))


@query("i1_centred_moments", _centred_moments_sql())
def i1_centred(spark, sf):
    """A year, far from 0 against its spread, among the columns."""
    df = obs(spark, sf, ("id", "split", "year_sold", "qty", "price")).filter("split = 'train'")
    df = df.select("year_sold", (q("qty") / 100).alias("x4"), F.ln("price").alias("y"), fold_of(q("id"), 5).alias("fold"))
    return rounded(rounded(centred_moments(df, ["year_sold", "x4"], "y", "fold"), ["mean_a", "mean_b"], 8), ["value"], 6)


_CENTRED = """, s AS (SELECT count(*) AS n, avg(x4) AS m4, avg(x5) AS m5, avg(y) AS my, var_pop(x4)*count(*) AS s44, var_pop(x5)*count(*) AS s55,
 covar_pop(x4,x5)*count(*) AS s45, covar_pop(x4,y)*count(*) AS s4, covar_pop(x5,y)*count(*) AS s5 FROM m)"""


def _weights(spark, df, fitted: LinearFit):
    """The fit as rows, with the number of rows it came from."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    row = [F.lit(float(fitted.intercept)).alias("intercept"), *[F.lit(float(w)).alias(f) for f, w in zip(fitted.features, fitted.coef)]]
    return rounded(n.select("n", *row), ["intercept", *fitted.features])


@query("i2_fit_ridge", model_sql(_CENTRED + """, w AS (SELECT n, m4, m5, my, (s4*(s55+2)-s5*s45)/((s44+2)*(s55+2)-s45*s45) AS w4, (s5*(s44+2)-s4*s45)/((s44+2)*(s55+2)-s45*s45) AS w5 FROM s)
 SELECT n, round(my-w4*m4-w5*m5,6) AS intercept, round(w4,6) AS x4, round(w5,6) AS x5 FROM w"""))
def i2(spark, sf):
    df = store(model_obs(spark, sf))
    return _weights(spark, df, Linear("ridge", {"alpha": 2.0}).fit(df, ["x4", "x5"], "y"))


@query("i2_ridge_predictions", model_sql(", w AS (SELECT avg(x4) AS m4, avg(y) AS my, covar_pop(x4,y)*count(*)/(var_pop(x4)*count(*)+1) AS w FROM m) "
       "SELECT id, round(my+w*(x4-m4),6) AS prediction FROM m, w"))
def i2_predict(spark, sf):
    df = store(model_obs(spark, sf))
    fitted = Linear("ridge", {"alpha": 1.0}).fit(df, ["x4"], "y")
    return fitted.predict(df).select("id", rnd("prediction").alias("prediction"))


@query("i3_fit_lasso")
def i3(spark, sf):
    df = store(model_obs(spark, sf))
    return lasso(0.001).fit(df, FEATURES, "y").predict(df).select("id", "y", "prediction")


@query("i3_lasso_one_column", model_sql(""", s AS (SELECT avg(x4) AS mx, avg(y) AS my, covar_pop(x4,y)/stddev_pop(x4) AS c, stddev_pop(x4) AS sx FROM m)
 SELECT id, round(my + sign(c)*greatest(abs(c)-0.001,0)/sx*(x4-mx),4) AS prediction FROM m, s"""))
def i3_one(spark, sf):
    """With one column the penalty shortens the weight by a known amount."""
    df = store(model_obs(spark, sf))
    return lasso(0.001).fit(df, ["x4"], "y").predict(df).select("id", rnd("prediction", 4).alias("prediction"))


_LASSO_TWO = _CENTRED + """, z AS (SELECT n, m4, m5, my, sqrt(s44/n) AS d4, sqrt(s55/n) AS d5, s45/sqrt(s44*s55) AS r, s4/n/sqrt(s44/n) AS c4, s5/n/sqrt(s55/n) AS c5 FROM s)
, a AS (SELECT exp(-6.907755278982137 + i*0.05) AS alpha FROM range(100) t(i))
, g AS (SELECT * FROM z, a, (VALUES (-1),(0),(1)) u(e4), (VALUES (-1),(0),(1)) v(e5))
, b AS (SELECT *, CASE WHEN e4=0 THEN 0 WHEN e5=0 THEN c4-alpha*e4 ELSE (c4-alpha*e4-r*(c5-alpha*e5))/(1-r*r) END AS b4,
  CASE WHEN e5=0 THEN 0 WHEN e4=0 THEN c5-alpha*e5 ELSE (c5-alpha*e5-r*(c4-alpha*e4))/(1-r*r) END AS b5 FROM g)
, k AS (SELECT * FROM b WHERE CASE WHEN e4=0 THEN abs(c4-r*b5) <= alpha ELSE b4*e4 > 0 END AND CASE WHEN e5=0 THEN abs(c5-r*b4) <= alpha ELSE b5*e5 > 0 END)
 SELECT round(alpha,8) AS alpha, round(my-b4/d4*m4-b5/d5*m5,6) AS intercept, round(b4/d4,6) AS x4, round(b5/d5,6) AS x5 FROM k"""


@query("i3_lasso_path", model_sql(_LASSO_TWO))
def i3_path(spark, sf):
    """A path of 100 penalties from one scan; with two columns the conditions of the optimum can be solved."""
    alphas = [math.exp(-6.907755278982137 + i * 0.05) for i in range(100)]
    fits = lasso_path(gram_by_fold(model_obs(spark, sf), ["x4", "x5"], "y")[0], alphas)
    rows = spark.createDataFrame([(a, b, *map(float, w)) for a, (b, w) in zip(alphas, fits)], "alpha double, intercept double, x4 double, x5 double")
    return rounded(rounded(rows, ["alpha"], 8), ["intercept", "x4", "x5"], 6)


@query("i4_fit_bayesian_ridge")
def i4(spark, sf):
    df = store(model_obs(spark, sf))
    return _weights(spark, df, Linear("bridge").fit(df, FEATURES, "y"))


@query("i5_fit_pls", model_sql(_CENTRED + """
, c AS (SELECT *, sqrt(s44/(n-1)) AS d4, sqrt(s55/(n-1)) AS d5 FROM s), r AS (SELECT *, s4/d4 AS c4, s5/d5 AS c5 FROM c)
, u AS (SELECT *, c4/sqrt(c4*c4+c5*c5) AS r4, c5/sqrt(c4*c4+c5*c5) AS r5 FROM r)
, t AS (SELECT *, (r4*c4+r5*c5)/(r4*r4*s44/d4/d4 + r5*r5*s55/d5/d5 + 2*r4*r5*s45/d4/d5) AS b FROM u)
SELECT n, round(my - b*r4/d4*m4 - b*r5/d5*m5,6) AS intercept, round(b*r4/d4,6) AS x4, round(b*r5/d5,6) AS x5 FROM t"""))
def i5(spark, sf):
    df = store(model_obs(spark, sf))
    return _weights(spark, df, Linear("pls", {"n_components": 1}).fit(df, ["x4", "x5"], "y"))


@query("i5_fit_pls_full", model_sql(_CENTRED + """, w AS (SELECT n, m4, m5, my, (s4*s55-s5*s45)/(s44*s55-s45*s45) AS w4, (s5*s44-s4*s45)/(s44*s55-s45*s45) AS w5 FROM s)
 SELECT n, round(my-w4*m4-w5*m5,6) AS intercept, round(w4,6) AS x4, round(w5,6) AS x5 FROM w"""))
def i5_full(spark, sf):
    """As many components as columns: least squares."""
    df = store(model_obs(spark, sf))
    b, w = fit_pls(gram_by_fold(df, ["x4", "x5"], "y")[0], 2)
    return _weights(spark, df, LinearFit(("x4", "x5"), b, tuple(w)))


@query("i6_fit_kernel_robust")
def i6(spark, sf):
    df = store(model_obs(spark, sf))
    return KernelRobust(gamma=0.5, width=32).fit(df, FEATURES, "y").predict(df).select("id", "y", "prediction")


def _wave() -> tuple[float, float]:
    """Frequency (at a gamma of 1/2) and shift of the one feature of a model of width 1."""
    rng = np.random.default_rng(27)
    return float(rng.normal(0.0, 1.0, (1, 1))[0, 0]), float(rng.uniform(0.0, 2 * np.pi, 1)[0])


_F, _S = _wave()
_FLAT = 1e6  # scales that no residual reaches: the loss is the squared one


@query("i6_robust_kernel_without_outliers", model_sql(f""", z AS (SELECT id, y, sqrt(2)*cos(x5*{_F!r} + {_S!r}) AS z FROM m)
, c AS (SELECT avg(z) AS mz, avg(y) AS my FROM z), w AS (SELECT sum((z-mz)*(y-my))/(sum((z-mz)*(z-mz)) + 0.5) AS w FROM z, c)
 SELECT id, round(my + w*(z-mz), 6) AS prediction FROM z, c, w"""))
def i6_closed(spark, sf):
    df = store(model_obs(spark, sf))
    fitted = RobustKernel(gamma=0.5, c=2.0, epsilon=_FLAT, width=1).fit(df, ["x5"], "y")
    return rounded(fitted.predict(df).select("id", "prediction"), ["prediction"])


@query("i6_robust_kernel")
def i6_robust(spark, sf):
    df = store(model_obs(spark, sf))
    return RobustKernel(gamma=0.5, c=10.0).fit(df, FEATURES, "y").predict(df).select("id", "y", "prediction")


@query("i7_knn_regress", """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
 d AS (SELECT a.vec_id AS id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.v, b.v),9), b.vec_id) AS r
  FROM e a JOIN e b ON a.vec_id%4=0 AND b.vec_id%4<>0)
 SELECT id, round(avg(label),6) AS prediction FROM d WHERE r <= 5 GROUP BY id""")
def i7(spark, sf):
    e = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "id")
    return rounded(knn_regress(e.filter("id % 4 <> 0"), e.filter("id % 4 = 0"), "id", "embedding", "label", 5), ["prediction"])


@query("i8_fit_tree")
def i8(spark, sf):
    df = store(model_obs(spark, sf))
    return tree(5).fit(df, FEATURES, "y").predict(df).select("id", "y", "prediction")


@query("i9_fit_random_tree")
def i9(spark, sf):
    df = store(model_obs(spark, sf))
    return random_tree(5).fit(df, FEATURES, "y").predict(df).select("id", "y", "prediction")


@query("i10_fit_boosted_trees")
def i10(spark, sf):
    df = store(model_obs(spark, sf))
    return boosted_trees(max_depth=3, n_estimators=10).fit(df, FEATURES, "y").predict(df).select("id", "y", "prediction")


def _stump(source: str, x: str, y: str, tag: str) -> str:
    """Best single split of ``y`` by ``x``: named query ``st<tag>`` with (cut, low, high, gain)."""
    return f""", lv{tag} AS (SELECT {x} AS v, count(*)::DOUBLE AS n, sum({y}) AS s FROM {source} GROUP BY 1)
, cu{tag} AS (SELECT v, sum(n) OVER (ORDER BY v) AS nl, sum(s) OVER (ORDER BY v) AS sl, sum(n) OVER () AS tn, sum(s) OVER () AS ts FROM lv{tag})
, st{tag} AS (SELECT v AS cut, sl/nl AS low, (ts-sl)/(tn-nl) AS high, sl*sl/nl + (ts-sl)*(ts-sl)/(tn-nl) AS gain FROM cu{tag} WHERE nl < tn ORDER BY gain DESC, v LIMIT 1)"""


_ONE_SPLIT = model_sql(_stump("m", "x2", "y", "1") + " SELECT id, round(CASE WHEN x2 <= cut THEN low ELSE high END,6) AS prediction FROM m, st1")


def _one_split(spark, sf, spec):
    df = store(model_obs(spark, sf))
    return spec.fit(df, ["x2"], "y").predict(df).select("id", rnd("prediction").alias("prediction"))


@query("i8_tree_one_split", _ONE_SPLIT)
def i8_one(spark, sf):
    return _one_split(spark, sf, tree(1))


@query("i9_random_tree_one_split", _ONE_SPLIT)
def i9_one(spark, sf):
    return _one_split(spark, sf, random_tree(1))


@query("i10_boosted_two_splits", model_sql(_stump("m", "x2", "y", "1") + ", r1 AS (SELECT *, CASE WHEN x2 <= cut THEN low ELSE high END AS p1 FROM m, st1), r2 AS (SELECT id, x2, p1, y-p1 AS e FROM r1)"
       + _stump("r2", "x2", "e", "2") + " SELECT id, round(p1 + 0.2*CASE WHEN x2 <= cut THEN low ELSE high END,6) AS prediction FROM r2, st2"))
def i10_two(spark, sf):
    """Two stumps, the second on what the first leaves, at the learning rate."""
    return _one_split(spark, sf, boosted_trees(max_depth=1, n_estimators=2, learning_rate=0.2))


@query("h3_importance_one_split", model_sql(_stump("m", "x2", "y", "1") + _stump("m", "x3", "y", "2") + """
 SELECT CASE WHEN st1.gain > st2.gain THEN 'x2' ELSE 'x3' END AS feature, 1.0::DOUBLE AS importance FROM st1, st2"""))
def h3_one(spark, sf):
    fitted = tree(1).fit(store(model_obs(spark, sf)), ["x2", "x3"], "y")
    return top_importances(fitted.importances(spark), 1)


@query("i11_assign_folds", "SELECT o_orderkey AS id, CAST((o_orderkey*30011)%65521%5 AS BIGINT) AS fold FROM orders")
def i11(spark, sf):
    return assign_folds(table(spark, sf, "orders").select(q("o_orderkey").alias("id")))


# predictions made from the data: the mean log price of each level, in sample and from the other folds
_LEVELS = ("priority", "nation")


def _level_means(spark, sf):
    df = assign_folds(obs(spark, sf, ("id", "split", *_LEVELS, "price")).filter("price is not null").withColumn("priority", F.coalesce("priority", F.lit("none"))))
    df = settle(df.select("id", "fold", F.ln("price").alias("y"), *_LEVELS))
    inside, outside = None, None
    for c in _LEVELS:
        sums = df.groupBy(c, "fold").agg(F.sum("y").alias("s"), F.count("y").alias("n"))
        whole = sums.groupBy(c).agg(F.sum("s").alias("ts"), F.sum("n").alias("tn"))
        keep = [F.lit("all").alias("dataset"), F.lit(f"mean_{c}").alias("model"), "id", "fold", "y"]
        a = df.join(whole, c).select(*keep, (q("ts") / q("tn")).alias("p"))
        b = df.join(whole, c).join(sums, [c, "fold"]).select(*keep, ((q("ts") - q("s")) / (q("tn") - q("n"))).alias("p"))
        inside = a if inside is None else inside.unionByName(a)
        outside = b if outside is None else outside.unionByName(b)
    return inside, outside


def _means_sql() -> str:
    body = " UNION ALL ".join(
        f"""SELECT 'all' AS dataset, 'mean_{c}' AS model, id, fold, y, avg(y) OVER (PARTITION BY {c}) AS p,
 (sum(y) OVER (PARTITION BY {c}) - sum(y) OVER (PARTITION BY {c}, fold)) / (count(*) OVER (PARTITION BY {c}) - count(*) OVER (PARTITION BY {c}, fold)) AS po FROM z"""
        for c in _LEVELS)
    return f""", z AS (SELECT id, CAST((id*30011)%65521%5 AS BIGINT) AS fold, ln(price) AS y, coalesce(priority, 'none') AS priority, nation FROM obs WHERE price IS NOT NULL),
 pr AS ({body})
, tr AS (SELECT dataset, model, sqrt(avg(pow(y-p,2))) AS e FROM pr GROUP BY 1,2)
, cv AS (SELECT dataset, model, sqrt(avg(mse)) AS e FROM (SELECT dataset, model, fold, avg(pow(y-po,2)) AS mse FROM pr GROUP BY 1,2,3) GROUP BY 1,2)"""


@query("i12_train_rmse", with_obs(_means_sql() + " SELECT model, round(e,6) AS rmse FROM tr"))
def i12(spark, sf):
    return rounded(train_rmse(_level_means(spark, sf)[0], ["model"]), ["rmse"])


@query("i13_cv_rmse", with_obs(_means_sql() + " SELECT dataset, model, round(e,6) AS cv_rmse FROM cv"))
def i13(spark, sf):
    return rounded(cv_rmse(_level_means(spark, sf)[1]), ["cv_rmse"])


@query("i14_fit_all")
def i14(spark, sf):
    df = store(model_obs(spark, sf))
    specs = {"ridge": Linear("ridge"), "bridge": Linear("bridge"), "pls": Linear("pls", {"n_components": 2}), "tree": tree(4)}
    inside, outside = fit_all({"full": (df, FEATURES), "few": (df, FEATURES[:3])}, specs, "y", "fold")
    return compare_models(inside, outside)


@query("i14_fit_all_linear", model_sql(_OOF + """
, z AS (SELECT avg(x4) AS mx, avg(y) AS my, covar_pop(x4,y)*count(*) AS c, var_pop(x4)*count(*) AS v FROM m)
, i AS (SELECT avg(pow(y-(my+c/v*(x4-mx)),2)) AS ea, avg(pow(y-(my+c/(v+500)*(x4-mx)),2)) AS eb FROM m, z)
, h AS (SELECT sqrt(avg(ea)) AS ea, sqrt(avg(eb)) AS eb FROM (SELECT avg(pow(y-a,2)) AS ea, avg(pow(y-b,2)) AS eb FROM o GROUP BY fold))
, q AS (SELECT 'a' AS model, sqrt(i.ea) AS train_rmse, h.ea AS cv_rmse FROM i, h UNION ALL SELECT 'b', sqrt(i.eb), h.eb FROM i, h)
SELECT d AS dataset, model, round(train_rmse,6) AS train_rmse, round(cv_rmse,6) AS cv_rmse FROM q, (VALUES ('one'),('two')) t(d)"""))
def i14_linear(spark, sf):
    df = store(model_obs(spark, sf))
    inside, outside = fit_all({"one": (df, ["x4"]), "two": (df, ["x4"])}, _MEMBERS, "y", "fold")
    return rounded(compare_models(inside, outside), ["train_rmse", "cv_rmse"])


@query("i15_compare_models", with_obs(_means_sql() + """ SELECT dataset, model, round(tr.e,6) AS train_rmse,
 CASE WHEN model='mean_nation' THEN 0.5 ELSE round(cv.e,6) END AS cv_rmse FROM tr JOIN cv USING (dataset, model)"""))
def i15(spark, sf):
    inside, outside = _level_means(spark, sf)
    known = inside.filter("model = 'mean_nation'").groupBy("dataset", "model").agg(F.lit(0.5).alias("cv_rmse"))
    return rounded(compare_models(inside, outside, known), ["train_rmse", "cv_rmse"])


@query("i15_comparison_long", with_obs(_means_sql() + """ SELECT dataset, model, 'train_rmse' AS metric, round(e,6) AS value FROM tr
 UNION ALL SELECT dataset, model, 'cv_rmse', round(e,6) FROM cv"""))
def i15_long(spark, sf):
    return rounded(comparison_long(compare_models(*_level_means(spark, sf))), ["value"])


@query("i16_exclude_models", with_obs(_means_sql() + " SELECT dataset, model, round(e,6) AS cv_rmse FROM cv WHERE model <> 'mean_nation'"))
def i16(spark, sf):
    return rounded(exclude_models(cv_rmse(_level_means(spark, sf)[1]), ["mean_nation"]), ["cv_rmse"])


@query("i17_back_transform", with_obs(" SELECT id, round(price,4) AS p FROM obs WHERE price IS NOT NULL"))
def i17(spark, sf):
    df = obs(spark, sf, ("id", "price")).filter("price is not null").select("id", F.ln("price").alias("p"))
    return rounded(back_transform(df), ["p"], 4)


@query("i18_log_rmse", with_obs(""", t AS (SELECT price AS y, gross*1.05 AS p FROM obs WHERE price IS NOT NULL AND gross IS NOT NULL)
, e AS (SELECT sqrt(avg(pow(ln(p)-ln(y),2))) AS log_rmse FROM t)
SELECT round(log_rmse,6) AS log_rmse, round(exp(-log_rmse),6) AS low, round(exp(log_rmse),6) AS high FROM e"""))
def i18(spark, sf):
    df = obs(spark, sf, ("gross", "price")).filter("price is not null and gross is not null")
    score = log_rmse(df.select(q("price").alias("y"), (q("gross") * 1.05).alias("p")))
    return rounded(error_band(score, "log_rmse"), ["log_rmse", "low", "high"])


# --- search and ensembles ------------------------------------------------------------------------

# Ranges of the searched parameters (logs of powers of ten).
SPACE = {"alpha": ("loguniform", -6.907755278982137, 4.605170185988092), "share": ("uniform", 0.25, 1.0), "trees": ("quniform", 100, 500, 50)}
WEIGHTS = {"voter1": ("uniform", 0.0, 1.0), "voter2": ("uniform", 0.0, 1.0)}


@query("j1_trial_points", """SELECT c_custkey+1 AS trial_id, round(exp(-6.907755278982137 + (((c_custkey+1)*30011)%65521)/65521.0*(4.605170185988092+6.907755278982137)),6) AS alpha,
 round(0.25 + (((c_custkey+1)*40503)%65521)/65521.0*0.75,6) AS share, round((100 + (((c_custkey+1)*12347)%65521)/65521.0*400)/50)*50.0 AS trees FROM customer""")
def j1(spark, sf):
    points = trial_points(table(spark, sf, "customer").select((q("c_custkey") + 1).alias("trial")), SPACE, "trial")
    return points.select("trial_id", *[rnd(q("params")[n]).alias(n) for n in SPACE])


TRIALS, ENSEMBLE_TRIALS = 100, 50
_TRIAL_SQL = f""", tr AS (SELECT i AS trial_id, exp(-6.907755278982137 + ((i*30011)%65521)/65521.0*11.512925464970229) AS alpha FROM range(1,{TRIALS + 1}) t(i))
, f AS (SELECT fold, count(*)::DOUBLE AS n, sum(x4) AS sx, sum(y) AS sy, sum(x4*x4) AS sxx, sum(x4*y) AS sxy, sum(y*y) AS syy FROM m GROUP BY fold)
, a AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM f)
, w AS (SELECT trial_id, alpha, f.*, a.n-f.n AS rn, (a.sx-f.sx) AS rx, (a.sy-f.sy) AS ry,
   ((a.sxy-f.sxy)-(a.sx-f.sx)*(a.sy-f.sy)/(a.n-f.n)) / ((a.sxx-f.sxx)-(a.sx-f.sx)*(a.sx-f.sx)/(a.n-f.n)+alpha) AS w FROM tr, f, a)
, e AS (SELECT *, ry/rn - w*rx/rn AS b FROM w)
, sc AS (SELECT trial_id, alpha, sqrt(avg((syy - 2*b*sy - 2*w*sxy + n*b*b + 2*b*w*sx + w*w*sxx)/n)) AS cv_rmse FROM e GROUP BY 1,2)"""


def _ridge_trials(spark, sf):
    grams = gram_by_fold(model_obs(spark, sf), ["x4"], "y", fold=q("fold"))
    return evaluate_trials(grams, trial_table(spark, {"alpha": SPACE["alpha"]}, TRIALS), "ridge")


@query("j2_evaluate_trials", model_sql(_TRIAL_SQL + " SELECT trial_id, round(alpha,6) AS alpha, round(cv_rmse,7) AS cv_rmse FROM sc"))
def j2(spark, sf):
    return _ridge_trials(spark, sf).select("trial_id", rnd(q("params")["alpha"]).alias("alpha"), rnd("cv_rmse", 7).alias("cv_rmse"))


@query("j2_evaluate_tree_trials")
def j2_trees(spark, sf):
    from pyspark.ml.regression import DecisionTreeRegressor

    df = store(model_obs(spark, sf))
    trials = trial_table(spark, {"max_depth": ("quniform", 1, 4, 1)}, ENSEMBLE_TRIALS)
    return evaluate_ml_trials(df, FEATURES, "y", "fold", trials, lambda p: DecisionTreeRegressor(maxDepth=int(p["max_depth"]), seed=1), 5)


@query("j2_kernel_trials_without_outliers", model_sql(f""", t AS (SELECT c_nationkey AS t, CAST(1+c_nationkey AS DOUBLE) AS c, count(*)/(1000.0+count(*)) AS g FROM customer GROUP BY 1)
, z AS (SELECT t, c, g, fold, y, sqrt(2)*cos(x5*{_F!r}*sqrt(2*g) + {_S!r}) AS z FROM m, t)
, f AS (SELECT DISTINCT fold AS f FROM m)
, s AS (SELECT t, c, f, avg(z) AS mz, avg(y) AS my, covar_pop(z, y)*count(*) AS zy, var_pop(z)*count(*) AS zz FROM z, f WHERE fold <> f GROUP BY t, c, f)
, e AS (SELECT s.t, s.f, avg(pow(y - my - zy/(zz+1/s.c)*(z-mz), 2)) AS e FROM s JOIN z ON z.t = s.t AND z.fold = s.f GROUP BY s.t, s.f)
 SELECT CAST(t AS BIGINT) AS trial_id, round(sqrt(avg(e)), 6) AS cv_rmse FROM e GROUP BY t"""))
def j2_kernel_closed(spark, sf):
    trials = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).select(
        q("c_nationkey").cast("bigint").alias("trial_id"),
        F.create_map(F.lit("gamma"), q("n") / (q("n") + 1000.0), F.lit("C"), q("c_nationkey") + 1.0, F.lit("epsilon"), F.lit(_FLAT)).alias("params"))
    return rounded(evaluate_kernel_trials(model_obs(spark, sf), ["x5"], "y", "fold", trials, 5, width=1).select("trial_id", "cv_rmse"), ["cv_rmse"])


@query("j2_evaluate_kernel_trials")
def j2_kernel(spark, sf):
    return evaluate_kernel_trials(model_obs(spark, sf), FEATURES, "y", "fold", trial_table(spark, housing.SPACES["svr"], ENSEMBLE_TRIALS), 5)


@query("j3_best_trial", """WITH b AS (SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1)
 SELECT o_orderkey AS trial_id, o_totalprice AS cv_rmse, 'depth' AS name, trunc(o_custkey/7.0) AS value FROM b UNION ALL SELECT o_orderkey, o_totalprice, 'rate', round(o_custkey/9.0,6) FROM b""")
def j3(spark, sf):
    trials = table(spark, sf, "orders").select(
        q("o_orderkey").alias("trial_id"), q("o_totalprice").alias("cv_rmse"),
        F.create_map(F.lit("depth"), q("o_custkey") / 7.0, F.lit("rate"), q("o_custkey") / 9.0).alias("params"))
    return best_trial(trials, ["depth"]).withColumn("value", rnd("value"))


@query("j4_resume_trials", "SELECT c_custkey AS trial_id, c_acctbal AS cv_rmse FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def j4(spark, sf):
    trials = table(spark, sf, "customer").select(q("c_custkey").alias("trial_id"), q("c_acctbal").alias("cv_rmse"))
    log = table(spark, sf, "orders").filter("o_totalprice > 400000").select(q("o_custkey").alias("trial_id")).distinct()
    return resume_trials(log, trials)


@query("j4_repeated_append", "SELECT CAST(c_nationkey AS BIGINT) AS trial_id, round(avg(c_acctbal),6) AS cv_rmse FROM customer GROUP BY 1")
def j4_log(spark, sf):
    """The score of a nation is a mean over its customers; some were logged before, with another score, and are logged again."""
    scored = table(spark, sf, "customer").groupBy(q("c_nationkey").cast("bigint").alias("trial_id")).agg(rnd(F.avg("c_acctbal")).alias("cv_rmse"))
    scored = scored.withColumn("params", F.create_map(F.lit("nation"), q("trial_id").cast("double")))
    path = work_folder(spark)
    append_trials(scored.filter("trial_id % 3 = 0").withColumn("cv_rmse", F.lit(0.0)), path, "customer", "mean")
    append_trials(scored, path, "customer", "mean")
    return read_trials(spark, path, "customer", "mean").select("trial_id", "cv_rmse")


@query("j5_split_params", """WITH p AS (SELECT o_orderkey AS trial, CASE o_orderkey%5 WHEN 0 THEN 'alpha_ridge' WHEN 1 THEN 'gamma_svr' WHEN 2 THEN 'max_depth_xgb_meta' WHEN 3 THEN 'voter1' ELSE 'alpha_ridge_meta' END AS name, o_totalprice AS value FROM orders)
 SELECT trial, CASE WHEN name LIKE '%\\_meta' ESCAPE '\\' THEN 'meta' ELSE 'base' END AS level,
  CASE WHEN name LIKE 'voter%' THEN 'weights' WHEN name LIKE '%ridge%' THEN 'ridge' WHEN name LIKE '%svr%' THEN 'svr' ELSE 'xgb' END AS member,
  CASE WHEN name LIKE 'alpha%' THEN 'alpha' WHEN name LIKE 'gamma%' THEN 'gamma' WHEN name LIKE 'max%' THEN 'max_depth' ELSE name END AS param, value FROM p""")
def j5(spark, sf):
    names = F.array(*[F.lit(n) for n in ("alpha_ridge", "gamma_svr", "max_depth_xgb_meta", "voter1", "alpha_ridge_meta")])
    flat = table(spark, sf, "orders").select(
        q("o_orderkey").alias("trial"), F.element_at(names, (q("o_orderkey") % 5 + 1).cast("int")).alias("name"), q("o_totalprice").alias("value"))
    return split_params(flat)


@query("j6_normalise_weights", "SELECT l_orderkey, l_partkey, l_linenumber, round(l_quantity/sum(l_quantity) OVER (PARTITION BY l_orderkey),8) AS weight FROM lineitem")
def j6(spark, sf):
    w = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", q("l_quantity").alias("weight"))
    return rounded(normalise_weights(w, ["l_orderkey"]), ["weight"], 8)


@query("j7_vote", with_obs(_means_sql() + " SELECT dataset, id, round(sum(p*CASE model WHEN 'mean_priority' THEN 2.0 ELSE 1.0 END)/3,6) AS p FROM pr GROUP BY dataset, id"))
def j7(spark, sf):
    preds = _level_means(spark, sf)[0]
    weights = preds.select("dataset", "model").distinct().withColumn("weight", F.when(q("model") == "mean_priority", 2.0).otherwise(1.0))
    return rounded(vote(preds, weights), ["p"])


@query("j7_vote_uniform", with_obs(_means_sql() + " SELECT dataset, id, round(avg(p),6) AS p FROM pr GROUP BY dataset, id"))
def j7_uniform(spark, sf):
    return rounded(vote(_level_means(spark, sf)[0]), ["p"])


@query("j8_out_of_fold", model_sql(_OOF + " SELECT id, fold, round(y,6) AS y, round(a,6) AS a, round(b,6) AS b FROM o"))
def j8(spark, sf):
    return rounded(out_of_fold(model_obs(spark, sf), _MEMBERS, ["x4"], "y", "fold"), ["y", "a", "b"])


@query("j8_out_of_fold_trees")
def j8_trees(spark, sf):
    return out_of_fold(store(model_obs(spark, sf)), {"ridge": Linear(), "tree": tree(3)}, FEATURES, "y", "fold")


@query("j9_stack")
def j9(spark, sf):
    df = store(model_obs(spark, sf))
    stack = Stack({"ridge": Linear(), "pls": Linear("pls", {"n_components": 2}), "tree": tree(3)}, Linear("ridge", {"alpha": 1.0}))
    return stack.fit(df, FEATURES, "y").predict(df).select("id", "y", "prediction")


@query("j9_stack_linear", model_sql(_OOF.replace("FROM m GROUP BY fold", "FROM m2 GROUP BY fold").replace("FROM m JOIN k", "FROM m2 JOIN k")
       .replace(", f AS", ", m2 AS (SELECT id, x4, y, (id*40503)%65521%5 AS fold FROM m), f AS", 1) + """
, g AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a)*count(*)+1 AS aa, var_pop(b)*count(*)+1 AS bb, covar_pop(a,b)*count(*) AS ab,
  covar_pop(a,y)*count(*) AS ay, covar_pop(b,y)*count(*) AS zb FROM o)
, v AS (SELECT *, (ay*bb-zb*ab)/(aa*bb-ab*ab) AS va, (zb*aa-ay*ab)/(aa*bb-ab*ab) AS vb FROM g)
, z AS (SELECT avg(x4) AS mx, avg(y) AS zy, covar_pop(x4,y)*count(*) AS c, var_pop(x4)*count(*) AS w FROM m)
SELECT id, round(my-va*ma-vb*mb + va*(zy+c/w*(x4-mx)) + vb*(zy+c/(w+500)*(x4-mx)),6) AS prediction FROM m, v, z"""))
def j9_linear(spark, sf):
    df = store(model_obs(spark, sf))
    return Stack(_MEMBERS, Linear("ridge", {"alpha": 1.0})).fit(df, ["x4"], "y").predict(df).select("id", rnd("prediction").alias("prediction"))


@query("j9_stack_with_features")
def j9_features(spark, sf):
    df = store(model_obs(spark, sf))
    stack = Stack({"ridge": Linear(), "pls": Linear("pls", {"n_components": 2})}, boosted_trees(3, 5), use_features=True)
    return stack.fit(df, FEATURES, "y").predict(df).select("id", "y", "prediction")


@query("j9_voter")
def j9_voter(spark, sf):
    df = store(model_obs(spark, sf))
    voter = Voter({"ridge": Linear(), "tree": tree(3)}, {"ridge": 2.0, "tree": 1.0})
    return voter.fit(df, FEATURES, "y").predict(df).select("id", "y", "prediction")


@query("j10_search_weights", model_sql(_OOF + f""", t AS (SELECT i AS trial_id, ((i*30011)%65521)/65521.0 AS v1, ((i*40503)%65521)/65521.0 AS v2 FROM range(1,{TRIALS + 1}) g(i))
, s AS (SELECT trial_id, fold, avg(pow(y-(v1*a+v2*b)/(v1+v2),2)) AS mse FROM o, t GROUP BY 1,2)
SELECT trial_id, round(sqrt(avg(mse)),7) AS cv_rmse FROM s GROUP BY 1"""))
def j10(spark, sf):
    oof = out_of_fold(model_obs(spark, sf), _MEMBERS, ["x4"], "y", "fold")
    scored = search_weights(oof, ["a", "b"], "y", "fold", trial_table(spark, WEIGHTS, TRIALS))
    return scored.select("trial_id", rnd("cv_rmse", 7).alias("cv_rmse"))


@query("j11_search_ensemble_voter", model_sql(_OOF.replace("500", "3.0") + """
, s AS (SELECT fold, avg(pow(y-(a+b)/2,2)) AS mse FROM o GROUP BY 1) SELECT round(sqrt(avg(mse)),7) AS cv_rmse FROM s"""))
def j11_voter(spark, sf):
    """Joint search of a voter; with one column, full PLS is least squares."""
    grams = gram_by_fold(model_obs(spark, sf), ["x4"], "y", fold=q("fold"))
    space = {"alpha_ridge": ("uniform", 3.0, 3.0), "n_components_pls": ("uniform", 1.0, 1.0), "voter1": ("uniform", 0.5, 0.5), "voter2": ("uniform", 0.5, 0.5)}
    return search_ensemble(grams, trial_table(spark, space, 1), ["ridge", "pls"]).select(rnd("cv_rmse", 7).alias("cv_rmse"))


@query("j11_search_ensemble_stack")
def j11_stack(spark, sf):
    grams = gram_by_fold(model_obs(spark, sf), FEATURES, "y", fold=q("fold"))
    space = {"alpha_ridge": SPACE["alpha"], "n_components_pls": ("quniform", 1, 5, 1), "alpha_ridge_meta": SPACE["alpha"]}
    return search_ensemble(grams, trial_table(spark, space, TRIALS), ["ridge", "pls"], "stack")


_JOINT_SQL = f""", lv AS (SELECT fold, x2 AS v, count(*)::DOUBLE AS n, sum(y) AS s, sum(y*y) AS ss FROM m GROUP BY 1,2)
, o AS (SELECT k, v, sum(n) AS n, sum(s) AS s FROM lv, (SELECT DISTINCT fold AS k FROM lv) WHERE fold <> k GROUP BY 1,2)
, cu AS (SELECT k, v, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY k) AS tn, sum(s) OVER (PARTITION BY k) AS ts FROM o WINDOW w AS (PARTITION BY k ORDER BY v))
, st AS (SELECT k, v AS cut, sl/nl AS low, (ts-sl)/(tn-nl) AS high FROM cu WHERE nl < tn
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY sl*sl/nl + (ts-sl)*(ts-sl)/(tn-nl) DESC, v) = 1)
, mo AS (SELECT k, sum(n*v)/sum(n) AS mx, sum(s)/sum(n) AS my, sum(n*v*v)-sum(n*v)*sum(n*v)/sum(n) AS sxx, sum(v*s)-sum(n*v)*sum(s)/sum(n) AS sxy FROM o GROUP BY k)
, t AS (SELECT i AS trial_id, exp(-6.907755278982137 + ((i*30011)%65521)/65521.0*11.512925464970229) AS alpha, ((i*40503)%65521)/65521.0 AS v1, ((i*12347)%65521)/65521.0 AS v2
  FROM range(1,{ENSEMBLE_TRIALS + 1}) g(i))
, p AS (SELECT trial_id, alpha, fold, n, s, ss, (v1*(my+sxy/(sxx+alpha)*(v-mx)) + v2*CASE WHEN v <= cut THEN low ELSE high END)/(v1+v2) AS p
  FROM t, lv JOIN mo ON mo.k=fold JOIN st ON st.k=fold)
, e AS (SELECT trial_id, alpha, fold, sum(ss-2*p*s+n*p*p)/sum(n) AS mse FROM p GROUP BY 1,2,3)
 SELECT trial_id, round(alpha,6) AS alpha, round(sqrt(avg(mse)),7) AS cv_rmse FROM e GROUP BY trial_id, alpha"""
_TREE_MEMBER = {"tree": lambda p: tree(int(p["max_depth"]))}


@query("j11_joint_voter_with_tree", model_sql(_JOINT_SQL))
def j11_joint_voter(spark, sf):
    """Fifty trials of a ridge and a one-split tree with their weights; the tree is fitted once per fold."""
    space = {"alpha_ridge": SPACE["alpha"], "voter1": ("uniform", 0.0, 1.0), "voter2": ("uniform", 0.0, 1.0), "max_depth_tree": ("quniform", 1, 1, 1)}
    scored = search_joint(model_obs(spark, sf), ["x2"], "y", "fold", trial_table(spark, space, ENSEMBLE_TRIALS), ["ridge", "tree"], _TREE_MEMBER)
    return scored.select("trial_id", rnd(q("params")["alpha_ridge"]).alias("alpha"), rnd("cv_rmse", 7).alias("cv_rmse"))


@query("j11_joint_stack_with_trees")
def j11_joint_stack(spark, sf):
    """Fifty trials of a stack of ridge, PLS and trees of several depths; folds left out in pairs for the meta model."""
    space = {"alpha_ridge": SPACE["alpha"], "n_components_pls": ("quniform", 1, 4, 1), "max_depth_tree": ("quniform", 2, 4, 1), "alpha_ridge_meta": SPACE["alpha"]}
    return search_joint(model_obs(spark, sf), FEATURES, "y", "fold", trial_table(spark, space, ENSEMBLE_TRIALS), ["ridge", "pls", "tree"], _TREE_MEMBER, "stack")
