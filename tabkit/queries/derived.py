"""Queries of feature derivation, reshaping and ranking."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators.depend import column_pairs, correlations
from tabkit.operators.features import (
    add_ratio, build_model_data, flag_any_nonzero, flag_nonzero, log_transform, recode, recode_hits, row_mean,
    split_xy, sum_columns, weighted_sum,
)
from tabkit.operators.ranking import (
    best_models, extreme_coefficients, pivot_ranks, rank_datasets_within_model, rank_models_within_dataset, sort_results,
    top_importances,
)
from tabkit.operators.reshape import append, attach_columns, melt, pivot_results, set_ops, side_by_side, top_k_union
from tabkit.operators.rows import drop_columns
from tabkit.plans.variants import build_variants
from tabkit.queries.obs import QUANTS_FOR_WEIGHTS, obs, with_obs
from tabkit.queries.registry import query, rnd, rounded, table, work_folder
from tabkit.session import settle, store
from tabkit.sources.bucketed import correct_bucketed, join_bucketed, write_bucketed

# The level merges used by the queries; the last rule of each matches nothing.
MERGES = {
    "priority": {"4-NOT SPECIFIED": "other", "5-LOW": "other", "9-NONE": "other"},
    "n_lines": {7: 6, 99: 6},
}


@query("f1_recode", with_obs("""SELECT id, CASE WHEN priority IN ('4-NOT SPECIFIED','5-LOW') THEN 'other' ELSE priority END AS priority,
 CASE WHEN n_lines=7 THEN 6 ELSE n_lines END AS n_lines FROM obs"""))
def f1(spark, sf):
    return recode(obs(spark, sf, ("id", "priority", "n_lines")), MERGES)


@query("f1_recode_hits", with_obs("""SELECT 'priority' AS "column", v AS old, count(priority) AS rows FROM (VALUES ('4-NOT SPECIFIED'),('5-LOW'),('9-NONE')) t(v)
 LEFT JOIN obs ON priority=v GROUP BY v UNION ALL SELECT 'n_lines', CAST(v AS VARCHAR), count(n_lines) FROM (VALUES (7),(99)) t(v) LEFT JOIN obs ON n_lines=v GROUP BY v"""))
def f1_hits(spark, sf):
    return recode_hits(obs(spark, sf, ("id", "priority", "n_lines")), MERGES)


@query("f2_weighted_sum", with_obs("SELECT id, n_lines + 2*n_ret AS points FROM obs"))
def f2(spark, sf):
    return weighted_sum(obs(spark, sf, ("id", "n_lines", "n_ret")), "points", {"n_lines": 1, "n_ret": 2})


@query("f3_row_mean", with_obs("""SELECT id, round((coalesce(acctbal,0)+coalesce(qty,0)+coalesce(gross,0))
 / nullif((acctbal IS NOT NULL)::INT+(qty IS NOT NULL)::INT+(gross IS NOT NULL)::INT,0),6) AS mean FROM obs"""))
def f3(spark, sf):
    df = row_mean(obs(spark, sf, ("id", "acctbal", "qty", "gross")), "mean", ["acctbal", "qty", "gross"])
    return df.select("id", rnd("mean").alias("mean"))


@query("f4_flag_nonzero", with_obs("SELECT id, CAST(CASE WHEN tax0=0 THEN 0 ELSE 1 END AS INTEGER) AS has_tax, CAST(CASE WHEN qty=0 THEN 0 ELSE 1 END AS INTEGER) AS has_qty FROM obs"))
def f4(spark, sf):
    df = flag_nonzero(obs(spark, sf, ("id", "tax0", "qty")), "has_tax", "tax0")
    return flag_nonzero(df, "has_qty", "qty").select("id", "has_tax", "has_qty")


@query("f5_flag_any_nonzero", with_obs("SELECT id, CAST(CASE WHEN n_ret=0 AND tax0=0 THEN 0 ELSE 1 END AS INTEGER) AS any_flag FROM obs"))
def f5(spark, sf):
    return flag_any_nonzero(obs(spark, sf, ("id", "n_ret", "tax0")), "any_flag", ["n_ret", "tax0"]).select("id", "any_flag")


@query("f6_sum_columns", with_obs("SELECT id, round(acctbal+qty+gross,4) AS total FROM obs"))
def f6(spark, sf):
    df = sum_columns(obs(spark, sf, ("id", "acctbal", "qty", "gross")), "total", ["acctbal", "qty", "gross"])
    return df.select("id", rnd("total", 4).alias("total"))


@query("f7_ratio", with_obs("SELECT id, round(gross/nullif(tax0,0),4) AS share FROM obs"))
def f7(spark, sf):
    df = add_ratio(obs(spark, sf, ("id", "gross", "tax0")), "share", "gross", "tax0")
    return df.select("id", rnd("share", 4).alias("share"))


@query("f8_log_zero", with_obs("""SELECT id, tax0, acctbal, round(CASE WHEN tax0=0 THEN 0 WHEN tax0>0 THEN ln(tax0) END,6) AS log_tax0,
 round(CASE WHEN acctbal=0 THEN 0 WHEN acctbal>0 THEN ln(acctbal) END,6) AS log_acctbal FROM obs"""))
def f8(spark, sf):
    df = log_transform(obs(spark, sf, ("id", "tax0", "acctbal")), ["tax0", "acctbal", "absent"], zero="zero")
    return rounded(df, ["log_tax0", "log_acctbal"])


@query("f9_log_min", with_obs("""SELECT id, round(CASE WHEN tax0=0 THEN ln((SELECT min(tax0) FROM obs WHERE tax0<>0)) WHEN tax0>0 THEN ln(tax0) END,6) AS log_tax0,
 round(CASE WHEN gross>0 THEN ln(gross) END,6) AS log_gross FROM obs"""))
def f9(spark, sf):
    df = log_transform(obs(spark, sf, ("id", "tax0", "gross")), ["tax0", "gross", "absent"], zero="min")
    return rounded(df, ["log_tax0", "log_gross"])


def _edit(df, present):
    df = recode(df, MERGES)
    df = weighted_sum(df, "points", {"n_lines": 1, "n_ret": 2})
    df = flag_nonzero(df, "has_tax", "tax0")
    df = add_ratio(df, "unit", "gross", "qty")
    return log_transform(df, ["tax0", "gross"], zero="min")


_VARIANT_COLUMNS = ("id", "split", "priority", "n_lines", "n_ret", "tax0", "qty", "gross", "acctbal", "price")


@query("f10_build_variants", with_obs("""
, e AS (SELECT *, CASE WHEN n_lines=7 THEN 6 ELSE n_lines END AS nl, CASE WHEN tax0=0 THEN ln((SELECT min(tax0) FROM obs WHERE tax0<>0)) ELSE ln(tax0) END AS lt FROM obs)
SELECT v AS dataset, split, count(*) AS n, round(avg(ln(price)),6) AS mean_log_price,
 round(avg(CASE WHEN v IN ('clean','drop') THEN n_lines ELSE nl + 2*n_ret END),6) AS mean_count,
 round(avg(CASE WHEN v IN ('clean','clean_edit') THEN acctbal END),6) AS mean_acctbal,
 round(avg(CASE WHEN v IN ('clean_edit','drop_edit') THEN lt ELSE tax0 END),6) AS mean_tax
FROM e, (VALUES ('clean'),('drop'),('clean_edit'),('drop_edit')) t(v) GROUP BY v, split"""))
def f10(spark, sf):
    parts = []
    made = build_variants(obs(spark, sf, _VARIANT_COLUMNS), ["acctbal"], _edit, "price")
    for name, df in made.items():
        count = q("points") if "points" in df.columns else q("n_lines")
        tax = q("log_tax0") if "log_tax0" in df.columns else q("tax0")
        balance = q("acctbal") if "acctbal" in df.columns else F.lit(None).cast("double")
        parts.append(df.groupBy("split").agg(
            F.count(F.lit(1)).alias("n"), rnd(F.avg("log_price")).alias("mean_log_price"), rnd(F.avg(count)).alias("mean_count"),
            rnd(F.avg(balance)).alias("mean_acctbal"), rnd(F.avg(tax)).alias("mean_tax"),
        ).withColumn("dataset", F.lit(name)))
    return append(parts)


@query("f11_build_model_data", with_obs("""
SELECT v AS dataset, split, count(*) AS n, round(sum(price),2) AS label_sum, round(sum(qty),2) AS qty_sum,
 round(sum(CASE WHEN v='clean' THEN acctbal END),2) AS acctbal_sum FROM obs, (VALUES ('clean'),('drop')) t(v) GROUP BY v, split"""))
def f11(spark, sf):
    df = obs(spark, sf, ("id", "split", "qty", "acctbal", "price"))
    long = build_model_data({"clean": df, "drop": drop_columns(df, ["acctbal"])}, "price")
    value = lambda c: F.sum(F.try_element_at("features", F.lit(c)))
    return long.groupBy("dataset", "split").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.sum("label"), 2).alias("label_sum"), rnd(value("qty"), 2).alias("qty_sum"),
        rnd(value("acctbal"), 2).alias("acctbal_sum"))


@query("f11_split_xy", with_obs("SELECT id, nation, qty, price FROM obs WHERE split='train'"))
def f11_split(spark, sf):
    x, y = split_xy(obs(spark, sf, ("id", "split", "nation", "qty", "price")), "price", "train")
    return x.join(y, "id")


@query("g1_attach_columns", with_obs("SELECT id, split, n_lines, CAST(CASE WHEN qty=0 THEN 0 ELSE 1 END AS INTEGER) AS has_qty FROM obs"))
def g1(spark, sf):
    df = obs(spark, sf, ("id", "split", "n_lines", "qty"))
    return attach_columns(df.drop("qty"), flag_nonzero(df, "has_qty", "qty"), ["has_qty"], ["split", "id"]).select("id", "split", "n_lines", "has_qty")


def _bucketed(df, key, buckets=8):
    """``df`` as a bucketed table under a name of its own in the shared folder."""
    name = f"t_{uuid.uuid4().hex}"
    write_bucketed(df, name, key, buckets, work_folder(df.sparkSession))
    return name


@query("g1_bucketed_join", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, l.n_lines, l.qty FROM orders
 LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, round(sum(l_quantity),2) AS qty FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey""")
def g1_bucketed(spark, sf):
    orders = table(spark, sf, "orders").drop("o_orderdate")
    lines = table(spark, sf, "lineitem").groupBy(q("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), rnd(F.sum("l_quantity"), 2).alias("qty"))
    a, b = _bucketed(orders, ["o_orderkey"]), _bucketed(lines, ["o_orderkey"])
    return join_bucketed(spark, {a: None, b: ["n_lines", "qty"]}, ["o_orderkey"])


@query("b6_bucketed_corrections", """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag='R') THEN NULL
 ELSE o_totalprice END AS o_totalprice FROM orders""")
def b6_bucketed(spark, sf):
    name = _bucketed(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"])
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(q("l_orderkey").alias("o_orderkey")).distinct()
    return correct_bucketed(spark, name, returned.withColumn("new", F.lit(None).cast("double")), ["o_orderkey"], "o_totalprice", "new")


@query("g2_side_by_side", with_obs("""
, a AS (SELECT n_lines AS k, count(*) AS n, round(avg(price),4) AS mean FROM obs WHERE split='train' AND n_ret>1 GROUP BY 1)
, b AS (SELECT n_lines AS k, count(*) AS n, round(avg(qty),4) AS mean FROM obs WHERE split='test' AND n_ret<2 GROUP BY 1)
SELECT k AS n_lines, a.n AS train_n, a.mean AS train_mean, b.n AS test_n, b.mean AS test_mean FROM a FULL JOIN b USING (k)"""))
def g2(spark, sf):
    df = obs(spark, sf, ("split", "n_lines", "n_ret", "qty", "price"))
    a = df.filter("split='train' and n_ret > 1").groupBy("n_lines").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("price"), 4).alias("mean"))
    b = df.filter("split='test' and n_ret < 2").groupBy("n_lines").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("qty"), 4).alias("mean"))
    return side_by_side({"train": a, "test": b}, ["n_lines"])


@query("g3_append", "SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderstatus='F' UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def g3(spark, sf):
    o = table(spark, sf, "orders")
    a = o.filter("o_orderstatus = 'F'").select(q("o_orderkey").alias("k"), q("o_totalprice").alias("v"))
    b = o.filter("o_totalprice > 100000").select(q("o_totalprice").alias("v"), q("o_orderkey").alias("k"))
    return append([a, b])


@query("g4_column_pairs", with_obs("""
, c AS (SELECT 1 AS i, 'acctbal' AS v UNION ALL SELECT 2,'qty' UNION ALL SELECT 3,'gross' UNION ALL SELECT 4,'price')
SELECT a.v AS var1, b.v AS var2, (SELECT count(*) FROM obs WHERE
  CASE a.v WHEN 'acctbal' THEN acctbal WHEN 'qty' THEN qty WHEN 'gross' THEN gross ELSE price END IS NOT NULL AND
  CASE b.v WHEN 'acctbal' THEN acctbal WHEN 'qty' THEN qty WHEN 'gross' THEN gross ELSE price END IS NOT NULL) AS n
FROM c a JOIN c b ON a.i < b.i"""))
def g4(spark, sf):
    """Rows holding both columns, for every unordered pair of columns."""
    cols = ["acctbal", "qty", "gross", "price"]
    pairs = column_pairs(cols)
    df = obs(spark, sf, cols)
    names = [f"{a}|{b}" for a, b in pairs]
    both = df.agg(*[F.count_if(q(a).isNotNull() & q(b).isNotNull()).alias(f"{a}|{b}") for a, b in pairs])
    return both.unpivot([], [q(n) for n in names], "pair", "n").select(
        F.split("pair", "\\|")[0].alias("var1"), F.split("pair", "\\|")[1].alias("var2"), "n")


@query("g5_set_ops", with_obs("""
, a AS (SELECT DISTINCT o_custkey AS v FROM orders WHERE o_orderstatus='F'), b AS (SELECT DISTINCT o_custkey AS v FROM orders WHERE o_totalprice > 300000)
SELECT coalesce(a.v,b.v) AS value, a.v IS NOT NULL AS in_a, b.v IS NOT NULL AS in_b FROM a FULL JOIN b ON a.v=b.v"""))
def g5(spark, sf):
    o = table(spark, sf, "orders")
    return set_ops(o.filter("o_orderstatus = 'F'"), o.filter("o_totalprice > 300000"), "o_custkey")


def _scores(spark, sf):
    """A comparison table made from the data: the spread of log price by nation (dataset) and month (model)."""
    df = obs(spark, sf, ("nation", "month_sold", "price")).filter("price is not null")
    return df.groupBy(q("nation").alias("dataset"), F.concat(F.lit("m"), q("month_sold")).alias("model")).agg(
        rnd(F.stddev_samp(F.ln("price"))).alias("train_rmse"), rnd(F.stddev_pop(F.ln("price"))).alias("cv_rmse"))


_SCORES = """, cmp AS (SELECT nation AS dataset, 'm' || month_sold AS model, round(stddev_samp(ln(price)),6) AS train_rmse,
 round(stddev_pop(ln(price)),6) AS cv_rmse FROM obs WHERE price IS NOT NULL GROUP BY 1,2)"""


@query("g6_melt", with_obs(_SCORES + """ SELECT dataset, model, 'train_rmse' AS performance, train_rmse AS value FROM cmp
 UNION ALL SELECT dataset, model, 'cv_rmse', cv_rmse FROM cmp"""))
def g6(spark, sf):
    return melt(_scores(spark, sf), ["dataset", "model"], "performance", "value")


def _pivot_sql() -> str:
    cols = ", ".join(f"max(CASE WHEN dataset='NATION_{d}' THEN {m} END) AS \"NATION_{d}_{m}\"" for d in range(25) for m in ("train_rmse", "cv_rmse"))
    return with_obs(_SCORES + f" SELECT model, {cols} FROM cmp GROUP BY model")


@query("g7_pivot_results", _pivot_sql())
def g7(spark, sf):
    names = [f"NATION_{d}" for d in range(25)]
    long = melt(_scores(spark, sf), ["dataset", "model"], "metric", "value")
    return pivot_results(long, names, ["train_rmse", "cv_rmse"])


@query("g8_top_k_union", with_obs(_SCORES + """ SELECT model || '_' || dataset AS name, CAST(NULL AS DOUBLE) AS test_rmse
 FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY cv_rmse, model) AS r FROM cmp) WHERE r <= 5"""))
def g8(spark, sf):
    names = [r["n_name"] for r in table(spark, sf, "nation").select("n_name").collect()]
    return top_k_union(_scores(spark, sf), names, 5)


@query("h1_sort_results", with_obs(_SCORES + " SELECT dataset, model, train_rmse, cv_rmse FROM cmp"))
def h1(spark, sf):
    return sort_results(_scores(spark, sf), "cv_rmse")


@query("h2_extreme_coefficients", with_obs(""", c AS (SELECT 'acctbal' AS feature, corr(acctbal, price) AS coef FROM obs UNION ALL SELECT 'qty', corr(qty, price) FROM obs
 UNION ALL SELECT 'gross', corr(gross, price) FROM obs UNION ALL SELECT 'tax0', corr(tax0, price) FROM obs UNION ALL SELECT 'n_lines', corr(n_lines, price) FROM obs)
 SELECT side, feature, round(coef,6) AS coef FROM (
 (SELECT 'positive' AS side, feature, coef FROM c ORDER BY coef DESC, feature LIMIT 2) UNION ALL (SELECT 'negative', feature, coef FROM c ORDER BY coef, feature LIMIT 2))"""))
def h2(spark, sf):
    cols = list(QUANTS_FOR_WEIGHTS)
    weights = settle(correlations(obs(spark, sf, (*cols, "price")), [*cols, "price"]).filter("var2 = 'price'").select(q("var1").alias("feature"), q("r").alias("coef")))
    return rounded(extreme_coefficients(weights, 2), ["coef"])


@query("h3_top_importances")
def h3(spark, sf):
    from tabkit.operators.regress import boosted_trees
    from tabkit.queries.obs import FEATURES, model_obs

    fitted = boosted_trees(max_depth=3, n_estimators=5).fit(store(model_obs(spark, sf)), FEATURES, "y")
    return top_importances(fitted.importances(spark), 3)


@query("h4_rank_models_within_dataset", with_obs(_SCORES + " SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY cv_rmse, model) AS rank FROM cmp"))
def h4(spark, sf):
    return rank_models_within_dataset(_scores(spark, sf))


@query("h5_rank_datasets_within_model", with_obs(_SCORES + " SELECT *, row_number() OVER (PARTITION BY model ORDER BY cv_rmse, dataset) AS rank FROM cmp"))
def h5(spark, sf):
    return rank_datasets_within_model(_scores(spark, sf))


@query("h5_pivot_ranks", with_obs(_SCORES + f""", r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY cv_rmse, dataset) AS rank FROM cmp)
 SELECT model, {", ".join(f"max(CASE WHEN dataset='NATION_{d}' THEN rank END) AS NATION_{d}" for d in range(25))} FROM r GROUP BY model"""))
def h5_pivot(spark, sf):
    return pivot_ranks(rank_datasets_within_model(_scores(spark, sf)), [f"NATION_{d}" for d in range(25)])


@query("h6_best_models", with_obs(_SCORES + " SELECT * FROM cmp WHERE dataset='NATION_3' ORDER BY cv_rmse, model LIMIT 4"))
def h6(spark, sf):
    return best_models(_scores(spark, sf), "NATION_3", 4)
