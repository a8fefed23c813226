"""Queries of encoding, imputation and scaling."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators.encode import (
    encode_ordinals, inverse_scale, label_encode_ordinals, min_max_scale, model_matrix, one_hot, ordinal_map_from_data,
    round_numeric, unmapped_levels,
)
from tabkit.operators.impute import (
    apply_fill, complete_case_medians, group_mode_fill, impute_categorical, impute_categoricals, impute_chained, impute_few,
)
from tabkit.operators.moments import gram_by_fold
from tabkit.operators.regress import fit_ridge
from tabkit.operators.impute import match_donors
from tabkit.operators.roles import Roles
from tabkit.operators.sparse import sparse_model_matrix, sparse_one_hot
from tabkit.queries.obs import KEY, PRIORITY, obs, with_obs
from tabkit.queries.registry import query, rnd, rounded, table
from tabkit.session import store



@query("e1_encode_ordinals", with_obs("SELECT id, CAST(CASE WHEN priority IS NULL THEN 0 ELSE 6 - CAST(left(priority,1) AS INTEGER) END AS BIGINT) AS priority FROM obs"))
def e1(spark, sf):
    return encode_ordinals(obs(spark, sf, ("id", "priority")), PRIORITY)


@query("e1_unmapped_levels", with_obs("""SELECT 'priority' AS "column", priority AS value, count(*) AS n FROM obs
 WHERE priority IS NULL OR priority IN ('4-NOT SPECIFIED','5-LOW') GROUP BY priority"""))
def e1_report(spark, sf):
    return unmapped_levels(obs(spark, sf, ("id", "priority")), {"priority": {"1-URGENT": 2, "2-HIGH": 1, "3-MEDIUM": 0}})


@query("e2_ordinal_map_from_data", with_obs("""
, f AS (SELECT priority AS value, min((CASE WHEN split='train' THEN 0 ELSE 1000000000000 END) + id) AS k FROM obs WHERE priority IS NOT NULL GROUP BY 1)
SELECT value, row_number() OVER (ORDER BY k DESC) - 1 AS code FROM f"""))
def e2(spark, sf):
    df = obs(spark, sf, ("id", "split", "priority")).withColumn("split_order", F.when(q("split") == "train", 0).otherwise(1))
    return ordinal_map_from_data(df, "priority", ["split_order", "id"])


@query("e3_label_encode_ordinals", with_obs("""
, p AS (SELECT priority AS v, row_number() OVER (ORDER BY priority)-1 AS c FROM (SELECT DISTINCT priority FROM obs WHERE priority IS NOT NULL AND split='train'))
, m AS (SELECT n_lines AS v, row_number() OVER (ORDER BY n_lines)-1 AS c FROM (SELECT DISTINCT n_lines FROM obs WHERE split='train'))
SELECT id, p.c AS priority, m.c AS n_lines FROM obs LEFT JOIN p ON priority=p.v LEFT JOIN m ON n_lines=m.v"""))
def e3(spark, sf):
    df = obs(spark, sf, ("id", "split", "priority", "n_lines"))
    return label_encode_ordinals(df, ["priority", "n_lines"], fit_on=df.filter("split = 'train'")).drop("split")


def _mode(c: str) -> str:
    return f"(SELECT {c} FROM obs WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


FEW = {"segment": 2000, "priority": 1000, "qty": 500, "acctbal": 100}


def _few(c: str, value: str) -> str:
    return f"CASE WHEN (SELECT count(*) FROM obs WHERE {c} IS NULL) <= {FEW[c]} THEN coalesce({c}, {value}) ELSE {c} END AS {c}"


@query("e4_impute_few", with_obs(f"""SELECT id, split, {_few('segment', _mode('segment'))}, {_few('priority', _mode('priority'))},
 {_few('qty', '(SELECT median(qty) FROM obs)')}, {_few('acctbal', '(SELECT median(acctbal) FROM obs)')}, n_lines FROM obs"""))
def e4(spark, sf):
    df = store(obs(spark, sf, ("id", "split", "segment", "priority", "qty", "acctbal", "n_lines")))
    # fixed limits; each column has its own, so one call per column
    for c in ("segment", "priority"):
        df = impute_few(df, Roles(cat=(c,), key=KEY), max_cat=FEW[c])
    for c in ("qty", "acctbal"):
        df = impute_few(df, Roles(quant=(c,), key=KEY), max_quant=FEW[c])
    return df


@query("e5_impute_categorical")
def e5(spark, sf):
    df = store(obs(spark, sf, ("id", "split", "segment", "status", "month_sold", "n_lines", "acctbal", "price")))
    roles = Roles(cat=("segment", "status"), ord=("month_sold", "n_lines"), quant=("acctbal",), response="price", key=KEY)
    return impute_categorical(df, "segment", roles, "price").select("id", "segment", "status", "acctbal")


@query("e5_impute_categoricals")
def e5_all(spark, sf):
    df = store(obs(spark, sf, ("id", "split", "segment", "status", "priority", "n_lines", "price")))
    roles = Roles(cat=("segment", "status", "priority"), ord=("n_lines",), response="price", key=KEY)
    done = impute_categoricals(df, roles, "price")
    return done.groupBy("segment", "priority").agg(F.count(F.lit(1)).alias("n"))


@query("e5_group_mode_fill", with_obs("""
, c AS (SELECT nation, priority, count(*) AS n FROM obs WHERE priority IS NOT NULL GROUP BY 1,2)
, m AS (SELECT nation, priority AS mode FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY n DESC, priority) AS r FROM c) WHERE r=1)
SELECT id, nation, coalesce(priority, mode) AS priority FROM obs LEFT JOIN m USING (nation)"""))
def e5_mode(spark, sf):
    return group_mode_fill(obs(spark, sf, ("id", "nation", "priority")), "priority", "nation")


@query("e6_impute_chained")
def e6(spark, sf):
    df = store(obs(spark, sf, ("id", "month_sold", "n_lines", "n_ret", "tax0", "acctbal", "qty", "gross")))
    return impute_chained(df, "id", ["acctbal", "qty", "gross"], ["month_sold", "n_lines", "n_ret", "tax0"])


@query("e6_chained_one_predictor", with_obs("""
, l AS (SELECT regr_slope(acctbal, n_lines) AS b, regr_intercept(acctbal, n_lines) AS a FROM obs WHERE acctbal IS NOT NULL)
, d AS (SELECT id, acctbal, round(a+b*n_lines,6) AS p FROM obs, l WHERE acctbal IS NOT NULL)
, g AS (SELECT p, min_by(acctbal, id) AS first_value, max_by(acctbal, id) AS last_value, min(id) AS first_id, max(id) AS last_id FROM d GROUP BY p)
, m AS (SELECT id, round(a+b*n_lines,6) AS p FROM obs, l WHERE acctbal IS NULL)
, c AS (SELECT m.id, g.first_id AS donor, g.first_value AS v, abs(g.p-m.p) AS gap, row_number() OVER (PARTITION BY m.id ORDER BY g.p) AS r FROM m JOIN g ON g.p >= m.p
  UNION ALL SELECT m.id, g.last_id, g.last_value, abs(g.p-m.p), row_number() OVER (PARTITION BY m.id ORDER BY g.p DESC) FROM m JOIN g ON g.p < m.p)
, n AS (SELECT id, v, row_number() OVER (PARTITION BY id ORDER BY gap, donor) AS r FROM c WHERE r = 1)
SELECT obs.id, n_lines, coalesce(acctbal, v) AS acctbal FROM obs LEFT JOIN (SELECT * FROM n WHERE r = 1) n ON obs.id=n.id"""))
def e6_one(spark, sf):
    """One target, one predictor, one donor and no bootstrap: the nearest donor's value."""
    df = store(obs(spark, sf, ("id", "n_lines", "acctbal")))
    return impute_chained(df, "id", ["acctbal"], ["n_lines"], iterations=1, donors=1, bootstrap=False)


def _chained_sql() -> str:
    """Two targets regressed on each other in two rounds; every gap takes the value of the nearest donor."""
    steps, now = [], "b0"
    for i, (t, x) in enumerate([("qty", "acctbal"), ("acctbal", "qty")] * 2, 1):
        steps.append(f"""l{i} AS (SELECT regr_slope({t}, {x}) AS s, regr_intercept({t}, {x}) AS a FROM {now} WHERE NOT no_{t})
, d{i} AS (SELECT id, {t} AS v, round(a + s*{x}, 9) AS p FROM {now}, l{i} WHERE NOT no_{t})
, g{i} AS (SELECT p, min_by(v, id) AS first_v, max_by(v, id) AS last_v, min(id) AS first_id, max(id) AS last_id FROM d{i} GROUP BY p)
, m{i} AS (SELECT id, round(a + s*{x}, 9) AS p FROM {now}, l{i} WHERE no_{t})
, up{i} AS (SELECT m.id, g.first_id AS donor, g.first_v AS v, g.p - m.p AS gap FROM m{i} m ASOF JOIN g{i} g ON m.p <= g.p)
, dn{i} AS (SELECT m.id, g.last_id AS donor, g.last_v AS v, m.p - g.p AS gap FROM m{i} m ASOF JOIN g{i} g ON m.p > g.p)
, n{i} AS (SELECT id, arg_min(v, (gap, donor)) AS v FROM (SELECT * FROM up{i} UNION ALL SELECT * FROM dn{i}) GROUP BY id)
, b{i} AS (SELECT b.id, {"coalesce(n.v, qty) AS qty, acctbal" if t == "qty" else "qty, coalesce(n.v, acctbal) AS acctbal"}, no_qty, no_acctbal FROM {now} b LEFT JOIN n{i} n ON b.id = n.id)""")
        now = f"b{i}"
    return with_obs(""", st AS (SELECT (SELECT qty FROM obs, (SELECT avg(qty) AS c FROM obs) WHERE qty IS NOT NULL ORDER BY abs(qty-c), qty LIMIT 1) AS q0,
 (SELECT acctbal FROM obs, (SELECT avg(acctbal) AS c FROM obs) WHERE acctbal IS NOT NULL ORDER BY abs(acctbal-c), acctbal LIMIT 1) AS a0)
, b0 AS (SELECT id, coalesce(qty, q0) AS qty, coalesce(acctbal, a0) AS acctbal, qty IS NULL AS no_qty, acctbal IS NULL AS no_acctbal FROM obs, st)
, """ + "\n, ".join(steps) + f" SELECT id, qty, acctbal FROM {now}")


@query("e6_chained_two_rounds", _chained_sql())
def e6_two_rounds(spark, sf):
    """Two targets, two rounds, the nearest donor and no bootstrap: every step can be followed."""
    df = store(obs(spark, sf, ("id", "qty", "acctbal")))
    return impute_chained(df, "id", ["acctbal", "qty"], [], iterations=2, donors=1, bootstrap=False)


@query("e6_one_donor_step", with_obs("""
, l AS (SELECT regr_slope(acctbal, qty) AS b, regr_intercept(acctbal, qty) AS a FROM obs WHERE acctbal IS NOT NULL AND qty IS NOT NULL)
, d AS (SELECT id, acctbal, round(a+b*qty,6) AS p FROM obs, l WHERE acctbal IS NOT NULL AND qty IS NOT NULL)
, m AS (SELECT id, round(a+b*qty,6) AS p FROM obs, l WHERE acctbal IS NULL AND qty IS NOT NULL)
, g AS (SELECT p, min(id) AS lo_id, max(id) AS hi_id FROM d GROUP BY p)
, n AS (SELECT m.id, m.p, (SELECT max(p) FROM g WHERE g.p <= m.p) AS below, (SELECT min(p) FROM g WHERE g.p > m.p) AS above FROM m)
SELECT id, round(least(coalesce(abs(p-below),1e300), coalesce(abs(above-p),1e300)),5) AS gap FROM n"""))
def e6_step(spark, sf):
    """Distance of the nearest donor's prediction, which the drawn donor must attain."""
    df = store(obs(spark, sf, ("id", "acctbal", "qty")).filter("qty is not null"))
    seen = df.filter("acctbal is not null")
    b, w = fit_ridge(gram_by_fold(seen, ["qty"], "acctbal")[0], 0.0)
    pred = F.round(F.lit(b) + F.lit(float(w[0])) * q("qty"), 6)
    holes = df.filter("acctbal is null").select("id", pred.alias("pred"))
    # the donor's own prediction is carried as its value
    drawn = match_donors(seen.select("id", pred.alias("pred"), pred.alias("value")), holes, "id", 1, lambda c: F.lit(0))
    return drawn.select("id", rnd(F.abs(q("pred") - q("_drawn")), 5).alias("gap"))


@query("e7_complete_case_medians", with_obs("""
SELECT 'acctbal' AS "column", median(acctbal) AS median FROM obs WHERE acctbal IS NOT NULL AND qty IS NOT NULL AND priority IS NOT NULL
UNION ALL SELECT 'qty', median(qty) FROM obs WHERE acctbal IS NOT NULL AND qty IS NOT NULL AND priority IS NOT NULL"""))
def e7(spark, sf):
    df = obs(spark, sf, ("id", "priority", "acctbal", "qty"))
    found = complete_case_medians(df, ["acctbal", "qty"], ["acctbal", "qty", "priority"])
    # attach the fitted values to the columns of the table itself
    shown = df.agg(*[F.max(F.lit(v)).alias(c) for c, v in found.items()])
    return shown.unpivot([], list(found), "column", "median")


def _flag(c: str, v: str) -> str:
    return f"CAST(CASE WHEN {c}='{v}' THEN 1 ELSE 0 END AS INTEGER) AS \"{c}_{v}\""


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("e8_one_hot", with_obs(f"SELECT id, {', '.join(_flag('status', v) for v in ('F', 'O', 'P'))}, {', '.join(_flag('priority', v) for v in PRIORITIES)} FROM obs"))
def e8(spark, sf):
    return one_hot(obs(spark, sf, ("id", "status", "priority")), ["status", "priority"])


@query("e8_sparse_one_hot", """WITH l AS (SELECT 'o_custkey' AS "column", o_custkey AS k, CAST(o_custkey AS VARCHAR) AS value, count(*) AS total FROM orders WHERE o_custkey IS NOT NULL GROUP BY 2
 UNION ALL SELECT 'o_orderpriority', NULL, o_orderpriority, count(*) FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 3)
SELECT row_number() OVER (ORDER BY "column", k, value) - 1 AS slot, "column", value, CAST(total AS DOUBLE) AS total FROM l""")
def e8_sparse(spark, sf):
    """Flags of every customer and priority, summed over all orders: one vector as wide as the levels."""
    made, names = sparse_one_hot(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), ["o_custkey", "o_orderpriority"])
    sums = made.agg(Summarizer.sum(q("features")).alias("s")).select(F.posexplode(vector_to_array("s")).alias("slot", "total"))
    return sums.select(q("slot").cast("bigint").alias("slot"), "total").join(names, "slot").select("slot", "column", "value", "total")


@query("e9_min_max_scale", with_obs("""
, r AS (SELECT min(acctbal) a0, max(acctbal) a1, min(qty) q0, max(qty) q1 FROM obs)
SELECT id, round((acctbal-a0)/(a1-a0),8) AS acctbal, round((qty-q0)/(q1-q0),8) AS qty, CAST(0 AS DOUBLE) AS const FROM obs, r"""))
def e9(spark, sf):
    df = obs(spark, sf, ("id", "acctbal", "qty")).withColumn("const", F.lit(5.0))
    return rounded(min_max_scale(df, ["acctbal", "qty", "const"])[0], ["acctbal", "qty"], 8)


@query("e9_min_max_scale_train", with_obs("""
, r AS (SELECT min(qty) q0, max(qty) q1 FROM obs WHERE split='train') SELECT id, round((qty-q0)/(q1-q0),8) AS qty FROM obs, r"""))
def e9_train(spark, sf):
    df = obs(spark, sf, ("id", "split", "qty"))
    return rounded(min_max_scale(df, ["qty"], fit_on=df.filter("split = 'train'"))[0].drop("split"), ["qty"], 8)


@query("e10_inverse_scale", with_obs("SELECT id, round(acctbal,4) AS acctbal, round(gross,4) AS gross FROM obs"))
def e10(spark, sf):
    scaled, params = min_max_scale(obs(spark, sf, ("id", "acctbal", "gross")), ["acctbal", "gross"])
    return rounded(inverse_scale(scaled, params), ["acctbal", "gross"], 4)


@query("e11_round_numeric", "SELECT l_orderkey, l_linenumber, round_even(l_quantity/4, 0) AS quarter, round_even(l_tax*100, 0) AS tax FROM lineitem")
def e11(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (q("l_quantity") / 4).alias("quarter"), (q("l_tax") * 100).alias("tax"))
    return round_numeric(df)


@query("e12_model_matrix", with_obs(f"""
, r AS (SELECT min(acctbal) a0, max(acctbal) a1, min(n_lines) n0, max(n_lines) n1 FROM obs)
SELECT split, id, {', '.join(f"CAST(CASE WHEN status='{v}' THEN 1 ELSE 0 END AS DOUBLE) AS status_{v}" for v in ('F', 'O', 'P'))},
 round((acctbal-a0)/(a1-a0),8) AS acctbal, round((n_lines-n0)/(n1-n0)::DOUBLE,8) AS n_lines, price FROM obs, r"""))
def e12(spark, sf):
    df = obs(spark, sf, ("split", "id", "status", "n_lines", "acctbal", "price"))
    made, _ = model_matrix(df, Roles(cat=("status",), ord=("n_lines",), quant=("acctbal", "price"), response="price", key=KEY), "price")
    return rounded(made, ["acctbal", "n_lines"], 8)


@query("e12_sparse_model_matrix", with_obs(f"""
, r AS (SELECT max(abs(acctbal)) a, max(abs(n_lines))::DOUBLE n FROM obs)
SELECT split, id, {', '.join(f"CAST(CASE WHEN status='{v}' THEN 1 ELSE 0 END AS DOUBLE) AS status_{v}" for v in ('F', 'O', 'P'))},
 round(acctbal/a,8) AS acctbal, round(n_lines/n,8) AS n_lines, price FROM obs, r"""))
def e12_sparse(spark, sf):
    df = obs(spark, sf, ("split", "id", "status", "n_lines", "acctbal", "price"))
    made, _ = sparse_model_matrix(df, Roles(cat=("status",), ord=("n_lines",), quant=("acctbal", "price"), response="price", key=KEY), "price")
    x = vector_to_array("features")
    names = ["n_lines", "acctbal", "status_F", "status_O", "status_P"]
    return made.select("split", "id", *[F.round(F.when(~F.isnan(x[i]), x[i]), 8).alias(n) for i, n in enumerate(names)], "price")


@query("e4_apply_fill", with_obs("SELECT id, coalesce(priority,'none') AS priority, coalesce(qty,0) AS qty FROM obs"))
def e4_fill(spark, sf):
    return apply_fill(obs(spark, sf, ("id", "priority", "qty")), {"priority": "none", "qty": 0.0})
