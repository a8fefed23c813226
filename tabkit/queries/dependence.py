"""Queries of the dependence and rank statistics."""

from __future__ import annotations

from itertools import combinations

from tabkit.functions.expr import q
from tabkit.operators.density import bin_index, column_ranges
from tabkit.operators.depend import (
    compare_rank_tests, correlation_matrix, dependence_distance, dependence_matrix, dependence_with_response,
    high_correlations, kendall, label_encode_all, rank_by, rank_pairs_by_correlation, rank_pairs_by_dependence, rank_test,
    spearman,
)
from tabkit.queries.obs import obs, with_obs
from tabkit.queries.registry import query, rnd, rounded, table

LINE_COLS = ("l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_linenumber")
QUANTS = ("acctbal", "qty", "gross", "tax0", "price")


def _code(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE dense_rank() OVER (ORDER BY {c} NULLS LAST) - 1 END AS {c}"


@query("d1_label_encode_all", with_obs(f"SELECT id, {', '.join(_code(c) for c in ('segment', 'nation', 'priority', 'n_lines', 'tax0'))} FROM obs"))
def d1(spark, sf):
    cols = ["segment", "nation", "priority", "n_lines", "tax0"]
    return label_encode_all(obs(spark, sf, ("id", *cols)), cols)


def _distance_sql(pairs, source: str) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, CAST({a} AS VARCHAR) AS v1, CAST({b} AS VARCHAR) AS v2, count(*)::DOUBLE AS n "
        f"FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a}, {b}" for a, b in pairs)
    return f"""cells AS ({cells}),
 tot AS (SELECT var1, var2, sum(n) AS t FROM cells GROUP BY 1,2),
 hj AS (SELECT var1, var2, -sum(n/t*ln(n/t)) AS h FROM cells JOIN tot USING (var1,var2) GROUP BY 1,2),
 ha AS (SELECT var1, var2, -sum(n/t*ln(n/t)) AS h FROM (SELECT var1,var2,v1,sum(n) AS n FROM cells GROUP BY 1,2,3) JOIN tot USING (var1,var2) GROUP BY 1,2),
 hb AS (SELECT var1, var2, -sum(n/t*ln(n/t)) AS h FROM (SELECT var1,var2,v2,sum(n) AS n FROM cells GROUP BY 1,2,3) JOIN tot USING (var1,var2) GROUP BY 1,2),
 dd AS (SELECT var1, var2, (2*hj.h - ha.h - hb.h)/nullif(hj.h,0) AS "D" FROM hj JOIN ha USING (var1,var2) JOIN hb USING (var1,var2))"""


@query("d2_dependence_distance", "WITH " + _distance_sql([("l_returnflag", "l_linestatus")], "lineitem") + ' SELECT var1, var2, round("D",8) AS "D" FROM dd')
def d2(spark, sf):
    return rounded(dependence_distance(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus"), ["D"], 8)


_PAIRS = "WITH " + _distance_sql(list(combinations(LINE_COLS, 2)), "lineitem")


@query("d3_dependence_matrix", _PAIRS + """ SELECT var1, var2, round("D",8) AS "D" FROM dd UNION ALL SELECT var2, var1, round("D",8) FROM dd
 UNION ALL SELECT v, v, 0.0 FROM (SELECT DISTINCT var1 AS v FROM dd UNION SELECT DISTINCT var2 FROM dd)""")
def d3(spark, sf):
    return rounded(dependence_matrix(table(spark, sf, "lineitem"), list(LINE_COLS)), ["D"], 8)


@query("d4_rank_pairs_by_dependence", _PAIRS + """, o AS (SELECT least(var1,var2) AS var1, greatest(var1,var2) AS var2, "D" FROM dd)
 SELECT var1, var2, round("D",8) AS "D", row_number() OVER (ORDER BY "D", var1, var2) AS rank FROM o WHERE "D" <= 0.9999""")
def d4(spark, sf):
    pairs = dependence_matrix(table(spark, sf, "lineitem"), list(LINE_COLS))
    return rounded(rank_pairs_by_dependence(pairs, 0.9999), ["D"], 8)


@query("d5_dependence_with_response", with_obs("""
, r AS (SELECT min(price) AS lo, max(price) AS hi FROM obs), b AS (SELECT priority, nation, n_lines, n_ret,
  least(CAST(floor((price-lo)/((hi-lo)/10)) AS BIGINT),9) AS pb FROM obs, r WHERE price IS NOT NULL), """
  + _distance_sql([(c, "pb") for c in ("priority", "nation", "n_lines", "n_ret")], "b") + ' SELECT var1 AS variable, round("D",8) AS "D" FROM dd'))
def d5(spark, sf):
    df = obs(spark, sf, ("priority", "nation", "n_lines", "n_ret", "price"))
    lo, hi, _ = column_ranges(df, ["price"])["price"]
    df = df.withColumn("price", bin_index(q("price"), lo, hi, 10))
    return rounded(dependence_with_response(df, "price"), ["D"], 8)


def _corr_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a},{b}) AS r FROM obs" for a, b in combinations(QUANTS, 2))


@query("d6_correlation_matrix", with_obs(f", c AS ({_corr_sql()}) SELECT var1, var2, round(r,6) AS r, round(abs(r),6) AS abs_r FROM c"))
def d6(spark, sf):
    return rounded(correlation_matrix(obs(spark, sf, QUANTS), list(QUANTS)), ["r", "abs_r"])


@query("d7_high_correlations", with_obs(f", c AS ({_corr_sql()}) SELECT var1, var2, CASE WHEN abs(r) >= 0.5 THEN round(r,6) END AS r FROM c"))
def d7(spark, sf):
    return rounded(high_correlations(obs(spark, sf, QUANTS), list(QUANTS), 0.5), ["r"])


@query("d8_rank_pairs_by_correlation", with_obs(f""", c AS ({_corr_sql()}) SELECT var1, var2, round(abs(r),6) AS abs_corr,
 row_number() OVER (ORDER BY abs(r), var1, var2) AS rank FROM c WHERE abs(r) >= 0.005"""))
def d8(spark, sf):
    return rounded(rank_pairs_by_correlation(obs(spark, sf, QUANTS), list(QUANTS), 0.005), ["abs_corr"])


RANKED = ("month_sold", "n_lines", "n_ret", "tax0")
def _normal(z: str) -> str:
    t = f"(1/(1+0.3275911*(abs({z})/sqrt(2.0))))"
    return (f"({t}*(0.254829592+{t}*(-0.284496736+{t}*(1.421413741+{t}*(-1.453152027+{t}*1.061405429))))"
            f"*exp(-(({z})*({z})/2.0)))")


_LONG = " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS x, price AS y FROM obs WHERE price IS NOT NULL AND {c} IS NOT NULL" for c in RANKED)
_SPEARMAN = f"""l AS ({_LONG}),
 rk AS (SELECT variable, rank() OVER (PARTITION BY variable ORDER BY x) + (count(*) OVER (PARTITION BY variable, x) - 1)/2.0 AS rx,
   rank() OVER (PARTITION BY variable ORDER BY y) + (count(*) OVER (PARTITION BY variable, y) - 1)/2.0 AS ry FROM l),
 sp AS (SELECT variable, corr(rx, ry) AS stat, corr(rx, ry)*sqrt(count(*)-1) AS z FROM rk GROUP BY variable)"""


@query("d9_rank_test_spearman", with_obs(f", {_SPEARMAN} SELECT variable, round(stat,6) AS stat, round(z,4) AS z, round({_normal('z')},5) AS p_val FROM sp"))
def d9(spark, sf):
    df = rank_test(obs(spark, sf, (*RANKED, "price")), list(RANKED), "price", "spearman")
    return rounded(rounded(rounded(df, ["stat"]), ["z"], 4), ["p_val"], 5)


def _kendall_sql(names, source: str, y: str) -> str:
    """Tau-b by all pairs of contingency cells."""
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y, count(*)::DOUBLE AS n FROM {source} WHERE {y} IS NOT NULL AND {c} IS NOT NULL GROUP BY {c}, {y}"
        for c in names)
    return f"""kc AS ({cells}),
 kn AS (SELECT a.variable, sum(a.n*b.n*sign(b.y-a.y)) AS s FROM kc a JOIN kc b ON a.variable=b.variable AND a.x < b.x GROUP BY a.variable),
 kx AS (SELECT variable, sum(n*(n-1)/2) AS p, sum(n*(n-1)*(n-2)) AS h, sum(n*(n-1)*(2*n+5)) AS v, sum(n) AS t FROM (SELECT variable, x, sum(n) AS n FROM kc GROUP BY 1,2) GROUP BY 1),
 ky AS (SELECT variable, sum(n*(n-1)/2) AS p, sum(n*(n-1)*(n-2)) AS h, sum(n*(n-1)*(2*n+5)) AS v FROM (SELECT variable, y, sum(n) AS n FROM kc GROUP BY 1,2) GROUP BY 1),
 kt AS (SELECT variable, s/sqrt((t*(t-1)/2-kx.p)*(t*(t-1)/2-ky.p)) AS stat,
   s/sqrt((t*(t-1)*(2*t+5)-kx.v-ky.v)/18 + 2*kx.p*ky.p/(t*(t-1)) + kx.h*ky.h/(9*t*(t-1)*(t-2))) AS z
   FROM kn JOIN kx USING (variable) JOIN ky USING (variable))"""


@query("d10_rank_test_kendall", "WITH " + _kendall_sql(["l_discount", "l_tax"], "lineitem", "l_quantity")
       + f" SELECT variable, round(stat,6) AS stat, round(z,4) AS z, round({_normal('z')},5) AS p_val FROM kt")
def d10(spark, sf):
    df = rank_test(table(spark, sf, "lineitem"), ["l_discount", "l_tax"], "l_quantity", "kendall")
    return rounded(rounded(rounded(df, ["stat"]), ["z"], 4), ["p_val"], 5)


@query("d10_kendall_continuous", with_obs(", " + _kendall_sql(["n_lines", "month_sold"], "obs", "price")
       + f" SELECT variable, round(stat,6) AS stat, round(z,4) AS z, round({_normal('z')},5) AS p_val FROM kt"))
def d10_cont(spark, sf):
    df = kendall(obs(spark, sf, ("n_lines", "month_sold", "price")), ["n_lines", "month_sold"], "price")
    return rounded(rounded(rounded(df, ["stat"]), ["z"], 4), ["p_val"], 5)


@query("d11_rank_by", "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS o_totalprice_rank FROM orders")
def d11(spark, sf):
    return rank_by(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"])


@query("d12_compare_rank_tests", with_obs(f""", {_SPEARMAN}, {_kendall_sql(RANKED[:3], 'obs', 'price')}
, s AS (SELECT variable, stat, z, {_normal('z')} AS p FROM sp WHERE variable <> 'tax0'), k AS (SELECT variable, stat, z, {_normal('z')} AS p FROM kt)
SELECT variable, round(s.stat,6) AS spearman, row_number() OVER (ORDER BY s.p, abs(s.z) DESC, variable) AS spearman_p_val_rank,
 round(k.stat,6) AS kendall, row_number() OVER (ORDER BY k.p, abs(k.z) DESC, variable) AS kendall_p_val_rank
FROM s FULL JOIN k USING (variable)"""))
def d12(spark, sf):
    df = obs(spark, sf, (*RANKED[:3], "price"))
    cols = list(RANKED[:3])
    both = compare_rank_tests({"spearman": spearman(df, cols, "price"), "kendall": kendall(df, cols, "price")})
    return both.select("variable", rnd("spearman").alias("spearman"), "spearman_p_val_rank", rnd("kendall").alias("kendall"), "kendall_p_val_rank")
