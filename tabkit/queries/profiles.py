"""Queries of the profiling aggregations and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators.density import (
    group_distribution, group_histogram, histogram, joint_density, kde, log_histogram, scatter_points,
)
from tabkit.operators.profile import (
    columns_with_nulls, discrete_distributions, dominant_columns, levels_by_first_seen, metric_summary, min_values,
    null_columns_by_role, null_counts, null_counts_by_split, null_only_in, null_share_by_split, null_share_in_both,
    rare_levels, value_counts,
)
from tabkit.queries.obs import COLUMNS, ROLES, obs, with_obs
from tabkit.queries.registry import query, rounded, table
from tabkit.session import store

NULLABLE = ("segment", "priority", "sparse_note", "acctbal", "qty", "gross", "price")


def _null_sql(extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*)-count({c}) AS nulls FROM obs {extra}" for c in COLUMNS)


def _split_sql(cols=tuple(c for c in COLUMNS if c not in ("split", "price"))) -> str:
    return " UNION ALL ".join(
        f"SELECT split, '{c}' AS \"column\", count(*)-count({c}) AS nulls FROM obs GROUP BY split" for c in cols)


@query("c1_null_counts", with_obs(f', n AS ({_null_sql()}) SELECT * FROM n WHERE nulls > 0'))
def c1(spark, sf):
    return null_counts(obs(spark, sf))


@query("c2_columns_with_nulls", with_obs(f"SELECT {', '.join(c for c in COLUMNS if c in NULLABLE)} FROM obs"))
def c2(spark, sf):
    return columns_with_nulls(obs(spark, sf))


def _role_case() -> str:
    return "CASE " + " ".join(f"WHEN \"column\"='{c}' THEN '{k}'" for k in ("cat", "ord", "quant") for c in ROLES.of(k)) + " END"


@query("c3_null_columns_by_role", with_obs(f', n AS ({_null_sql()}) SELECT {_role_case()} AS role, "column", nulls FROM n WHERE nulls > 0'))
def c3(spark, sf):
    return null_columns_by_role(obs(spark, sf), ROLES)


@query("c4_null_share_by_split", with_obs(f', n AS ({_split_sql()}) SELECT split, "column", nulls, '
       'round(nulls / sum(nulls) OVER (PARTITION BY split), 6) AS share FROM n WHERE nulls > 0'))
def c4(spark, sf):
    return rounded(null_share_by_split(obs(spark, sf), exclude=["price"]), ["share"])


@query("c4_null_counts_by_split", with_obs(f', n AS ({_split_sql()}) SELECT split, "column", nulls FROM n WHERE nulls > 0'))
def c4_counts(spark, sf):
    return null_counts_by_split(obs(spark, sf), exclude=["price"])


@query("c5_null_share_in_both", with_obs(f"""
, n AS (SELECT split, "column", nulls, nulls / sum(nulls) OVER (PARTITION BY split) AS share FROM ({_split_sql()}) WHERE nulls > 0)
SELECT a."column", round(a.share,6) AS train_share, round(b.share,6) AS test_share FROM n a JOIN n b USING ("column")
WHERE a.split='train' AND b.split='test' """))
def c5(spark, sf):
    return rounded(null_share_in_both(obs(spark, sf), exclude=["price"]), ["train_share", "test_share"])


@query("c6_null_only_in", with_obs(f"""
, n AS (SELECT * FROM ({_split_sql(tuple(c for c in COLUMNS if c != 'split'))}) WHERE nulls > 0)
SELECT split, "column", nulls FROM n WHERE "column" IN (SELECT "column" FROM n GROUP BY "column" HAVING count(*)=1)"""))
def c6(spark, sf):
    return null_only_in(obs(spark, sf))


def _counts_sql(pairs, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in pairs)


@query("c7_value_counts", with_obs(f", v AS ({_counts_sql(('segment', 'status', 'nation', 'priority', 'month_sold', 'n_lines'), 'obs')}) SELECT * FROM v"))
def c7(spark, sf):
    return value_counts(obs(spark, sf), ["segment", "status", "nation", "priority", "month_sold", "n_lines"])


@query("c7_value_counts_documents", f"SELECT * FROM ({_counts_sql(('lang', 'source', 'n_chars'), 'documents')})")
def c7_docs(spark, sf):
    return value_counts(table(spark, sf, "documents"), ["lang", "source", "n_chars"])


@query("c8_rare_levels", with_obs(f""", v AS ({_counts_sql(('nation', 'n_lines', 'n_ret', 'month_sold'), 'obs')})
 SELECT "column", value, n FROM v WHERE "column" IN (SELECT "column" FROM v WHERE n < 300)"""))
def c8(spark, sf):
    return rare_levels(obs(spark, sf, ("nation", "n_lines", "n_ret", "month_sold")), ["nation", "n_lines", "n_ret", "month_sold"], 300)


@query("c9_dominant_columns", with_obs(f"""
, v AS (SELECT *, n / sum(n) OVER (PARTITION BY "column") AS share FROM ({_counts_sql(('status', 'n_ret', 'nation'), 'obs')}))
 SELECT "column", value, n, round(share,6) AS share FROM v WHERE "column" IN (SELECT "column" FROM v WHERE share > 0.3)"""))
def c9(spark, sf):
    return rounded(dominant_columns(obs(spark, sf, ("status", "n_ret", "nation")), ["status", "n_ret", "nation"], 0.3), ["share"])


@query("c10_discrete_distributions", f"""SELECT "column", value, n, round(n / sum(n) OVER (PARTITION BY "column"),6) AS share
 FROM ({_counts_sql(('l_returnflag', 'l_linestatus', 'l_linenumber', 'l_suppkey'), 'lineitem')})""")
def c10(spark, sf):
    cols = ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"]
    return rounded(discrete_distributions(table(spark, sf, "lineitem"), cols), ["share"])


@query("c11_min_values", with_obs("SELECT least(min(qty),min(gross),min(tax0)) AS min_value, "
       "least(min(nullif(qty,0)),min(nullif(gross,0)),min(nullif(tax0,0))) AS min_nonzero FROM obs"))
def c11(spark, sf):
    return min_values(obs(spark, sf, ("qty", "gross", "tax0")), ["qty", "gross", "tax0"])


@query("c12_levels_by_first_seen", with_obs("""SELECT priority AS value, split_order, id FROM (
 SELECT priority, CAST(CASE WHEN split='train' THEN 0 ELSE 1 END AS INTEGER) AS split_order, id,
  row_number() OVER (PARTITION BY priority ORDER BY CASE WHEN split='train' THEN 0 ELSE 1 END, id) AS r
 FROM obs WHERE priority IS NOT NULL) WHERE r=1"""))
def c12(spark, sf):
    df = obs(spark, sf, ("id", "split", "priority")).withColumn("split_order", F.when(q("split") == "train", 0).otherwise(1))
    return levels_by_first_seen(df, "priority", ["split_order", "id"])


def _hist_sql(source: str, cols, bins: int, pre: str = "") -> str:
    long = " UNION ALL ".join(f"SELECT {i} AS k, {c} AS x FROM {source} WHERE {c} IS NOT NULL" for i, c in enumerate(cols))
    names = "CASE k " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(cols)) + " END"
    return f"""{pre} l AS ({long}), r AS (SELECT k, min(x) AS lo, max(x) AS hi, count(*) AS t FROM l GROUP BY k),
 b AS (SELECT k, least(CAST(floor((x-lo)/((hi-lo)/{bins})) AS BIGINT), {bins - 1}) AS bin, lo, (hi-lo)/{bins} AS w, t FROM l JOIN r USING (k))
 SELECT {names} AS "column", CAST(bin AS BIGINT) AS bin, round(min(lo)+bin*min(w),6) AS bin_start, count(*) AS n, round(count(*)/(min(t)*min(w)),9) AS density FROM b GROUP BY k, bin"""


@query("c13_histogram", _hist_sql("events", ["value"], 20, "WITH"))
def c13(spark, sf):
    return rounded(rounded(histogram(table(spark, sf, "events"), ["value"], 20), ["bin_start"]), ["density"], 9)


@query("c13_histogram_obs", with_obs("," + _hist_sql("obs", ["acctbal", "qty", "gross"], 16)))
def c13_obs(spark, sf):
    df = histogram(obs(spark, sf, ("acctbal", "qty", "gross")), ["acctbal", "qty", "gross"], 16)
    return rounded(rounded(df, ["bin_start"]), ["density"], 9)


@query("c13_kde", """WITH r AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS t FROM events),
 b AS (SELECT least(CAST(floor((value-lo)/((hi-lo)/256)) AS BIGINT), 255) AS bin, count(*) AS n FROM events, r GROUP BY 1),
 g AS (SELECT unnest(generate_series(0,31)) AS point)
 SELECT 'value' AS "column", CAST(point AS BIGINT) AS point, round(min(lo)+(min(hi)-min(lo))*point/31,6) AS x,
  round(sum(n*exp(-pow(((bin+0.5)/256 - point/31.0)/0.05,2)/2))/(min(t)*(min(hi)-min(lo))*0.05*sqrt(2*pi())),9) AS density
 FROM b, g, r GROUP BY point""")
def c13_kde(spark, sf):
    return rounded(rounded(kde(table(spark, sf, "events"), ["value"], 32), ["x"]), ["density"], 9)


@query("c14_log_histogram", with_obs(", p AS (SELECT CASE WHEN acctbal>0 THEN ln(acctbal) END AS acctbal, CASE WHEN tax0>0 THEN ln(tax0) END AS tax0 FROM obs)," + _hist_sql("p", ["acctbal", "tax0"], 12)))
def c14(spark, sf):
    df = log_histogram(obs(spark, sf, ("acctbal", "tax0")), ["acctbal", "tax0"], 12)
    return rounded(rounded(df, ["bin_start"]), ["density"], 9)


def _dist_sql(cols) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS level, count(*) AS n, round(min(y),6) AS low, round(quantile_cont(y,0.25),6) AS q1,
 round(quantile_cont(y,0.5),6) AS median, round(quantile_cont(y,0.75),6) AS q3, round(max(y),6) AS high FROM t WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in cols)


@query("c15_group_distribution", with_obs(f", t AS (SELECT *, ln(price) AS y FROM obs WHERE price IS NOT NULL), d AS ({_dist_sql(('priority', 'nation', 'n_lines'))}) SELECT * FROM d"))
def c15(spark, sf):
    df = store(obs(spark, sf, ("priority", "nation", "n_lines", "price"))).withColumn("y", F.ln("price"))
    return rounded(group_distribution(df, ["priority", "nation", "n_lines"], "y"), ["low", "q1", "median", "q3", "high"])


@query("c15_group_distribution_events", """SELECT 'event_type' AS "column", event_type AS level, count(*) AS n, min(value) AS low,
 round(quantile_cont(value,0.25),6) AS q1, round(quantile_cont(value,0.5),6) AS median, round(quantile_cont(value,0.75),6) AS q3, max(value) AS high
 FROM events GROUP BY event_type""")
def c15_events(spark, sf):
    return rounded(group_distribution(table(spark, sf, "events"), ["event_type"], "value"), ["q1", "median", "q3"])


@query("c15_group_histogram", """WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
 SELECT 'event_type' AS "column", event_type AS level, CAST(least(CAST(floor((value-lo)/((hi-lo)/10)) AS BIGINT),9) AS BIGINT) AS bin, count(*) AS n
 FROM events, r GROUP BY 2,3""")
def c15_hist(spark, sf):
    return group_histogram(table(spark, sf, "events"), ["event_type"], "value", 10)


@query("c16_joint_density", with_obs("""
, t AS (SELECT qty, gross, ln(price) AS y FROM obs WHERE price IS NOT NULL)
, ry AS (SELECT min(y) AS ylo, max(y) AS yhi FROM t)
, l AS (SELECT 'qty' AS "column", qty AS x, y FROM t WHERE qty IS NOT NULL UNION ALL SELECT 'gross', gross, y FROM t WHERE gross IS NOT NULL)
, rx AS (SELECT "column", min(x) AS lo, max(x) AS hi, count(*) AS t FROM l GROUP BY 1)
, b AS (SELECT "column", CAST(least(CAST(floor((x-lo)/((hi-lo)/8)) AS BIGINT),7) AS BIGINT) AS x_bin,
   CAST(least(CAST(floor((y-ylo)/((yhi-ylo)/8)) AS BIGINT),7) AS BIGINT) AS y_bin, (hi-lo)/8*((yhi-ylo)/8) AS a, t
  FROM l JOIN rx USING ("column"), ry)
SELECT "column", x_bin, y_bin, count(*) AS n, round(count(*)/(min(t)*min(a)),9) AS density FROM b GROUP BY 1,2,3"""))
def c16(spark, sf):
    df = obs(spark, sf, ("qty", "gross", "price")).withColumn("y", F.ln("price"))
    return rounded(joint_density(df, ["qty", "gross"], "y", 8), ["density"], 9)


@query("c17_scatter_points", with_obs("""SELECT id, 'acctbal' AS variable, acctbal AS x, price AS y FROM obs WHERE price IS NOT NULL AND acctbal IS NOT NULL
 UNION ALL SELECT id, 'gross', gross, price FROM obs WHERE price IS NOT NULL AND gross IS NOT NULL"""))
def c17(spark, sf):
    return scatter_points(obs(spark, sf, ("id", "acctbal", "gross", "price")), ["acctbal", "gross"], "price")


@query("c17_log_scatter_points", with_obs("""SELECT id, 'acctbal' AS variable, round(ln(acctbal),6) AS x, price AS y FROM obs WHERE price IS NOT NULL AND acctbal > 0"""))
def c17_log(spark, sf):
    return rounded(scatter_points(obs(spark, sf, ("id", "acctbal", "price")), ["acctbal"], "price", log_x=True), ["x"])


@query("c18_metric_summary", "SELECT round(avg(o_totalprice),4) AS mean, round(stddev_samp(o_totalprice),4) AS std FROM orders")
def c18(spark, sf):
    return rounded(metric_summary(table(spark, sf, "orders"), "o_totalprice"), ["mean", "std"], 4)
