"""Queries of the row and column predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators.features import row_mean
from tabkit.operators.roles import columns_matching
from tabkit.operators.rows import (
    apply_corrections, complete_cases, drop_columns, drop_first_match, drop_matching, drop_sparse_columns,
    mask_non_positive, null_shares, rename_safe, restore_names, take_split,
)
from tabkit.queries.obs import COLUMNS, obs, with_obs
from tabkit.queries.registry import query, rnd, table


@query("b1_take_split", with_obs("SELECT id, split, nation, price FROM obs WHERE split='train'"))
def b1(spark, sf):
    return take_split(obs(spark, sf, ("id", "split", "nation", "price")), "train")


@query("b2_drop_columns", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def b2(spark, sf):
    return drop_columns(table(spark, sf, "part"), ["p_name", "p_type"])


def _shares_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", (count(*)-count({c}))/count(*)::DOUBLE AS s, {'true' if c == 'price' else 'false'} AS k FROM obs"
        for c in COLUMNS)
    return with_obs(f', s AS ({parts}) SELECT "column", round(s,6) AS null_share, (s <= 0.2 OR k) AS kept FROM s')


@query("b3_null_shares", _shares_sql())
def b3(spark, sf):
    return null_shares(obs(spark, sf), 0.20, keep=["price"]).withColumn("null_share", rnd("null_share"))


@query("b3_drop_sparse_columns", with_obs(f"SELECT {', '.join(c for c in COLUMNS if c != 'sparse_note')} FROM obs"))
def b3_drop(spark, sf):
    return drop_sparse_columns(obs(spark, sf), 0.20, keep=["price"])


@query("b4_drop_matching", with_obs("""SELECT id, split, n_lines, gross, price FROM obs
 WHERE NOT coalesce(n_lines < 3 AND price > 200000, false) AND NOT coalesce(gross > 200000 AND price < 100000, false)"""))
def b4(spark, sf):
    df = obs(spark, sf, ("id", "split", "n_lines", "gross", "price"))
    return drop_matching(df, [(q("n_lines") < 3) & (q("price") > 200000), (q("gross") > 200000) & (q("price") < 100000)])


@query("b5_drop_first_match", with_obs("""
, f1 AS (SELECT min(id) AS k FROM obs WHERE n_lines < 3 AND price > 200000)
, f2 AS (SELECT min(id) AS k FROM obs WHERE n_ret > 2 AND price < 100000 AND id NOT IN (SELECT k FROM f1 WHERE k IS NOT NULL))
SELECT id, split, n_lines, n_ret, price FROM obs
 WHERE id NOT IN (SELECT k FROM f1 WHERE k IS NOT NULL) AND id NOT IN (SELECT k FROM f2 WHERE k IS NOT NULL)"""))
def b5(spark, sf):
    df = obs(spark, sf, ("id", "split", "n_lines", "n_ret", "price"))
    return drop_first_match(df, [(q("n_lines") < 3) & (q("price") > 200000), (q("n_ret") > 2) & (q("price") < 100000)])


@query("b6_apply_corrections", with_obs("""SELECT id, split, CASE WHEN split='test' AND id%97=0 THEN 2007 ELSE year_sold END AS year_sold,
 CASE WHEN split='train' AND id%89=0 THEN 'X' ELSE status END AS status FROM obs"""))
def b6(spark, sf):
    df = obs(spark, sf, ("id", "split", "year_sold", "status"))
    fixes = df.filter("split = 'test' and id % 97 = 0").select("split", "id", F.lit("year_sold").alias("column"), F.lit("2007").alias("value"))
    more = df.filter("split = 'train' and id % 89 = 0").select("split", "id", F.lit("status").alias("column"), F.lit("X").alias("value"))
    return apply_corrections(df, fixes.unionByName(more), ["split", "id"], ["year_sold", "status"])


@query("b7_complete_cases", with_obs("SELECT id, priority, acctbal, qty FROM obs WHERE priority IS NOT NULL AND acctbal IS NOT NULL AND qty IS NOT NULL"))
def b7(spark, sf):
    return complete_cases(obs(spark, sf, ("id", "priority", "acctbal", "qty")))


@query("b8_rename_safe", """SELECT p_partkey AS "1st key", p_name AS "name (all)", p_size+1 AS "size.1" FROM part""")
def b8(spark, sf):
    names = {"p_partkey": "1st key", "p_name": "name (all)", "p_size": "size.1"}
    df = rename_safe(table(spark, sf, "part").select(*names), names)
    safe = restore_names(df, names).withColumn("p_size", q("p_size") + 1)
    return rename_safe(safe, names)


@query("b9_mask_non_positive", with_obs("SELECT id, round(CASE WHEN acctbal>0 THEN ln(acctbal) END,6) AS acctbal, round(CASE WHEN tax0>0 THEN ln(tax0) END,6) AS tax0 FROM obs"))
def b9(spark, sf):
    df = mask_non_positive(obs(spark, sf, ("id", "acctbal", "tax0")), ["acctbal", "tax0"])
    return df.select("id", rnd("acctbal").alias("acctbal"), rnd("tax0").alias("tax0"))


@query("b10_columns_matching", with_obs("SELECT id, round((n_lines+n_ret)/2.0,6) AS avg_counts FROM obs"))
def b10(spark, sf):
    df = obs(spark, sf, ("id", "nation", "n_lines", "n_ret", "month_sold"))
    cols = columns_matching(df, contains=["n_"], excludes=["month"])
    return row_mean(df, "avg_counts", cols).select("id", rnd("avg_counts").alias("avg_counts"))
