"""The observation table: one row per order, with missing values put in by an arithmetic hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators.roles import Roles
from tabkit.queries.registry import table

KEY = ("split", "id")
CAT = ("segment", "status", "nation")
ORD = ("month_sold", "year_sold", "n_lines", "n_ret")
QUANT = ("acctbal", "qty", "gross", "tax0", "price")
QUANTS_FOR_WEIGHTS = ("acctbal", "qty", "gross", "tax0", "n_lines")
TEXT_ORD = ("priority", "sparse_note")
COLUMNS = ("id", "split", "segment", "status", "nation", "priority", "sparse_note", *ORD, *QUANT)
FROM_LINES = {"n_lines", "n_ret", "qty", "gross", "tax0"}
FROM_CUSTOMER = {"segment", "nation", "acctbal"}

ROLES = Roles(cat=CAT, ord=(*TEXT_ORD, *ORD), quant=QUANT, response="price", key=KEY)
NUMERIC_ROLES = Roles(cat=(*CAT, *TEXT_ORD), ord=ORD, quant=QUANT, response="price", key=KEY)

# Codes of the order priorities.
PRIORITY = {
    "priority": {None: 0, "5-LOW": 1, "4-NOT SPECIFIED": 2, "3-MEDIUM": 3, "2-HIGH": 4, "1-URGENT": 5}
}

OBS_SQL = """obs AS (
SELECT o.o_orderkey AS id,
 CASE WHEN (o.o_orderkey*40503)%65536%10 < 7 THEN 'train' ELSE 'test' END AS split,
 CASE WHEN (o.o_orderkey*40503)%65536%2111 = 0 THEN NULL ELSE c.c_mktsegment END AS segment,
 o.o_orderstatus AS status, n.n_name AS nation,
 CASE WHEN (o.o_orderkey*40503)%65536%13 = 0 THEN NULL ELSE o.o_orderpriority END AS priority,
 CASE WHEN (o.o_orderkey*40503)%65536%3 = 0 THEN NULL ELSE o.o_orderpriority END AS sparse_note,
 CAST(month(o.o_orderdate) AS BIGINT) AS month_sold, CAST(year(o.o_orderdate) AS BIGINT) AS year_sold,
 CAST(coalesce(l.n_lines,0) AS BIGINT) AS n_lines, CAST(coalesce(l.n_ret,0) AS BIGINT) AS n_ret,
 CASE WHEN (o.o_orderkey*40503)%65536%17 = 0 THEN NULL ELSE c.c_acctbal END AS acctbal,
 l.qty AS qty, l.gross AS gross, coalesce(l.tax0,0.0) AS tax0,
 CASE WHEN (o.o_orderkey*40503)%65536%10 < 7 THEN o.o_totalprice END AS price
FROM orders o JOIN customer c ON o.o_custkey=c.c_custkey JOIN nation n ON c.c_nationkey=n.n_nationkey
LEFT JOIN (SELECT l_orderkey, count(*) n_lines,
   sum(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) n_ret, round(sum(l_quantity),2) qty,
   round(sum(l_extendedprice),2) gross, round(sum(l_tax),2) tax0
   FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey=o.o_orderkey)"""


def with_obs(body: str) -> str:
    """SQL text over the observation table; ``body`` may add further named queries."""
    return f"WITH {OBS_SQL}{body if body.lstrip().startswith(',') else ' ' + body}"


def obs(spark: SparkSession, sf: str, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Observation table with the wanted columns; tables not needed for them are not read."""
    want = set(columns)
    o = table(spark, sf, "orders")
    h = (q("o_orderkey") * 40503) % 65536
    joined = o
    if want & FROM_CUSTOMER:
        c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
        joined = joined.join(c, joined["o_custkey"] == c["c_custkey"])
    if "nation" in want:
        n = table(spark, sf, "nation").select("n_nationkey", "n_name")
        joined = joined.join(n, joined["c_nationkey"] == n["n_nationkey"])
    if want & FROM_LINES:
        lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("_lines"), F.count_if(q("l_returnflag") == "R").alias("_ret"),
            F.round(F.sum("l_quantity"), 2).alias("_qty"), F.round(F.sum("l_extendedprice"), 2).alias("_gross"),
            F.round(F.sum("l_tax"), 2).alias("_tax"),
        )
        joined = joined.join(lines, joined["o_orderkey"] == lines["l_orderkey"], "left")
    train = h % 10 < 7
    made = {
        "id": lambda: q("o_orderkey"),
        "split": lambda: F.when(train, "train").otherwise("test"),
        "segment": lambda: F.when(h % 2111 != 0, q("c_mktsegment")),
        "status": lambda: q("o_orderstatus"),
        "nation": lambda: q("n_name"),
        "priority": lambda: F.when(h % 13 != 0, q("o_orderpriority")),
        "sparse_note": lambda: F.when(h % 3 != 0, q("o_orderpriority")),
        "month_sold": lambda: F.month("o_orderdate").cast("bigint"),
        "year_sold": lambda: F.year("o_orderdate").cast("bigint"),
        "n_lines": lambda: F.coalesce(q("_lines"), F.lit(0).cast("bigint")),
        "n_ret": lambda: F.coalesce(q("_ret"), F.lit(0).cast("bigint")),
        "acctbal": lambda: F.when(h % 17 != 0, q("c_acctbal")),
        "qty": lambda: q("_qty"),
        "gross": lambda: q("_gross"),
        "tax0": lambda: F.coalesce(q("_tax"), F.lit(0.0)),
        "price": lambda: F.when(train, q("o_totalprice")),
    }
    return joined.select(*[made[c]().alias(c) for c in columns])


def model_obs(spark: SparkSession, sf: str) -> DataFrame:
    """Complete numeric table for model fitting: train rows, label = log price, five features, fold."""
    from tabkit.functions.expr import fold_of
    from tabkit.operators.impute import apply_fill
    from tabkit.operators.ordering import column_quantiles

    df = obs(spark, sf, ("id", "split", "month_sold", "n_lines", "n_ret", "qty", "gross", "price"))
    df = df.filter(q("split") == "train")
    # orders without lines have the medians of the others
    df = apply_fill(df, column_quantiles(df, ["qty", "gross"]))
    return df.select(
        "id", (q("month_sold") / 12).alias("x1"), (q("n_lines") / 10).alias("x2"), (q("n_ret") / 10).alias("x3"),
        (q("qty") / 100).alias("x4"), (q("gross") / 100000).alias("x5"), F.ln("price").alias("y"),
        fold_of(q("id"), 5).alias("fold"),
    )


FEATURES = ["x1", "x2", "x3", "x4", "x5"]

MODEL_SQL = """, m AS (SELECT id, month_sold/12.0 AS x1, n_lines/10.0 AS x2, n_ret/10.0 AS x3,
 coalesce(qty, (SELECT median(qty) FROM obs WHERE split='train'))/100 AS x4,
 coalesce(gross, (SELECT median(gross) FROM obs WHERE split='train'))/100000 AS x5, ln(price) AS y, CAST((id*30011)%65521%5 AS BIGINT) AS fold
 FROM obs WHERE split='train')"""
