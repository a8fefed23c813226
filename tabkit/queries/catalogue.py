"""All registered queries and the flagship one."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.operators.density import group_distribution
from tabkit.operators.encode import encode_ordinals
from tabkit.operators.features import log_transform
from tabkit.operators.impute import apply_fill
from tabkit.operators.ordering import column_quantiles
from tabkit.queries import dependence, derived, encoding, models, profiles, rows, sources  # noqa: F401
from tabkit.queries.obs import PRIORITY, obs, with_obs
from tabkit.queries.registry import QUERIES, SQL, query, rounded
from tabkit.session import store

__all__ = ["QUERIES", "SQL", "flagship"]


@query("flagship", with_obs("""
, md AS (SELECT median(acctbal) AS a FROM obs), mz AS (SELECT min(nullif(gross,0)) AS g FROM obs)
, e AS (SELECT CASE WHEN priority IS NULL THEN 0 ELSE 6 - CAST(left(priority,1) AS INTEGER) END AS code, coalesce(acctbal, a) AS acctbal,
   CASE WHEN gross=0 THEN ln(g) WHEN gross>0 THEN ln(gross) END AS log_gross, ln(price) AS log_price
  FROM obs, md, mz WHERE split='train')
SELECT 'priority' AS "column", CAST(code AS VARCHAR) AS level, count(*) AS n, round(min(log_price),6) AS low,
 round(quantile_cont(log_price,0.25),6) AS q1, round(quantile_cont(log_price,0.5),6) AS median, round(quantile_cont(log_price,0.75),6) AS q3,
 round(max(log_price),6) AS high, round(avg(acctbal),4) AS mean_acctbal, round(avg(log_gross),6) AS mean_log_gross FROM e GROUP BY code"""))
def flagship(spark, sf):
    """Codes, median fill, logs, then the log price per priority code over the training rows."""
    df = store(obs(spark, sf, ("id", "split", "priority", "acctbal", "gross", "price")))
    df = encode_ordinals(df, PRIORITY)
    df = apply_fill(df, column_quantiles(df, ["acctbal"]))
    df = log_transform(df, ["gross"], zero="min")
    train = df.filter("split = 'train'").withColumn("log_price", F.ln("price"))
    spread = group_distribution(train, ["priority"], "log_price")
    means = train.groupBy(F.col("priority").cast("string").alias("level")).agg(
        F.round(F.avg("acctbal"), 4).alias("mean_acctbal"), F.round(F.avg("log_gross"), 6).alias("mean_log_gross"))
    return rounded(spread.join(means, "level"), ["low", "q1", "median", "q3", "high"])
