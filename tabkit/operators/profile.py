"""Null profiles, level counts and small summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators.ordering import to_long
from tabkit.operators.roles import KINDS, Roles
from tabkit.session import settle, sized_join


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with nulls and how many, from one pass."""
    cols = df.columns
    return (
        df.agg(*[F.count_if(q(c).isNull()).alias(c) for c in cols])
        .unpivot([], [q(c) for c in cols], "column", "nulls")
        .filter("nulls > 0")
    )


def columns_with_nulls(df: DataFrame) -> DataFrame:
    """Projection to the columns holding nulls; the whole table when there are none."""
    # one name per column
    found = {r["column"] for r in null_counts(df).collect()}
    return df.select(*[q(c) for c in df.columns if c in found]) if found else df


def role_table(df: DataFrame, roles: Roles) -> DataFrame:
    """Rows ``(column, role)`` of a table's schema."""
    rows = [(c, k) for k in KINDS for c in roles.of(k)]
    return df.sparkSession.createDataFrame(rows, "column string, role string")


def null_columns_by_role(df: DataFrame, roles: Roles) -> DataFrame:
    """Per role, the columns holding nulls with their counts."""
    if not any(roles.of(k) for k in KINDS):
        raise ValueError("roles are not set")
    kind = F.create_map(*[F.lit(x) for k in KINDS for c in roles.of(k) for x in (c, k)])
    return null_counts(df).select(
        kind[q("column")].alias("role"), "column", "nulls"
    ).filter("role is not null")


def null_counts_by_split(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows ``(split, column, nulls)`` for columns holding nulls in that split."""
    cols = [c for c in df.columns if c != "split" and c not in exclude]
    return (
        df.groupBy("split").agg(*[F.count_if(q(c).isNull()).alias(c) for c in cols])
        .unpivot("split", [q(c) for c in cols], "column", "nulls")
        .filter("nulls > 0")
    )


def null_share_by_split(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Per split, each column's share of all nulls of the split."""
    # one row per column and split
    whole = Window.partitionBy("split")
    return null_counts_by_split(df, exclude).withColumn("share", q("nulls") / F.sum("nulls").over(whole))


def null_share_in_both(df: DataFrame, a: str = "train", b: str = "test", exclude: Sequence[str] = ()) -> DataFrame:
    """Null shares of the columns with nulls in both splits."""
    wide = null_share_by_split(df, exclude).groupBy("column").pivot("split", [a, b]).agg(F.first("share"))
    return wide.filter(q(a).isNotNull() & q(b).isNotNull()).select(
        "column", q(a).alias(f"{a}_share"), q(b).alias(f"{b}_share")
    )


def null_only_in(df: DataFrame, a: str = "train", b: str = "test", exclude: Sequence[str] = ()) -> DataFrame:
    """Columns with nulls in just one of two splits."""
    per = null_counts_by_split(df, exclude).filter(q("split").isin(a, b))
    return (
        per.groupBy("column").agg(F.count(F.lit(1)).alias("_k"), F.min("split").alias("split"), F.max("nulls").alias("nulls"))
        .filter("_k = 1").select("split", "column", "nulls")
    )


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows ``(column, value, n)`` over many columns, nulls left out."""
    return to_long(df, cols, as_type="string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def level_shares(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Level counts with each level's share of the non-null rows and its column's extremes.

    Column totals come from a second small aggregation and a join, not from a window, so that a
    column with very many levels is not gathered in one task.
    """
    counts = settle(value_counts(df, cols))
    totals = settle(counts.groupBy("column").agg(
        F.sum("n").alias("total"), F.min("n").alias("least"), F.max("n").alias("most")
    ))
    return sized_join(counts, totals, "column", "inner").withColumn("share", q("n") / q("total"))


def rare_levels(df: DataFrame, cols: Sequence[str], min_count: int) -> DataFrame:
    """All level counts of the columns where some level is rarer than ``min_count``."""
    return level_shares(df, cols).filter(q("least") < min_count).select("column", "value", "n")


def dominant_columns(df: DataFrame, cols: Sequence[str], max_share: float) -> DataFrame:
    """Level shares of the columns dominated by one level."""
    return level_shares(df, cols).filter(q("most") / q("total") > max_share).select("column", "value", "n", "share")


def discrete_distributions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count and share of every level of every column."""
    return level_shares(df, cols).select("column", "value", "n", "share")


def min_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Smallest and smallest non-zero value over all the columns together."""
    per = df.agg(*[
        e for c in cols
        for e in (F.min(q(c)).alias(f"lo_{c}"), F.min(F.when(q(c) != 0, q(c))).alias(f"nz_{c}"))
    ])
    lo = F.array_min(F.array(*[q(f"lo_{c}") for c in cols]))
    nz = F.array_min(F.array(*[q(f"nz_{c}") for c in cols]))
    return per.select(lo.alias("min_value"), nz.alias("min_nonzero"))


def levels_by_first_seen(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """Distinct non-null values with the first key at which each occurs."""
    return (
        df.filter(q(col).isNotNull()).groupBy(q(col).alias("value"))
        .agg(F.min(F.struct(*[q(o) for o in order])).alias("_first"))
        .select("value", "_first.*")
    )


def metric_summary(df: DataFrame, col: str) -> DataFrame:
    """Mean and sample standard deviation of a metric."""
    return df.agg(F.avg(q(col)).alias("mean"), F.stddev_samp(q(col)).alias("std"))
