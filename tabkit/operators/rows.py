"""Row and column predicates: splits, drops, corrections, renames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.session import settle, sized_join


def take_split(df: DataFrame, name: str) -> DataFrame:
    """Rows of one split."""
    return df.filter(q("split") == name)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Table without some columns; names it does not have are ignored."""
    return df.drop(*cols)


def null_shares(df: DataFrame, max_null: float = 0.20, keep: Sequence[str] = ()) -> DataFrame:
    """Per column: share of nulls and whether it stays under the limit."""
    cols = df.columns
    # null counts over the table: no group, so one row leaves every task
    return (
        df.agg(*[F.try_divide(F.count_if(q(c).isNull()), F.count(F.lit(1))).alias(c) for c in cols])
        .unpivot([], [q(c) for c in cols], "column", "null_share")
        .withColumn("kept", F.coalesce(q("null_share") <= max_null, F.lit(True)) | q("column").isin(list(keep)))
    )


def drop_sparse_columns(df: DataFrame, max_null: float = 0.20, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns whose share of nulls exceeds the limit."""
    sparse = [r["column"] for r in null_shares(df, max_null, keep).filter("not kept").collect()]
    return df.drop(*sparse)


def drop_matching(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    """Drop every row for which a predicate is true; unknown counts as false."""
    for p in predicates:
        df = df.filter(~F.coalesce(p, F.lit(False)))
    return df


def drop_first_match(
    df: DataFrame, predicates: Sequence[Column], order: Sequence[Column] | None = None, key: str = "id"
) -> DataFrame:
    """Per predicate in turn, drop all rows sharing the key of the first match in ``order``.

    The default order puts the training rows first, then goes by key.
    """
    order = order or [q("split") != "train", q(key)]
    first: list[Column] = []
    for p in predicates:
        remaining = p
        for f in first:
            remaining = remaining & f
        # one row per predicate
        found = df.filter(remaining).agg(F.min_by(q(key), F.struct(*order)).alias("k")).first()["k"]
        if found is not None:
            first.append(q(key) != F.lit(found))
    for f in first:
        df = df.filter(F.coalesce(f, F.lit(True)))
    return df


def apply_corrections(df: DataFrame, corrections: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Overwrite cells listed as ``(key..., column, value text)``; at most one value per cell."""
    wide = settle(
        corrections.groupBy(*[q(k) for k in key])
        .pivot("column", list(columns)).agg(F.max("value"))
        .withColumnsRenamed({c: f"_new_{c}" for c in columns})
    )
    joined = sized_join(df, wide, list(key), "left")
    return joined.select(*[
        F.coalesce(q(f"_new_{c}").cast(df.schema[c].dataType), q(c)).alias(c) if c in columns else q(c)
        for c in df.columns
    ])


def complete_cases(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows without nulls in the columns."""
    return df.na.drop(subset=list(cols) if cols is not None else None)


def rename_safe(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names the table lacks are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def restore_names(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Undo ``rename_safe``."""
    return df.withColumnsRenamed({new: old for old, new in mapping.items()})


def mask_non_positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Natural log of positive values, null elsewhere."""
    return df.withColumns({c: F.when(q(c) > 0, F.ln(q(c))) for c in cols})
