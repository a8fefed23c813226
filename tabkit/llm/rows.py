"""Keeping a table's own columns apart from working columns, so that no name can clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(table: DataFrame) -> DataFrame:
    """One struct column ``doc``."""
    return table.select(F.struct(*[table[f"`{c}`"] for c in table.columns]).alias("doc"))


def unpacked(df: DataFrame, columns: list[str], results: dict[str, Column | str]) -> DataFrame:
    """The columns of ``doc`` with the results in place of, or after, them."""
    made = {k: F.col(v) if isinstance(v, str) else v for k, v in results.items()}
    own = [made[c].alias(c) if c in made else F.col("doc")[c].alias(c) for c in columns]
    return df.select(*own, *[v.alias(k) for k, v in made.items() if k not in columns])
