"""The four dataset variants a comparison runs over."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tabkit.operators.features import log_transform
from tabkit.operators.rows import drop_columns

Edit = Callable[[DataFrame, frozenset[str]], DataFrame]


def build_variants(clean: DataFrame, drop: Sequence[str], edit: Edit, response: str) -> dict[str, DataFrame]:
    """``{as it is, columns dropped} x {as it is, edited}``, the response on log scale in all four.

    ``edit(df, present)`` always sees every column of the clean table, so that flags can use columns the
    variant lacks; ``present`` names the columns the variant has, for the features that depend on it.
    What a variant lacks is dropped after its edit.
    """
    def logged(df: DataFrame) -> DataFrame:
        return log_transform(df, [response], zero="min")

    every = frozenset(clean.columns)
    kept = every - set(drop)
    plain = logged(clean)
    leftovers = [*drop, *[f"log_{c}" for c in drop]]
    return {
        "clean": plain,
        "drop": drop_columns(plain, drop),
        "clean_edit": logged(edit(clean, every)),
        "drop_edit": drop_columns(logged(edit(clean, kept)), leftovers),
    }
