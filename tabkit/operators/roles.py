"""Column roles (categorical, ordinal, quantitative) carried in the schema, and typed projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.expr import q

KINDS = ("cat", "ord", "quant")


@dataclass(frozen=True)
class Roles:
    """Which columns are of which kind; ``key`` columns identify a row and have no kind."""

    cat: tuple[str, ...] = ()
    ord: tuple[str, ...] = ()
    quant: tuple[str, ...] = ()
    response: str | None = None
    key: tuple[str, ...] = ("split", "id")

    def of(self, kind: str) -> tuple[str, ...]:
        return getattr(self, kind)

    def within(self, df: DataFrame) -> Roles:
        """The same roles restricted to columns the table still has."""
        have = set(df.columns)
        return Roles(
            *[tuple(c for c in self.of(k) if c in have) for k in KINDS],
            response=self.response if self.response in have else None,
            key=tuple(c for c in self.key if c in have),
        )

    def without(self, *cols: str) -> Roles:
        """The same roles less some columns."""
        return Roles(
            *[tuple(c for c in self.of(k) if c not in cols) for k in KINDS],
            response=self.response, key=self.key,
        )


def role_report(df: DataFrame, roles: Mapping[str, Sequence[str]], key: Sequence[str] = ()) -> DataFrame:
    """Validation of a role mapping as rows ``(column, rule, ok)``."""
    rows = [(str(name), "known_role", name in KINDS) for name in roles]
    listed: set[str] = set()
    for name, cols in roles.items():
        is_list = isinstance(cols, (list, tuple))
        rows.append((str(name), "is_list", is_list))
        for c in cols if is_list else ():
            rows.append((str(c), "is_name", isinstance(c, str)))
            listed.add(c)
    rows += [(c, "has_role", c in listed) for c in df.columns if c not in key]
    return df.sparkSession.createDataFrame(rows, "column string, rule string, ok boolean")


def set_roles(
    df: DataFrame, roles: Mapping[str, Sequence[str]], response: str | None = None, key: Sequence[str] = ()
) -> tuple[DataFrame, Roles]:
    """Check roles against the table and store them in the column metadata."""
    bad = role_report(df, roles, key).filter("not ok").collect()
    if bad:
        raise ValueError("; ".join(f"{r['column']}: {r['rule']}" for r in bad))
    kept = Roles(
        *[tuple(roles.get(k, ())) for k in KINDS], response=response, key=tuple(key)
    ).within(df)
    kind_of = {c: k for k in KINDS for c in kept.of(k)}
    tagged = df.select(*[
        q(c).alias(c, metadata={**df.schema[c].metadata, "role": kind_of[c]}) if c in kind_of else q(c)
        for c in df.columns
    ])
    return tagged, kept


def stored_roles(df: DataFrame, response: str | None = None, key: Sequence[str] = ()) -> Roles:
    """Roles read back from the column metadata."""
    found = {k: tuple(f.name for f in df.schema if f.metadata.get("role") == k) for k in KINDS}
    return Roles(**found, response=response, key=tuple(key))


def kind_of_type(t: T.DataType) -> str | None:
    """Role implied by a type: text is categorical, integers ordinal, fractions quantitative."""
    if isinstance(t, (T.StringType, T.BooleanType)):
        return "cat"
    if isinstance(t, T.IntegralType):
        return "ord"
    if isinstance(t, T.FractionalType):
        return "quant"
    return None


def infer_roles(df: DataFrame, response: str | None = None, key: Sequence[str] = ()) -> Roles:
    """Roles from the column types."""
    found = {
        k: tuple(f.name for f in df.schema if f.name not in key and kind_of_type(f.dataType) == k) for k in KINDS
    }
    return Roles(**found, response=response, key=tuple(key))


def select_by_type(df: DataFrame, kind: str, key: Sequence[str] = ()) -> DataFrame:
    """Projection to the key and the columns of one kind."""
    return df.select(*[q(k) for k in key], *[q(c) for c in infer_roles(df, key=key).of(kind)])


def enforce_types(df: DataFrame, roles: Roles) -> DataFrame:
    """Categorical to string, ordinal to bigint, quantitative to double."""
    target = {**{c: "string" for c in roles.cat}, **{c: "bigint" for c in roles.ord},
              **{c: "double" for c in roles.quant}}
    return df.select(*[q(c).cast(target[c]).alias(c) if c in target else q(c) for c in df.columns])


def columns_matching(
    df: DataFrame, contains: Sequence[str], excludes: Sequence[str] = (), within: Sequence[str] | None = None
) -> list[str]:
    """Numeric column names holding any of some fragments and none of others."""
    pool = within if within is not None else df.columns
    return [
        f.name for f in df.schema
        if f.name in pool and isinstance(f.dataType, T.NumericType)
        and any(p in f.name for p in contains) and not any(p in f.name for p in excludes)
    ]


def schema_profile(df: DataFrame) -> DataFrame:
    """Rows ``(column, type, non_null, row_count, column_count)`` from one pass."""
    cols = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"), *[F.count(q(c)).alias(c) for c in cols]
    ).unpivot("row_count", [q(c) for c in cols], "column", "non_null")
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    return counts.select(
        "column", types[q("column")].alias("type"), "non_null", "row_count",
        F.lit(len(cols)).cast("bigint").alias("column_count"),
    )
