"""One-hot flags and scaled numbers as sparse vectors, for columns of any number of levels.

Nothing grows with the levels but the table of their codes: codes are joined (broadcast only by measured size), flags are
positions of a sparse vector, and the names of the positions are rows of a table. Zeros stay zeros throughout.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators.depend import apply_level_codes, level_codes
from tabkit.operators.roles import Roles


@dataclass(frozen=True)
class SparseEncoding:
    """What ``fit_sparse`` learned: the settled codes of all levels, how many each column has, the largest magnitudes."""

    cats: tuple[str, ...]
    nums: tuple[str, ...]
    codes: DataFrame
    sizes: dict[str, int]
    largest: dict[str, float]

    @property
    def width(self) -> int:
        return len(self.nums) + sum(self.sizes.values())

    def names(self) -> DataFrame:
        """``(slot, column, value)`` of every position: numbers first, then the sorted levels of each column."""
        spark = self.codes.sparkSession
        numbers = [(i, c, None) for i, c in enumerate(self.nums)]
        first, at = [], len(self.nums)
        for c in self.cats:
            first.append((c, at))
            at += self.sizes[c]
        out = spark.createDataFrame(numbers, "slot bigint, column string, value string")
        if not self.cats:
            return out
        starts = spark.createDataFrame(first, "column string, start bigint")
        level = F.coalesce(q("s"), q("i").cast("string"), q("d").cast("string")).alias("value")
        return out.unionByName(self.codes.join(F.broadcast(starts), "column").select((q("start") + q("code")).alias("slot"), "column", level))

    def apply(self, df: DataFrame, output: str = "features") -> DataFrame:
        """``df`` with the vector ``output`` in place of the encoded columns.

        A null or unseen level has no flag. Numbers are divided by their largest magnitude, so 0 stays 0 and no shift
        fills the vector; a column of zeros stays 0 and a null number is NaN.
        """
        # working names stand for all columns, so that those of ``df`` may have any names
        own = [f"o{i}" for i in range(len(df.columns))]
        place = dict(zip(df.columns, own))
        rows = df.toDF(*own)
        held = self.codes
        if self.cats:
            to = F.create_map(*[F.lit(x) for c in self.cats for x in (c, place[c])])
            held = held.withColumn("column", to[q("column")])
        coded = apply_level_codes(rows, held, [place[c] for c in self.cats])
        numbers = {place[c]: F.coalesce(q(place[c]).cast("double") / (self.largest[c] or 1.0), F.lit(float("nan"))) for c in self.nums}
        # no level at all: no flags
        flagged = [c for c in self.cats if self.sizes[c]]
        levels = {place[c]: F.coalesce(q(place[c]).cast("double"), F.lit(float(self.sizes[c]))) for c in flagged}
        coded = coded.withColumns({**numbers, **levels}) if numbers or levels else coded
        parts = [place[c] for c in self.nums]
        if flagged:
            hot = OneHotEncoder(inputCols=[place[c] for c in flagged], outputCols=[f"h{place[c]}" for c in flagged], dropLast=True, handleInvalid="error")
            # one category more than there are levels: the last one, of nulls and unseen values, has no flag
            top = df.sparkSession.createDataFrame([tuple(float(self.sizes[c]) for c in flagged)], [place[c] for c in flagged])
            coded = hot.fit(top).transform(coded)
            parts += [f"h{place[c]}" for c in flagged]
        made = VectorAssembler(inputCols=parts, outputCol="v", handleInvalid="keep").transform(coded)
        gone = {*self.cats, *self.nums}
        return made.select(*[q(place[c]).alias(c) for c in df.columns if c not in gone and c != output], q("v").alias(output))


def fit_sparse(df: DataFrame, cats: Sequence[str], nums: Sequence[str] = ()) -> SparseEncoding:
    """Codes of the levels of ``cats`` in sorted order and the largest magnitudes of ``nums``. The driver gets one number per column."""
    if not cats and not nums:
        raise ValueError("no columns to encode")
    codes = level_codes(df, cats) if cats else None
    sizes = {c: 0 for c in cats}
    if cats:
        sizes.update({r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()})
    else:
        codes = df.sparkSession.createDataFrame([], "column string, i bigint, d double, s string, n bigint, code bigint")
    largest: dict[str, float] = {}
    if nums:
        row = df.agg(*[F.max(F.abs(q(c).cast("double"))).alias(f"m{i}") for i, c in enumerate(nums)]).first()
        largest = {c: float(row[f"m{i}"] or 0.0) for i, c in enumerate(nums)}
    return SparseEncoding(tuple(cats), tuple(nums), codes, sizes, largest)


def sparse_one_hot(df: DataFrame, cols: Sequence[str], output: str = "features") -> tuple[DataFrame, DataFrame]:
    """The flags of ``one_hot`` as one sparse vector a row, and the names of its positions."""
    fitted = fit_sparse(df, cols)
    return fitted.apply(df, output), fitted.names()


def sparse_model_matrix(
    df: DataFrame, roles: Roles, response: str, fit_on: DataFrame | None = None, output: str = "features"
) -> tuple[DataFrame, DataFrame]:
    """Key, sparse features and response, ready for Spark's learners, and the names of the positions.

    Beside ``model_matrix``: flags are the same, numbers are divided by their largest magnitude instead of being moved to [0, 1].
    """
    roles = roles.within(df)
    cats = [c for c in roles.cat if c != response]
    nums = [c for c in (*roles.ord, *roles.quant) if c != response]
    fitted = fit_sparse(fit_on if fit_on is not None else df, cats, nums)
    kept = list(dict.fromkeys([*roles.key, *cats, *nums, response]))
    made = fitted.apply(df.select(*[q(c) for c in kept]), output)
    return made.select(*[q(k) for k in roles.key], q(output), q(response)), fitted.names()
