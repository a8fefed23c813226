"""Column expressions: arithmetic hashes, null-safe arithmetic, logs, flags, normal tails."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# One multiplier per search dimension for the arithmetic hash uniforms.
HASH_MULTIPLIERS = (
    30011, 40503, 12347, 51431, 7919, 60013, 22567, 35837, 47297, 17389, 56099, 27431,
)
HASH_MODULUS = 65521


def quoted(name: str) -> str:
    """A column name as SQL, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def q(name: str) -> Column:
    """A column by its literal name."""
    return F.col(quoted(name))


def linear_sql(intercept: float, weights: Sequence[tuple[str, float]]) -> str:
    """SQL of an intercept plus weighted columns, one text however many columns."""
    return " + ".join([f"{float(intercept)!r}D", *[f"{quoted(c)} * {float(w)!r}D" for c, w in weights]])


def add_all(terms: Sequence[Column]) -> Column:
    """Sum of column expressions."""
    return reduce(lambda a, b: a + b, terms)


def fold_of(key: Column, k: int, seed: int = 30011) -> Column:
    """Fold number of a row: the same on every run, in every engine."""
    reduced = key.cast("bigint") % F.lit(HASH_MODULUS)  # keeps the product within a bigint
    return ((reduced * F.lit(seed)) % F.lit(HASH_MODULUS) % F.lit(k)).cast("bigint")


def hash_uniform(i: Column, multiplier: int) -> Column:
    """Number in [0, 1) by an arithmetic hash of an integer."""
    reduced = i.cast("bigint") % F.lit(HASH_MODULUS)
    return (reduced * F.lit(multiplier)) % F.lit(HASH_MODULUS) / F.lit(float(HASH_MODULUS))


def poisson_one(key: str, salt: int) -> Column:
    """Poisson(1) count by inversion of a hashed uniform: the bootstrap weight of a row."""
    # Cumulative Poisson(1) probabilities at 0..6.
    cdf = (
        0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
        0.9963401531726563, 0.9994058151824183, 0.9999167588507119,
    )
    limits = [int(c * HASH_MODULUS) for c in cdf]
    u = f"pmod(xxhash64({quoted(key)}, {salt}L), {HASH_MODULUS}L)"
    return F.expr(" + ".join(f"if({u} > {x}, 1, 0)" for x in limits))


def no_nan(c: Column) -> Column:
    """Turn NaN into null, so that null is the only missing value."""
    return F.when(~F.isnan(c), c)


def ratio(num: Column, den: Column) -> Column:
    """Quotient, null when the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def nonzero(c: Column) -> Column:
    """1 where the value differs from zero, a null counting as different, else 0."""
    return (~c.eqNullSafe(F.lit(0))).cast("int")


def ln_or(c: Column, at_zero: Column) -> Column:
    """Natural log with a given value at zero and null below zero."""
    return F.when(c == 0, at_zero).when(c > 0, F.ln(c))


def normal_tail(z: Column) -> Column:
    """Two-sided normal p-value by the rational erfc approximation (error at most 1.5e-7)."""
    # Abramowitz and Stegun, formula 7.1.26.
    p = 0.3275911
    a = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(p) * x)
    poly = F.lit(0.0)
    for coef in reversed(a):
        poly = (poly + F.lit(coef)) * t
    return poly * F.exp(-x * x)
