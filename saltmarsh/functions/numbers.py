"""Number column functions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def parse_amount(value: Column, scale: int = 2) -> Column:
    """Unparsable or missing amounts count as zero; half-up to ``scale``."""
    parsed = value.try_cast("decimal(30,10)")
    return F.round(F.coalesce(parsed, F.lit(0)), scale).cast(f"decimal(18,{scale})")


def clamp_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0).cast("decimal(18,2)"))


def ratio(numerator: Column, denominator: Column, scale: int = 2, default=None) -> Column:
    """Rounded quotient; a zero or missing denominator gives ``default``."""
    value = F.when(denominator > 0, F.round(numerator.cast("double") / denominator.cast("double"), scale))
    return value if default is None else F.coalesce(value, F.lit(default).cast("double"))


def exact_ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """Quotient of non-negative counts, rounded half-up in integer arithmetic.

    Counts divide exactly here, so the rounded value does not depend on how a
    binary fraction happens to fall around the half.
    """
    n, d = numerator.cast("long"), denominator.cast("long")
    top, below = n * (2 * 10**scale) + d, d * 2
    units = (top - F.pmod(top, below)) / below  # divides evenly
    return F.when(d > 0, (units.cast("decimal(18,0)") / F.lit(10**scale)).cast(f"decimal(16,{scale})"))


def percent(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """Percentage of two counts; an empty denominator counts as one."""
    below = F.when(denominator > 0, denominator).otherwise(F.lit(1))
    return F.coalesce(exact_ratio(numerator * 100, below, scale).cast("double"), F.lit(0.0))


def fixed(value: str) -> Column:
    """Decimal literal, so weighted sums of rounded scores stay exact."""
    return F.lit(Decimal(value))


def bands(value: Column, limits: list[tuple[float, str]], rest: str) -> Column:
    """Label of the first upper limit that is not exceeded."""
    expr = None
    for limit, label in limits:
        cond = value <= F.lit(limit)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(rest)


def grade(score: Column, cuts: list[tuple[float, str]], rest: str) -> Column:
    """Label of the first lower limit that is reached."""
    expr = None
    for limit, label in cuts:
        cond = score >= F.lit(limit)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(rest)
