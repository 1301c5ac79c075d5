"""Data-quality operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.operators.relations import align


def coverage(df: DataFrame, column: str, known: Sequence[str]) -> DataFrame:
    """Share of rows whose value is one of the known ones, in percent."""
    hit = F.count(F.when(F.col(column).isin(*known), 1))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total_rows"),
        hit.alias("covered_rows"),
        F.when(total > 0, F.round(hit * 100.0 / total, 2)).alias("coverage_pct"),
    )


def exceeding(base: DataFrame, other: DataFrame, keys: Sequence[str], base_measure: str, other_measure: str) -> DataFrame:
    """Keys whose other measure is larger than the base measure (clicks above visits)."""
    totals = other.groupBy(*keys).agg(F.sum(other_measure).alias("total_other"))
    return base.join(totals, list(keys), "left").filter(F.col(base_measure) < F.col("total_other"))


def differing(left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str, tolerance: float = 0.001) -> DataFrame:
    """Keys where two computations of one metric differ by more than ``tolerance`` (relative)."""
    both = align(
        {
            "l": left.select(*keys, F.col(measure).alias("left_value")),
            "r": right.select(*keys, F.col(measure).alias("right_value")),
        },
        keys,
    )
    gap = F.abs(F.col("left_value") - F.col("right_value"))
    size = F.greatest(F.abs("left_value"), F.abs("right_value"))
    return both.filter(
        F.col("left_value").isNull() | F.col("right_value").isNull() | (gap > size * F.lit(tolerance))
    )


def valid_rows(df: DataFrame, text_keys: Sequence[str] = (), not_null: Sequence[str] = (), positive: Sequence[str] = ()) -> DataFrame:
    """Rows with non-blank keys, present times and amounts above zero."""
    cond: Column = F.lit(True)
    for c in text_keys:
        cond = cond & F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    for c in positive:
        cond = cond & (F.col(c) > 0)
    return df.filter(cond)
