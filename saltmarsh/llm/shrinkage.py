"""Empirical-Bayes priors for shares, estimated from all groups of a level by moments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WEAKEST, STRONGEST = 1.0, 1e4


def strength(groups: DataFrame, hits: str = "good") -> DataFrame:
    """One row ``strength``: how many outcomes the prior of a group counts for.

    ``groups`` has ``n`` outcomes, ``hits`` of them positive, and the prior mean ``prior``.  For
    a beta prior E[(hits/n - p)^2] = p(1-p) (1/n + (1-1/n)/(1+s)); this is
    solved for s with weights n.  Without more spread than chance gives, the
    prior is at its strongest.
    """
    v = F.col("prior") * (1 - F.col("prior"))
    found = groups.agg(
        F.sum(F.col("n") * F.pow(F.col(hits) / F.col("n") - F.col("prior"), 2)).alias("seen"),
        F.sum(v).alias("noise"), F.sum(v * (F.col("n") - 1)).alias("room"))
    usable = (F.col("room") > 0) & (F.col("seen") > F.col("noise"))
    value = F.least(F.greatest(F.col("room") / (F.col("seen") - F.col("noise")) - 1, F.lit(WEAKEST)), F.lit(STRONGEST))
    return found.select(F.when(usable, value).otherwise(F.lit(STRONGEST)).alias("strength"))
