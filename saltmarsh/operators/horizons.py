"""Recent-days roll-ups without multiplying the input rows.

The horizons 1, 7 and 30 days are nested, so one scan of the widest range is
enough: sums become conditional sums, and an exact distinct count of a horizon
is the number of members whose *latest* day falls inside it.  Only the small
aggregated result is unfolded to one row per horizon.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HORIZONS = (1, 7, 30)


def within(day: Column, as_of: Column, days: int) -> Column:
    """True when ``day`` lies in the closed range of ``days`` days ending at ``as_of``."""
    return (day > F.date_sub(as_of, days)) & (day <= as_of)


def recent(df: DataFrame, day: str, as_of: Column, days: int = 30) -> DataFrame:
    """Rows of the last ``days`` days; the bare column keeps partition pruning possible."""
    return df.filter(within(F.col(day), as_of, days))


def horizon_sums(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    as_of: Column,
    measures: dict[str, Column],
    horizons: Sequence[int] = HORIZONS,
    suffix: str = "_{}d",
) -> DataFrame:
    """One row per key with a column per measure and horizon (pivoted sums)."""
    rows = recent(df, day, as_of, max(horizons))
    aggs = []
    for days in horizons:
        inside = within(F.col(day), as_of, days)
        for name, value in measures.items():
            total = F.sum(F.when(inside, value))
            aggs.append(F.coalesce(total, total * 0, F.lit(0)).alias(name + suffix.format(days)))
    return rows.groupBy(*keys).agg(*aggs)


def unfold(
    df: DataFrame,
    keys: Sequence[str],
    names: Sequence[str],
    horizons: Sequence[int] = HORIZONS,
    suffix: str = "_{}d",
    label: str = "recent_days",
) -> DataFrame:
    """Pivoted horizon columns back to one row per key and horizon."""
    boxes = [
        F.struct(
            F.lit(days).alias(label),
            *[F.col(name + suffix.format(days)).alias(name) for name in names],
        )
        for days in horizons
    ]
    return df.select(*keys, F.explode(F.array(*boxes)).alias("_box")).select(*keys, "_box.*")


def horizon_distinct(
    df: DataFrame,
    keys: Sequence[str],
    member: str,
    day: str,
    as_of: Column,
    sums: dict[str, Column] | None = None,
    horizons: Sequence[int] = HORIZONS,
    member_name: str = "members",
) -> DataFrame:
    """Exact distinct members and sums per key and horizon in two aggregations.

    The first groups by key and member (spreading a hot key over its members),
    the second by key on the already reduced rows.
    """
    sums = sums or {}
    rows = recent(df, day, as_of, max(horizons))
    first = [F.max(day).alias("_last")]
    for days in horizons:
        inside = within(F.col(day), as_of, days)
        for name, value in sums.items():
            first.append(F.sum(F.when(inside, value)).alias(f"{name}_{days}d"))
    per_member = rows.groupBy(*keys, member).agg(*first)
    second = []
    for days in horizons:
        hit = within(F.col("_last"), as_of, days) & F.col(member).isNotNull()
        second.append(F.count(F.when(hit, 1)).alias(f"{member_name}_{days}d"))
        for name in sums:
            second.append(F.coalesce(F.sum(f"{name}_{days}d"), F.lit(0)).alias(f"{name}_{days}d"))
    wide = per_member.groupBy(*keys).agg(*second)
    return unfold(wide, keys, [member_name, *sums], horizons)


def to_date(
    df: DataFrame, keys: Sequence[str], day: str, sums: dict[str, Column], first: str, last: str
) -> DataFrame:
    """To-date summary with the first and last day of activity."""
    return df.groupBy(*keys).agg(
        F.min(day).alias(first),
        F.max(day).alias(last),
        *[F.sum(value).alias(name) for name, value in sums.items()],
    )
