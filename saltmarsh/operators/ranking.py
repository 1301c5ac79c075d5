"""Ranking, latest-per-key and consecutive-day operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saltmarsh.functions.dates import OPEN_END
from saltmarsh.session import checkpointed, stored


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Whole row with the greatest ``order`` per key, as one aggregation.

    An aggregation combines on the map side, so a key that holds a third of the
    rows reaches its reducer as one row per task.
    """
    box = F.struct(*df.columns)
    return (
        df.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
        .agg(F.max_by(box, F.struct(*order)).alias("_row"))
        .select("_row.*")
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Whole row with the smallest ``order`` per key (deterministic de-duplication)."""
    box = F.struct(*df.columns)
    return (
        df.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
        .agg(F.min_by(box, F.struct(*order)).alias("_row"))
        .select("_row.*")
    )


def top_n(
    df: DataFrame, partition: Sequence[str], measure: str, n: int, name: str = "rk"
) -> DataFrame:
    """``rank()`` at most ``n`` per group on already aggregated rows.

    Ties may give more than ``n`` rows.  Spark applies the group limit before
    the shuffle, so a group sends at most a few rows per task.
    """
    w = Window.partitionBy(*partition).orderBy(F.col(measure).desc())
    return df.withColumn(name, F.rank().over(w)).filter(F.col(name) <= n)


def top_n_rows(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column], n: int, name: str = "rank_num"
) -> DataFrame:
    """``row_number()`` at most ``n`` per group; ``order`` must be unique per group."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows written once in ranges of ``order``, with ``_part`` (the range) and ``_at`` (the place in it, from 0).

    Spark samples the order columns and cuts ranges of about equal size, so equal
    scores, ids from a high number on or texts with one long head are spread over
    all tasks as long as ``order`` as a whole has few repeats.  Rows with equal
    ``order`` share a range.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(spread.withColumn("_id", F.monotonically_increasing_id()), "ranges")  # range << 33, plus the place
    low = F.lit((1 << 33) - 1)
    return numbered.select(*df.columns, F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(low).alias("_at"))


def ordered_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    position: str,
    total: str | None = None,
    sums: dict[str, str] | None = None,
    about: DataFrame | None = None,
) -> DataFrame:
    """Adds the number of rows of the same ``keys`` before the row in ``order``; no task holds a whole key.

    Rows are sorted in ranges of keys and order.  One count per (range, key) and
    prefix sums over these counts give the rows ahead of a range; there are at
    most as many counts as ranges plus keys.  ``total`` names the number of rows
    of the keys, ``sums`` maps new columns to the integer columns whose running
    sum before the row they hold, ``about`` has further columns by ``keys``, which
    meet the counts instead of the rows, so that a frequent key is no hot join key.
    Null keys are a group of their own and come first; ties in ``order`` are
    numbered in any order.
    """
    sums = sums or {}
    rows = ranged(df, [*[F.col(k).asc_nulls_first() for k in keys], *order])
    cell, key = F.struct("_part", *keys), F.struct(F.lit(0), *keys)
    rows = rows.withColumn("_cell", cell)
    runs = rows.groupBy("_cell").agg(
        F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"), *[F.sum(src).alias(f"_sum_{new}") for new, src in sums.items()])
    runs = runs.select("*", *[F.col("_cell")[k].alias(k) for k in keys])
    every = Window.partitionBy(key)
    earlier = every.orderBy(F.col("_cell._part")).rowsBetween(Window.unboundedPreceding, -1)
    picked = [F.col("_cell").alias("_cell2"), (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_from")).alias("_shift")]
    picked += [F.coalesce(F.sum(f"_sum_{new}").over(earlier), F.lit(0)).alias(f"_before_{new}") for new in sums]
    if total:
        picked.append(F.sum("_n").over(every).alias(total))
    runs = runs.select(*picked, key.alias("_key"))
    more: list[str] = []
    if about is not None:
        more = [c for c in about.columns if c not in keys]
        runs = runs.join(about.select(key.alias("_key2"), *more), F.col("_key") == F.col("_key2"))
    if sums:
        here = Window.partitionBy("_cell").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        for new, src in sums.items():
            rows = rows.withColumn(f"_local_{new}", F.coalesce(F.sum(src).over(here), F.lit(0)))
    out = [F.col(c) for c in df.columns] + [(F.col("_at") + F.col("_shift")).alias(position)]
    out += [F.col(total)] if total else []
    out += [(F.col(f"_local_{new}") + F.col(f"_before_{new}")).alias(new) for new in sums]
    return rows.join(runs, F.col("_cell") == F.col("_cell2")).select(*out, *more)


def global_row_number(df: DataFrame, score: str, tie: str, name: str, materialize: bool = False) -> DataFrame:
    """``row_number() over (order by score desc, tie)`` without a single-task sort; null scores go last.

    Rows are cut into sampled ranges of (score, tie), so a score that a third of
    all rows share is spread by its tie column, whatever its values look like.
    The input is read twice, for the sample and for the ranges; ``materialize``
    writes it to the checkpoint folder first, which pays off when it comes from
    large scans.
    """
    df = checkpointed(df) if materialize else df
    ahead = ordered_positions(df, [], [F.col(score).desc_nulls_last(), F.col(tie).asc_nulls_first()], "_ahead")
    return ahead.select(*df.columns, (F.col("_ahead") + 1).cast("long").alias(name))


# -- consecutive days: input is one row per (user, day), at most 7 rows per user --


def streak_by_lead(days: DataFrame, user: str, day: str, length: int = 3, span: int | None = None) -> DataFrame:
    """Users with ``length`` active days inside ``span`` days (default: consecutive)."""
    span = length - 1 if span is None else span
    w = Window.partitionBy(user).orderBy(day)
    ahead = F.lead(day, length - 1).over(w)
    gap = F.datediff(F.coalesce(ahead, F.lit(OPEN_END).cast("date")), F.col(day))
    hit = F.col("_gap") == span if span == length - 1 else F.col("_gap") <= span
    return days.withColumn("_gap", gap).filter(hit).select(user).distinct()


def streak_by_islands(days: DataFrame, user: str, day: str, length: int = 3) -> DataFrame:
    """Users with an island of at least ``length`` consecutive days."""
    w = Window.partitionBy(user).orderBy(day)
    island = F.date_sub(F.col(day), F.rank().over(w))
    return (
        days.withColumn("_island", island)
        .groupBy(user, "_island")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= length)
        .select(user)
        .distinct()
    )


def streak_by_bitmap(days: DataFrame, user: str, day: str, as_of: Column, length: int = 3, window: int = 7) -> DataFrame:
    """Users whose day bitmap over the window contains ``length`` ones in a row."""
    age = F.datediff(as_of, F.col(day))
    bit = F.when((age >= 0) & (age < window), F.pow(F.lit(10), age).cast("long")).otherwise(F.lit(0).cast("long"))
    return (
        days.groupBy(user)
        .agg(F.sum(bit).alias("_bits"))
        .filter(F.col("_bits").cast("string").like("%" + "1" * length + "%"))
        .select(user)
    )
