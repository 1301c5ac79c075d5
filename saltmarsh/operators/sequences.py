"""Ordered computations per key that stay parallel inside one hot key.

A plain window over ``partition by key`` puts the whole key into one task.  Here
every key is cut into ordered *slices* (for example minutes of its event time):
a window runs inside each (key, slice), a one-row-per-slice summary carries the
result from slice to slice, and both are joined on (key, slice).  The summary
has as many rows per key as there are slices, whatever the number of events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_slice(ts: Column, width: str = "hour") -> Column:
    return F.date_trunc(width, ts)


def number_slice(value: Column, width: int) -> Column:
    return F.floor(value / F.lit(width))


def ordered_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    row_number: str | None = None,
    following: dict[str, str] | None = None,
    carried: dict[str, str] | None = None,
    max_before: dict[str, str] | None = None,
    running_sum: dict[str, str] | None = None,
) -> DataFrame:
    """Add order-dependent columns per key.

    ``slice_by`` must be non-decreasing along ``order``.  Names map new columns
    to source columns: ``following`` = value of the next row, ``carried`` = last
    non-null value up to this row, ``max_before`` = maximum of all earlier rows,
    ``running_sum`` = sum up to this row.
    """
    following, carried = following or {}, carried or {}
    max_before, running_sum = max_before or {}, running_sum or {}
    # one struct as key: null keys match, and window and join share one shuffle
    spread = df.withColumn("_cell", F.struct(*keys, slice_by.alias("_slice")))
    inner = Window.partitionBy("_cell").orderBy(*order)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inner.rowsBetween(Window.unboundedPreceding, -1)

    local = spread
    if row_number:
        local = local.withColumn("_rn", F.row_number().over(inner))
    if following:
        # a struct tells "no next row in this slice" from "next value is null"
        boxed = F.struct(*[F.col(src).alias(new) for new, src in following.items()])
        local = local.withColumn("_next", F.lead(boxed).over(inner))
    for new, src in carried.items():
        local = local.withColumn(f"_c_{new}", F.last(src, ignorenulls=True).over(upto))
    for new, src in max_before.items():
        local = local.withColumn(f"_m_{new}", F.max(src).over(before))
    for new, src in running_sum.items():
        local = local.withColumn(f"_s_{new}", F.sum(src).over(upto))

    place = F.struct(*order)
    facts = [F.count(F.lit(1)).alias("_n")]
    if following:
        head = F.struct(*[F.col(src).alias(new) for new, src in following.items()])
        facts.append(F.min_by(head, place).alias("_head"))
    for new, src in carried.items():
        facts.append(F.max_by(F.col(src), F.when(F.col(src).isNotNull(), place)).alias(f"_lc_{new}"))
    facts += [F.max(src).alias(f"_lm_{new}") for new, src in max_before.items()]
    facts += [F.sum(src).alias(f"_ls_{new}") for new, src in running_sum.items()]

    outer = Window.partitionBy(*[F.col("_cell")[k] for k in keys]).orderBy(F.col("_cell._slice"))
    earlier = outer.rowsBetween(Window.unboundedPreceding, -1)
    steps = spread.groupBy("_cell").agg(*facts)
    picked: list[Column] = [F.col("_cell").alias("_cell2")]
    if row_number:
        picked.append(F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    if following:
        picked.append(F.lead("_head").over(outer).alias("_head_next"))
    picked += [F.last(f"_lc_{new}", ignorenulls=True).over(earlier).alias(f"_pc_{new}") for new in carried]
    picked += [F.max(f"_lm_{new}").over(earlier).alias(f"_pm_{new}") for new in max_before]
    picked += [F.sum(f"_ls_{new}").over(earlier).alias(f"_ps_{new}") for new in running_sum]
    steps = steps.select(*picked)

    both = local.join(steps, F.col("_cell") == F.col("_cell2"), "inner")
    out: list[Column] = [F.col(c) for c in df.columns]
    if row_number:
        out.append((F.col("_rn") + F.col("_before")).alias(row_number))
    if following:
        nxt = F.coalesce(F.col("_next"), F.col("_head_next"))
        out += [nxt[new].alias(new) for new in following]
    out += [F.coalesce(F.col(f"_c_{new}"), F.col(f"_pc_{new}")).alias(new) for new in carried]
    out += [F.greatest(f"_m_{new}", f"_pm_{new}").alias(new) for new in max_before]
    for new in running_sum:
        here, earlier_sum = F.col(f"_s_{new}"), F.col(f"_ps_{new}")
        out.append(F.coalesce(here + earlier_sum, here, earlier_sum).alias(new))
    return both.select(*out)
