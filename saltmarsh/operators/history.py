"""History ("zip") dimensions and as-of lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saltmarsh.functions.dates import OPEN_END
from saltmarsh.operators.sequences import ordered_columns


def open_history(df: DataFrame, start: Column) -> DataFrame:
    """A first snapshot as open-ended history rows."""
    return df.withColumn("start_date", start).withColumn("end_date", F.lit(OPEN_END).cast("date"))


def build_history(changes: DataFrame, keys: Sequence[str], day: str, order: Sequence[str]) -> DataFrame:
    """Validity ranges from a change log: last change per key and day wins.

    Reducing to one row per key and day happens by aggregation, so the window
    over a key never sees more rows than there are calendar days.
    """
    attributes = [c for c in changes.columns if c not in keys and c != day]
    daily = changes.groupBy(*keys, day).agg(
        F.max_by(F.struct(*attributes), F.struct(*order)).alias("_row")
    )
    w = Window.partitionBy(*keys).orderBy(day)
    following = F.lead(day).over(w)
    return daily.select(
        *keys,
        "_row.*",
        F.col(day).alias("start_date"),
        F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END).cast("date")).alias("end_date"),
    )


def apply_changes(history: DataFrame, changes: DataFrame, keys: Sequence[str], day: Column) -> DataFrame:
    """Versions valid from ``day`` on for the keys of ``changes``; applying a day again gives the same table.

    ``changes`` holds at most one row per key with the attribute columns.  The
    version that covers ``day`` ends the day before, one that starts on ``day``
    is replaced, and a day that comes late ends where the next version starts.
    Null keys are keys.
    """
    attributes = [c for c in history.columns if c not in (*keys, "start_date", "end_date")]
    marks = changes.select(*[F.col(k).alias("_c" + k) for k in keys], F.lit(True).alias("_hit"))

    def same(prefix: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])

    marked = history.join(marks, same("_c"), "left")
    covers = F.col("_hit") & (F.col("start_date") < day) & (F.col("end_date") >= day)
    closed = marked.filter(F.col("_hit").isNull() | (F.col("start_date") != day)).select(
        *keys,
        *attributes,
        "start_date",
        F.when(covers, F.date_sub(day, 1)).otherwise(F.col("end_date")).alias("end_date"),
    )
    later = history.filter(F.col("start_date") > day).groupBy(*[F.col(k).alias("_n" + k) for k in keys]).agg(
        F.min("start_date").alias("_next"))
    fresh = changes.join(later, same("_n"), "left").select(
        *keys, *attributes, day.alias("start_date"),
        F.coalesce(F.date_sub("_next", 1), F.lit(OPEN_END).cast("date")).alias("end_date"),
    )
    return closed.unionByName(fresh)


def as_of_lookup(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    fact_ts: str,
    version_ts: str,
    values: Sequence[str],
    slice_width: str = "hour",
) -> DataFrame:
    """Latest version at or before each fact, as one ordered pass over both.

    Facts and versions are stacked and the last version is carried forward,
    slice by slice, so neither a hot key nor a long version list meets in one
    task and no pairs are produced.
    """
    f = facts.withColumn("_at", F.col(fact_ts)).withColumn("_side", F.lit(1)).withColumn(
        "_v", F.lit(None).cast(versions.select(F.struct(*values).alias("v")).schema["v"].dataType)
    )
    v = versions.select(
        *[F.col(k) for k in keys],
        *[F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in facts.columns if c not in keys],
        F.col(version_ts).alias("_at"),
        F.lit(0).alias("_side"),
        F.struct(*values).alias("_v"),
    )
    stacked = f.unionByName(v)
    filled = ordered_columns(
        stacked, keys, ["_at", "_side"], F.date_trunc(slice_width, F.col("_at")), carried={"_found": "_v"}
    )
    return filled.filter(F.col("_side") == 1).select(
        *facts.columns, *[F.col("_found")[c].alias(c) for c in values]
    )


def range_lookup(
    facts: DataFrame, history: DataFrame, keys: Sequence[str], day: str, values: Sequence[str], slice_width: str = "month"
) -> DataFrame:
    """History row valid on the fact's day.

    Ranges of a key do not overlap, so the valid row is the latest one that has
    started, if it has not ended: an ordered pass, not a join of all versions
    with all facts of a key.
    """
    ends = history.select(*keys, F.col("start_date").alias("_from"), F.col("end_date").alias("_to"), *[F.col(c).alias("_v_" + c) for c in values])
    found = as_of_lookup(facts, ends, keys, day, "_from", ["_to", *["_v_" + c for c in values]], slice_width)
    valid = F.col(day) <= F.col("_to")
    return found.select(*facts.columns, *[F.when(valid, F.col("_v_" + c)).alias(c) for c in values])
