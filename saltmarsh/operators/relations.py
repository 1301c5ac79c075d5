"""Joins and unions that the metric plans share.

No join here carries a broadcast hint: Spark broadcasts a side only when its
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles with skew splitting, so a dimension may grow without breaking a job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


LARGEST_CODE_TABLE = 100_000


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by ``keys`` over all of ``spark.sql.shuffle.partitions``, which adaptive execution leaves apart.

    It merges other partitions up to 64 MB of packed shuffle data; the sorts and
    groups of a task over such rows hold twenty to thirty times as much memory.
    For inputs of a join or an aggregation on ``keys``, which then needs no other shuffle of them.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def code_names(dictionary: DataFrame, code_column: str, name_column: str, largest: int = LARGEST_CODE_TABLE) -> Column:
    """A code table as one map from text codes to names: a scalar sub-query, evaluated once and held by every task.

    Of several names of a code the least counts, null codes are left out.  More
    than ``largest`` codes are an error: such a table is a dimension to join.
    """
    side = dictionary.select(F.col(code_column).cast("string").alias("_code"), F.col(name_column).alias("_name"))
    side = side.filter(F.col("_code").isNotNull()).groupBy("_code").agg(F.min("_name").alias("_name"))
    whole = F.map_from_entries(F.collect_list(F.struct("_code", "_name")))
    too_many = F.raise_error(F.lit(f"a code table of more than {largest} codes has to be joined"))
    return side.limit(largest + 1).agg(F.when(F.count(F.lit(1)) <= largest, whole).otherwise(too_many)).scalar()


def decode(
    df: DataFrame,
    dictionary: DataFrame,
    code: str,
    name: str,
    parent: str | None = None,
    missing: str | None = None,
    code_column: str = "dic_code",
    name_column: str = "dic_name",
    parent_column: str = "parent_code",
) -> DataFrame:
    """Add the dictionary name of ``code``; a miss gives ``missing``.

    The rows stay where they are: a fact is not shuffled on a code of a few
    values, whatever the broadcast threshold is.  Works on streams, too.
    """
    side = dictionary if parent is None else dictionary.filter(F.col(parent_column) == parent)
    found = F.try_element_at(code_names(side, code_column, name_column), F.col(code).cast("string"))
    return df.withColumn(name, found if missing is None else F.coalesce(found, F.lit(missing)))


def align(parts: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of many summaries on the same keys as one aggregation.

    Every part becomes rows of (keys, its own measures, nulls for the others);
    grouping them once gives the row of a chained full join, with null keys
    matched, one shuffle and map-side combining.  A key that a part has twice is
    an error, as its rows would be mixed.
    """
    measures: dict[str, object] = {}
    owner: dict[str, int] = {}
    for i, part in enumerate(parts.values()):
        for field in part.schema.fields:
            if field.name not in keys:
                if field.name in measures:
                    raise ValueError(f"two parts have a measure {field.name}")
                measures[field.name], owner[field.name] = field.dataType, i
    tagged = []
    for i, part in enumerate(parts.values()):
        have = set(part.columns)
        tagged.append(
            part.select(
                *keys,
                F.lit(i).alias("_part"),
                *[
                    F.col(m) if m in have else F.lit(None).cast(kind).alias(m)
                    for m, kind in measures.items()
                ],
            )
        )
    stacked = reduce(DataFrame.unionByName, tagged)
    rows = [F.count(F.when(F.col("_part") == i, 1)).alias(f"_rows_{i}") for i in range(len(parts))]
    merged = stacked.groupBy(*keys).agg(*[F.max(m).alias(m) for m in measures], *rows)
    labels = list(parts)

    def single(measure: str) -> Column:
        repeated = F.raise_error(F.lit(f"part {labels[owner[measure]]} has several rows with the same {', '.join(keys) or 'empty key'}"))
        return F.when(F.col(f"_rows_{owner[measure]}") > 1, repeated.cast(measures[measure])).otherwise(F.col(measure)).alias(measure)

    return merged.select(*keys, *[single(m) for m in measures])


def one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Columns of several one-row aggregates side by side, without a cross join."""
    return align({str(i): p for i, p in enumerate(parts)}, [])


def with_group_mean(df: DataFrame, keys: Sequence[str], columns: Sequence[str], prefix: str) -> DataFrame:
    """Group means beside each row, by aggregating and joining back."""
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(prefix + c) for c in columns])
    renamed = means.select(*[F.col(k).alias("_g" + k) for k in keys], *[prefix + c for c in columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("_g" + k)) for k in keys])
    return df.join(renamed, same, "left").drop(*["_g" + k for k in keys])


def net_balance(added: DataFrame, removed: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``sum(added) - sum(removed)`` per key by union with negated rows."""
    minus = removed.select(*keys, *[(-F.col(m)).alias(m) for m in measures])
    return (
        added.select(*keys, *measures)
        .unionByName(minus)
        .groupBy(*keys)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    before: int,
    after: int,
    left_columns: dict[str, str],
    right_columns: dict[str, str],
) -> DataFrame:
    """Pairs with equal keys and ``left_ts - before <= right_ts <= left_ts + after`` seconds.

    Both sides carry a time bucket as part of the join key, the right side once
    per bucket it can touch (at most two), so one hot key spreads over its time
    buckets instead of meeting itself as a whole.  Columns map new to source names.
    """
    width = max(before + after, 1)

    def bucket(micros: Column) -> Column:
        return F.floor(micros / F.lit(width * 1_000_000)).cast("long")

    lt, rt = F.unix_micros(F.col(left_ts)), F.unix_micros(F.col(right_ts))
    lside = left.filter(F.col(left_ts).isNotNull()).select(
        *[F.col(k).alias(f"_l_{k}") for k in keys],
        lt.alias("_lt"),
        bucket(lt).alias("_lb"),
        *[F.col(src).alias(new) for new, src in left_columns.items()],
    )
    reach = F.sequence(bucket(rt - F.lit(after * 1_000_000)), bucket(rt + F.lit(before * 1_000_000)))
    rside = right.filter(F.col(right_ts).isNotNull()).select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        rt.alias("_rt"),
        F.explode(reach).alias("_rb"),
        *[F.col(src).alias(new) for new, src in right_columns.items()],
    )
    cond = (F.col("_lb") == F.col("_rb")) & (
        F.col("_rt") - F.col("_lt")
    ).between(F.lit(-before * 1_000_000), F.lit(after * 1_000_000))
    for k in keys:
        cond = cond & (F.col(f"_l_{k}") == F.col(f"_r_{k}"))
    return lside.join(rside, cond, "inner").select(
        *[F.col(f"_l_{k}").alias(k) for k in keys], *left_columns, *right_columns
    )


def overwrite_merge(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which non-null values of the right record win."""
    r = right.select(*[F.col(c).alias("_r_" + c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col("_r_" + k) for k in keys])
    out = [F.col(k) for k in keys]
    for c in left.columns:
        if c in keys:
            continue
        out.append(F.coalesce(F.col("_r_" + c), F.col(c)).alias(c) if c in right.columns else F.col(c))
    out += [F.col("_r_" + c).alias(c) for c in right.columns if c not in left.columns]
    return left.join(r, same, "left").select(*out)


def climb(
    df: DataFrame, tree: DataFrame, start: str, levels: Sequence[str],
    id_column: str = "id", parent_column: str = "parent_id", name_column: str = "name",
) -> DataFrame:
    """Walk a parent-child tree by repeated left joins; adds ``<level>_id`` and ``<level>_name``."""
    out, at = df, start
    for level in levels:
        side = tree.select(
            F.col(id_column).alias("_id"),
            F.col(name_column).alias(f"{level}_name"),
            F.col(parent_column).alias(f"_parent_{level}"),
        )
        out = out.join(side, F.col(at) == F.col("_id"), "left").withColumnRenamed("_id", f"{level}_id")
        at = f"_parent_{level}"
    return out.drop(*[f"_parent_{level}" for level in levels])
