"""Joins of streams with streams and with dimension tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.operators.relations import code_names, decode
from saltmarsh.streaming.inputs import AVAILABLE_NOW, row_image


def interval_join_stream(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
    before: str, after: str, prefix: str = "info_", delay: str = "10 seconds",
) -> DataFrame:
    """Stream-stream join on keys with ``left - before <= right <= left + after``.

    Watermarks on both sides let Spark drop state; right columns get a prefix.
    """
    l = left.withWatermark(left_ts, delay)
    r = right.select(*[F.col(c).alias(prefix + c) for c in right.columns]).withWatermark(prefix + right_ts, delay)
    same: Column = reduce(lambda a, b: a & b, [F.col(k) == F.col(prefix + k) for k in keys])
    low = F.col(left_ts) - F.expr(f"INTERVAL {before}")
    high = F.col(left_ts) + F.expr(f"INTERVAL {after}")
    return l.join(r, same & (F.col(prefix + right_ts) >= low) & (F.col(prefix + right_ts) <= high), "inner")


def lookup(stream: DataFrame, dimension: DataFrame, on: str, key: str, columns: dict[str, str], missing: str | None = "N/A") -> DataFrame:
    """Left join with a dimension table; a miss gives ``missing``.

    A static file table is read again by each micro-batch, so updates to the
    dimension show up without a cache.
    """
    side = dimension.select(F.col(key).alias("_k"), *[F.col(src).alias("_d_" + new) for new, src in columns.items()])
    value = (lambda c: F.col(c)) if missing is None else (lambda c: F.coalesce(F.col(c), F.lit(missing)))
    return stream.join(side, F.col(on) == F.col("_k"), "left").select(
        *stream.columns, *[value("_d_" + new).alias(new) for new in columns]
    )


def comment_facts(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the appraisal decoded, without moving them to their appraisal code."""
    return decode(comments, dictionary, "appraise", "appraise_name", missing="N/A")


def route_by_config(batch: DataFrame, config: DataFrame) -> DataFrame:
    """Changes of configured tables with target table, row key column and column list.

    ``config`` has source_table, sink_table, sink_row_key, sink_columns (comma list).
    It is looked up, not joined: the changes of a table stay where they are,
    however many they are.  More than ``LARGEST_CODE_TABLE`` tables are an error.
    """
    target = F.struct("sink_table", "sink_row_key", F.split("sink_columns", ",").alias("_cols"))
    targets = config.groupBy("source_table").agg(F.collect_list(target).alias("_targets"))
    found = F.try_element_at(code_names(targets, "source_table", "_targets"), F.col("table"))
    wanted = F.map_filter(F.col("row"), lambda k, v: F.array_contains(F.col("_cols"), k))
    return (
        batch.select("*", F.inline(found).alias("sink_table", "sink_row_key", "_cols"))
        .withColumn("row", F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")))
        .withColumn("key_value", F.try_element_at(F.col("row"), F.col("sink_row_key")))
        .select("sink_table", "op", "ts_ms", "key_value", F.md5("key_value").alias("row_key"), wanted.alias("row"))
    )


def current_config(config_changes: DataFrame) -> DataFrame:
    """Configuration in force: the latest change per source table, deletes removed."""
    image = row_image()
    rows = config_changes.select(image["source_table"].alias("source_table"), image.alias("_row"), "op", "ts_ms")
    last = rows.groupBy("source_table").agg(F.max_by(F.struct("op", "_row"), "ts_ms").alias("_l"))
    return last.filter(F.col("_l.op") != "d").select(
        "source_table", *[F.col("_l._row")[c].alias(c) for c in ("sink_table", "sink_row_key", "sink_columns")]
    )


def dimension_sync(changes: DataFrame, read_config: Callable[[], DataFrame], apply: Callable[[DataFrame, int], None], checkpoint: str, trigger: Mapping = AVAILABLE_NOW):
    """Route changes by a configuration that is read anew for every micro-batch."""
    return (
        changes.writeStream.foreachBatch(lambda batch, i: apply(route_by_config(batch, read_config()), i))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
