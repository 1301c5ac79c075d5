"""Keyed sinks for ``foreachBatch``.

A batch is written to its own ``batch_id=<n>`` directory, overwriting it on a
replay.  The current rows are the latest per key over all batches, taken with
one aggregation.  Nothing is read back while writing, so a batch costs what it
contains, not what the target holds; :func:`fold_rows` and
:func:`fold_partial_rows` fold old batches in place, behind a manifest.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from saltmarsh.operators.ranking import top_n_rows
from saltmarsh.sources.sinks import execute_jdbc
from saltmarsh.streaming import versions
from saltmarsh.streaming.inputs import AVAILABLE_NOW


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def keep_latest_batch(batch: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """One row per key of a batch, the one with the greatest sequence value."""
    box = F.struct(*batch.columns)
    return batch.groupBy(*[F.col(k).alias("_k" + k) for k in keys]).agg(F.max_by(box, F.col(seq)).alias("_r")).select("_r.*")


def upsert_stream(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], seq: str, output_mode: str = "update", trigger: Mapping = AVAILABLE_NOW) -> StreamingQuery:
    """Start a query whose result rows replace earlier rows of the same key."""
    return (
        df.writeStream.outputMode(output_mode)
        .foreachBatch(lambda batch, i: write_batch(keep_latest_batch(batch, keys, seq), i, path))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _latest(rows: DataFrame, keys: Sequence[str], seq: str | None) -> DataFrame:
    order = F.struct(*([F.col(seq)] if seq else []), F.col("batch_id"))
    names = [c for c in rows.columns if c != "batch_id"]
    return rows.groupBy(*[F.col(k).alias("_k" + k) for k in keys]).agg(F.max_by(F.struct(*names), order).alias("_r")).select("_r.*")


def current_rows(spark: SparkSession, path: str, keys: Sequence[str], seq: str | None = None, deleted: str | None = None) -> DataFrame:
    """Latest row per key over all batches; the sequence decides, then the later batch.

    With ``deleted`` (a boolean column) removed keys disappear.
    """
    last = _latest(versions.all_rows(spark, path), keys, seq)
    return last.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted) if deleted else last


def fold_rows(spark: SparkSession, path: str, keys: Sequence[str], seq: str | None = None) -> versions.Version:
    """Fold the batches of a table of whole rows; removed keys stay marked, so an older row that comes late stays older."""
    return versions.fold(spark, path, lambda rows: _latest(rows, keys, seq))


def partial_update(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Per key and column the last non-null value by sequence; nulls never overwrite."""
    values = [c for c in df.columns if c not in keys and c != seq]
    return df.groupBy(*keys).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in values], F.max(seq).alias(seq)
    )


def cart_partial_rows(changes: DataFrame) -> DataFrame:
    """Cart changes as partial updates of (id, ds); deletes are ignored."""
    rows = changes.filter(~F.col("is_dirty") & (F.col("table") == "cart_info") & (F.col("op") != "d"))
    after = F.col("after")
    names = ("user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked", "is_ordered", "create_time", "operate_time")
    return rows.select(
        after["id"].alias("id"), F.date_format(F.timestamp_millis("ts_ms"), "yyyyMMdd").alias("ds"),
        *[after[n].alias(n) for n in names], "ts_ms",
    )


def partial_update_stream(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], seq: str, trigger: Mapping = AVAILABLE_NOW) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(lambda batch, i: write_batch(_with_times(batch, keys, seq), i, path))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _with_times(batch: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """A batch reduced to one row per key; each value keeps the sequence it came with."""
    values = [c for c in batch.columns if c not in keys and c != seq]
    return batch.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(seq).alias("at"), F.col(c).alias("v")))).alias(c)
            for c in values
        ],
        F.max(seq).alias(seq),
    )


def _newest_values(rows: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """One row per key; each column keeps its newest value together with the sequence it came with."""
    values = [c for c in rows.columns if c not in keys and c not in (seq, "batch_id")]
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values], F.max(seq).alias(seq))


def current_partial_rows(spark: SparkSession, path: str, keys: Sequence[str], seq: str) -> DataFrame:
    rows = _newest_values(versions.all_rows(spark, path), keys, seq)
    values = [c for c in rows.columns if c not in keys and c != seq]
    return rows.select(*keys, *[F.col(c)["v"].alias(c) for c in values], seq)


def fold_partial_rows(spark: SparkSession, path: str, keys: Sequence[str], seq: str) -> versions.Version:
    """Fold the batches of a partial-update table; values keep their sequence, so later and late updates merge as before."""
    return versions.fold(spark, path, lambda rows: _newest_values(rows, keys, seq))


def compact(spark: SparkSession, path: str, target: str, keys: Sequence[str], seq: str, partial: bool = False) -> None:
    """The current rows of a table as one batch of a new table (of the same kind with ``partial``)."""
    rows = versions.all_rows(spark, path)
    now = _newest_values(rows, keys, seq) if partial else _latest(rows, keys, seq)
    now.write.mode("overwrite").parquet(f"{target}/batch_id=-1")


def ranked_stream(df: DataFrame, path: str, checkpoint: str, window: Sequence[str], keys: Sequence[str], trigger: Mapping = AVAILABLE_NOW) -> StreamingQuery:
    """Windowed sums in update mode, kept per (window, key) for ranking on read.

    A window may change over several micro-batches, so the rank is taken over
    the whole window when it is read, not over the rows of one batch.
    """
    return (
        df.writeStream.outputMode("update")
        .foreachBatch(lambda batch, i: write_batch(batch, i, path))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def current_top(spark: SparkSession, path: str, window: Sequence[str], keys: Sequence[str], measure: str, n: int = 10) -> DataFrame:
    """Top ``n`` keys of every window from the kept sums."""
    rows = current_rows(spark, path, [*window, *keys])
    return top_n_rows(rows, window, [F.col(measure).desc(), *[F.col(k) for k in keys]], n)


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None) -> StreamingQuery:
    """JSON rows to a topic, acknowledged by all replicas, keyed for upsert topics."""
    row = F.to_json(F.struct(*df.columns)).alias("value")
    out = df.select(row) if key is None else df.select(F.col(key).cast("string").alias("key"), row)
    return (
        out.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("checkpointLocation", checkpoint)
        .start()
    )


def replace_batch(batch: DataFrame, batch_id: int, delete: Callable[[str], None], append: Callable[[DataFrame], None], table: str) -> None:
    """Append one micro-batch with its id, after the rows of an earlier try of the same batch were deleted."""
    delete(f"DELETE FROM `{table}` WHERE `batch_id` = {batch_id}")
    append(batch.withColumn("batch_id", F.lit(batch_id)))


def jdbc_sink(
    df: DataFrame, url: str, table: str, properties: dict[str, str], checkpoint: str, output_mode: str = "append", trigger: Mapping = AVAILABLE_NOW,
) -> StreamingQuery:
    """Window results appended to a database table that has a ``batch_id``; a replayed batch replaces its own rows."""
    def write(batch: DataFrame, i: int) -> None:
        replace_batch(
            batch, i, lambda text: execute_jdbc(batch.sparkSession, url, [text], properties),
            lambda rows: rows.write.jdbc(url, table, mode="append", properties=properties), table,
        )

    return df.writeStream.outputMode(output_mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def json_lines_sink(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append", trigger: Mapping = AVAILABLE_NOW) -> StreamingQuery:
    """JSON-lines files for a bulk load; a replayed batch overwrites its own files."""
    return (
        df.writeStream.outputMode(output_mode)
        .foreachBatch(lambda batch, i: batch.write.mode("overwrite").json(f"{path}/batch_id={i}"))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def dimension_rows(routed: DataFrame) -> DataFrame:
    """Routed dimension changes as upsert rows; deletes are ignored."""
    return routed.filter(F.col("op") != "d").select("sink_table", "row_key", "row", "ts_ms")
