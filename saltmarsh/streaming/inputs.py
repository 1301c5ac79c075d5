"""Streaming sources and change-record parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.functions.documents import CHANGE_RECORD, parse_records

# default trigger of the sinks; {"processingTime": "10 seconds"} keeps a query running
AVAILABLE_NOW = {"availableNow": True}


def kafka_source(spark: SparkSession, servers: str, topic: str, group: str, offset: str = "earliest", rows_per_trigger: int | None = None) -> DataFrame:
    """Topic as a string ``value`` column; null payloads are dropped.

    New partitions are discovered by Spark; ``rows_per_trigger`` bounds a batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("kafka.group.id", group)
        .option("startingOffsets", offset)
        .option("failOnDataLoss", "true")
    )
    if rows_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", rows_per_trigger)
    return non_null(reader.load().select(F.col("value").cast("string").alias("value"), "timestamp"))


def non_null(df: DataFrame, column: str = "value") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def text_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """New lines of files in a directory; the checkpoint remembers the position."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def table_files(spark: SparkSession, path: str, schema, kind: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(kind).load(path)


def with_arrival_time(df: DataFrame, name: str = "proc_time") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def change_rows(df: DataFrame, column: str = "value") -> DataFrame:
    """Change envelope as columns op, before, after, source, db, table, ts_ms and ``is_dirty``."""
    parsed = parse_records(df, column, CHANGE_RECORD, "chg")
    return parsed.select(
        *df.columns,
        "is_dirty",
        F.col("chg.op").alias("op"),
        F.col("chg.before").alias("before"),
        F.col("chg.after").alias("after"),
        F.col("chg.source").alias("source"),
        F.col("chg.source")["db"].alias("db"),
        F.col("chg.source")["table"].alias("table"),
        F.col("chg.ts_ms").alias("ts_ms"),
    )


def row_image() -> Column:
    """The row a change speaks about: ``after``, or ``before`` of a delete."""
    return F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))


def archive_rows(changes: DataFrame) -> DataFrame:
    """Change-log rows for an archive table keyed by id."""
    image = row_image()
    return changes.filter(~F.col("is_dirty")).select(
        image["id"].alias("id"), "op", "db", "table",
        F.to_json("before").alias("before"), F.to_json("after").alias("after"), "ts_ms",
    )


def event_time(millis: Column) -> Column:
    """Event time from epoch millis; a missing one counts as the epoch."""
    return F.timestamp_millis(F.coalesce(millis.cast("long"), F.lit(0)))


def with_event_time(df: DataFrame, millis: str, delay: str = "5 seconds", name: str = "event_time") -> DataFrame:
    """Bounded-out-of-orderness watermark; "0 seconds" for monotone streams."""
    return df.withColumn(name, event_time(F.col(millis))).withWatermark(name, delay)
