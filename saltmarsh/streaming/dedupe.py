"""Removing repeated records from streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from saltmarsh.operators.ranking import first_per_key
from saltmarsh.operators.sequences import ordered_columns
from saltmarsh.streaming.inputs import AVAILABLE_NOW
from saltmarsh.streaming.merge import write_batch


def within_watermark(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "10 seconds") -> DataFrame:
    """Exact: one row per key, state is dropped once the watermark passes."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def record_hash(df: DataFrame, ignore: Sequence[str] = ()) -> Column:
    """128-bit text hash of a record without the ignored columns."""
    return F.md5(F.to_json(F.struct(*[c for c in df.columns if c not in ignore])))


def whole_records(df: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Equal records of a key survive once (columns in ``ignore`` do not matter)."""
    hashed = df.withColumn("_hash", record_hash(df, ignore))
    return hashed.dropDuplicates([*keys, "_hash"]).drop("_hash")


def whole_records_batch(df: DataFrame, keys: Sequence[str], order: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Batch form that keeps the first of equal records by ``order``."""
    hashed = df.withColumn("_hash", record_hash(df, ignore))
    return first_per_key(hashed, [*keys, "_hash"], [F.col(c) for c in order]).drop("_hash")


def newer_only(df: DataFrame, keys: Sequence[str], arrival: Sequence[str], ts: str, slice_by: Column) -> DataFrame:
    """Batch form of the monotone filter: rows newer than everything that arrived before."""
    marked = ordered_columns(df, keys, arrival, slice_by, max_before={"_seen": ts})
    return marked.filter(F.col("_seen").isNull() | (F.col(ts) > F.col("_seen"))).drop("_seen")


def first_rows_stream(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], trigger: Mapping = AVAILABLE_NOW) -> StreamingQuery:
    """Exact, for keys that may come back at any time: each micro-batch writes its first row per key.

    The rows of a key are reduced before the shuffle, and nothing is read back
    while writing; :func:`first_rows` takes the first row per key over all batches.
    """
    place = [F.col(c) for c in order]
    return (
        df.writeStream.foreachBatch(lambda batch, i: write_batch(first_per_key(batch, keys, place), i, path))
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def first_rows(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key by ``order`` over all batches, whatever order they came in."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    return first_per_key(rows, keys, [F.col(c) for c in order])
