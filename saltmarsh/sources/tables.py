"""Batch readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_day(spark: SparkSession, table: str, day: str, column: str = "dt") -> DataFrame:
    """One day partition of a catalogue table (the filter prunes partitions)."""
    return spark.table(table).filter(F.col(column) == day)


def read_files(spark: SparkSession, path: str, kind: str = "parquet", schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.format(kind)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, separator: str = ",") -> DataFrame:
    """CSV with a header; types come from the schema, inference only without one."""
    reader = spark.read.option("header", True).option("sep", separator)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_raw_text(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Raw-layer text: tab separated, one header line, nulls written as NULL."""
    return spark.read.csv(path, schema=schema, sep="\t", header=True, nullValue="NULL")


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    day: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    fetch_size: int = 1000,
) -> DataFrame:
    """Whole table over JDBC, read in parallel when a split column is given.

    ``split`` is (column, lower, upper, partitions).
    """
    options = {**properties, "fetchsize": str(fetch_size)}
    if split is None:
        df = spark.read.jdbc(url, table, properties=options)
    else:
        column, lower, upper, parts = split
        df = spark.read.jdbc(
            url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=options
        )
    return df if day is None else df.withColumn("dt", F.lit(day))


def by_own_day(df: DataFrame, time_column: str, name: str = "dt") -> DataFrame:
    """Partition column from each row's own create time; rows without it are dropped."""
    return df.filter(F.col(time_column).isNotNull()).withColumn(name, F.date_format(time_column, "yyyyMMdd"))


def pull_by_own_day(
    spark: SparkSession, url: str, tables: dict[str, str], properties: dict[str, str],
    write: Callable[[str, DataFrame], None], split: dict[str, tuple[str, int, int, int]] | None = None,
) -> None:
    """Pull several tables, each partitioned by its own time column (table -> column)."""
    for table, time_column in tables.items():
        write(table, by_own_day(jdbc_table(spark, url, table, properties, split=(split or {}).get(table)), time_column))


def default_partition(day: str) -> Column:
    return F.lit(day).alias("dt")
