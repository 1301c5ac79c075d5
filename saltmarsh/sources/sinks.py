"""Batch writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.functions.dates import seconds_or_millis
from saltmarsh.functions.text import array_text
from saltmarsh.sources.schemas import database_ddl


def spread_days(df: DataFrame, partition: Sequence[str], files_per_day: int) -> DataFrame:
    """Rows dealt by day and a salt: a large day is written by several tasks, and no day gets a file from every task."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)]), F.lit(files_per_day))
    return df.withColumn("_salt", salt).repartition(*partition, "_salt").drop("_salt")


def append_by_position(df: DataFrame, table: str, files_per_day: int | None = None) -> None:
    """Append to a table with columns matched by position; a different number of columns is an error.

    With ``files_per_day`` rows are dealt by the last column, the partition of the table.
    """
    (spread_days(df, df.columns[-1:], files_per_day) if files_per_day else df).write.mode("append").insertInto(table)


def overwrite_days(df: DataFrame, path: str, partition: Sequence[str] = ("dt",), kind: str = "parquet", files_per_day: int | None = None) -> None:
    """Replace only the day partitions present in ``df`` (safe to re-run).

    With ``files_per_day`` rows are spread as in ``spread_days``.
    """
    out = spread_days(df, partition, files_per_day) if files_per_day else df
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).format(kind).save(path)


def repair_partitions(spark: SparkSession, table: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {table}")


def overwrite_table(df: DataFrame, table: str, folder: str | None = None) -> None:
    """Replace a whole table, columns included; it is kept in ``folder`` if that is given, else in the warehouse."""
    writer = df.write.mode("overwrite")
    (writer.option("path", folder) if folder else writer).saveAsTable(table)


def keep_history(spark: SparkSession, path: str, new_day: DataFrame, day: str = "dt") -> None:
    """Report table with all days kept: the days of ``new_day`` replace themselves only, so a day can run again.

    A row without a day would stay beside its repetition in no day's place, so it is an error.
    """
    dated = F.assert_true(F.col(day).isNotNull(), F.lit("a report row has no day"))
    new_day = new_day.filter(F.coalesce(dated.cast("boolean"), F.lit(True)))
    overwrite_days(new_day, path, [day])


def export_frame(df: DataFrame, casts: dict[str, str] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns as an RDBMS takes them: numeric casts, arrays as ``[a,b]`` text."""
    casts, seen, out = casts or {}, set(), []
    for name in columns or df.columns:
        if name in seen:
            continue
        seen.add(name)
        kind = df.schema[name].dataType
        value: Column = F.col(name)
        if isinstance(kind, T.ArrayType):
            value = array_text(value)
        elif isinstance(kind, (T.MapType, T.StructType)):
            value = F.to_json(value)
        elif name in casts:
            value = value.cast(casts[name])
        out.append(value.alias(name))
    return df.select(*out)


def export_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append", partitions: int = 8) -> None:
    """Write from the executors over ``partitions`` connections; what comes before keeps its own parallelism."""
    export_frame(df).repartition(partitions).write.jdbc(url, table, mode=mode, properties=properties)


def export_ddl(df: DataFrame, table: str, primary_key: str | None = "id") -> str:
    return database_ddl(table, export_frame(df).schema, primary_key)


def upsert_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """Merge a staging table into a target that has a unique key on ``keys``."""
    names = ", ".join(f"`{c}`" for c in columns)
    updates = ", ".join(f"`{c}` = VALUES(`{c}`)" for c in columns if c not in keys)
    return (
        f"INSERT INTO `{table}` ({names}) SELECT {names} FROM `{staging}` "
        f"ON DUPLICATE KEY UPDATE {updates}"
    )


def execute_jdbc(spark: SparkSession, url: str, statements: Sequence[str], properties: dict[str, str]) -> None:
    """Statements on the server, in one transaction."""
    connection = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url, properties.get("user"), properties.get("password"))
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            statement.executeUpdate(text)
            statement.close()
        connection.commit()
    finally:
        connection.close()


def upsert_jdbc(df: DataFrame, url: str, table: str, keys: Sequence[str], properties: dict[str, str], batch: str | int = "") -> None:
    """Parallel write to a staging table of its own (named after ``batch``), then one transaction on the server."""
    flat = export_frame(df)
    staging = f"{table}_staging_{batch}" if batch != "" else f"{table}_staging"
    flat.write.jdbc(url, staging, mode="overwrite", properties=properties)
    execute_jdbc(df.sparkSession, url, [upsert_statement(table, staging, flat.columns, keys)], properties)
    execute_jdbc(df.sparkSession, url, [f"DROP TABLE `{staging}`"], properties)


def day_bucket(epoch: Column) -> Column:
    """``yyyyMMdd`` of an epoch in seconds or millis; bad values go to ``error_bucket``."""
    millis = seconds_or_millis(epoch)
    return F.coalesce(F.date_format(F.timestamp_millis(millis), "yyyyMMdd"), F.lit("error_bucket"))


def write_day_buckets(df: DataFrame, path: str, epoch: str, kind: str = "json") -> None:
    df.withColumn("day", day_bucket(F.col(epoch))).write.mode("append").partitionBy("day").format(kind).save(path)
