"""Type mapping between database columns and Spark schemas, and table DDL."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import types as T

# Database type -> Spark type.
FROM_DATABASE = {
    "tinyint": T.ByteType(), "smallint": T.ShortType(), "mediumint": T.IntegerType(), "int": T.IntegerType(),
    "integer": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
    "bit": T.BooleanType(), "boolean": T.BooleanType(), "date": T.DateType(), "datetime": T.TimestampType(),
    "timestamp": T.TimestampType(), "time": T.StringType(), "year": T.IntegerType(), "char": T.StringType(),
    "varchar": T.StringType(), "tinytext": T.StringType(), "text": T.StringType(), "mediumtext": T.StringType(),
    "longtext": T.StringType(), "json": T.StringType(), "enum": T.StringType(), "set": T.StringType(),
    "blob": T.BinaryType(), "longblob": T.BinaryType(), "mediumblob": T.BinaryType(), "tinyblob": T.BinaryType(),
    "binary": T.BinaryType(), "varbinary": T.BinaryType(),
}

# Unsigned database type -> the Spark type that holds its range.
FROM_UNSIGNED = {"tinyint": T.ShortType(), "smallint": T.IntegerType(), "int": T.LongType(), "integer": T.LongType()}

# Spark type -> database type.
TO_DATABASE = {
    T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INT", T.LongType: "BIGINT",
    T.FloatType: "FLOAT", T.DoubleType: "DOUBLE", T.BooleanType: "TINYINT(1)", T.DateType: "DATE",
    T.TimestampType: "DATETIME", T.StringType: "LONGTEXT", T.BinaryType: "LONGBLOB",
}
KEY_TEXT = "VARCHAR(255)"  # an index needs a bounded text


def spark_type(database_type: str) -> T.DataType:
    """Spark type of a database column type such as ``decimal(10,2)``; unknown types are text.

    ``tinyint(1)`` is a flag, and unsigned whole numbers take the next wider type.
    """
    name = database_type.strip().lower()
    number = re.fullmatch(r"(?:decimal|numeric)\s*(?:\((\d+)\s*(?:,\s*(\d+))?\))?(?: unsigned)?", name)
    if number:
        return T.DecimalType(int(number.group(1) or 10), int(number.group(2) or 0))
    if re.match(r"tinyint\s*\(1\)", name):
        return T.BooleanType()
    base = re.match(r"[a-z]+", name)
    word = base.group(0) if base else ""
    if "unsigned" in name and word in FROM_UNSIGNED:
        return FROM_UNSIGNED[word]
    return FROM_DATABASE.get(word, T.StringType())


def database_type(kind: T.DataType) -> str:
    """Database column type of a Spark type; nested types are stored as text."""
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return TO_DATABASE.get(type(kind), "TEXT")


def schema_from_catalog(columns: Sequence[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, spark_type(kind)) for name, kind in columns])


def external_table_ddl(
    table: str, schema: T.StructType, location: str, kind: str = "PARQUET", partition: str = "dt",
    comments: dict[str, str] | None = None,
) -> str:
    """CREATE TABLE text of a day-partitioned external table."""
    comments = comments or {}
    lines = []
    for f in schema.fields:
        if f.name == partition:
            continue
        note = comments.get(f.name)
        lines.append(f"  `{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{note}'" if note else ""))
    body = ",\n".join(lines)
    return (
        f"CREATE EXTERNAL TABLE IF NOT EXISTS {table} (\n{body}\n)\n"
        f"PARTITIONED BY (`{partition}` string)\nSTORED AS {kind}\nLOCATION '{location}'"
    )


def day_table_ddl(table: str, schema: T.StructType, location: str, kind: str = "parquet", partition: str = "dt") -> str:
    """CREATE TABLE text of a day-partitioned table in Spark's own catalogue; the partition column comes last."""
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != partition)
    return f"CREATE TABLE IF NOT EXISTS {table} ({body}, `{partition}` string) USING {kind} PARTITIONED BY (`{partition}`) LOCATION '{location}'"


def database_ddl(table: str, schema: T.StructType, primary_key: str | None = "id") -> str:
    """CREATE TABLE text for an export target; a repeated column name is written once.

    Texts are unbounded; only a text that is the primary key has a length.
    """
    seen: dict[str, T.DataType] = {}
    for f in schema.fields:
        seen.setdefault(f.name, f.dataType)
    keyed = {primary_key} if isinstance(seen.get(primary_key or ""), T.StringType) else set()
    lines = [f"  `{name}` {KEY_TEXT if name in keyed else database_type(kind)}" for name, kind in seen.items()]
    if primary_key and primary_key in seen:
        lines.append(f"  PRIMARY KEY (`{primary_key}`)")
    return f"CREATE TABLE IF NOT EXISTS `{table}` (\n" + ",\n".join(lines) + "\n)"
