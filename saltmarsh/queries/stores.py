"""Readers and writers on whole tables: rows are written to the shared folder and read back as the next job would."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.queries import adapters as a
from saltmarsh.queries.registry import query
from saltmarsh.session import shared_folder
from saltmarsh.sources import schemas, sinks, tables
from saltmarsh.streaming import inputs, merge

DAY = "strftime(ts, '%Y%m%d')"
HALF = "day(ts) > 15"  # what comes second


def _day_table(spark: SparkSession, purpose: str, rows: DataFrame, kind: str = "parquet") -> tuple[str, str]:
    """A new table of the rows' columns, partitioned by ``dt``, in the shared folder: its name and its folder."""
    name, folder = f"store_{uuid.uuid4().hex}", shared_folder(spark, purpose)
    spark.sql(schemas.day_table_ddl(name, rows.schema, folder, kind))
    return name, folder


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return a.events(spark, sf).select("event_id", "user_id", "value", F.date_format("ts", "yyyyMMdd").alias("dt"))


# -- readers ----------------------------------------------------------------------


@query("src02_csv_with_header", """
SELECT p_partkey, p_name, p_brand, p_size, p_retailprice, 'declared' AS types FROM part
UNION ALL SELECT p_partkey, p_name, p_brand, p_size, p_retailprice, 'inferred' FROM part
""")
def src02_csv(spark, sf):
    """CSV with a header, once with declared and once with inferred types."""
    folder = shared_folder(spark, "csv")
    parts = a.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    parts.write.option("header", True).option("escape", '"').csv(folder)
    declared = tables.read_csv(spark, folder, parts.schema).withColumn("types", F.lit("declared"))
    guessed = tables.read_csv(spark, folder)
    inferred = guessed.select(*[F.col(f.name).cast(f.dataType) for f in parts.schema], F.lit("inferred").alias("types"))
    return declared.unionByName(inferred)


@query("src02_raw_text", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events
""")
def src02_raw(spark, sf):
    """Raw-layer text: tabs, a header line, nulls as NULL."""
    folder = shared_folder(spark, "raw")
    rows = a.events(spark, sf).select(
        "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
    )
    rows.write.csv(folder, sep="\t", header=True, nullValue="NULL")
    return tables.read_raw_text(spark, folder, rows.schema)


@query("src01_pruned_day", f"""
SELECT event_id, user_id, value, {DAY} AS dt FROM events WHERE {DAY} = (SELECT max({DAY}) FROM events)
""")
def src01_day(spark, sf):
    """One day of a partitioned catalogue table; only its files are opened."""
    rows = _daily(spark, sf)
    name, _ = _day_table(spark, "days", rows)
    sinks.append_by_position(rows, name, files_per_day=2)
    return tables.read_day(spark, name, rows.agg(F.max("dt")).first()[0])


@query("src09_json_rows", """
SELECT event_id, user_id, event_type, value, true AS has_arrived FROM events WHERE event_id % 5 <> 0
""")
def src09_json(spark, sf):
    """A stream of JSON rows with a processing-time column; rows without a body are left out."""
    folder = shared_folder(spark, "json-rows")
    stream = inputs.table_files(spark, f"{sf}/events.parque[t]", a.SCHEMAS["events"])
    body = F.when(F.col("event_id") % 5 != 0, F.to_json(F.struct("event_id", "user_id", "event_type", "value"))).alias("value")
    parsed = F.from_json("value", "event_id bigint, user_id bigint, event_type string, value double")
    rows = inputs.with_arrival_time(inputs.non_null(stream.select(body)).select(parsed.alias("r")).select("r.*"))
    merge.json_lines_sink(rows, f"{folder}/out", f"{folder}/cp").awaitTermination()
    got = spark.read.schema(rows.schema).json(f"{folder}/out")
    return got.select("event_id", "user_id", "event_type", "value", F.col("proc_time").isNotNull().alias("has_arrived"))


@query("src11_log_tail", f"""
SELECT CAST(event_id AS VARCHAR) || ' ' || event_type AS line, CASE WHEN {HALF} THEN 'second' ELSE 'first' END AS run FROM events
""")
def src11_tail(spark, sf):
    """New lines of a folder of logs: the second run takes up where the first one ended, so each line comes once."""
    folder = shared_folder(spark, "tail")
    late = F.dayofmonth("ts") > 15
    lines = a.events(spark, sf).select(F.concat_ws(" ", "event_id", "event_type").alias("value"), late.alias("late"))

    def tail(rows: DataFrame, run: str) -> None:
        rows.select("value").write.mode("append").text(f"{folder}/logs")
        told = inputs.text_lines(spark, f"{folder}/logs").select(F.col("value").alias("line"), F.lit(run).alias("run"))
        merge.json_lines_sink(told, f"{folder}/out", f"{folder}/cp").awaitTermination()

    tail(lines.filter(~F.col("late")), "first")
    tail(lines.filter("late"), "second")
    return spark.read.schema("line string, run string").json(f"{folder}/out").drop("batch_id")


# -- writers ----------------------------------------------------------------------


@query("snk01_append_by_position", f"""
SELECT event_id AS id, user_id AS who, value AS amount, {DAY} AS dt FROM events
""")
def snk01_append(spark, sf):
    """Two appends by position into a day table whose columns have other names."""
    rows = _daily(spark, sf)
    name, _ = _day_table(spark, "append", rows.toDF("id", "who", "amount", "dt"))
    second = F.col("event_id") % 2 == 1
    sinks.append_by_position(rows.filter(~second), name, files_per_day=2)
    sinks.append_by_position(rows.filter(second), name)
    return spark.table(name)


def _days_again(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """All days, then the second half of the month twice with other values, read through the repaired catalogue."""
    rows = _daily(spark, sf)
    name, folder = _day_table(spark, f"days-{kind}", rows, kind)
    sinks.overwrite_days(rows, folder, kind=kind, files_per_day=2)
    again = rows.filter(F.substring("dt", 7, 2) > "15").withColumn("value", F.col("value") + 1)
    for _ in range(2):
        sinks.overwrite_days(again, folder, kind=kind)
    sinks.repair_partitions(spark, name)
    return spark.table(name).withColumn("kind", F.lit(kind))


@query("snk02_overwrite_days", f"""
SELECT event_id, user_id, CASE WHEN {HALF} THEN value + 1 ELSE value END AS value, {DAY} AS dt, kind
FROM events CROSS JOIN (VALUES ('parquet'), ('orc')) AS k(kind)
""")
def snk02_days(spark, sf):
    """Days that are written again replace themselves and no other day, in both file formats."""
    return _days_again(spark, sf, "parquet").unionByName(_days_again(spark, sf, "orc"))


@query("snk03_overwrite_table", """
SELECT c_custkey, c_nationkey, upper(c_name) AS name FROM customer
""")
def snk03_table(spark, sf):
    """A whole table replaced by one with other columns."""
    name, folder = f"store_{uuid.uuid4().hex}", shared_folder(spark, "whole")
    customers = a.table(spark, sf, "customer")
    sinks.overwrite_table(customers.select("c_custkey", "c_name"), name, folder)
    sinks.overwrite_table(customers.select("c_custkey", "c_nationkey", F.upper("c_name").alias("name")), name, folder)
    return spark.table(name)


@query("snk15_report_history", f"""
SELECT {DAY} AS dt, event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2
""")
def snk15_history(spark, sf):
    """A report with its history: the later days are first reported from half of their rows, then run again whole."""
    folder = shared_folder(spark, "history")
    events = a.events(spark, sf).withColumn("dt", F.date_format("ts", "yyyyMMdd"))
    late = F.dayofmonth("ts") > 15

    def report(rows: DataFrame) -> DataFrame:
        return rows.groupBy("dt", "event_type").agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))

    sinks.keep_history(spark, folder, report(events.filter(~late)))
    sinks.keep_history(spark, folder, report(events.filter(late & (F.col("event_id") % 2 == 0))))
    sinks.keep_history(spark, folder, report(events.filter(late)))
    return spark.read.schema("event_type string, events bigint, users bigint, dt string").parquet(folder)


@query("snk10_json_lines", """
SELECT event_id, user_id, CAST(value AS DECIMAL(18,2)) AS amount, event_type FROM events
""")
def snk10_lines(spark, sf):
    """JSON lines for a bulk load, one folder a micro-batch."""
    folder = shared_folder(spark, "lines")
    stream = inputs.table_files(spark, f"{sf}/events.parque[t]", a.SCHEMAS["events"])
    rows = stream.select("event_id", "user_id", F.col("value").cast("decimal(18,2)").alias("amount"), "event_type")
    merge.json_lines_sink(rows, f"{folder}/out", f"{folder}/cp").awaitTermination()
    return spark.read.schema(rows.schema).json(f"{folder}/out").drop("batch_id")


@query("snk04_export_types", """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(16,2)) AS total, '[' || o_orderstatus || ',' || o_orderpriority || ']' AS marks FROM orders
""")
def snk04_types(spark, sf):
    """Rows as a database takes them, read back with the types of the statement that makes the table."""
    marks = F.array("o_orderstatus", "o_orderpriority").alias("marks")
    flat = sinks.export_frame(a.table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(16,2)").alias("total"), marks))
    kinds = [(f.name, schemas.database_type(f.dataType)) for f in flat.schema]
    folder = shared_folder(spark, "export")
    flat.write.csv(folder, header=True)
    return tables.read_csv(spark, folder, schemas.schema_from_catalog(kinds))
