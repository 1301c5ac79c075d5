import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.sources import schemas, sinks, tables
from saltmarsh.streaming import merge
from tests.conftest import rows


def test_database_types_map_both_ways():
    assert schemas.spark_type("decimal(10,2)") == T.DecimalType(10, 2)
    assert schemas.spark_type("BIGINT(20) unsigned") == T.LongType()
    assert schemas.spark_type("varchar(255)") == T.StringType()
    assert schemas.spark_type("geometry") == T.StringType()
    assert schemas.database_type(T.DecimalType(16, 2)) == "DECIMAL(16,2)"
    assert schemas.database_type(T.ArrayType(T.LongType())) == "TEXT"


def test_ddl_texts():
    schema = schemas.schema_from_catalog([("id", "bigint"), ("price", "decimal(10,2)"), ("dt", "varchar(10)")])
    ddl = schemas.external_table_ddl("ods.sku", schema, "/w/sku", comments={"id": "key"})
    assert "`id` bigint COMMENT 'key'" in ddl and "PARTITIONED BY (`dt` string)" in ddl and ddl.count("`dt`") == 1
    assert "PRIMARY KEY (`id`)" in schemas.database_ddl("sku", schema)
    assert "PRIMARY KEY" not in schemas.database_ddl("sku", schemas.schema_from_catalog([("a", "int")]))


def test_upsert_statement():
    text = sinks.upsert_statement("t", "s", ["k", "v"], ["k"])
    assert text == "INSERT INTO `t` (`k`, `v`) SELECT `k`, `v` FROM `s` ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)"


def test_export_frame_flattens_and_skips_repeated_columns(spark):
    df = spark.createDataFrame([(1, [1, 2], {"a": 1}), (2, None, None)], "id int, xs array<int>, m map<string,int>")
    out = sinks.export_frame(df, {"id": "bigint"}, ["id", "xs", "m", "id"])
    assert rows(out) == [(1, "[1,2]", '{"a":1}'), (2, "[]", None)] and out.columns == ["id", "xs", "m"]


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_overwrite_days_replaces_only_its_days(spark, tmp_path, kind):
    path = str(tmp_path / kind)
    first = spark.createDataFrame([(1, "20240101"), (2, "20240102")], "v int, dt string")
    sinks.overwrite_days(first, path, kind=kind)
    again = spark.createDataFrame([(9, "20240102"), (8, "20240102")], "v int, dt string")
    sinks.overwrite_days(again, path, kind=kind, files_per_day=2)
    sinks.keep_history(spark, path, again) if kind == "parquet" else None
    got = spark.read.format(kind).load(path).select("v", F.col("dt").cast("string"))
    assert rows(got) == [(1, "20240101"), (8, "20240102"), (9, "20240102")]


def test_tables_round_trip(spark, tmp_path):
    spark.sql("CREATE TABLE IF NOT EXISTS sink_t (v INT, dt STRING) USING parquet PARTITIONED BY (dt) LOCATION '%s'" % (tmp_path / "t"))
    sinks.append_by_position(spark.createDataFrame([(1, "20240101"), (2, "20240102")], "v int, dt string"), "sink_t")
    sinks.repair_partitions(spark, "sink_t")
    assert rows(tables.read_day(spark, "sink_t", "20240102"), "v") == [(2,)]
    plan = tables.read_day(spark, "sink_t", "20240102")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    spark.sql("DROP TABLE sink_t")


def test_raw_text_and_csv(spark, tmp_path):
    raw = tmp_path / "raw.txt"
    raw.write_text("id\tname\n1\tNULL\n2\tb\n")
    assert rows(tables.read_raw_text(spark, str(raw), "id int, name string")) == [(1, None), (2, "b")]
    csv = tmp_path / "c.csv"
    csv.write_text("id,name\n1,a\n")
    assert rows(tables.read_csv(spark, str(csv), "id int, name string")) == [(1, "a")]
    assert rows(tables.read_csv(spark, str(csv))) == [(1, "a")]


def test_rows_go_to_their_own_day(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3)), (2, None)], "id int, create_time timestamp")
    assert rows(tables.by_own_day(df, "create_time"), "id", "dt") == [(1, "20240102")]


def test_day_buckets(spark, tmp_path):
    df = spark.createDataFrame([("1704067200", 1), ("1704067200000", 2), ("x", 3), (None, 4)], "t string, id int")
    sinks.write_day_buckets(df, str(tmp_path / "b"), "t")
    got = spark.read.json(str(tmp_path / "b"))
    assert rows(got, "id", F.col("day").cast("string")) == [(1, "20240101"), (2, "20240101"), (3, "error_bucket"), (4, "error_bucket")]


def test_wider_types_and_unbounded_texts():
    assert schemas.spark_type("tinyint(1)") == T.BooleanType() and schemas.spark_type("tinyint(4)") == T.ByteType()
    assert schemas.spark_type("int(10) unsigned") == T.LongType() and schemas.spark_type("tinyint(3) unsigned") == T.ShortType()
    assert schemas.spark_type("mediumblob") == T.BinaryType() == schemas.spark_type("TINYBLOB")
    text = schemas.database_ddl("t", schemas.schema_from_catalog([("id", "varchar(20)"), ("body", "text")]))
    assert "`id` VARCHAR(255)" in text and "`body` LONGTEXT" in text


def test_a_report_row_without_a_day_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="has no day"):
        sinks.keep_history(spark, str(tmp_path / "r"), spark.createDataFrame([(1, "20240101"), (2, None)], "v int, dt string"))


def test_a_replayed_batch_replaces_its_own_rows(spark):
    table = {}

    def delete(text):
        assert text == "DELETE FROM `t` WHERE `batch_id` = 7"
        table.pop(7, None)

    def append(rows_):
        for r in rows_.collect():
            table.setdefault(r.batch_id, []).append(r.v)

    for _ in range(2):
        merge.replace_batch(spark.createDataFrame([(1,), (2,)], "v int"), 7, delete, append, "t")
    assert {k: sorted(v) for k, v in table.items()} == {7: [1, 2]}
