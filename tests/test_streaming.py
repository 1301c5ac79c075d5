import datetime as dt
import json
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from saltmarsh.streaming import dedupe, inputs, joins, merge, routes, state, windows
from tests.conftest import rows

BASE = dt.datetime(2024, 1, 1)


def at(seconds):
    return (BASE + dt.timedelta(seconds=seconds)).isoformat()


class Folder:
    """A directory of JSON files read as a stream, one file per call of ``add``."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.n = spark, path, schema, 0
        (path / "in").mkdir(parents=True)

    def add(self, *records):
        self.n += 1
        name = self.path / "in" / f"part-{self.n:03d}.json"
        name.write_text("".join(json.dumps(r) + "\n" for r in records))
        # later files must look newer
        import os

        stamp = time.time() - 1000 + self.n
        os.utime(name, (stamp, stamp))
        return self

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(str(self.path / "in"))

    def run(self, build, name="a"):
        """Append-mode run over the available files into parquet; returns all output so far."""
        df = build(self.stream())
        out, cp = str(self.path / f"out-{name}"), str(self.path / f"cp-{name}")
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).outputMode("append").trigger(availableNow=True).start().awaitTermination()
        return self.spark.read.schema(df.schema).parquet(out)


LOGIN = "id long, user string, ts timestamp, is_new string"


@pytest.fixture
def folder(spark, tmp_path):
    return lambda schema, name="f": Folder(spark, tmp_path / name, schema)


RECORDS = [
    {"id": 1, "user": "a", "ts": at(0), "is_new": "1"}, {"id": 2, "user": "a", "ts": at(100), "is_new": "1"},
    {"id": 3, "user": "a", "ts": at(86400), "is_new": "1"}, {"id": 4, "user": "b", "ts": at(5), "is_new": "0"},
    {"id": 5, "user": "b", "ts": at(9), "is_new": "1"}, {"id": 6, "user": "c", "ts": at(200000), "is_new": "1"},
]


def both_ways(folder, schema, records, build, columns):
    """Result with all records in one file and with one file per record."""
    one, many = folder(schema, "one").add(*records), folder(schema, "many")
    for r in records:
        many.add(r)
    a, b = rows(one.run(build), *columns), rows(many.run(build), *columns)
    assert a == b
    return a


def test_new_visitor_repair_stream_equals_batch(spark, folder):
    got = both_ways(folder, LOGIN, RECORDS, lambda s: state.repair_new_flag_stream(s, "user", "ts", "is_new"), ["id", "fixed_is_new"])
    assert got == [(1, "1"), (2, "1"), (3, "0"), (4, "0"), (5, "0"), (6, "1")]
    batch = spark.read.schema(LOGIN).json(spark.sparkContext.parallelize([json.dumps(r) for r in RECORDS]))
    assert rows(state.repair_new_flag(batch, "user", ["ts", "id"], "ts", "is_new"), "id", "fixed_is_new") == got


def test_state_survives_a_restart(folder):
    f = folder(LOGIN).add(*RECORDS[:2])
    build = lambda s: state.repair_new_flag_stream(s, "user", "ts", "is_new")
    assert rows(f.run(build), "id") == [(1,), (2,)]
    f.add(RECORDS[2])  # second run continues from the checkpoint with the stored first day
    assert rows(f.run(build), "id", "fixed_is_new") == [(1, "1"), (2, "1"), (3, "0")]


def test_first_login_and_first_seen(folder):
    got = both_ways(folder, LOGIN, RECORDS, lambda s: state.first_login_stream(s, "user", "ts"), ["id", "is_first"])
    assert got == [(1, 1), (2, 1), (3, 0), (4, 1), (5, 1), (6, 1)]


def test_first_seen_flag(spark, folder):
    got = both_ways(folder, LOGIN, RECORDS, lambda s: state.first_seen_stream(s, "user", "ts"), ["id", "is_new_visitor"])
    assert got == [(1, 1), (2, 0), (3, 0), (4, 1), (5, 0), (6, 1)]


def test_newer_only(spark, folder):
    records = [{"id": i, "user": u, "ts": at(0), "is_new": str(v)} for i, (u, v) in enumerate([("a", 5), ("a", 3), ("a", 5), ("a", 6), ("b", 1), ("a", 2), ("b", 2)])]
    build = lambda s: state.newer_only_stream(s.withColumn("v", F.col("is_new").cast("long")), "user", "id", "v")
    got = both_ways(folder, LOGIN, records, build, ["id"])
    assert got == [(0,), (3,), (4,), (6,)]
    batch = spark.createDataFrame([(r["id"], r["user"], int(r["is_new"])) for r in records], "id int, user string, v int")
    assert rows(dedupe.newer_only(batch, ["user"], ["id"], "v", F.floor(F.col("id") / 2)), "id") == got


def test_running_profile(folder):
    build = lambda s: state.running_profile_stream(s, "user", "ts", ["is_new"])
    got = both_ways(folder, LOGIN, RECORDS, build, ["id", "pv", "is_new_list"])
    assert got == [(1, 1, "1"), (2, 2, "1"), (3, 3, "1"), (4, 1, "0"), (5, 2, "0,1"), (6, 1, "1")]


WORD = "keyword string, ts timestamp"


def test_late_rows_update_their_window_until_the_watermark(spark, folder):
    f = folder(WORD)
    f.add({"keyword": "x", "ts": at(10)}, {"keyword": "x", "ts": at(60)})      # two windows, the second starts on the boundary
    f.add({"keyword": "x", "ts": at(62)}, {"keyword": "x", "ts": at(50)})      # late but allowed
    f.add({"keyword": "y", "ts": at(300)})                                      # moves the watermark to 285
    f.add({"keyword": "y", "ts": at(400)})                                      # late rows are cut by the watermark of the batch before
    f.add({"keyword": "x", "ts": at(20)}, {"keyword": "y", "ts": at(301)})      # too late, dropped
    out = windows.keyword_counts(windows.with_lateness(f.stream(), "ts"), "ts")
    path, cp = str(f.path / "out"), str(f.path / "cp")
    merge.upsert_stream(out, path, cp, ["stt", "keyword"], "keyword_count").awaitTermination()
    got = rows(merge.current_rows(spark, path, ["stt", "keyword"]), "stt", "keyword", "keyword_count")
    assert got == [("2024-01-01 00:00:00", "x", 2), ("2024-01-01 00:01:00", "x", 2),
                   ("2024-01-01 00:05:00", "y", 2), ("2024-01-01 00:06:00", "y", 1)]


def test_login_window_stream(spark, folder):
    f = folder(LOGIN)
    f.add(*[{"id": i, "user": u, "ts": at(s), "is_new": n} for i, (u, s, n) in enumerate([("a", 1, "1"), ("a", 2, "0"), ("b", 3, "1"), ("c", 61, "0")])])
    f.add({"id": 9, "user": "z", "ts": at(1000), "is_new": "1"})
    f.add({"id": 10, "user": "z", "ts": at(2000), "is_new": "1"})
    got = rows(f.run(lambda s: windows.login_users(s.withWatermark("ts", "5 seconds"), "ts", user="user")))
    assert got[:2] == [("2024-01-01 00:00:00", "2024-01-01 00:01:00", "2024-01-01", 2, 1), ("2024-01-01 00:01:00", "2024-01-01 00:02:00", "2024-01-01", 1, 1)]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    b0 = spark.createDataFrame([("k", 1, 10), ("j", 1, 5)], "k string, seq int, v int")
    b1 = spark.createDataFrame([("k", 2, 20)], "k string, seq int, v int")
    for batch, i in ((b0, 0), (b1, 1), (b1, 1), (b0, 0)):
        merge.write_batch(merge.keep_latest_batch(batch, ["k"], "seq"), i, path)
    assert rows(merge.current_rows(spark, path, ["k"], "seq")) == [("j", 1, 5), ("k", 2, 20)]
    merge.compact(spark, path, str(tmp_path / "c"), ["k"], "seq")
    assert rows(merge.current_rows(spark, str(tmp_path / "c"), ["k"], "seq")) == [("j", 1, 5), ("k", 2, 20)]


def test_partial_update_keeps_non_null_and_order(spark, tmp_path):
    schema = "id string, a string, b string, ts long"
    b0 = spark.createDataFrame([("1", "x", None, 5), ("1", None, "early", 1)], schema)
    b1 = spark.createDataFrame([("1", None, "late", 3), ("1", "old", None, 2)], schema)  # out of order across batches
    path = str(tmp_path / "p")
    for batch, i in ((b0, 0), (b1, 1), (b1, 1)):
        merge.write_batch(merge._with_times(batch, ["id"], "ts"), i, path)
    assert rows(merge.current_partial_rows(spark, path, ["id"], "ts")) == [("1", "x", "late", 5)]
    assert rows(merge.partial_update(b0.unionByName(b1), ["id"], "ts")) == [("1", "x", "late", 5)]


def test_window_ranking_over_several_batches(spark, folder):
    f = folder("k string, ts timestamp")
    f.add({"k": "a", "ts": at(1)}, {"k": "b", "ts": at(2)}, {"k": "a", "ts": at(3)})
    f.add({"k": "b", "ts": at(4)}, {"k": "b", "ts": at(5)}, {"k": "c", "ts": at(61)})
    out = windows.tumbling(f.stream().withWatermark("ts", "10 seconds"), "ts", "1 minute", ["k"], [F.count("*").alias("n")])
    path = str(f.path / "out")
    merge.ranked_stream(out, path, str(f.path / "cp"), ["stt"], ["k"]).awaitTermination()
    got = rows(merge.current_top(spark, path, ["stt"], ["k"], "n", 1), "stt", "k", "n", "rank_num")
    assert got == [("2024-01-01 00:00:00", "b", 3, 1), ("2024-01-01 00:01:00", "c", 1, 1)]


def change(table, op, after=None, before=None, ts=1, **source):
    return json.dumps({"op": op, "after": after, "before": before, "source": {"db": "d", "table": table, **source}, "ts_ms": ts})


CHANGES = [
    change("cart_info", "r", {"id": "1", "user_id": "u", "sku_id": "s", "sku_num": "3"}),
    change("cart_info", "u", {"id": "2", "sku_num": "5"}, {"id": "2", "sku_num": "2"}),
    change("cart_info", "u", {"id": "3", "sku_num": "1"}, {"id": "3", "sku_num": "2"}),
    change("cart_info", "u", {"id": "4", "sku_num": "2"}, {"id": "4", "sku_num": "2"}),
    change("cart_info", "d", None, {"id": "5", "sku_num": "2"}),
    change("order_info", "u", {"id": "6", "order_status": "1003", "operate_time": "77", "total_amount": "9.5"}),
    change("order_info", "u", {"id": "7", "order_status": "1001"}),
    change("user_info", "c", {"id": "8", "login_name": "n"}), change("user_info", "u", {"id": "9", "login_name": "m"}),
    change("base_dic", "c", {"id": "x"}), change("odd_table", "c", {"id": "y"}), "{broken", change("cart_info", "u"),
]


def test_change_routes(spark):
    parsed = inputs.change_rows(spark.createDataFrame([(c,) for c in CHANGES], "value string"))
    assert rows(routes.cart_add_delta(parsed), "id", "sku_num") == [("1", 3), ("2", 3)]
    assert rows(routes.CHANGE_ROUTES["order_cancel"](parsed), "id", "cancel_time") == [("6", 77)]
    assert rows(routes.CHANGE_ROUTES["user_register"](parsed), "id") == [("8",)]
    assert rows(routes.dirty(parsed), "value") == [("{broken",)]
    assert routes.unrouted_changes(parsed, ["base_dic"]).count() == 1
    assert rows(inputs.archive_rows(parsed).filter("op = 'd'"), "id", "before") == [("5", '{"id":"5","sku_num":"2"}')]
    # deletes and rows without an image stay out of the cart table
    assert [r[0] for r in rows(merge.cart_partial_rows(parsed), "id")] == ["1", "2", "3", "4", None]


def test_each_change_has_one_place(spark, folder, tmp_path):
    lines = [*CHANGES, change("coupon_use", "u", {"id": "z", "coupon_status": "1403"}), None]
    f = folder("value string").add(*[{"value": c} for c in lines[:7]]).add(*[{"value": c} for c in lines[7:]])
    parsed = inputs.change_rows(f.stream()).withColumn("route", routes.change_route(["base_dic"])).select("route", "value")
    out = str(tmp_path / "places")
    routes.route_records(parsed, "route", out, str(tmp_path / "cp")).awaitTermination()
    back = spark.read.schema("value string, route string").parquet(out)
    assert rows(back.groupBy("route").count(), "route", "count") == sorted(
        [("cart_add", 6), ("dimension", 1), ("dirty", 1), ("order_cancel", 1), ("unrouted", 2), ("unused", 3), ("user_register", 1)]
    )
    # the route of a record is the fact that takes it
    batch = inputs.change_rows(spark.createDataFrame([(c,) for c in lines], "value string")).withColumn("route", routes.change_route([]))
    for name, fact in routes.CHANGE_ROUTES.items():
        assert fact(batch).count() == batch.filter(F.col("route") == name).count()
    complete = routes.complete_change_routes(["base_dic"])
    assert complete["dirty"](batch).count() == 1 and complete["unrouted"](batch).count() == 2


def test_log_records_without_common_are_dirty(spark):
    lines = ['{"page": {"page_id": "p"}, "ts": 1}', '{"common": null, "ts": 2}', '{"common": {"mid": "m"}, "page": {"page_id": "p"}, "ts": 3}', None]
    logs = routes.parse_logs(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert [r[0] for r in rows(routes.dirty(logs), "value")] == [lines[1], lines[0]]
    assert rows(routes.page_log(logs), "mid", "ts") == [("m", 3)]


def test_shop_logs_have_one_place(spark):
    lines = [
        change("order_pay_log", "d", None, {"buyer_id": "b", "pay_time": "5"}), change("search_log", "c", {"visitor_id": "v", "search_time": "x"}),
        change("search_log", "c"), change("page_click_log", "q", {"visitor_id": "v"}), change("stock_log", "c", {"id": "1"}), "{broken", None,
    ]
    got = routes.shop_log_rows(inputs.change_rows(spark.createDataFrame([(x,) for x in lines], "value string")))
    assert rows(got, "route", "visitor_id", "log_time") == sorted([
        ("order_pay_log", "b", 5), ("search_log", "v", None), ("dirty", None, None), ("dirty", None, None), ("dirty", None, None),
        ("unrouted", None, None), ("unrouted", None, None),
    ], key=lambda t: tuple((x is None, str(x)) for x in t))


def test_trigger_is_a_choice(spark, folder, tmp_path):
    f = folder("value string").add({"value": "a"})
    running = routes.route_records(f.stream(), F.lit("all"), str(tmp_path / "o"), str(tmp_path / "cp"), trigger={"processingTime": "200 milliseconds"})
    try:
        running.processAllAvailable()
        f.add({"value": "b"})
        running.processAllAvailable()
        assert running.isActive
    finally:
        running.stop()
    assert rows(spark.read.parquet(str(tmp_path / "o")), "value") == [("a",), ("b",)]


def test_config_routing_follows_config_changes(spark):
    parsed = inputs.change_rows(spark.createDataFrame([(c,) for c in CHANGES], "value string")).filter("not is_dirty")
    configs = spark.createDataFrame([
        (change("cfg", "c", {"source_table": "cart_info", "sink_table": "dim_cart", "sink_row_key": "id", "sink_columns": "id,sku_num"}, ts=1),),
        (change("cfg", "c", {"source_table": "user_info", "sink_table": "old", "sink_row_key": "id", "sink_columns": "id"}, ts=1),),
        (change("cfg", "d", None, {"source_table": "user_info"}, ts=2),),
    ], "value string")
    config = joins.current_config(inputs.change_rows(configs))
    assert rows(config, "source_table", "sink_table") == [("cart_info", "dim_cart")]
    routed = merge.dimension_rows(joins.route_by_config(parsed, config))
    got = [(r["sink_table"], r["row"]) for r in routed.filter("row['id'] = '1'").collect()]
    assert got == [("dim_cart", {"id": "1", "sku_num": "3"})]


def test_routing_by_config_moves_no_change(spark):
    """Before, all changes of a table were sorted in the one task of its name."""
    kind = "table string, op string, ts_ms long, before map<string,string>, after map<string,string>"
    changes = spark.createDataFrame([
        ("a", "c", 1, None, {"id": "1", "x": "y"}), ("a", "d", 2, {"id": "2"}, None), ("b", "c", 3, None, {"id": "3"}), (None, "c", 4, None, {"id": "4"}),
    ], kind)
    config = spark.createDataFrame(
        [("a", "dim_a", "id", "id"), ("a", "dim_b", "x", "id,x"), ("a", "dim_b", "x", "id,x"), (None, "dim_n", "id", "id"), ("c", "dim_c", "id", "id")],
        "source_table string, sink_table string, sink_row_key string, sink_columns string",
    )
    routed = joins.route_by_config(changes, config)
    plan = spark._jvm.PythonSQLUtils.explainString(routed._jdf.queryExecution(), "simple")
    assert "Join" not in plan.split("Subquery")[0]
    got = sorted((r["sink_table"], r["ts_ms"], r["key_value"] or "", tuple(sorted(r["row"].items()))) for r in routed.collect())
    both = [("dim_b", 1, "y", (("id", "1"), ("x", "y"))), ("dim_b", 2, "", (("id", "2"),))]
    assert got == sorted([("dim_a", 1, "1", (("id", "1"),)), ("dim_a", 2, "2", (("id", "2"),)), *both, *both])


def test_routes_are_written_once_per_batch(spark, folder, tmp_path):
    f = folder("value string").add(*[{"value": c} for c in CHANGES[:6]]).add(*[{"value": c} for c in CHANGES[6:]])
    out = str(tmp_path / "routed")
    routes.route_stream(inputs.change_rows(f.stream()), routes.CHANGE_ROUTES, out, str(tmp_path / "cp"), "parquet").awaitTermination()
    assert spark.read.parquet(f"{out}/cart_add").filter("batch_id is not null").count() == 6
    assert rows(spark.read.parquet(f"{out}/user_register"), "id") == [("8",)]


def test_log_routes_accept_both_action_names(spark):
    lines = [
        {"common": {"mid": "m"}, "page": {"page_id": "p"}, "actions": [{"action_id": "a1", "ts": 1}], "displays": [{"item": "i", "pos_id": 1}], "ts": 5},
        {"common": {"mid": "m"}, "page": {"page_id": "p"}, "action": [{"action_id": "a2", "ts": 2}], "ts": 6},
        {"common": {"mid": "n"}, "start": {"entry": "icon"}, "err": {"error_code": 4, "msg": "x"}, "ts": 7}, {"common": {"mid": "o"}, "ts": 8},
    ]
    logs = routes.parse_logs(spark.createDataFrame([(json.dumps(x),) for x in lines] + [("zzz",)], "value string"))
    got = {name: route(logs).count() for name, route in routes.LOG_ROUTES.items()}
    assert got == {"start": 1, "page": 2, "action": 2, "display": 1, "error": 1, "unknown": 1, "dirty": 1}


def test_interval_join_stream(spark, folder):
    left, right = folder("k string, ts timestamp, n int", "l"), folder("k string, ts timestamp, n int", "r")
    left.add({"k": "a", "ts": at(100), "n": 1})
    right.add(*[{"k": "a", "ts": at(s), "n": s} for s in (39, 40, 160, 161)], {"k": "b", "ts": at(100), "n": 0})
    joined = joins.interval_join_stream(left.stream(), right.stream(), ["k"], "ts", "ts", "60 SECONDS", "60 SECONDS")
    got = left.run(lambda _: joined.select("n", "info_n"))
    assert rows(got) == [(1, 160), (1, 40)]


def test_exact_dedupe(folder):
    records = [{"id": i % 3, "user": "a", "ts": at(i), "is_new": "1"} for i in range(9)]
    got = both_ways(folder, LOGIN, records, lambda s: dedupe.within_watermark(s, ["id"], "ts").select("id"), ["id"])
    assert got == [(0,), (1,), (2,)]


def test_snapshot_end_by_row_and_by_idle_timer(spark, folder):
    f = folder("id int, k string, op string, is_snapshot string")
    f.add({"id": 1, "k": "a", "op": "r", "is_snapshot": "false"}, {"id": 2, "k": "a", "op": "c", "is_snapshot": "true"}, {"id": 3, "k": "a", "op": "u", "is_snapshot": "false"})
    f.add({"id": 4, "k": "b", "op": "r", "is_snapshot": "false"}, {"id": 5, "k": "a", "op": "r", "is_snapshot": "false"})
    ended = rows(f.run(lambda s: state.snapshot_rows_stream(s, "k", idle_ms=None)), "id", "k", "completed")
    assert ended == [(1, "a", False), (2, "a", False), (4, "b", False), (5, "a", False), (None, "a", True)]
    query = (
        state.snapshot_rows_stream(f.stream(), "k", idle_ms=1000).writeStream.format("memory").queryName("snap").outputMode("append")
        .option("checkpointLocation", str(f.path / "cp-timer")).trigger(processingTime="500 milliseconds").start()
    )
    try:
        deadline = time.time() + 40
        while time.time() < deadline and spark.sql("SELECT 1 FROM snap WHERE k = 'b' AND completed").count() == 0:
            time.sleep(0.5)
    finally:
        query.stop()
    assert rows(spark.sql("SELECT k FROM snap WHERE completed")) == [("a",), ("b",)]


def test_lookup_miss_gives_default(spark):
    facts = spark.createDataFrame([("1", "a"), ("2", "z"), ("3", None)], "id string, code string")
    dim = spark.createDataFrame([("a", "Alpha")], "code string, name string")
    assert rows(joins.lookup(facts, dim, "code", "code", {"n": "name"}), "id", "n") == [("1", "Alpha"), ("2", "N/A"), ("3", "N/A")]


def test_last_record_per_key_of_a_batch(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z")], "k string, ts int, v string")
    assert rows(windows.last_per_key(df, ["k"], "ts")) == [("a", 3, "y")]


def test_json_lines_sink(spark, folder):
    f = folder(WORD).add({"keyword": "x", "ts": at(1)})
    merge.json_lines_sink(f.stream(), str(f.path / "o"), str(f.path / "c")).awaitTermination()
    assert spark.read.json(str(f.path / "o")).count() == 1


def test_text_lines_remember_their_position(spark, tmp_path):
    source = tmp_path / "log"
    source.mkdir()
    (source / "a.log").write_text("one\ntwo\n")

    def run():
        df = inputs.with_arrival_time(inputs.non_null(inputs.text_lines(spark, str(source))))
        df.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(str(tmp_path / "o"))

    assert run().count() == 2
    (source / "b.log").write_text("three\n")
    assert rows(run(), "value") == [("one",), ("three",), ("two",)]


def test_shop_logs_are_typed(spark):
    line = change("user_visit_log", "c", {"log_id": "7", "visit_time": "1704067200000", "visitor_id": "v", "page_view": "x"})
    parsed = inputs.change_rows(spark.createDataFrame([(line,), (CHANGES[0],)], "value string"))
    got = routes.shop_log(parsed, "user_visit_log", {"log_id": "bigint", "visitor_id": "string", "page_view": "int"})
    assert rows(got, "log_id", "visitor_id", "page_view") == [(7, "v", None)]


def test_dimension_sync_reads_the_config_for_each_batch(spark, folder, tmp_path):
    f = folder("value string").add(*[{"value": c} for c in CHANGES])
    config = spark.createDataFrame([("cart_info", "dim_cart", "id", "id")], "source_table string, sink_table string, sink_row_key string, sink_columns string")
    out = str(tmp_path / "dim")
    changes = inputs.change_rows(f.stream()).filter("not is_dirty")
    joins.dimension_sync(changes, lambda: config, lambda b, i: merge.write_batch(merge.dimension_rows(b), i, out), str(tmp_path / "cp")).awaitTermination()
    got = merge.current_rows(spark, out, ["sink_table", "row_key"], "ts_ms")
    assert sorted(r["row"]["id"] for r in got.filter("row['id'] is not null").collect()) == ["1", "2", "3", "4"]


def test_state_table_equals_keyed_state(spark, folder, tmp_path):
    f = folder(LOGIN).add(*RECORDS[:2]).add(*RECORDS[2:4]).add(*RECORDS[4:])
    out = str(tmp_path / "fixed")
    state.repair_new_flag_table(f.stream(), out, str(tmp_path / "cp1"), "user", ["ts", "id"], "ts", "is_new").awaitTermination()
    got = rows(spark.read.parquet(f"{out}/out"), "id", "fixed_is_new")
    assert got == [(1, "1"), (2, "1"), (3, "0"), (4, "0"), (5, "0"), (6, "1")]
    seen = str(tmp_path / "seen")
    state.first_seen_table(f.stream(), seen, str(tmp_path / "cp2"), "user", ["ts", "id"]).awaitTermination()
    assert rows(spark.read.parquet(f"{seen}/out"), "id", "is_new_visitor") == [(1, 1), (2, 0), (3, 0), (4, 1), (5, 0), (6, 1)]


def test_newer_only_table_equals_keyed_state(spark, folder, tmp_path):
    values = [("a", 5), ("a", 3), ("a", 5), ("a", 6), ("b", 1), ("a", 2), ("b", 2), ("b", 2)]
    records = [{"id": i, "user": u, "ts": at(0), "is_new": str(v)} for i, (u, v) in enumerate(values)]
    f = folder(LOGIN).add(*records[:2]).add(*records[2:6]).add(*records[6:])
    out = str(tmp_path / "newer")
    rows_in = f.stream().withColumn("v", F.col("is_new").cast("long"))
    state.newer_only_table(rows_in, out, str(tmp_path / "cp"), "user", ["id"], "v", F.floor(F.col("id") / 2)).awaitTermination()
    assert rows(spark.read.parquet(f"{out}/out"), "id") == [(0,), (3,), (4,), (6,)]


def event_files(spark, path, n_files=12, users=3):
    """Events in more files than a micro-batch reads, the later ones in time first."""
    import os

    import pandas as pd

    for i in range(n_files):
        made = [(100 - 5 * i + k, BASE + dt.timedelta(hours=100 - 5 * i + k), (k + i) % users, ["view", "click", "error", "signup"][(i + k) % 4], 1.0, "{}")
                for k in range(5)]
        frame = pd.DataFrame(made, columns=["event_id", "ts", "user_id", "event_type", "value", "props"])
        frame["ts"] = frame["ts"].astype("datetime64[us]")
        name = path / "events.parquet" / f"part-{i:03d}.parquet"
        name.parent.mkdir(exist_ok=True)
        frame.to_parquet(name)
        os.utime(name, (time.time() - 1000 + i,) * 2)
    return str(path)


def against_sql(spark, name, folder):
    import duckdb

    from saltmarsh.queries import all_entries

    entry = all_entries()[name]
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    result = con.execute(entry.sql)
    names = [d[0] for d in result.description]
    got = entry.run(spark, folder).select(*names).collect()
    return sorted(map(tuple, got), key=str), sorted(result.fetchall(), key=str)


def test_running_profile_does_not_follow_the_order_of_files(spark, tmp_path):
    got, expected = against_sql(spark, "stream_running_profile", event_files(spark, tmp_path))
    assert got == expected and len(got) == 60


def test_first_rows_are_exact_over_files_in_any_order(spark, tmp_path):
    got, expected = against_sql(spark, "stream_approximate_dedupe", event_files(spark, tmp_path))
    assert got == expected


def test_no_new_row_is_lost_where_the_filter_was_full(spark, tmp_path):
    path = str(tmp_path / "events.parquet")
    ids = spark.range(3_000_000)
    ids.select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200)).alias("ts"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.0).alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(path)
    from saltmarsh.queries import all_entries

    assert all_entries()["stream_approximate_dedupe"].run(spark, str(tmp_path)).count() == 3_000_000
