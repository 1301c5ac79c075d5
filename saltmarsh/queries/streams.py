"""Streaming queries: whole tables read as a stream, run to the end, result read back.

Each query makes its own folder below the shared checkpoint directory and runs
with ``availableNow``, so it ends when the table has been consumed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.plans import moderation
from saltmarsh.queries import adapters as a
from saltmarsh.queries.registry import query
from saltmarsh.queries.traffic import CHG, KEYWORD_SQL, WORDS, _bounds, changes_from, log_lines_from
from saltmarsh.queries.fragments import with_
from saltmarsh.session import shared_folder
from saltmarsh.streaming import dedupe, expiry, inputs, joins, merge, replay, routes, state, versions, windows


def _stream(spark: SparkSession, sf: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    # a pattern that names exactly one table, be it a file or a folder of files
    return inputs.table_files(spark, f"{sf}/{name}.parque[t]", a.SCHEMAS[name], files_per_trigger=files_per_trigger)


def _finish(query_handle) -> None:
    query_handle.awaitTermination()


def _append(df: DataFrame, folder: str) -> DataFrame:
    """Run an append-mode stream into parquet files and read them back."""
    spark = df.sparkSession
    writer = df.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
    _finish(writer.outputMode("append").trigger(availableNow=True).start())
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


@query("stream_keyword_windows", KEYWORD_SQL)
def keyword_windows(spark, sf):
    """Late-tolerant keyword windows in update mode, merged by key."""
    folder = shared_folder(spark, "keywords")
    rows = windows.with_lateness(
        _stream(spark, sf, "events").select("ts", F.concat(F.col("event_type"), F.lit(" "), F.col("event_id") % 3).alias("keyword")), "ts"
    )
    out = windows.keyword_counts(rows, "ts", size="5 minutes")
    _finish(merge.upsert_stream(out, f"{folder}/out", f"{folder}/cp", ["stt", "keyword"], "keyword_count"))
    return merge.current_rows(spark, f"{folder}/out", ["stt", "keyword"])


@query("stream_top_users_per_day", """
SELECT stt, edt, cur_date, user_id, n, rank_num FROM (SELECT *, CAST(row_number() OVER (PARTITION BY stt ORDER BY n DESC, user_id) AS INTEGER) AS rank_num FROM (
""" + f"SELECT {_bounds(chr(39) + '1 day' + chr(39))}, user_id, count(*) AS n FROM events GROUP BY ALL)) WHERE rank_num <= 10")
def top_users(spark, sf):
    """Top ten per window, ranked over the kept window sums."""
    folder = shared_folder(spark, "top")
    rows = _stream(spark, sf, "events").withWatermark("ts", "0 seconds")
    out = windows.tumbling(rows, "ts", "1 day", ["user_id"], [F.count(F.lit(1)).alias("n")])
    _finish(merge.ranked_stream(out, f"{folder}/out", f"{folder}/cp", ["stt", "edt", "cur_date"], ["user_id"]))
    return merge.current_top(spark, f"{folder}/out", ["stt", "edt", "cur_date"], ["user_id"], "n")


@query("stream_change_routes", with_(CHG) + """
SELECT 'cart_add' AS route, id, ts FROM chg WHERE tab = 'cart_info' UNION ALL SELECT 'order_cancel', id, ts FROM chg WHERE tab = 'order_info' AND s = 'F'
UNION ALL SELECT 'coupon_use', id, ts FROM chg WHERE tab = 'coupon_use' AND s = 'P'
""")
def change_routes(spark, sf):
    """One pass over the change stream writes every route; three of them are read back."""
    folder = shared_folder(spark, "changes")
    raw = _stream(spark, sf, "orders")
    parsed = inputs.change_rows(changes_from(raw))
    _finish(routes.route_stream(parsed, routes.CHANGE_ROUTES, f"{folder}/out", f"{folder}/cp", "parquet"))
    parts = [
        spark.read.parquet(f"{folder}/out/{name}").select(F.lit(name).alias("route"), "id", "ts")
        for name in ("cart_add", "order_cancel", "coupon_use")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stream_change_places", with_(CHG) + """
, p AS (SELECT k, CASE WHEN tab = 'mystery' THEN 'unrouted' WHEN tab = 'order_detail' THEN 'order_detail' WHEN tab = 'cart_info' THEN 'cart_add'
    WHEN tab = 'order_info' THEN CASE WHEN s = 'F' THEN 'order_cancel' ELSE 'unused' END WHEN tab = 'payment_info' THEN CASE WHEN s = 'O' THEN 'payment_success' ELSE 'unused' END
    WHEN tab = 'order_refund_info' THEN 'order_refund' WHEN tab = 'comment_info' THEN 'comment' WHEN tab = 'coupon_use' THEN CASE WHEN s = 'P' THEN 'coupon_use' ELSE 'coupon_get' END
    WHEN tab = 'user_info' THEN CASE WHEN op IN ('c', 'r') THEN 'user_register' ELSE 'unused' END END AS route
  FROM chg UNION ALL
  SELECT o_orderkey, 'dirty' FROM orders WHERE o_orderkey % 50 = 0)
SELECT route, k FROM p
""")
def change_places(spark, sf):
    """Each change of the stream in exactly one folder, broken and unknown ones included; read back by record."""
    folder = shared_folder(spark, "places")
    parsed = inputs.change_rows(changes_from(_stream(spark, sf, "orders")))
    rows = parsed.withColumn("route", routes.change_route([])).select("route", "value")
    _finish(routes.route_records(rows, "route", f"{folder}/out", f"{folder}/cp"))
    back = spark.read.schema("value string, route string").parquet(f"{folder}/out")
    key = F.coalesce(F.get_json_object("value", "$.after.id"), F.get_json_object("value", "$.before.id"), F.regexp_extract("value", r"^\{broken (\d+)$", 1))
    return back.select("route", key.cast("bigint").alias("k"))


def _shop_changes(events: DataFrame) -> DataFrame:
    """Events as changes of the raw shop logs; every 40th is broken, every 37th of another table."""
    e, i = F.col("event_type"), F.col("event_id")
    table = F.when(i % 37 == 0, "stock_log").when(e == "view", "user_visit_log").when(e == "click", "page_click_log").when(e == "error", "search_log") \
        .when(e == "purchase", "order_pay_log").when(i % 2 == 0, "crowd_attribute_log").otherwise("product_interaction_log")
    fields = ["log_id", "visit_time", "interact_time", "pay_time", "search_time", "click_time", "update_time", "visitor_id", "buyer_id"]
    times = [F.unix_millis("ts") + n for n in range(6)]
    values = [i, *times, F.concat(F.lit("v"), F.col("user_id")), F.concat(F.lit("b"), F.col("user_id"))]
    image = F.create_map(*[x for n, v in zip(fields, values) for x in (F.lit(n), v.cast("string"))])
    op = F.when(i % 10 == 0, "d").when(i % 10 < 4, "u").when(i % 10 == 9, "x").otherwise("c")
    record = F.struct(
        op.alias("op"), F.when(op == "d", image).alias("before"), F.when(op != "d", image).alias("after"),
        F.create_map(F.lit("db"), F.lit("shop"), F.lit("table"), table).alias("source"), F.unix_millis("ts").alias("ts_ms"),
    )
    return events.select(F.when(i % 40 == 0, F.concat(F.lit("{broken "), i)).otherwise(F.to_json(record)).alias("value"))


@query("t16_shop_log_routes", """
SELECT route, event_id, CASE WHEN known THEN CAST(event_id AS VARCHAR) END AS log_id, CASE WHEN known THEN (CASE WHEN route = 'order_pay_log' THEN 'b' ELSE 'v' END) || CAST(user_id AS VARCHAR) END AS visitor_id,
  CASE WHEN known THEN epoch_us(ts) // 1000 + CASE route WHEN 'user_visit_log' THEN 0 WHEN 'product_interaction_log' THEN 1 WHEN 'order_pay_log' THEN 2 WHEN 'search_log' THEN 3 WHEN 'page_click_log' THEN 4 ELSE 5 END END AS log_time
FROM (SELECT *, route NOT IN ('dirty', 'unrouted') AS known FROM (SELECT *, CASE WHEN event_id % 40 = 0 THEN 'dirty' WHEN event_id % 37 = 0 THEN 'unrouted' WHEN event_id % 10 = 9 THEN 'dirty'
  WHEN event_type = 'view' THEN 'user_visit_log' WHEN event_type = 'click' THEN 'page_click_log' WHEN event_type = 'error' THEN 'search_log' WHEN event_type = 'purchase' THEN 'order_pay_log'
  WHEN event_id % 2 = 0 THEN 'crowd_attribute_log' ELSE 'product_interaction_log' END AS route FROM events))
""")
def t16_routes(spark, sf):
    """Raw shop logs streamed into one folder per log, with dirty and unrouted records beside them; the routes add up to the input."""
    folder = shared_folder(spark, "shop")
    rows = routes.shop_log_rows(inputs.change_rows(_shop_changes(_stream(spark, sf, "events"))))
    _finish(routes.route_records(rows, "route", f"{folder}/out", f"{folder}/cp"))
    back = spark.read.schema(rows.schema).parquet(f"{folder}/out")
    key = F.coalesce(F.get_json_object("value", "$.after.log_id"), F.get_json_object("value", "$.before.log_id"), F.regexp_extract("value", r"^\{broken (\d+)$", 1))
    return back.select("route", key.cast("bigint").alias("event_id"), F.get_json_object("row", "$.log_id").alias("log_id"), "visitor_id", "log_time")


@query("stream_log_routes", """
SELECT 'page' AS route, count(*) AS n FROM events WHERE event_id % 40 <> 0 AND event_type IN ('view', 'click')
UNION ALL SELECT 'display', 3 * count(*) FROM events WHERE event_id % 40 <> 0 AND event_type = 'view'
UNION ALL SELECT 'dirty', count(*) FROM events WHERE event_id % 40 = 0
""")
def log_routes(spark, sf):
    folder = shared_folder(spark, "logs")
    parsed = routes.parse_logs(log_lines_from(_stream(spark, sf, "events")))
    _finish(routes.route_stream(parsed, routes.LOG_ROUTES, f"{folder}/out", f"{folder}/cp", "parquet"))
    parts = [
        spark.read.parquet(f"{folder}/out/{name}").agg(F.lit(name).alias("route"), F.count(F.lit(1)).alias("n"))
        for name in ("page", "display", "dirty")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stream_dedupe_within_watermark", "SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS d FROM events)")
def stream_dedupe(spark, sf):
    """Exact de-duplication; the delay covers the whole table, so nothing is late."""
    folder = shared_folder(spark, "dedupe")
    rows = _stream(spark, sf, "events").withColumn("d", F.to_date("ts"))
    out = dedupe.within_watermark(rows, ["user_id", "event_type", "d"], "ts", "40 days")
    return _append(out.select("user_id", "event_type", "d"), folder).agg(F.count(F.lit(1)).alias("n"))


@query("stream_whole_record_dedupe", "SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events)")
def stream_whole(spark, sf):
    folder = shared_folder(spark, "records")
    out = dedupe.whole_records(_stream(spark, sf, "events").select("user_id", "event_type"), ["user_id"])
    return _append(out, folder).agg(F.count(F.lit(1)).alias("n"))


@query("stream_new_visitor_repair", """
WITH f AS (SELECT user_id AS u, arg_min(CASE WHEN event_id % 3 = 0 THEN CAST(ts AS DATE) - 1 ELSE CAST(ts AS DATE) END, ts) AS d FROM events GROUP BY 1)
SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN '0' ELSE '1' END AS is_new,
  CASE WHEN event_id % 3 <> 0 AND CAST(ts AS DATE) = d THEN '1' ELSE '0' END AS fixed_is_new FROM events JOIN f ON user_id = u
""")
def stream_repair(spark, sf):
    folder = shared_folder(spark, "repair")
    rows = _stream(spark, sf, "events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 == 0, "0").otherwise("1").alias("is_new"))
    _finish(state.repair_new_flag_table(rows, folder, f"{folder}/cp", "user_id", ["ts", "event_id"], "ts", "is_new"))
    return spark.read.parquet(f"{folder}/out").drop("ts", "batch_id")


@query("stream_first_login_counts", """
SELECT dt, is_first, count(*) AS login_count FROM (
  SELECT CAST(ts AS DATE) AS dt, CASE WHEN CAST(ts AS DATE) = min(CAST(ts AS DATE)) OVER (PARTITION BY user_id) THEN 1 ELSE 0 END AS is_first FROM events) GROUP BY 1, 2
""")
def stream_first_login(spark, sf):
    folder = shared_folder(spark, "logins")
    rows = _stream(spark, sf, "events").select("event_id", "user_id", "ts")
    _finish(state.first_login_table(rows, folder, f"{folder}/cp", "user_id", ["ts", "event_id"], "ts"))
    flagged = spark.read.parquet(f"{folder}/out")
    return windows.running_count(flagged.withColumn("dt", F.to_date("ts")), ["dt", "is_first"], "login_count")


@query("stream_first_seen_visitor", """
SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS is_new_visitor FROM events
""")
def stream_first_seen(spark, sf):
    folder = shared_folder(spark, "seen")
    rows = _stream(spark, sf, "events").select("event_id", "user_id", "ts")
    _finish(state.first_seen_table(rows, folder, f"{folder}/cp", "user_id", ["ts", "event_id"]))
    return spark.read.parquet(f"{folder}/out").select("event_id", "is_new_visitor")


@query("stream_newer_only", """
SELECT event_id, v FROM (SELECT *, max(v) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
  FROM (SELECT *, event_id * 7919 % 10007 AS v FROM events)) WHERE m IS NULL OR v > m
""")
def stream_newer(spark, sf):
    folder = shared_folder(spark, "newer")
    rows = _stream(spark, sf, "events").select("event_id", "user_id", (F.col("event_id") * 7919 % 10007).alias("v"))
    slices = F.floor(F.col("event_id") / 4096)
    _finish(state.newer_only_table(rows, folder, f"{folder}/cp", "user_id", ["event_id"], "v", slices))
    return spark.read.parquet(f"{folder}/out").select("event_id", "v")


@query("stream_running_profile", """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pv,
  (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT event_type AS x FROM events f WHERE f.user_id = e.user_id AND f.ts <= e.ts)) AS event_type_list FROM events e
""")
def stream_profile(spark, sf):
    folder = shared_folder(spark, "profile")
    rows = _append(_stream(spark, sf, "events", 8).select("event_id", "user_id", "ts", "event_type"), folder)
    out = state.running_profile_lists(rows, "user_id", ["ts", "event_id"], "ts", ["event_type"], F.date_trunc("day", "ts"))
    return out.select("event_id", "user_id", "pv", "event_type_list")


@query("stream_interval_join", """
SELECT c.event_id, p.event_id AS info_event_id FROM events c JOIN events p ON c.user_id = p.user_id AND p.ts >= c.ts - INTERVAL 6 HOUR AND p.ts <= c.ts + INTERVAL 6 HOUR
WHERE c.event_type = 'click' AND p.event_type = 'purchase'
""")
def stream_interval(spark, sf):
    folder = shared_folder(spark, "interval")
    clicks = _stream(spark, sf, "events").filter(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    buys = _stream(spark, sf, "events").filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    out = joins.interval_join_stream(clicks, buys, ["user_id"], "ts", "ts", "6 HOURS", "6 HOURS")
    return _append(out.select("event_id", "info_event_id"), folder)


@query("stream_dimension_lookup", """
SELECT event_id, coalesce(CASE WHEN event_type <> 'error' THEN upper(event_type) END, 'N/A') AS type_name FROM events
""")
def stream_lookup(spark, sf):
    folder = shared_folder(spark, "lookup")
    dim = a.events(spark, sf).filter(F.col("event_type") != "error").select("event_type").distinct().select(
        F.col("event_type").alias("code"), F.upper("event_type").alias("name")
    )
    out = joins.lookup(_stream(spark, sf, "events").select("event_id", "event_type"), dim, "event_type", "code", {"type_name": "name"})
    return _append(out.select("event_id", "type_name"), folder)


@query("stream_partial_update", with_(CHG) + """
SELECT CAST(k % 500 AS VARCHAR) AS id, arg_max(user_id, k) AS user_id, arg_max(CASE WHEN num > 3 THEN num END, k) AS sku_num, max(k) AS seq
FROM chg WHERE op <> 'd' GROUP BY 1
""")
def stream_partial(spark, sf):
    folder = shared_folder(spark, "partial")
    parsed = inputs.change_rows(changes_from(_stream(spark, sf, "orders")))
    rows = parsed.filter(~F.col("is_dirty") & (F.col("op") != "d"))
    num = F.col("after")["sku_num"].cast("int")
    wide = rows.select(
        F.col("after")["sku_id"].alias("id"), F.col("after")["user_id"].alias("user_id"), F.when(num > 3, num).alias("sku_num"),
        F.col("after")["id"].cast("bigint").alias("seq"),
    )
    _finish(merge.partial_update_stream(wide, f"{folder}/out", f"{folder}/cp", ["id"], "seq"))
    return merge.current_partial_rows(spark, f"{folder}/out", ["id"], "seq")


@query("stream_moderation", f"""
WITH c AS (SELECT conv_id, turn, regexp_replace(text, '[^A-Za-z]+', ',', 'g') AS txt FROM conversations),
t AS (SELECT conv_id, turn, split_part(rtrim(txt, ','), ',', -1) AS tok, [w FOR w IN {WORDS} IF contains(txt, w)] AS hits FROM c)
SELECT conv_id, turn, CASE WHEN list_contains({WORDS}, tok) THEN 'P0' WHEN len(hits) > 0 THEN 'P1' ELSE '' END AS violation_grade FROM t
""")
def stream_moderation(spark, sf):
    folder = shared_folder(spark, "moderation")
    rows = _stream(spark, sf, "conversations").select("conv_id", "turn", F.regexp_replace("text", "[^A-Za-z]+", ",").alias("comment_txt"))
    return _append(moderation.moderate(rows, WORDS).select("conv_id", "turn", "violation_grade"), folder)


@query("stream_snapshot_completion", """
SELECT count(CASE WHEN event_id % 50 <> 49 THEN 1 END) AS passed, count(DISTINCT CASE WHEN event_id % 50 = 49 THEN user_id END) AS marks FROM events
""")
def stream_snapshot(spark, sf):
    """Snapshot rows pass, one completion mark per key follows the first live row."""
    folder = shared_folder(spark, "snapshot")
    rows = _stream(spark, sf, "events").select(
        "event_id", "user_id", F.when(F.col("event_id") % 50 == 49, "u").otherwise("r").alias("op"), F.lit("false").alias("is_snapshot")
    )
    out = _append(state.snapshot_rows_stream(rows, "user_id", idle_ms=None), folder)
    return out.agg(F.count(F.when(~F.col("completed"), 1)).alias("passed"), F.count(F.when(F.col("completed"), 1)).alias("marks"))


@query("stream_approximate_dedupe", """
SELECT event_id, user_id, d FROM (
  SELECT event_id, user_id, CAST(ts AS DATE) AS d, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS rn FROM events) WHERE rn = 1
""")
def stream_first_per_day(spark, sf):
    """The first row of each user and day; exact, the name of the query is older."""
    folder = shared_folder(spark, "first-per-day")
    rows = _stream(spark, sf, "events", 8).select("event_id", "user_id", F.to_date("ts").alias("d"))
    _finish(dedupe.first_rows_stream(rows, f"{folder}/out", f"{folder}/cp", ["user_id", "d"], ["event_id"]))
    return dedupe.first_rows(spark, f"{folder}/out", rows.schema, ["user_id", "d"], ["event_id"])


# -- several micro-batches in order ------------------------------------------------


def _weeks(events: DataFrame) -> list[dt.datetime]:
    """Bounds of the slices: 7, 14 and 21 days after the first day."""
    first = events.agg(F.to_date(F.min("ts")).alias("d")).first()["d"]
    return [] if first is None else [dt.datetime.combine(first, dt.time()) + dt.timedelta(days=7 * k) for k in (1, 2, 3)]


def _devices(spark, sf) -> DataFrame:
    """Events by device, twenty of them per user, so that many devices are unseen for a week."""
    return a.events(spark, sf).select(
        "event_id", "ts", (F.col("user_id") * 20 + F.col("event_id") % 20).alias("device"),
        F.when(F.col("event_id") % 3 == 0, "0").otherwise("1").alias("is_new"))


LIVES_SQL = """
k AS (SELECT event_id, ts, user_id * 20 + event_id % 20 AS device, CASE WHEN event_id % 3 = 0 THEN '0' ELSE '1' END AS is_new FROM events),
g AS (SELECT *, lag(ts) OVER (PARTITION BY device ORDER BY ts, event_id) AS before FROM k),
l AS (SELECT *, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL 7 DAY THEN 1 ELSE 0 END) OVER (PARTITION BY device ORDER BY ts, event_id) AS life FROM g)"""


@query("stream_expiring_visitor_repair", with_(LIVES_SQL) + """
SELECT event_id, device, is_new, CASE WHEN is_new = '1' AND CAST(ts AS DATE) <> d THEN '0' ELSE is_new END AS fixed_is_new
FROM (SELECT *, first_value(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END) OVER (PARTITION BY device, life ORDER BY ts, event_id) AS d FROM l)
""")
def stream_expiring_repair(spark, sf):
    """New-visitor repair whose state is forgotten after 7 days without the device, over four micro-batches."""
    folder, rows = shared_folder(spark, "expiring-repair"), _devices(spark, sf)
    day = F.to_date("ts")
    kept = F.when(F.col("is_new") == "1", day).otherwise(F.date_sub(day, 1))

    def fixed(first):
        return F.when((F.col("is_new") == "1") & (day != first), F.lit("0")).otherwise(F.col("is_new"))

    replay.replay(rows, folder, "ts", _weeks(rows), lambda stream, n: expiry.first_value_stream(
        stream, folder, f"{folder}/cp", "device", ["ts", "event_id"], "ts", kept, fixed, "fixed_is_new", fold_every=2))
    return spark.read.parquet(f"{folder}/out").drop("ts", "batch_id")


@query("stream_expiring_login_counts", with_(LIVES_SQL) + """
SELECT dt, is_first, count(*) AS login_count FROM (
  SELECT CAST(ts AS DATE) AS dt, CASE WHEN CAST(ts AS DATE) = CAST(min(ts) OVER (PARTITION BY device, life) AS DATE) THEN 1 ELSE 0 END AS is_first FROM l) GROUP BY 1, 2
""")
def stream_expiring_login(spark, sf):
    """First-login flag with a lifetime of 7 days, counted per day."""
    folder, rows = shared_folder(spark, "expiring-logins"), _devices(spark, sf).drop("is_new")
    day = F.to_date("ts")
    replay.replay(rows, folder, "ts", _weeks(rows), lambda stream, n: expiry.first_value_stream(
        stream, folder, f"{folder}/cp", "device", ["ts", "event_id"], "ts", day, lambda first: F.when(day == first, 1).otherwise(0), "is_first"))
    return windows.running_count(spark.read.parquet(f"{folder}/out").withColumn("dt", day), ["dt", "is_first"], "login_count")


@query("stream_expiring_newer_only", """
WITH g AS (SELECT event_id, user_id, ts, event_id * 7919 % 10007 AS v, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
l AS (SELECT *, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL 1 DAY THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS life FROM g)
SELECT event_id, v FROM (SELECT *, max(v) OVER (PARTITION BY user_id, life ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM l)
WHERE m IS NULL OR v > m
""")
def stream_expiring_newer(spark, sf):
    """Latest-only filter whose state is forgotten after a day without the user."""
    folder = shared_folder(spark, "expiring-newer")
    rows = a.events(spark, sf).select("event_id", "user_id", "ts", (F.col("event_id") * 7919 % 10007).alias("v"))
    replay.replay(rows, folder, "ts", _weeks(rows), lambda stream, n: expiry.newer_only_stream(
        stream, folder, f"{folder}/cp", "user_id", ["ts", "event_id"], "ts", "v", fold_every=2))
    return spark.read.parquet(f"{folder}/out").select("event_id", "v")


LATE_SQL = """
WITH e AS (SELECT ts, event_type, CASE event_id % 50 WHEN 0 THEN ts + INTERVAL 8 SECOND WHEN 1 THEN ts + INTERVAL 5 DAY ELSE ts END AS arrival, event_id % 50 = 0 AS slow FROM events),
d AS (SELECT CAST(min(ts) AS DATE) AS d FROM e),
b AS (SELECT k, min(ts) + INTERVAL 1 SECOND AS bound FROM e, d, (VALUES (1), (2), (3)) v(k) WHERE slow AND ts >= d + 7 * k GROUP BY k),
s AS (SELECT *, (SELECT count(*) FROM b WHERE arrival >= bound) AS slice FROM e),
m AS (SELECT k, (SELECT date_trunc('millisecond', max(ts) - INTERVAL 15 SECOND) FROM s WHERE arrival < bound) AS mark FROM b),
w AS (SELECT s.*, time_bucket(INTERVAL 5 MINUTE, ts) AS start, coalesce(time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= mark, false) AS late
      FROM s LEFT JOIN m ON k = slice)
SELECT 'window' AS part, strftime(start, '%Y-%m-%d %H:%M:%S') AS stt, event_type AS keyword, count(*) AS n FROM w WHERE NOT late GROUP BY ALL
UNION ALL SELECT 'late', CAST(x AS VARCHAR), NULL, (SELECT count(*) FROM w WHERE late AND slice = x) FROM range(0, (SELECT count(*) + 1 FROM b)) r(x)
"""


@query("stream_late_rows", LATE_SQL)
def stream_late_rows(spark, sf):
    """Windows with late rows over four micro-batches: rows 8 seconds late change their window, rows 5 days late are counted per slice."""
    folder = shared_folder(spark, "late")
    late = F.when(F.col("event_id") % 50 == 0, F.expr("ts + INTERVAL 8 SECONDS")).when(F.col("event_id") % 50 == 1, F.expr("ts + INTERVAL 5 DAYS"))
    rows = a.events(spark, sf).select("ts", F.col("event_type").alias("keyword"), F.coalesce(late, "ts").alias("arrival"), (F.col("event_id") % 50 == 0).alias("slow"))
    marks = [F.min(F.when(F.col("slow") & (F.col("ts") >= F.lit(w)), F.col("ts"))) + F.expr("INTERVAL 1 SECOND") for w in _weeks(rows)]
    bounds = [b for b in (rows.agg(*marks).first() if marks else []) if b is not None]

    def start(stream, n):
        mark = replay.watermark_before(rows, "ts", "arrival", bounds[n - 1], "15 SECONDS") if n else None
        timely = windows.counted_late(windows.with_lateness(stream, "ts"), "ts", "5 minutes", mark)
        out = windows.keyword_counts(timely, "ts", size="5 minutes")
        return merge.upsert_stream(out, f"{folder}/out", f"{folder}/cp", ["stt", "keyword"], "keyword_count")

    reports = replay.replay(rows, folder, "arrival", bounds, start)
    counts = spark.createDataFrame([(str(n), windows.late_count(p)) for n, p in enumerate(reports)], "stt string, n long")
    kept = merge.current_rows(spark, f"{folder}/out", ["stt", "keyword"])
    return kept.select(F.lit("window").alias("part"), "stt", "keyword", F.col("keyword_count").alias("n")).unionByName(
        counts.select(F.lit("late").alias("part"), "stt", F.lit(None).cast("string").alias("keyword"), "n"))


PARTIAL_SQL = with_(CHG) + """
SELECT CAST(k % 500 AS VARCHAR) AS id, arg_max(user_id, k) AS user_id, arg_max(CASE WHEN num > 3 THEN num END, k) AS sku_num, max(k) AS seq
FROM chg WHERE op <> 'd' GROUP BY 1
"""


@query("stream_partial_update_folded", PARTIAL_SQL)
def stream_partial_folded(spark, sf):
    """Partial updates in four micro-batches; before each later one the table is folded, twice, and the folded batches are removed."""
    folder = shared_folder(spark, "partial-folded")
    orders = a.table(spark, sf, "orders")
    top = orders.agg(F.max("o_orderkey")).first()[0] or 0
    path, keys = f"{folder}/out", ["id"]

    def start(stream, n):
        if n:
            version = merge.fold_partial_rows(spark, path, keys, "seq")
            if merge.fold_partial_rows(spark, path, keys, "seq") != version:
                raise AssertionError("a fold without new batches made a version")
            versions.remove_folded(spark, path)
        parsed = inputs.change_rows(changes_from(stream)).filter(~F.col("is_dirty") & (F.col("op") != "d"))
        num, after = F.col("after")["sku_num"].cast("int"), F.col("after")
        wide = parsed.select(
            after["sku_id"].alias("id"), after["user_id"].alias("user_id"), F.when(num > 3, num).alias("sku_num"), after["id"].cast("bigint").alias("seq"))
        return merge.partial_update_stream(wide, path, f"{folder}/cp", keys, "seq")

    replay.replay(orders, folder, "o_orderkey", [top * k // 4 for k in (1, 2, 3)], start)
    return merge.current_partial_rows(spark, path, keys, "seq")


@query("stream_snapshot_idle", """
SELECT event_id, user_id, false AS completed FROM events WHERE NOT (event_id % 50 = 49 AND user_id % 2 = 0)
UNION ALL SELECT NULL, user_id, true FROM (SELECT DISTINCT user_id FROM events)
""")
def stream_snapshot_idle(spark, sf):
    """Rows of the snapshot and one mark per key: after the first live row, or, for odd users that have none, by the idle timer."""
    folder, idle_ms = shared_folder(spark, "snapshot-idle"), 2000
    live = (F.col("event_id") % 50 == 49) & (F.col("user_id") % 2 == 0)
    rows = _stream(spark, sf, "events").select("event_id", "user_id", F.when(live, "u").otherwise("r").alias("op"), F.lit("false").alias("is_snapshot"))
    out = state.snapshot_rows_stream(rows, "user_id", idle_ms)
    state.run_until_idle(out, f"{folder}/out", f"{folder}/cp", idle_ms)
    return spark.read.schema(out.schema).parquet(f"{folder}/out").select("event_id", "user_id", "completed")
