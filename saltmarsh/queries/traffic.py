"""Queries of the streaming jobs in batch form: routing, windows, state, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from saltmarsh.functions import dates, geo, numbers, text
from saltmarsh.functions.documents import append_to_json_array
from saltmarsh.operators.history import as_of_lookup, range_lookup
from saltmarsh.operators.quality import valid_rows
from saltmarsh.operators.ranking import first_per_key, global_row_number, latest_per_key, top_n_rows
from saltmarsh.operators.relations import interval_join, overwrite_merge
from saltmarsh.operators.sequences import number_slice
from saltmarsh.plans import moderation, profile, shop_traffic as st, vehicles
from saltmarsh.queries import adapters as a
from saltmarsh.queries.fragments import VIEWS, with_
from saltmarsh.queries.registry import query
from saltmarsh.queries.retail import f01
from saltmarsh.sources.sinks import day_bucket
from saltmarsh.streaming import dedupe, inputs, joins, merge, routes, state, windows

# -- change records built from the orders and lines -------------------------------------


def _changes(spark, sf):
    return changes_from(a.table(spark, sf, "orders"))


def changes_from(o):
    """Orders, payments, carts, comments, coupons and users as change envelopes.

    Every 50th record is broken JSON and every 51st names an unknown table.
    """
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")

    def text_map(**pairs):
        items = [x for n, v in pairs.items() for x in (F.lit(n), v.cast("string"))]
        return F.create_map(*items)

    after = text_map(
        id=k, order_id=k, user_id=F.col("o_custkey"), sku_id=k % 500, sku_num=k % 9, order_price=F.col("o_totalprice"),
        split_total_amount=F.col("o_totalprice"), total_amount=F.col("o_totalprice"), operate_time=F.unix_millis("o_orderdate"),
        create_time=F.unix_millis("o_orderdate"), callback_time=F.unix_millis("o_orderdate"), order_status=F.when(s == "F", "1003").otherwise("1001"),
        payment_status=F.when(s == "O", "1603").otherwise("1601"), payment_type=F.substring("o_orderpriority", 1, 1),
        coupon_status=F.when(s == "P", "1402").otherwise("1401"), coupon_id=k % 77, get_time=F.unix_millis("o_orderdate"),
        appraise=F.substring("o_orderpriority", 1, 1), comment_txt=F.col("o_orderpriority"), login_name=F.concat(F.lit("user"), F.col("o_custkey")),
        province_id=k % 30,
    )
    before = text_map(id=k, sku_num=k % 4)
    names = F.array(*[F.lit(n) for n in TABLES])
    table = F.when(k % 51 == 0, "mystery").otherwise(F.element_at(names, (k % len(TABLES) + 1).cast("int")))
    op = F.when(k % 10 < 4, "c").when(k % 10 < 6, "r").when(k % 10 < 9, "u").otherwise("d")
    record = F.struct(
        op.alias("op"), F.when(op.isin("u", "d"), F.when(op == "d", after).otherwise(before)).alias("before"),
        F.when(op != "d", after).alias("after"), F.create_map(F.lit("db"), F.lit("shop"), F.lit("table"), table).alias("source"),
        F.unix_millis("o_orderdate").alias("ts_ms"),
    )
    value = F.when(k % 50 == 0, F.concat(F.lit("{broken "), k)).otherwise(F.to_json(record))
    return o.select(value.alias("value"))


TABLES = ["order_detail", "cart_info", "order_info", "payment_info", "comment_info", "coupon_use", "user_info", "order_refund_info"]

CHG = f"""
chg AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS s, o_orderdate AS d,
    CAST(epoch(o_orderdate) * 1000 AS BIGINT) AS ts, CAST(o_totalprice AS DECIMAL(16,2)) AS price, substr(o_orderpriority, 1, 1) AS p, o_orderpriority AS prio,
    CASE WHEN o_orderkey % 51 = 0 THEN 'mystery' ELSE {TABLES}[o_orderkey % 8 + 1] END AS tab,
    CASE WHEN o_orderkey % 10 < 4 THEN 'c' WHEN o_orderkey % 10 < 6 THEN 'r' WHEN o_orderkey % 10 < 9 THEN 'u' ELSE 'd' END AS op,
    CAST(o_orderkey % 9 AS INTEGER) AS num, CAST(o_orderkey % 4 AS INTEGER) AS num0
  FROM orders WHERE o_orderkey % 50 <> 0
)"""


def _parsed(spark, sf):
    return inputs.change_rows(_changes(spark, sf))


def _route(name, sql):
    @query(f"t03_{name}_fact", with_(CHG) + sql)
    def run(spark, sf):
        return routes.CHANGE_ROUTES[name](_parsed(spark, sf))


_route("order_detail", """SELECT id, id AS order_id, user_id, CAST(k % 500 AS VARCHAR) AS sku_id, CAST(NULL AS VARCHAR) AS sku_name, num AS sku_num,
  price AS split_original_amount, CAST(NULL AS DECIMAL(16,2)) AS split_activity_amount, CAST(NULL AS DECIMAL(16,2)) AS split_coupon_amount,
  price AS split_total_amount, ts AS create_time, ts FROM chg WHERE tab = 'order_detail'""")
_route("cart_add", "SELECT id, user_id, CAST(k % 500 AS VARCHAR) AS sku_id, num AS sku_num, ts FROM chg WHERE tab = 'cart_info'")
_route("order_cancel", "SELECT id, user_id, ts AS cancel_time, price AS split_total_amount, ts FROM chg WHERE tab = 'order_info' AND s = 'F'")
_route("payment_success", "SELECT id, id AS order_id, user_id, p AS payment_type, ts AS callback_time, price AS split_payment_amount, ts FROM chg WHERE tab = 'payment_info' AND s = 'O'")
_route("order_refund", """SELECT id, id AS order_id, user_id, CAST(k % 500 AS VARCHAR) AS sku_id, CAST(NULL AS INTEGER) AS refund_num,
  CAST(NULL AS DECIMAL(16,2)) AS refund_amount, ts AS create_time, ts FROM chg WHERE tab = 'order_refund_info'""")
_route("comment", "SELECT id, user_id, CAST(k % 500 AS VARCHAR) AS sku_id, id AS order_id, p AS appraise, prio AS comment_txt, ts AS create_time, ts FROM chg WHERE tab = 'comment_info'")
_route("coupon_get", "SELECT id, user_id, CAST(k % 77 AS VARCHAR) AS coupon_id, ts AS get_time, ts FROM chg WHERE tab = 'coupon_use' AND s <> 'P'")
_route("coupon_use", "SELECT id, user_id, CAST(k % 77 AS VARCHAR) AS coupon_id, id AS order_id, ts FROM chg WHERE tab = 'coupon_use' AND s = 'P'")
_route("user_register", """SELECT id, 'user' || user_id AS login_name, ts AS register_time, CAST(k % 30 AS VARCHAR) AS province_id, ts
  FROM chg WHERE tab = 'user_info' AND op IN ('c', 'r')""")


@query("t04_cart_add_delta", with_(CHG) + """
SELECT id, user_id, CAST(k % 500 AS VARCHAR) AS sku_id, CASE op WHEN 'r' THEN num ELSE num - num0 END AS sku_num, ts
FROM chg WHERE tab = 'cart_info' AND (op = 'r' OR (op = 'u' AND num > num0))
""")
def t04(spark, sf):
    return routes.cart_add_delta(_parsed(spark, sf))


@query("t05_comment_fact_decoded", with_(CHG) + """
SELECT id, user_id, CAST(k % 500 AS VARCHAR) AS sku_id, id AS order_id, p AS appraise, prio AS comment_txt, ts AS create_time, ts,
  coalesce(n, 'N/A') AS appraise_name
FROM chg LEFT JOIN (SELECT DISTINCT substr(o_orderpriority, 1, 1) AS c, o_orderpriority AS n FROM orders WHERE o_orderpriority < '4') ON p = c WHERE tab = 'comment_info'
""")
def t05(spark, sf):
    dic = a.dictionary(spark, sf).filter((F.col("parent_code") == "11") & (F.col("dic_name") < "4"))
    return joins.comment_facts(routes.CHANGE_ROUTES["comment"](_parsed(spark, sf)), dic)


@query("t06_cart_partial_update", with_(CHG) + """
SELECT CAST(k % 500 AS VARCHAR) AS id, arg_max(user_id, k) AS user_id, arg_max(CASE WHEN num > 3 THEN num END, k) AS sku_num, max(k) AS seq
FROM chg WHERE op <> 'd' GROUP BY 1
""")
def t06(spark, sf):
    rows = _parsed(spark, sf).filter(~F.col("is_dirty") & (F.col("op") != "d"))
    num = F.col("after")["sku_num"].cast("int")
    wide = rows.select(
        F.col("after")["sku_id"].alias("id"), F.col("after")["user_id"].alias("user_id"), F.when(num > 3, num).alias("sku_num"),
        F.col("after")["id"].cast("bigint").alias("seq"),
    )
    return merge.partial_update(wide, ["id"], "seq")


@query("t01_dirty_and_unrouted_changes", """
SELECT kind, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'dirty' WHEN o_orderkey % 51 = 0 THEN 'unrouted' ELSE 'routed' END AS kind FROM orders) GROUP BY 1
""")
def t01_changes(spark, sf):
    rows = _parsed(spark, sf)
    known = F.col("table").isin(*routes.FACT_TABLES)
    kind = F.when(F.col("is_dirty"), "dirty").when(known, "routed").otherwise("unrouted")
    return rows.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("t25_change_archive", with_(CHG) + """
SELECT id, op, 'shop' AS db, tab AS "table", CASE WHEN op IN ('u', 'd') THEN 1 ELSE 0 END AS has_before, CASE WHEN op <> 'd' THEN 1 ELSE 0 END AS has_after, ts AS ts_ms FROM chg
""")
def t25(spark, sf):
    rows = inputs.archive_rows(_parsed(spark, sf))
    return rows.select("id", "op", "db", "table", F.col("before").isNotNull().cast("int").alias("has_before"), F.col("after").isNotNull().cast("int").alias("has_after"), "ts_ms")


CONFIG = {"comment_info": ("dim_comment", "id", "id,user_id"), "user_info": ("dim_user", "user_id", "user_id,login_name")}


@query("t12_dimension_sync", with_(CHG) + """
SELECT CASE tab WHEN 'comment_info' THEN 'dim_comment' ELSE 'dim_user' END AS sink_table,
  md5(CASE tab WHEN 'comment_info' THEN id ELSE user_id END) AS row_key,
  CASE tab WHEN 'comment_info' THEN 'id=' || id || ',user_id=' || user_id ELSE 'login_name=user' || user_id || ',user_id=' || user_id END AS cells, ts AS ts_ms
FROM chg WHERE tab IN ('comment_info', 'user_info') AND op <> 'd'
""")
def t12(spark, sf):
    """Configured tables routed to dimension tables with their chosen columns."""
    config = spark.createDataFrame(
        [(t, *v) for t, v in CONFIG.items()], "source_table string, sink_table string, sink_row_key string, sink_columns string"
    )
    routed = joins.route_by_config(_parsed(spark, sf).filter(~F.col("is_dirty")), config)
    out = merge.dimension_rows(routed)
    cells = F.array_sort(F.transform(F.map_entries("row"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return out.select("sink_table", "row_key", F.array_join(cells, ",").alias("cells"), "ts_ms")


# -- application logs ------------------------------------------------------------------------


def _log_lines(spark, sf):
    return log_lines_from(a.events(spark, sf))


def log_lines_from(events):
    """Events as log records with starts, pages, actions, displays and errors; some are broken."""
    e, i = F.col("event_type"), F.col("event_id")
    act = F.struct(e.alias("action_id"), F.lit("x").alias("item"), F.lit("t").alias("item_type"), F.unix_millis("ts").alias("ts"))
    shown = F.struct(F.col("props").alias("item"), F.lit("p").alias("item_type"), (i % 5).cast("int").alias("pos_id"), F.lit(1).alias("pos_seq"))
    record = F.struct(
        F.struct(F.col("user_id").cast("string").alias("mid"), F.lit("app").alias("ch"), (i % 2).cast("string").alias("is_new")).alias("common"),
        F.when(e == "signup", F.struct(F.lit("icon").alias("entry"), F.floor("value").alias("loading_time"))).alias("start"),
        F.when(e.isin("view", "click"), F.struct(e.alias("page_id"), F.floor("value").alias("during_time"))).alias("page"),
        F.when((e == "click") & (i % 2 == 0), F.array(act, act)).alias("actions"),
        F.when((e == "click") & (i % 2 == 1), F.array(act)).alias("action"),
        F.when(e == "view", F.array(shown, shown, shown)).alias("displays"),
        F.when(e == "error", F.struct((i % 100).cast("int").alias("error_code"), F.lit("bad").alias("msg"))).alias("err"),
        F.unix_millis("ts").alias("ts"),
    )
    return events.select(F.when(i % 40 == 0, "not json").otherwise(F.to_json(record)).alias("value"))


GOOD = "FROM events WHERE event_id % 40 <> 0"


def _log_route(name, sql):
    @query(f"t02_{name}_log", sql)
    def run(spark, sf):
        return routes.LOG_ROUTES[name](routes.parse_logs(_log_lines(spark, sf)))


_WHO = "CAST(user_id AS VARCHAR) AS mid, CAST(NULL AS VARCHAR) AS user_id"
_TS = "epoch_us(ts) // 1000 AS ts"
_log_route("start", f"SELECT {_WHO}, 'app' AS channel, CAST(event_id % 2 AS VARCHAR) AS is_new, 'icon' AS start_type, CAST(floor(value) AS BIGINT) AS loading_time, {_TS} {GOOD} AND event_type = 'signup'")
_log_route("page", f"""SELECT {_WHO}, 'app' AS channel, CAST(event_id % 2 AS VARCHAR) AS is_new, event_type AS page_id, CAST(NULL AS VARCHAR) AS last_page_id,
  CAST(NULL AS VARCHAR) AS item, CAST(NULL AS VARCHAR) AS item_type, CAST(floor(value) AS BIGINT) AS during_time, {_TS} {GOOD} AND event_type IN ('view', 'click')""")
_log_route("action", f"""SELECT {_WHO}, event_type AS action_id, 'x' AS item, 't' AS item_type, {_TS} FROM (
  SELECT *, unnest(range(CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END)) AS n {GOOD} AND event_type = 'click')""")
_log_route("display", f"""SELECT {_WHO}, props AS item, 'p' AS item_type, CAST(event_id % 5 AS INTEGER) AS pos_id, 1 AS pos_seq, {_TS}, 'view' AS page_id FROM (
  SELECT *, unnest(range(3)) AS n {GOOD} AND event_type = 'view')""")
_log_route("error", f"SELECT {_WHO}, CAST(event_id % 100 AS INTEGER) AS err_code, 'bad' AS err_msg, {_TS} {GOOD} AND event_type = 'error'")
_log_route("dirty", "SELECT 'not json' AS value FROM events WHERE event_id % 40 = 0")


@query("t02_unknown_log", "SELECT count(*) AS n FROM events WHERE event_id % 40 <> 0 AND event_type = 'purchase'")
def t02_unknown(spark, sf):
    return routes.unknown_log(routes.parse_logs(_log_lines(spark, sf))).agg(F.count(F.lit(1)).alias("n"))


# -- windows ---------------------------------------------------------------------------------


def _bounds(size: str) -> str:
    start = f"time_bucket(INTERVAL {size}, ts)"
    return (
        f"strftime({start}, '%Y-%m-%d %H:%M:%S') AS stt, strftime({start} + INTERVAL {size}, '%Y-%m-%d %H:%M:%S') AS edt, "
        f"strftime({start}, '%Y-%m-%d') AS cur_date"
    )


def _keywords(spark, sf):
    return a.events(spark, sf).select("ts", F.concat(F.col("event_type"), F.lit(" "), F.col("event_id") % 3).alias("keyword"))


KEYWORD_SQL = f"""
SELECT {_bounds("'5 minutes'")}, event_type || ' ' || CAST(event_id % 3 AS VARCHAR) AS keyword, count(*) AS keyword_count FROM events GROUP BY ALL
"""


@query("t07_keyword_windows", KEYWORD_SQL)
def t07(spark, sf):
    return windows.keyword_counts(_keywords(spark, sf), "ts", size="5 minutes")


def _sku_lines(spark, sf):
    v = F.col("value").cast("decimal(10,2)").cast("string")
    return a.events(spark, sf).select(
        "ts", (F.col("event_id") % 20).alias("sku_id"), F.when(F.col("event_id") % 3 > 0, F.col("event_type")).otherwise("").alias("sku_name"),
        v.alias("split_original_amount"), F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(v).alias("split_activity_amount"),
        F.concat(F.lit("-"), v).alias("split_coupon_amount"), v.alias("split_total_amount"),
    )


@query("t08_sku_amount_windows", f"""
SELECT {_bounds("'1 hour'")}, event_id % 20 AS sku_id, min(CASE WHEN event_id % 3 > 0 THEN event_type END) AS sku_name,
  CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS original_amount,
  CAST(sum(CASE WHEN event_id % 4 = 0 THEN 0 ELSE CAST(value AS DECIMAL(10,2)) END) AS DECIMAL(18,2)) AS activity_reduce_amount,
  CAST(0 AS DECIMAL(18,2)) AS coupon_reduce_amount, CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS order_amount
FROM events GROUP BY ALL
""")
def t08(spark, sf):
    return windows.sku_amounts(_sku_lines(spark, sf), "ts", "1 hour")


@query("t09_login_windows", f"""
SELECT {_bounds("'1 hour'")}, count(DISTINCT user_id) AS uu_ct, count(DISTINCT CASE WHEN event_id % 2 = 0 THEN user_id END) AS back_ct FROM events GROUP BY ALL
""")
def t09(spark, sf):
    rows = a.events(spark, sf).select("ts", "user_id", (F.col("event_id") % 2).alias("is_new"))
    return windows.login_users(rows, "ts", "1 hour")


@query("stm05_last_record_per_key", """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
""")
def stm05(spark, sf):
    return windows.last_per_key(a.events(spark, sf), ["user_id"], "ts")


@query("stm21_running_count", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stm21(spark, sf):
    return windows.running_count(a.events(spark, sf), ["user_id", "event_type"])


# -- state -----------------------------------------------------------------------------------


@query("stm09_new_visitor_repair", """
WITH f AS (SELECT user_id AS u, arg_min(CASE WHEN event_id % 3 = 0 THEN CAST(ts AS DATE) - 1 ELSE CAST(ts AS DATE) END, ts) AS d FROM events GROUP BY 1)
SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN '0' ELSE '1' END AS is_new,
  CASE WHEN event_id % 3 <> 0 AND CAST(ts AS DATE) = d THEN '1' ELSE '0' END AS fixed_is_new FROM events JOIN f ON user_id = u
""")
def stm09(spark, sf):
    rows = a.events(spark, sf).select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 == 0, "0").otherwise("1").alias("is_new"))
    return state.repair_new_flag(rows, "user_id", ["ts", "event_id"], "ts", "is_new").drop("ts")


@query("stm10_login_counts", """
SELECT dt, is_first, count(*) AS login_count FROM (
  SELECT CAST(ts AS DATE) AS dt, CASE WHEN CAST(ts AS DATE) = min(CAST(ts AS DATE)) OVER (PARTITION BY user_id) THEN 1 ELSE 0 END AS is_first FROM events) GROUP BY 1, 2
""")
def stm10(spark, sf):
    return state.login_counts(a.user_days(spark, sf), "user_id", "dt")


@query("stm11_first_seen_visitor", """
SELECT event_id, user_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS is_new_visitor FROM events
""")
def stm11(spark, sf):
    rows = a.events(spark, sf).select("event_id", "user_id", "ts")
    return state.first_seen_flag(rows, "user_id", ["ts", "event_id"]).drop("ts")


@query("stm13_whole_record_dedupe", """
SELECT user_id, event_type, k, min(event_id) AS event_id FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS k FROM events) GROUP BY 1, 2, 3
""")
def stm13(spark, sf):
    rows = a.events(spark, sf).select("event_id", "user_id", "event_type", (F.get_json_object("props", "$.k").cast("int") % 5).alias("k"))
    return dedupe.whole_records_batch(rows, ["user_id"], ["event_id"], ignore=["event_id"])


@query("stm12_exact_dedupe", """
SELECT user_id, d, min(event_id) AS event_id FROM (SELECT *, CAST(ts AS DATE) AS d FROM events) GROUP BY 1, 2
""")
def stm12(spark, sf):
    rows = a.events(spark, sf).select("event_id", "user_id", F.to_date("ts").alias("d"))
    return first_per_key(rows, ["user_id", "d"], [F.col("event_id")])


@query("stm14_newer_only", """
SELECT event_id, user_id, v FROM (SELECT *, max(v) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
  FROM (SELECT *, event_id * 7919 % 10007 AS v FROM events)) WHERE m IS NULL OR v > m
""")
def stm14(spark, sf):
    rows = a.events(spark, sf).select("event_id", "user_id", (F.col("event_id") * 7919 % 10007).alias("v"))
    return dedupe.newer_only(rows, ["user_id"], ["event_id"], "v", number_slice(F.col("event_id"), 4096))


@query("stm15_running_profile", """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
m AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS f1,
  CASE WHEN row_number() OVER (PARTITION BY user_id, k ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS f2 FROM e)
SELECT event_id, user_id, event_type, k, row_number() OVER w AS pv, CAST(sum(f1) OVER w AS BIGINT) AS event_type_count, CAST(sum(f2) OVER w AS BIGINT) AS k_count
FROM m WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def stm15(spark, sf):
    rows = a.events(spark, sf).select("event_id", "user_id", "ts", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return state.running_profile(rows, "user_id", ["ts", "event_id"], ["event_type", "k"], F.date_trunc("day", "ts")).drop("ts")


@query("stm15_latest_profile", """
SELECT user_id, count(*) AS pv, max(ts) AS last_ts, (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT event_type AS x FROM events y WHERE y.user_id = e.user_id)) AS event_type_list
FROM events e GROUP BY user_id
""")
def stm15_latest(spark, sf):
    return state.latest_profile(a.events(spark, sf), "user_id", "ts", ["event_type"])


@query("stm15_profile_lists", """
WITH e AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events),
sight AS (SELECT user_id, 't' AS tag, event_type AS v, min(ts) AS first FROM e WHERE event_type IS NOT NULL GROUP BY 1, 3
  UNION ALL SELECT user_id, 'k', CAST(CAST(k AS INTEGER) % 5 AS VARCHAR), min(ts) FROM e WHERE k IS NOT NULL GROUP BY 1, 3),
lists AS (SELECT e.event_id, string_agg(CASE WHEN tag = 't' THEN v END, ',' ORDER BY v) AS event_type_list, string_agg(CASE WHEN tag = 'k' THEN v END, ',' ORDER BY v) AS rest_list
  FROM e JOIN sight s ON s.user_id = e.user_id AND s.first <= e.ts GROUP BY 1)
SELECT e.event_id, e.user_id, row_number() OVER (PARTITION BY e.user_id ORDER BY ts, e.event_id) AS pv, event_type_list, rest_list
FROM e LEFT JOIN lists ON lists.event_id = e.event_id
""")
def stm15_lists(spark, sf):
    """The profile with its growing sets, as a batch over the stored rows."""
    rest = (F.get_json_object("props", "$.k").cast("int") % 5).alias("rest")
    rows = a.events(spark, sf).select("event_id", "user_id", "ts", "event_type", rest)
    out = state.running_profile_lists(rows, "user_id", ["ts", "event_id"], "ts", ["event_type", "rest"], F.date_trunc("day", "ts"))
    return out.select("event_id", "user_id", "pv", "event_type_list", "rest_list")


@query("t22_snapshot_rows", with_(CHG) + "SELECT id, op FROM chg WHERE op = 'r'")
def t22(spark, sf):
    return vehicles.snapshot_rows(_parsed(spark, sf).filter(~F.col("is_dirty"))).select(F.col("after")["id"].alias("id"), "op")


@query("t22_vehicle_locations", """
SELECT event_id, CAST(user_id AS DOUBLE) / 10 AS lon, CAST(event_id % 90 AS DOUBLE) AS lat, CASE WHEN event_id % 9 = 0 THEN '2024' ELSE strftime(ts, '%Y%m%d%H%M%S') END AS "dateTime",
  CASE WHEN event_id % 9 = 0 THEN 0 ELSE epoch_us(date_trunc('second', ts)) // 1000 - 28800000 END AS ts,
  CASE WHEN event_id % 9 = 0 THEN '19700101' ELSE strftime(ts - INTERVAL 8 HOUR, '%Y%m%d') END AS ds FROM events
""")
def t22_locations(spark, sf):
    loc = F.struct(
        (F.col("user_id") / 10).alias("lon"), (F.col("event_id") % 90).cast("double").alias("lat"),
        F.when(F.col("event_id") % 9 == 0, "2024").otherwise(F.date_format("ts", "yyyyMMddHHmmss")).alias("dateTime"),
    )
    return vehicles.flatten_location(a.events(spark, sf).select("event_id", loc.alias("upexgmsgreallocation")))


def _track(spark, sf):
    return a.events(spark, sf).select(
        F.col("user_id").alias("vehicle"), "ts", "event_id", (F.lit(30.0) + (F.col("event_id") % 100) / 1000).alias("lat"),
        (F.lit(120.0) + (F.col("event_id") % 77) / 1000).alias("lon"),
    )


@query("t23_track_haversine", """
WITH p AS (SELECT user_id AS vehicle, CAST(ts AS DATE) AS dt, radians(30.0::DOUBLE + (event_id % 100) / 1000::DOUBLE) AS a1, radians(120.0::DOUBLE + (event_id % 77) / 1000::DOUBLE) AS o1, ts, event_id FROM events),
q AS (SELECT *, lead(a1) OVER w AS a2, lead(o1) OVER w AS o2 FROM p WINDOW w AS (PARTITION BY vehicle, dt ORDER BY ts, event_id))
SELECT vehicle, dt, count(*) AS points, round(coalesce(sum(2 * 6371008.8::DOUBLE * asin(sqrt(power(sin((a2 - a1) / 2), 2) + cos(a1) * cos(a2) * power(sin((o2 - o1) / 2), 2)))), 0), 1) AS metres
FROM q GROUP BY 1, 2
""")
def t23(spark, sf):
    return vehicles.track_distance(_track(spark, sf), "vehicle", "ts", "lat", "lon", "event_id", exact=False)


# The legs of the track with their distance: the longitude difference is moved to its fixed point, leg by leg.
LEGS = """
WITH RECURSIVE fx AS (SELECT 6378137.0::DOUBLE AS ra, 1 / 298.257223563::DOUBLE AS f),
pts AS (SELECT user_id AS vehicle, CAST(ts AS DATE) AS dt, 30.0::DOUBLE + (event_id % 100) / 1000::DOUBLE AS lat, 120.0::DOUBLE + (event_id % 77) / 1000::DOUBLE AS lon, ts, event_id FROM events),
nx AS (SELECT *, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM pts WINDOW w AS (PARTITION BY vehicle, dt ORDER BY ts, event_id)),
pr AS (SELECT DISTINCT lat, lon, lat2, lon2 FROM nx WHERE lat2 IS NOT NULL),
u AS (SELECT pr.*, f, ra, atan((1 - f) * tan(radians(lat))) AS u1, atan((1 - f) * tan(radians(lat2))) AS u2, radians(lon2 - lon) AS span FROM pr, fx),
it AS (
  SELECT lat, lon, lat2, lon2, f, ra, u1, u2, span, span AS lam, 0 AS n, 1e9::DOUBLE AS move, 0.0::DOUBLE AS ss, 0.0::DOUBLE AS cs, 0.0::DOUBLE AS sg, 0.0::DOUBLE AS ca, 0.0::DOUBLE AS cm FROM u
  UNION ALL
  SELECT lat, lon, lat2, lon2, f, ra, u1, u2, span, nl, n + 1, abs(nl - lam), ss, cs, sg, ca, cm FROM (
    SELECT *, span + (1 - c) * f * sa * (sg + c * ss * (cm + c * cs * (2 * cm * cm - 1))) AS nl FROM (
      SELECT *, f / 16 * ca * (4 + f * (4 - 3 * ca)) AS c, CASE WHEN ca = 0 THEN 0 ELSE cs - 2 * sin(u1) * sin(u2) / ca END AS cm FROM (
        SELECT *, atan2(ss, cs) AS sg, 1 - sa * sa AS ca FROM (
          SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin(lam) / ss END AS sa FROM (
            SELECT lat, lon, lat2, lon2, f, ra, u1, u2, span, lam, n, move, sqrt(power(cos(u2) * sin(lam), 2) + power(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss,
              sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM it WHERE n < 100 AND move >= 1e-12)))))),
done AS (SELECT *, ca * (1 / power(1 - f, 2) - 1) AS k FROM it WHERE move < 1e-12),
ab AS (SELECT *, 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k))) AS fa, k / 1024 * (256 + k * (-128 + k * (74 - 47 * k))) AS fb FROM done),
legs AS (SELECT lat, lon, lat2, lon2, CASE WHEN ss = 0 THEN 0 ELSE (1 - f) * ra * fa * (sg - fb * ss * (cm + fb / 4 * (cs * (2 * cm * cm - 1) - fb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))) END AS metres FROM ab)
"""


@query("t23_track_ellipsoid", LEGS + """
SELECT vehicle, dt, count(*) AS points, round(coalesce(sum(metres), 0), 1) AS metres FROM nx LEFT JOIN legs USING (lat, lon, lat2, lon2) GROUP BY 1, 2
""")
def t23_exact(spark, sf):
    return vehicles.track_distance(_track(spark, sf), "vehicle", "ts", "lat", "lon", "event_id")


@query("mth04_ellipsoid_close_to_sphere", """
SELECT 0 AS far_apart, count(*) AS points FROM events
""")
def mth04(spark, sf):
    """Ellipsoidal and spherical distance never differ by more than 0.7 percent."""
    d1 = geo.ellipsoid_distance(F.lit(30.0), F.lit(120.0), F.col("lat"), F.col("lon"))
    d2 = geo.haversine(F.lit(30.0), F.lit(120.0), F.col("lat"), F.col("lon"))
    rows = _track(spark, sf).select(d1.alias("a"), d2.alias("b"))
    far = F.abs(F.col("a") - F.col("b")) > F.col("b") * 0.007
    return rows.agg(F.count(F.when(far, 1)).cast("int").alias("far_apart"), F.count(F.lit(1)).alias("points"))


# -- joins over time -------------------------------------------------------------------------


@query("jon11_interval_join", """
SELECT c.user_id, c.event_id AS click_id, p.event_id AS purchase_id, p.ts AS info_ts
FROM events c JOIN events p ON c.user_id = p.user_id AND p.ts >= c.ts - INTERVAL 6 HOUR AND p.ts <= c.ts + INTERVAL 6 HOUR
WHERE c.event_type = 'click' AND p.event_type = 'purchase'
""")
def jon11(spark, sf):
    e = a.events(spark, sf)
    return interval_join(
        e.filter(F.col("event_type") == "click"), e.filter(F.col("event_type") == "purchase"), ["user_id"], "ts", "ts",
        6 * 3600, 6 * 3600, {"click_id": "event_id"}, {"purchase_id": "event_id", "info_ts": "ts"},
    )


@query("jon13_as_of_lookup", """
SELECT p.event_id, p.user_id, s.event_id AS signup_id, s.value AS signup_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s ON p.user_id = s.user_id AND p.ts >= s.ts
""")
def jon13(spark, sf):
    e = a.events(spark, sf)
    facts = e.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    versions = e.filter(F.col("event_type") == "signup").select(
        "user_id", F.col("ts").alias("vts"), F.col("event_id").alias("signup_id"), F.col("value").alias("signup_value")
    )
    return as_of_lookup(facts, versions, ["user_id"], "ts", "vts", ["signup_id", "signup_value"]).drop("ts")


@query("jon13_history_range_lookup", """
WITH daily AS (SELECT o_custkey AS u, CAST(o_orderdate AS DATE) AS d, arg_max(o_orderpriority, o_orderkey) AS level FROM orders GROUP BY 1, 2),
h AS (SELECT *, coalesce(CAST(lead(d) OVER (PARTITION BY u ORDER BY d) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS e FROM daily)
SELECT o_orderkey, o_custkey, level FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) + 10 AS day FROM orders) f LEFT JOIN h ON o_custkey = u AND day BETWEEN d AND e
""")
def jon13_range(spark, sf):
    from saltmarsh.queries.retail import d04_history

    f = a.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), F.date_add(F.col("o_orderdate").cast("date"), 10).alias("day"))
    out = range_lookup(f, d04_history(spark, sf), ["user_id"], "day", ["level"])
    return out.select("o_orderkey", F.col("user_id").alias("o_custkey"), "level")


@query("jon15_overwrite_merge", """
SELECT c_custkey, coalesce(v, c_mktsegment) AS c_mktsegment, n FROM customer
LEFT JOIN (SELECT o_custkey, CASE WHEN count(*) > 9 THEN min(o_orderpriority) END AS v, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey
""")
def jon15(spark, sf):
    left = a.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    n = F.count(F.lit(1))
    right = a.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.when(n > 9, F.min("o_orderpriority")).alias("c_mktsegment"), n.alias("n")
    )
    return overwrite_merge(left, right, ["c_custkey"])


# -- ranking and de-duplication -----------------------------------------------------------------


@query("win03_global_rank", """
SELECT o_orderkey, row_number() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(16,0)) DESC, o_orderkey) AS place FROM orders
""")
def win03(spark, sf):
    o = a.table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(16,0)").alias("price"))
    return global_row_number(o, "price", "o_orderkey", "place").select("o_orderkey", "place")


@query("win03_global_rank_with_ties", """
SELECT event_id, row_number() OVER (ORDER BY CASE WHEN event_id % 3 = 0 THEN 1 ELSE event_id % 50 END DESC, event_id) AS place FROM events
""")
def win03_ties(spark, sf):
    score = F.when(F.col("event_id") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("event_id") % 50)
    rows = a.events(spark, sf).select("event_id", score.alias("score"))
    return global_row_number(rows, "score", "event_id", "place").select("event_id", "place")


@query("set05_latest_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def set05(spark, sf):
    o = a.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest_per_key(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])


@query("srt03_window_top_ten", """
SELECT w AS stat_time, user_id, n, rank_num FROM (SELECT *, CAST(row_number() OVER (PARTITION BY w ORDER BY n DESC, user_id) AS INTEGER) AS rank_num
  FROM (SELECT date_trunc('day', ts) AS w, user_id, count(*) AS n FROM events GROUP BY 1, 2)) WHERE rank_num <= 10
""")
def srt03(spark, sf):
    per = a.events(spark, sf).groupBy(F.date_trunc("day", "ts").alias("stat_time"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return top_n_rows(per, ["stat_time"], [F.col("n").desc(), F.col("user_id")], 10)


# -- moderation ------------------------------------------------------------------------------------

WORDS = ["the", "thion", "onen", "heen", "les", "ere", "on", "wh"]


@query("t11_moderation", f"""
WITH c AS (SELECT doc_id, regexp_replace(text, '[^A-Za-z]+', ',', 'g') AS txt FROM documents),
t AS (SELECT doc_id, txt, CASE WHEN rtrim(txt, ',') = '' THEN '' ELSE split_part(rtrim(txt, ','), ',', -1) END AS tok, [w FOR w IN {WORDS} IF contains(txt, w)] AS hits FROM c)
SELECT doc_id, CASE WHEN list_contains({WORDS}, tok) OR len(hits) > 0 THEN 1 ELSE 0 END AS is_violation,
  CASE WHEN list_contains({WORDS}, tok) THEN 'P0' WHEN len(hits) > 0 THEN 'P1' ELSE '' END AS violation_grade,
  CASE WHEN list_contains({WORDS}, tok) THEN tok WHEN len(hits) > 0 THEN array_to_string(hits, ', ') ELSE '' END AS violation_msg FROM t
""")
def t11(spark, sf):
    d = a.table(spark, sf, "documents").select("doc_id", F.regexp_replace("text", "[^A-Za-z]+", ",").alias("comment_txt"))
    return moderation.moderate(d, WORDS).drop("comment_txt")


@query("t11_moderation_once", f"""
WITH c AS (SELECT conv_id, min_by(regexp_replace(text, '[^A-Za-z]+', ',', 'g'), turn) AS txt FROM conversations GROUP BY 1),
t AS (SELECT conv_id, txt, split_part(rtrim(txt, ','), ',', -1) AS tok, [w FOR w IN {WORDS} IF contains(txt, w)] AS hits FROM c)
SELECT conv_id, CASE WHEN list_contains({WORDS}, tok) THEN 'P0' WHEN len(hits) > 0 THEN 'P1' ELSE '' END AS violation_grade FROM t
""")
def t11_once(spark, sf):
    c = a.table(spark, sf, "conversations").select("conv_id", "turn", F.regexp_replace("text", "[^A-Za-z]+", ",").alias("comment_txt"))
    return moderation.moderate_once(c, WORDS, ["conv_id"], ["turn"]).select("conv_id", "violation_grade")


@query("t10_comment_enrichment", """
WITH c AS (SELECT event_id, user_id, ts, event_type AS appraise FROM events WHERE event_type IN ('view', 'error')),
o AS (SELECT event_id AS order_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT c.user_id, c.event_id AS comment_id, o.order_id, coalesce(d.n, 'N/A') AS appraise_name, strftime(c.ts, '%Y%m%d') AS ds
FROM c JOIN o ON c.user_id = o.user_id AND o.ts BETWEEN c.ts - INTERVAL 60 MINUTE AND c.ts + INTERVAL 60 MINUTE
LEFT JOIN (SELECT DISTINCT event_type AS k, upper(event_type) AS n FROM events WHERE event_type = 'view') d ON c.appraise = d.k
""")
def t10(spark, sf):
    e = a.events(spark, sf)
    comments = e.filter(F.col("event_type").isin("view", "error")).withColumn("appraise", F.col("event_type"))
    dic = e.filter(F.col("event_type") == "view").select(F.col("event_type").alias("dic_code"), F.upper("event_type").alias("dic_name")).distinct()
    named = joins.comment_facts(comments, dic)
    both = interval_join(
        named, e.filter(F.col("event_type") == "purchase"), ["user_id"], "ts", "ts", 3600, 3600,
        {"comment_id": "event_id", "appraise_name": "appraise_name", "comment_ts": "ts"}, {"order_id": "event_id"},
    )
    return both.withColumn("ds", F.date_format("comment_ts", "yyyyMMdd")).drop("comment_ts")


# -- profile scoring ----------------------------------------------------------------------------------

BRANDS = ["TCL", "苹果", "联想", "小米", "欧莱雅", "香奈儿", "other"]
CATEGORIES = ["数码", "手机", "厨具", "母婴", "other"]
SEARCH = ["时尚与潮流", "性价比", "健康与养生", "科技与数码", "unlisted"]
_B = profile.BANDS


def _weights_sql(factor: str) -> str:
    rows = ", ".join(
        f"('{v}', {', '.join(str(p) for p in points)})" for f, v, points in profile.weight_rows() if f == factor
    )
    return f"w_{factor}(v, {', '.join(f'b{i}' for i in range(6))}) AS (VALUES {rows})"


def _pick(items: list[str], index):
    return F.element_at(F.array(*[F.lit(x) for x in items]), (index + 1).cast("int"))


def _order_rows(spark, sf):
    k = F.col("o_orderkey")
    return a.table(spark, sf, "orders").select(
        k.alias("order_id"), F.col("o_custkey").alias("uid"), (k % 200).alias("sku_id"),
        F.timestamp_seconds(F.unix_timestamp("o_orderdate") + (k % 24) * 3600).alias("pay_time"),
        (F.col("o_totalprice") / 100).cast("decimal(16,2)").alias("total_amount"),
        F.concat(_pick(["iOS", "Android", "Other"], k % 3), F.lit(",x")).alias("os"), F.concat(F.lit("item"), k % 5).alias("search_item"),
    )


def _sku_names(spark, sf):
    p = F.col("p_partkey")
    return a.table(spark, sf, "part").select(
        p.alias("sku_id"), _pick(BRANDS, p % 7).alias("tname"), _pick(CATEGORIES, p % 5).alias("b1_name")
    )


def _search_names(spark, sf):
    i = F.col("r_regionkey")
    return a.table(spark, sf, "region").select(F.concat(F.lit("item"), i).alias("search_item"), _pick(SEARCH, i).alias("search_category"))


def _sql_list(items: list[str]) -> str:
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


SLOT = """CASE WHEN o_orderkey % 24 < 6 THEN '凌晨' WHEN o_orderkey % 24 < 9 THEN '早晨' WHEN o_orderkey % 24 < 12 THEN '上午' WHEN o_orderkey % 24 < 14 THEN '中午'
 WHEN o_orderkey % 24 < 18 THEN '下午' WHEN o_orderkey % 24 < 22 THEN '晚上' ELSE '夜间' END"""
PROFILE = f"""
prof AS (SELECT o_orderkey AS order_id, {SLOT} AS slot, CASE WHEN round(o_totalprice / 100, 2) < 1000 THEN '低消费' WHEN round(o_totalprice / 100, 2) < 4000 THEN '中消费' ELSE '高消费' END AS spending_pow,
  {_sql_list(BRANDS)}[o_orderkey % 200 % 7 + 1] AS tname, {_sql_list(CATEGORIES)}[o_orderkey % 200 % 5 + 1] AS b1_name,
  ['iOS', 'Android', 'Other'][o_orderkey % 3 + 1] AS judge_os, {_sql_list(SEARCH)}[o_orderkey % 5 + 1] AS cat FROM orders)"""
FACTOR_COLUMNS = {"device": "judge_os", "search": "cat", "time": "slot", "amount": "spending_pow", "brand": "tname", "category": "b1_name"}
_JOINS = " ".join(
    f"LEFT JOIN w_{f} j_{f} ON {c} = j_{f}.v AND j_{f}.v <> '*' LEFT JOIN (SELECT * FROM w_{f} WHERE v = '*') d_{f} ON true" for f, c in FACTOR_COLUMNS.items()
)


def _points_sql(factors: list[str], i: int) -> str:
    return " + ".join(f"coalesce(j_{f}.b{i}, d_{f}.b{i}, 0)" for f in factors)


_ALL_W = [_weights_sql(f) for f in FACTOR_COLUMNS]
_SUM_COLS = ", ".join(f"CAST({_points_sql(list(FACTOR_COLUMNS), i)} AS DOUBLE) AS {profile.band_column('sum', b)}" for i, b in enumerate(_B))
_SUM_NAMES = [profile.band_column("sum", b) for b in _B]
_BEST = "CASE " + " ".join(f"WHEN {n} = greatest({', '.join(_SUM_NAMES)}) THEN '{b}'" for n, b in zip(_SUM_NAMES, _B)) + " END"


@query("t13_device_search_scores", with_(PROFILE, *[_weights_sql(f) for f in ("device", "search")]) + "SELECT order_id, judge_os, " + ", ".join(
    f"CAST({_points_sql([f], i)} AS DOUBLE) AS {profile.band_column(f, b)}" for f in ("device", "search") for i, b in enumerate(_B)
) + " FROM prof " + " ".join(
    f"LEFT JOIN w_{f} j_{f} ON {FACTOR_COLUMNS[f]} = j_{f}.v AND j_{f}.v <> '*' LEFT JOIN (SELECT * FROM w_{f} WHERE v = '*') d_{f} ON true" for f in ("device", "search")))
def t13(spark, sf):
    out = profile.device_search_scores(_order_rows(spark, sf), profile.weight_table(spark), _search_names(spark, sf))
    return out.select("order_id", "judge_os", *[profile.band_column(f, b) for f in ("device", "search") for b in _B])


_ORDER_F = ("time", "amount", "brand", "category")


@query("t14_order_scores", with_(PROFILE, *[_weights_sql(f) for f in _ORDER_F]) + "SELECT order_id, spending_pow, " + ", ".join(
    f"CAST({_points_sql([f], i)} AS DOUBLE) AS {profile.band_column(f, b)}" for f in _ORDER_F for i, b in enumerate(_B)
) + " FROM prof " + " ".join(
    f"LEFT JOIN w_{f} j_{f} ON {FACTOR_COLUMNS[f]} = j_{f}.v AND j_{f}.v <> '*' LEFT JOIN (SELECT * FROM w_{f} WHERE v = '*') d_{f} ON true" for f in _ORDER_F))
def t14(spark, sf):
    out = profile.order_scores(_order_rows(spark, sf), profile.weight_table(spark), _sku_names(spark, sf))
    return out.select("order_id", "spending_pow", *[profile.band_column(f, b) for f in _ORDER_F for b in _B])


LINE_PROFILE = f"""
prof AS (SELECT l_orderkey * 10 + l_linenumber AS order_id, l_partkey AS sku_id, {SLOT.replace("o_orderkey", "l_orderkey")} AS slot,
  CASE WHEN round(l_extendedprice / 100, 2) < 1000 THEN '低消费' WHEN round(l_extendedprice / 100, 2) < 4000 THEN '中消费' ELSE '高消费' END AS spending_pow,
  {_sql_list(BRANDS)}[p_partkey % 7 + 1] AS tname, {_sql_list(CATEGORIES)}[p_partkey % 5 + 1] AS b1_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""


@query("t14_line_scores", with_(LINE_PROFILE, *[_weights_sql(f) for f in _ORDER_F]) + "SELECT order_id, sku_id, spending_pow, " + ", ".join(
    f"CAST(CASE WHEN {FACTOR_COLUMNS[f]} IS NULL THEN 0 ELSE {_points_sql([f], i)} END AS DOUBLE) AS {profile.band_column(f, b)}" for f in _ORDER_F for i, b in enumerate(_B)
) + " FROM prof " + " ".join(
    f"LEFT JOIN w_{f} j_{f} ON {FACTOR_COLUMNS[f]} = j_{f}.v AND j_{f}.v <> '*' LEFT JOIN (SELECT * FROM w_{f} WHERE v = '*') d_{f} ON true" for f in _ORDER_F))
def t14_lines(spark, sf):
    """Order lines with their own part, so the join grows with both tables."""
    k = F.col("l_orderkey")
    lines = a.table(spark, sf, "lineitem").select(
        (k * 10 + F.col("l_linenumber")).alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.timestamp_seconds(F.unix_timestamp(a.day("2001-01-01").cast("timestamp")) + (k % 24) * 3600).alias("pay_time"),
        (F.col("l_extendedprice") / 100).cast("decimal(16,2)").alias("total_amount"),
    )
    out = profile.order_scores(lines, profile.weight_table(spark), _sku_names(spark, sf))
    return out.select("order_id", "sku_id", "spending_pow", *[profile.band_column(f, b) for f in _ORDER_F for b in _B])


LINE_FULL_PROFILE = LINE_PROFILE.replace(" FROM lineitem", f""", ['iOS', 'Android', 'Other'][l_orderkey % 3 + 1] AS judge_os, {_sql_list(SEARCH)}[l_orderkey % 5 + 1] AS cat FROM lineitem""")
_LINE_SUMS = ", ".join(
    "CAST(" + " + ".join(f"CASE WHEN {FACTOR_COLUMNS[f]} IS NULL THEN 0 ELSE {_points_sql([f], i)} END" for f in FACTOR_COLUMNS) + f" AS DOUBLE) AS {n}"
    for i, n in enumerate(_SUM_NAMES)
)


@query("t15_line_best_band", with_(LINE_FULL_PROFILE, *_ALL_W) + f"""
SELECT order_id, {', '.join(_SUM_NAMES)}, {_BEST} AS best_band, greatest({', '.join(_SUM_NAMES)}) AS best_score FROM (SELECT order_id, {_LINE_SUMS} FROM prof {_JOINS})
""")
def t15_lines(spark, sf):
    """Full score of order lines with their own part, so the join grows with both tables."""
    return _line_totals(spark, sf).select("order_id", *_SUM_NAMES, "best_band", "best_score")


def _line_totals(spark, sf):
    k, w = F.col("l_orderkey"), profile.weight_table(spark)
    lines = a.table(spark, sf, "lineitem").select(
        (k * 10 + F.col("l_linenumber")).alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.timestamp_seconds(F.unix_timestamp(a.day("2001-01-01").cast("timestamp")) + (k % 24) * 3600).alias("pay_time"),
        (F.col("l_extendedprice") / 100).cast("decimal(16,2)").alias("total_amount"),
        F.concat(_pick(["iOS", "Android", "Other"], k % 3), F.lit(",x")).alias("os"), F.concat(F.lit("item"), k % 5).alias("search_item"),
    )
    rows = profile.order_scores(lines, w, _sku_names(spark, sf))
    return profile.total_scores(profile.device_search_scores(rows, w, _search_names(spark, sf)))


@query("t15_line_label_documents", with_(LINE_FULL_PROFILE, *_ALL_W) + f"""
SELECT order_id, {_BEST} AS best_band, CAST(sum_18_24 AS DOUBLE) AS first_band, spending_pow FROM (SELECT order_id, spending_pow, {_LINE_SUMS} FROM prof {_JOINS})
""")
def t15_line_documents(spark, sf):
    """The nested result document of each order line, read back field by field."""
    return _read_labels(_line_totals(spark, sf))


def _read_labels(scored):
    docs = profile.label_document(scored.withColumn("uid", F.col("order_id")))
    calc = "$.user_calculate_label"
    return docs.select(
        F.col("uid").alias("order_id"), F.get_json_object("label", f"{calc}.calculate_age.best_band").alias("best_band"),
        F.get_json_object("label", f"{calc}.computer_age_info.18-24").cast("double").alias("first_band"),
        F.get_json_object("label", f"{calc}.spending_pow").alias("spending_pow"),
    )


def _scored(spark, sf):
    w = profile.weight_table(spark)
    rows = profile.order_scores(_order_rows(spark, sf), w, _sku_names(spark, sf))
    return profile.total_scores(profile.device_search_scores(rows, w, _search_names(spark, sf)))


@query("t15_profile_best_band", with_(PROFILE, *_ALL_W) + f"""
SELECT order_id, {', '.join(_SUM_NAMES)}, {_BEST} AS best_band, greatest({', '.join(_SUM_NAMES)}) AS best_score FROM (SELECT order_id, {_SUM_COLS} FROM prof {_JOINS})
""")
def t15(spark, sf):
    return _scored(spark, sf).select("order_id", *_SUM_NAMES, "best_band", "best_score")


@query("t15_label_documents", with_(PROFILE, *_ALL_W) + f"""
SELECT order_id, {_BEST} AS best_band, CAST(sum_18_24 AS DOUBLE) AS first_band, spending_pow FROM (SELECT order_id, spending_pow, {_SUM_COLS} FROM prof {_JOINS})
""")
def t15_documents(spark, sf):
    """The nested result document, read back field by field."""
    return _read_labels(_scored(spark, sf))


@query("t15_base_labels", """
SELECT c_custkey, CAST(date_diff('year', b, DATE '2025-08-01') - CASE WHEN month(b) * 100 + day(b) > 801 THEN 1 ELSE 0 END AS INTEGER) AS age, CAST(year(b) // 10 * 10 AS INTEGER) AS decade,
  CASE WHEN m <= 119 THEN '摩羯座' WHEN m <= 218 THEN '水瓶座' WHEN m <= 320 THEN '双鱼座' WHEN m <= 419 THEN '白羊座' WHEN m <= 520 THEN '金牛座' WHEN m <= 621 THEN '双子座'
    WHEN m <= 722 THEN '巨蟹座' WHEN m <= 822 THEN '狮子座' WHEN m <= 922 THEN '处女座' WHEN m <= 1023 THEN '天秤座' WHEN m <= 1122 THEN '天蝎座' WHEN m <= 1221 THEN '射手座' ELSE '摩羯座' END AS zodiac_sign
FROM (SELECT c_custkey, b, month(b) * 100 + day(b) AS m FROM (SELECT c_custkey, DATE '1960-01-01' + CAST(c_custkey * 13 % 16000 AS INTEGER) AS b FROM customer))
""")
def t15_base(spark, sf):
    c = a.table(spark, sf, "customer").select("c_custkey", F.date_add(a.day("1960-01-01"), (F.col("c_custkey") * 13 % 16000).cast("int")).alias("birthday"))
    return profile.base_labels(c, a.day("2025-08-01")).drop("birthday")


# -- shop traffic -----------------------------------------------------------------------------------


def _shop_logs(spark, sf):
    e = a.events(spark, sf)
    i, t, ms = F.col("event_id"), F.col("event_type"), F.unix_millis("ts")
    who, term = F.concat(F.lit("v"), F.col("user_id")), F.when(i % 2 == 0, "pc").otherwise("wireless")
    visits = e.filter(t.isin("view", "click", "error")).select(
        i.alias("log_id"), ms.alias("visit_time"), F.when(i % 31 == 0, "  ").otherwise(who).alias("visitor_id"), term.alias("terminal_type"),
        F.when(t == "view", "shop").when(t == "click", "product").otherwise("page").alias("visit_object_type"), (i % 30).alias("visit_object_id"),
        F.concat(F.lit("s"), F.col("user_id") % 3).alias("traffic_source_first"), F.concat(F.lit("t"), i % 4).alias("traffic_source_second"),
        (F.col("user_id") % 2).alias("is_new_visitor"), (i % 5 + 1).alias("page_view"), F.floor("value").alias("stay_time"),
    )
    acts = e.filter(t == "signup").select(
        i.alias("log_id"), ms.alias("interact_time"), who.alias("visitor_id"), term.alias("terminal_type"), (i % 30).alias("product_id"),
        F.when(i % 3 == 0, "cart").otherwise("collect").alias("interact_type"), F.when(i % 7 == 0, 1).alias("is_cancel"),
    )
    pays = e.filter(t == "purchase").select(
        i.alias("log_id"), ms.alias("pay_time"), who.alias("buyer_id"), term.alias("terminal_type"), i.alias("order_id"), (i % 30).alias("product_id"),
        F.col("value").cast("decimal(18,2)").alias("pay_amount"), F.when(i % 4 == 0, 0).otherwise(1).alias("is_paid"),
    )
    searches = e.filter(t == "error").select(
        i.alias("log_id"), ms.alias("search_time"), who.alias("visitor_id"), term.alias("terminal_type"), F.concat(F.lit("kw"), i % 17).alias("keyword"),
        (i % 2).alias("is_click_result"),
    )
    clicks = e.filter(t == "click").select(
        i.alias("log_id"), ms.alias("click_time"), who.alias("visitor_id"), term.alias("terminal_type"), (i % 30).alias("page_id"),
    )
    crowd = e.filter(t == "signup").select(
        i.alias("log_id"), who.alias("visitor_id"), F.when(i % 2 == 0, "m").otherwise("f").alias("gender"), F.concat(F.lit("a"), i % 4).alias("age_range"),
        F.concat(F.lit("c"), F.col("user_id") % 5).alias("city"), (i % 3).alias("taoqi_value"), ms.alias("update_time"),
    )
    return {
        "visits": st.visit_detail(visits), "acts": st.interaction_detail(acts), "pays": st.pay_detail(pays), "searches": st.search_detail(searches),
        "clicks": st.page_click_detail(clicks), "crowd": st.crowd_detail(crowd),
    }


SHOP = """
ev AS (SELECT *, date_trunc('hour', ts) AS stat_time, CASE WHEN event_id % 2 = 0 THEN 'pc' ELSE 'wireless' END AS terminal_type, CAST(10001 AS BIGINT) AS shop_id,
  'v' || CAST(user_id AS VARCHAR) AS who FROM events),
vi AS (SELECT *, CASE event_type WHEN 'view' THEN 'shop' WHEN 'click' THEN 'product' ELSE 'page' END AS kind, event_id % 30 AS oid, event_id % 5 + 1 AS pv, CAST(floor(value) AS BIGINT) AS stay
  FROM ev WHERE event_type IN ('view', 'click', 'error') AND event_id % 31 <> 0),
ac AS (SELECT *, event_id % 30 AS product_id, CASE WHEN event_id % 3 = 0 THEN 'cart' ELSE 'collect' END AS kind FROM ev WHERE event_type = 'signup' AND event_id % 7 <> 0),
pa AS (SELECT *, event_id % 30 AS product_id, CAST(value AS DECIMAL(18,2)) AS amount FROM ev WHERE event_type = 'purchase' AND event_id % 4 <> 0)"""


@query("t17_visit_detail", with_(SHOP) + """
SELECT event_id AS log_id, epoch_us(ts) // 1000 AS visit_time, who AS visitor_id, terminal_type, kind AS visit_object_type, oid AS visit_object_id, 's' || CAST(user_id % 3 AS VARCHAR) AS traffic_source_first,
  't' || CAST(event_id % 4 AS VARCHAR) AS traffic_source_second, user_id % 2 AS is_new_visitor, pv AS page_view, stay AS stay_time, stat_time, shop_id FROM vi
""")
def t17_visit(spark, sf):
    return _shop_logs(spark, sf)["visits"]


@query("t17_interaction_detail", with_(SHOP) + """
SELECT event_id AS log_id, epoch_us(ts) // 1000 AS interact_time, who AS visitor_id, terminal_type, product_id, kind AS interact_type, CAST(NULL AS INTEGER) AS is_cancel, stat_time, shop_id FROM ac
""")
def t17_interaction(spark, sf):
    return _shop_logs(spark, sf)["acts"]


@query("t17_pay_detail", with_(SHOP) + """
SELECT event_id AS log_id, epoch_us(ts) // 1000 AS pay_time, who AS buyer_id, terminal_type, event_id AS order_id, product_id, amount AS pay_amount, 1 AS is_paid, stat_time, 1 AS pay_quantity, shop_id FROM pa
""")
def t17_pay(spark, sf):
    return _shop_logs(spark, sf)["pays"]


@query("t17_search_detail", with_(SHOP) + """
SELECT event_id AS log_id, epoch_us(ts) // 1000 AS search_time, who AS visitor_id, terminal_type, 'kw' || CAST(event_id % 17 AS VARCHAR) AS keyword, event_id % 2 AS is_click_result, stat_time, 'day' AS stat_dimension, shop_id
FROM ev WHERE event_type = 'error'
""")
def t17_search(spark, sf):
    return _shop_logs(spark, sf)["searches"]


@query("t17_page_click_detail", with_(SHOP) + """
SELECT event_id AS log_id, epoch_us(ts) // 1000 AS click_time, who AS visitor_id, terminal_type, event_id % 30 AS page_id, stat_time, shop_id FROM ev WHERE event_type = 'click'
""")
def t17_click(spark, sf):
    return _shop_logs(spark, sf)["clicks"]


@query("t17_crowd_detail", with_(SHOP) + """
SELECT event_id AS log_id, who AS visitor_id, CASE WHEN event_id % 2 = 0 THEN 'm' ELSE 'f' END AS gender, 'a' || CAST(event_id % 4 AS VARCHAR) AS age_range, 'c' || CAST(user_id % 5 AS VARCHAR) AS city,
  event_id % 3 AS taoqi_value, epoch_us(ts) // 1000 AS update_time, date_trunc('day', ts) AS stat_time, shop_id FROM ev WHERE event_type = 'signup'
""")
def t17_crowd(spark, sf):
    return _shop_logs(spark, sf)["crowd"]


OVERVIEW = """
ovr AS (SELECT stat_time, terminal_type, shop_id, coalesce(a, 0) AS shop_visitor_count, coalesce(b, 0) AS shop_page_view, coalesce(c, 0) AS new_visitor_count, coalesce(a - c, 0) AS old_visitor_count,
  coalesce(d, 0) AS product_visitor_count, coalesce(e, 0) AS product_page_view, coalesce(f, 0) AS add_collection_count, coalesce(g, 0) AS pay_buyer_count, coalesce(h, 0) AS pay_amount
  FROM (SELECT stat_time, terminal_type, shop_id, count(DISTINCT CASE WHEN kind = 'shop' THEN who END) AS a, CAST(coalesce(sum(CASE WHEN kind = 'shop' THEN pv END), 0) AS BIGINT) AS b,
          count(DISTINCT CASE WHEN kind = 'shop' AND user_id % 2 = 1 THEN who END) AS c, count(DISTINCT CASE WHEN kind = 'product' THEN who END) AS d,
          CAST(coalesce(sum(CASE WHEN kind = 'product' THEN pv END), 0) AS BIGINT) AS e FROM vi GROUP BY 1, 2, 3)
  FULL JOIN (SELECT stat_time, terminal_type, shop_id, count(*) AS f FROM ac WHERE kind = 'collect' GROUP BY 1, 2, 3) USING (stat_time, terminal_type, shop_id)
  FULL JOIN (SELECT stat_time, terminal_type, shop_id, count(DISTINCT who) AS g, CAST(sum(amount) AS DECIMAL(20,2)) AS h FROM pa GROUP BY 1, 2, 3) USING (stat_time, terminal_type, shop_id))"""


@query("t18_overview", with_(SHOP, OVERVIEW) + "SELECT * FROM ovr")
def t18_overview(spark, sf):
    logs = _shop_logs(spark, sf)
    return st.overview(logs["visits"], logs["acts"], logs["pays"])


@query("t19_overview_report", with_(SHOP, OVERVIEW) + """
SELECT *, CASE WHEN shop_visitor_count > 0 THEN round(CAST(pay_buyer_count AS DOUBLE) / shop_visitor_count, 4) ELSE 0.0 END AS pay_conversion_rate FROM ovr
""")
def t19(spark, sf):
    return st.overview_report(t18_overview(spark, sf))


SOURCE = """
src AS (SELECT stat_time, terminal_type, shop_id, 's' || CAST(user_id % 3 AS VARCHAR) AS traffic_source_first, 't' || CAST(event_id % 4 AS VARCHAR) AS traffic_source_second,
  count(DISTINCT who) AS visitor_count, count(DISTINCT CASE WHEN kind = 'product' THEN who END) AS product_visitor_count FROM vi GROUP BY 1, 2, 3, 4, 5)"""


@query("t18_source_summary", with_(SHOP, SOURCE) + "SELECT * FROM src")
def t18_source(spark, sf):
    return st.source_summary(_shop_logs(spark, sf)["visits"])


KEYWORD = """
kw AS (SELECT CAST(stat_time AS DATE) AS stat_date, 'day' AS stat_dimension, terminal_type, shop_id, 'kw' || CAST(event_id % 17 AS VARCHAR) AS keyword, count(DISTINCT who) AS search_visitor_count,
  count(DISTINCT CASE WHEN event_id % 2 = 1 THEN who END) AS click_visitor_count FROM ev WHERE event_type = 'error' GROUP BY 1, 2, 3, 4, 5)"""


@query("t18_keyword_summary", with_(SHOP, KEYWORD) + "SELECT * FROM kw")
def t18_keyword(spark, sf):
    return st.keyword_summary(_shop_logs(spark, sf)["searches"])


PRODUCT = """
pr AS (SELECT stat_time, terminal_type, shop_id, product_id, coalesce(a, 0) AS visitor_count, coalesce(b, 0) AS page_view, coalesce(c, 0.0) AS avg_stay_time, coalesce(d, 0) AS add_cart_count,
  coalesce(e, 0) AS collection_count, coalesce(f, 0) AS pay_buyer_count, coalesce(g, 0) AS pay_amount
  FROM (SELECT stat_time, terminal_type, shop_id, oid AS product_id, count(DISTINCT who) AS a, CAST(sum(pv) AS BIGINT) AS b, round(avg(stay), 4) AS c FROM vi WHERE kind = 'product' GROUP BY 1, 2, 3, 4)
  FULL JOIN (SELECT stat_time, terminal_type, shop_id, product_id, count(CASE WHEN kind = 'cart' THEN 1 END) AS d, count(CASE WHEN kind = 'collect' THEN 1 END) AS e FROM ac GROUP BY 1, 2, 3, 4) USING (stat_time, terminal_type, shop_id, product_id)
  FULL JOIN (SELECT stat_time, terminal_type, shop_id, product_id, count(DISTINCT who) AS f, CAST(sum(amount) AS DECIMAL(20,2)) AS g FROM pa GROUP BY 1, 2, 3, 4) USING (stat_time, terminal_type, shop_id, product_id))"""


@query("t18_product_summary", with_(SHOP, PRODUCT) + "SELECT * FROM pr")
def t18_product(spark, sf):
    logs = _shop_logs(spark, sf)
    return st.product_summary(logs["visits"], logs["acts"], logs["pays"])


PAGE = """
pg AS (SELECT stat_time, terminal_type, shop_id, page_id, coalesce(a, 0) AS visitor_count, coalesce(b, 0) AS page_view, coalesce(c, 0.0) AS avg_stay_time, coalesce(d, 0) AS click_count
  FROM (SELECT stat_time, terminal_type, shop_id, oid AS page_id, count(DISTINCT who) AS a, CAST(sum(pv) AS BIGINT) AS b, round(avg(stay), 4) AS c FROM vi WHERE kind = 'page' GROUP BY 1, 2, 3, 4)
  FULL JOIN (SELECT stat_time, terminal_type, shop_id, event_id % 30 AS page_id, count(*) AS d FROM ev WHERE event_type = 'click' GROUP BY 1, 2, 3, 4) USING (stat_time, terminal_type, shop_id, page_id))"""


@query("t18_page_summary", with_(SHOP, PAGE) + "SELECT * FROM pg")
def t18_page(spark, sf):
    logs = _shop_logs(spark, sf)
    return st.page_summary(logs["visits"], logs["clicks"])


CROWD = """
cr AS (SELECT date_trunc('day', ts) AS stat_time, 'overall' AS terminal_type, shop_id, crowd_type, CASE WHEN event_id % 2 = 0 THEN 'm' ELSE 'f' END AS gender, 'a' || CAST(event_id % 4 AS VARCHAR) AS age_range,
  'c' || CAST(user_id % 5 AS VARCHAR) AS city, event_id % 3 AS taoqi_value, count(*) AS crowd_count
  FROM ev CROSS JOIN (VALUES ('shop_entry'), ('product_visit'), ('conversion')) k(crowd_type) WHERE event_type = 'signup' GROUP BY ALL)"""


@query("t18_crowd_summary", with_(SHOP, CROWD) + "SELECT * FROM cr")
def t18_crowd(spark, sf):
    return st.crowd_summary(_shop_logs(spark, sf)["crowd"])


@query("t21_crowd_report", with_(SHOP, CROWD) + """
SELECT *, round(CAST(crowd_count AS DOUBLE) / total_crowd_count, 4) AS crowd_ratio FROM (
  SELECT *, CAST(sum(crowd_count) OVER (PARTITION BY stat_time, terminal_type, shop_id, crowd_type) AS BIGINT) AS total_crowd_count FROM cr)
""")
def t21(spark, sf):
    return st.crowd_report(t18_crowd(spark, sf))


def _top(source: str, window: str, key: str, measure: str, columns: str, extra: str = "") -> str:
    return f"""SELECT {window}, {key}, {columns}, rank_num{extra} FROM (
SELECT *, CAST(row_number() OVER (PARTITION BY {window} ORDER BY {measure} DESC, {key}) AS INTEGER) AS rank_num FROM {source}) WHERE rank_num <= 10"""


GRAIN = "stat_time, terminal_type, shop_id"


@query("t20_top_products", with_(SHOP, PRODUCT) + _top("pr", GRAIN, "product_id", "visitor_count",
       "visitor_count, page_view, add_cart_count, collection_count, pay_buyer_count, pay_amount",
       ", CASE WHEN visitor_count > 0 THEN round(CAST(pay_buyer_count AS DOUBLE) / visitor_count, 4) ELSE 0.0 END AS pay_conversion_rate"))
def t20_products(spark, sf):
    return st.product_ranking(t18_product(spark, sf))


@query("t20_top_pages", with_(SHOP, PAGE) + _top("pg", GRAIN, "page_id", "visitor_count", "visitor_count, page_view, click_count"))
def t20_pages(spark, sf):
    return st.page_ranking(t18_page(spark, sf))


@query("t20_top_keywords", with_(SHOP, KEYWORD) + _top("kw", "stat_date, stat_dimension, terminal_type, shop_id", "keyword", "search_visitor_count", "search_visitor_count, click_visitor_count"))
def t20_keywords(spark, sf):
    return st.keyword_ranking(t18_keyword(spark, sf))


@query("t20_top_sources", with_(SHOP, SOURCE) + _top("src", GRAIN, "traffic_source_first, traffic_source_second", "visitor_count", "visitor_count, product_visitor_count"))
def t20_sources(spark, sf):
    return st.source_ranking(t18_source(spark, sf))


@query("t26_channel_day_report", with_(VIEWS) + """
SELECT dt AS stat_date, channel, count(*) AS pv, count(DISTINCT mid_id) AS uv, count(DISTINCT session_id) AS sv, round(CAST(sum(during_time) AS DOUBLE) / count(*), 2) AS avg_duration FROM views GROUP BY 1, 2
""")
def t26_channel(spark, sf):
    return st.channel_day_report(a.page_views(spark, sf))


@query("t26_daily_sales_top", """
SELECT stat_date, sku_id, sku_name, sale_amount, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY stat_date ORDER BY sale_amount DESC, sku_id) AS INTEGER) AS rank
  FROM (SELECT CAST(l_shipdate AS DATE) AS stat_date, l_partkey AS sku_id, p_name AS sku_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS DECIMAL(20,2)) AS sale_amount
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)) WHERE rank <= 10
""")
def t26_sales(spark, sf):
    p = a.table(spark, sf, "part").select(F.col("p_partkey").alias("_p"), F.col("p_name").alias("sku_name"))
    l = a.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("dt"), F.col("l_partkey").alias("sku_id"), numbers.money(F.col("l_extendedprice")).alias("split_total_amount")
    )
    return st.daily_sales_top(l.join(p, F.col("sku_id") == F.col("_p"), "left"))


@query("t26_activity_rate", """
WITH d AS (SELECT CAST(ts AS DATE) AS stat_date, count(DISTINCT user_id) AS active_user_ct FROM events GROUP BY 1),
r AS (SELECT f AS stat_date, count(*) AS new_user_ct FROM (SELECT user_id, min(CAST(ts AS DATE)) AS f FROM events GROUP BY 1) GROUP BY 1)
SELECT stat_date, coalesce(new_user_ct, 0) AS new_user_ct, coalesce(active_user_ct, 0) AS active_user_ct,
  round(CAST(coalesce(active_user_ct, 0) * 100 AS DOUBLE) / sum(coalesce(new_user_ct, 0)) OVER (ORDER BY stat_date), 2) AS active_rate FROM d FULL JOIN r USING (stat_date)
""")
def t26_rate(spark, sf):
    days = a.user_days(spark, sf)
    return st.activity_rate(days, days.groupBy("user_id").agg(F.min("dt").alias("dt")))


# -- column functions over whole tables ---------------------------------------------------------------


@query("str07_hash_bucket", """
SELECT c_custkey, lpad(CAST(CAST('0x' || right(md5(c_name), 3) AS INTEGER) % 37 AS VARCHAR), 4, '0') AS bucket FROM customer
""")
def str07(spark, sf):
    return a.table(spark, sf, "customer").select("c_custkey", text.hash_bucket(F.col("c_name"), 37).alias("bucket"))


@query("dat05_time_slots", """
SELECT slot, count(*) AS n FROM (SELECT CASE WHEN hour(ts) < 6 THEN '凌晨' WHEN hour(ts) < 9 THEN '早晨' WHEN hour(ts) < 12 THEN '上午' WHEN hour(ts) < 14 THEN '中午'
  WHEN hour(ts) < 18 THEN '下午' WHEN hour(ts) < 22 THEN '晚上' ELSE '夜间' END AS slot FROM events) GROUP BY 1
""")
def dat05(spark, sf):
    return a.events(spark, sf).groupBy(dates.time_slot(F.col("ts")).alias("slot")).agg(F.count(F.lit(1)).alias("n"))


@query("dat07_day_numbers", """
SELECT o_orderkey, string_agg(strftime(d, '%Y%m%d'), ',' ORDER BY d) AS days
FROM (SELECT o_orderkey, unnest(generate_series(o_orderdate, o_orderdate + CAST(o_orderkey % 4 AS INTEGER) * INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders) GROUP BY 1
""")
def dat07(spark, sf):
    start = F.col("o_orderdate").cast("date")
    days = dates.day_numbers(start, F.date_add(start, (F.col("o_orderkey") % 4).cast("int")))
    return a.table(spark, sf, "orders").select("o_orderkey", F.array_join(days, ",").alias("days"))


@query("snk12_day_buckets", """
SELECT day, count(*) AS n FROM (SELECT CASE WHEN event_id % 13 = 0 THEN 'error_bucket' ELSE strftime(ts, '%Y%m%d') END AS day FROM events) GROUP BY 1
""")
def snk12(spark, sf):
    s = F.unix_timestamp("ts")
    epoch = F.when(F.col("event_id") % 13 == 0, "bad").when(F.col("event_id") % 2 == 0, s.cast("string")).otherwise((s * 1000).cast("string"))
    return a.events(spark, sf).groupBy(day_bucket(epoch).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("jsn04_json_array_append", """
SELECT event_id, '["' || event_type || '","' || CAST(event_id % 5 AS VARCHAR) || '"]' AS items FROM events
""")
def jsn04(spark, sf):
    first = F.to_json(F.array("event_type"))
    return a.events(spark, sf).select("event_id", append_to_json_array(first, (F.col("event_id") % 5).cast("string")).alias("items"))


@query("flt04_valid_rows", """
SELECT event_id FROM events WHERE value > 0 AND event_id % 6 <> 0
""")
def flt04(spark, sf):
    rows = a.events(spark, sf).withColumn("who", F.when(F.col("event_id") % 6 == 0, " ").otherwise("x"))
    return valid_rows(rows, text_keys=["who"], not_null=["ts"], positive=["value"]).select("event_id")


@query("flt05_clean_text", r"""
SELECT doc_id, CASE WHEN regexp_full_match(word, '[\x{4e00}-\x{9fa5}a-zA-Z0-9\[\]\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)"]+') THEN true ELSE false END AS is_clean
FROM (SELECT doc_id, regexp_extract(text, '^[^ ]*') AS word FROM documents)
""")
def flt05(spark, sf):
    d = a.table(spark, sf, "documents").withColumn("word", F.regexp_extract("text", "^[^ ]*", 0))
    return d.select("doc_id", text.is_clean_text(F.col("word")).alias("is_clean"))


@query("snk16_export_shape", """
SELECT l_orderkey AS id, '[' || string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) || ']' AS lines FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY 1
""")
def snk16(spark, sf):
    from saltmarsh.sources.sinks import export_frame

    l = a.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sort_array(F.collect_set("l_linenumber")).alias("lines"))
    return export_frame(l)


@query("agg04_conditional_by_activity", """
SELECT activity_id, count(*) AS lines, count(DISTINCT CASE WHEN sku_num > 25 THEN order_id END) AS big_orders FROM (
  SELECT l_orderkey AS order_id, CAST(l_quantity AS BIGINT) AS sku_num, activity_id FROM lineitem LEFT JOIN (
    SELECT l_orderkey * 10 + l_linenumber AS aid, min(l_suppkey) AS activity_id FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_orderkey * 10 + l_linenumber = aid) GROUP BY 1
""")
def agg04(spark, sf):
    return f01(spark, sf).groupBy("activity_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct(F.when(F.col("sku_num") > 25, F.col("order_id"))).alias("big_orders")
    )
