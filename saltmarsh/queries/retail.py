"""Shop queries: facts, dimensions, summaries and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from saltmarsh.functions import text
from saltmarsh.functions.dates import latest_date
from saltmarsh.operators.history import apply_changes, build_history, open_history
from saltmarsh.plans import retail_dims as dims
from saltmarsh.plans import retail_facts as facts
from saltmarsh.plans import retail_reports as reports
from saltmarsh.plans import retail_summaries as sums
from saltmarsh.queries import adapters as a
from saltmarsh.queries.fragments import (
    DETAIL, EVENT_DAY, HORIZONS, PAYMENTS, SHOP_DAY, SKU, VIEWS, ratio, with_,
)
from saltmarsh.queries.registry import query
from saltmarsh.session import checkpointed


def _shop_day():
    return a.day(a.SHOP_DAY)


def _event_day():
    return a.day(a.EVENT_DAY)


def _detail(spark, sf):
    return facts.order_detail_fact(a.order_detail(spark, sf), a.order_info(spark, sf), spread=True)


def _paid_detail(spark, sf, spread=False):
    return facts.paid_detail_fact(
        a.order_detail(spark, sf), a.payments(spark, sf), a.order_info(spark, sf), a.dictionary(spark, sf), spread=spread
    )


def _sku_daily(spark, sf):
    return sums.user_sku_order_1d(_detail(spark, sf), a.sku_dim(spark, sf))


# -- facts ------------------------------------------------------------------------


@query("f01_order_detail_fact", with_(DETAIL) + """
, act AS (SELECT l_orderkey * 10 + l_linenumber AS aid, min(l_suppkey) AS activity_id, max(l_suppkey) AS activity_rule_id
          FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
, cou AS (SELECT l_orderkey * 10 + l_linenumber AS cid, min(l_partkey) AS coupon_id
          FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT id, order_id, user_id, sku_id, province_id, activity_id, activity_rule_id, coupon_id, dt,
       CAST(dt AS TIMESTAMP) AS create_time, sku_num, orig AS split_original_amount,
       CAST(act AS DECIMAL(16,2)) AS split_activity_amount, CAST(detail.cou AS DECIMAL(16,2)) AS split_coupon_amount,
       total AS split_total_amount
FROM detail LEFT JOIN act ON id = aid LEFT JOIN cou ON id = cid
""".replace("CAST(act AS", "CAST(detail.act AS"))
def f01(spark, sf):
    return facts.order_detail_fact(
        a.order_detail(spark, sf), a.order_info(spark, sf), a.detail_activity(spark, sf), a.detail_coupon(spark, sf)
    )


@query("f02_favourite_add_fact", """
SELECT event_id AS id, user_id, event_id % 1000 AS sku_id, CAST(ts AS DATE) AS dt, ts AS create_time
FROM events WHERE event_type = 'view'
""")
def f02(spark, sf):
    rows = a.events(spark, sf).filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("id"), "user_id", (F.col("event_id") % 1000).alias("sku_id"), F.col("ts").alias("create_time")
    )
    return facts.favourite_add_fact(rows)


@query("f03_paid_detail_fact", with_(DETAIL, PAYMENTS) + """
SELECT d.id, d.order_id, p.user_id, d.sku_id, d.province_id, p.payment_type AS payment_type_code,
       dic.n AS payment_type_name, CAST(p.callback_time AS DATE) AS dt, p.callback_time, d.sku_num,
       d.orig AS split_original_amount, CAST(d.act AS DECIMAL(16,2)) AS split_activity_amount,
       CAST(d.cou AS DECIMAL(16,2)) AS split_coupon_amount, d.total AS split_total_amount
FROM detail d JOIN payments p ON d.order_id = p.order_id
LEFT JOIN (SELECT DISTINCT substr(o_orderpriority, 1, 1) AS c, o_orderpriority AS n FROM orders) dic ON p.payment_type = dic.c
""")
def f03(spark, sf):
    return _paid_detail(spark, sf)


FLOW = """
flow AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, c_nationkey AS province_id,
         CAST(o_orderdate AS DATE) AS order_date_id, o_orderdate AS order_time,
         coalesce(CAST(p.callback_time AS DATE), DATE '9999-12-31') AS payment_date_id, p.callback_time AS payment_time,
         coalesce(CAST(f.last_ship AS DATE), DATE '9999-12-31') AS finish_date_id, f.last_ship AS finish_time,
         CAST(o_totalprice AS DECIMAL(16,2)) AS order_original_amount, CAST(0 AS DECIMAL(16,2)) AS order_activity_amount,
         CAST(0 AS DECIMAL(16,2)) AS order_coupon_amount, CAST(o_totalprice AS DECIMAL(16,2)) AS order_total_amount,
         coalesce(p.amount, CAST(0 AS DECIMAL(16,2))) AS payment_amount,
         coalesce(CAST(f.last_ship AS DATE), DATE '9999-12-31') AS dt
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN payments p ON p.order_id = o_orderkey
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             WHERE o_orderstatus = 'F' GROUP BY 1) f ON f.l_orderkey = o_orderkey
)"""


def _flow(spark, sf):
    return facts.trade_flow(a.order_info(spark, sf), a.payments(spark, sf), a.status_log(spark, sf))


@query("f04_trade_flow", with_(PAYMENTS, FLOW) + "SELECT * FROM flow")
def f04(spark, sf):
    return _flow(spark, sf)


def _carts(spark, sf):
    return a.table(spark, sf, "lineitem").select(
        a.line_id().alias("id"), F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("sku_id"),
        F.col("l_returnflag").alias("sku_name"), F.col("l_quantity").cast("long").alias("sku_num"),
        F.col("l_shipdate").alias("create_time"), F.when(F.col("l_linestatus") == "F", "1").otherwise("0").alias("is_ordered"),
    )


@query("f05_cart_add_fact", """
SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS user_id, l_partkey AS sku_id, CAST(l_shipdate AS DATE) AS dt,
       l_shipdate AS create_time, CAST(l_quantity AS BIGINT) AS sku_num FROM lineitem
""")
def f05_add(spark, sf):
    return facts.cart_add_fact(_carts(spark, sf))


@query("f05_open_cart_fact", """
SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS user_id, l_partkey AS sku_id, l_returnflag AS sku_name,
       CAST(l_quantity AS BIGINT) AS sku_num FROM lineitem WHERE l_linestatus <> 'F'
""")
def f05_open(spark, sf):
    return facts.open_cart_fact(_carts(spark, sf))


def _coupon_use(spark, sf):
    o = a.table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.substring("o_orderpriority", 1, 1).alias("coupon_id"),
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("used_time"),
    )


@query("f05_coupon_used_fact", """
SELECT o_orderkey AS id, substr(o_orderpriority, 1, 1) AS coupon_id, o_custkey AS user_id, o_orderkey AS order_id,
       CAST(o_orderdate AS DATE) AS dt, o_orderdate AS used_time FROM orders WHERE o_orderstatus <> 'O'
""")
def f05_coupon(spark, sf):
    return facts.coupon_used_fact(_coupon_use(spark, sf))


def _logs(spark, sf):
    """Events as JSON log records; purchases are start records without a page."""
    e = F.col("event_type")
    common = F.struct(
        (F.col("user_id") % 30).cast("string").alias("ar"), F.lit("b").alias("ba"), e.alias("ch"),
        (F.col("event_id") % 2).cast("string").alias("is_new"), F.lit("m").alias("md"),
        F.concat(F.lit("d"), F.col("user_id")).alias("mid"), F.lit("os").alias("os"),
        F.when(F.col("user_id") % 5 != 0, F.col("user_id").cast("string")).alias("uid"), F.lit("v1").alias("vc"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("sid"),
    )
    page = F.struct(
        F.col("props").alias("item"), F.lit("k").alias("item_type"),
        F.when(e == "signup", "register").otherwise(e).alias("page_id"), F.floor("value").alias("during_time"),
    )
    start = F.struct(F.lit("icon").alias("entry"), F.floor("value").alias("loading_time"))
    record = F.struct(
        common.alias("common"), F.when(e != "purchase", page).alias("page"), F.when(e == "purchase", start).alias("start"),
        F.unix_millis("ts").alias("ts"),
    )
    return a.events(spark, sf).select(F.to_json(record).alias("log"))


LOG_VIEWS = """
logviews AS (
  SELECT CAST(user_id % 30 AS VARCHAR) AS province_id, 'b' AS brand, event_type AS channel,
         CAST(event_id % 2 AS VARCHAR) AS is_new, 'm' AS model, 'd' || CAST(user_id AS VARCHAR) AS mid_id,
         'os' AS operate_system, CASE WHEN user_id % 5 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
         'v1' AS version_code,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         props AS page_item, 'k' AS page_item_type, CAST(NULL AS VARCHAR) AS last_page_id,
         CASE event_type WHEN 'signup' THEN 'register' ELSE event_type END AS page_id,
         CAST(NULL AS VARCHAR) AS from_pos_id, CAST(NULL AS VARCHAR) AS from_pos_seq, CAST(NULL AS VARCHAR) AS refer_id,
         CAST(floor(value) AS BIGINT) AS during_time,
         CAST(ts + INTERVAL 8 HOUR AS DATE) AS dt,
         strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS view_time, epoch_us(ts) // 1000 AS ts, event_id
  FROM events WHERE event_type <> 'purchase'
)"""
LOG_COLUMNS = """province_id, brand, channel, is_new, model, mid_id, operate_system, user_id, version_code, session_id,
page_item, page_item_type, last_page_id, page_id, from_pos_id, from_pos_seq, refer_id, during_time, dt, view_time, ts"""


@query("f06_page_view_fact", with_(LOG_VIEWS) + f"SELECT {LOG_COLUMNS} FROM logviews")
def f06(spark, sf):
    return facts.page_view_fact(_logs(spark, sf))


@query("f06_page_view_fact_by_path", with_(LOG_VIEWS) + f"SELECT {LOG_COLUMNS} FROM logviews")
def f06_path(spark, sf):
    return facts.page_view_fact_by_path(_logs(spark, sf))


@query("f07_login_fact", with_(LOG_VIEWS) + """
SELECT user_id, dt, view_time AS login_time, channel, province_id, version_code, mid_id, brand, model, operate_system
FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts, page_id, user_id) AS rn
      FROM logviews WHERE user_id IS NOT NULL) WHERE rn = 1
""")
def f07(spark, sf):
    return facts.login_fact(facts.page_view_fact(_logs(spark, sf)))


@query("f08_register_fact", with_(LOG_VIEWS) + """
, users AS (SELECT user_id AS uid, min(ts) AS create_time FROM events GROUP BY 1)
SELECT CAST(uid AS VARCHAR) AS user_id, CAST(create_time AS DATE) AS dt, create_time, channel, province_id, version_code,
       mid_id, brand, model, operate_system
FROM users LEFT JOIN (SELECT * FROM logviews WHERE page_id = 'register') l ON CAST(uid AS VARCHAR) = l.user_id
""")
def f08(spark, sf):
    users = a.events(spark, sf).groupBy(F.col("user_id").alias("id")).agg(F.min("ts").alias("create_time"))
    return facts.register_fact(users, facts.page_view_fact(_logs(spark, sf)))


# -- dimensions -------------------------------------------------------------------


def _sku_tables(spark, sf):
    p = a.table(spark, sf, "part")
    c1, c2, c3 = F.substring("p_type", 1, 1), F.col("p_type"), F.concat_ws("-", "p_type", "p_size")
    sku = p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        (F.col("p_size") % 2).alias("is_sale"), (F.col("p_partkey") % 100).alias("spu_id"), c3.alias("category3_id"),
        F.col("p_brand").alias("tm_id"),
    )
    spu = p.select((F.col("p_partkey") % 100).alias("id"), F.concat(F.lit("spu "), F.col("p_partkey") % 100).alias("spu_name")).distinct()
    cat3 = p.select(c3.alias("id"), F.lower(c3).alias("name"), c2.alias("category2_id")).distinct()
    cat2 = p.select(c2.alias("id"), F.lower(c2).alias("name"), c1.alias("category1_id")).distinct()
    cat1 = p.select(c1.alias("id"), F.lower(c1).alias("name")).distinct()
    tm = p.select(F.col("p_brand").alias("id"), F.lower("p_brand").alias("tm_name")).distinct()
    l = a.table(spark, sf, "lineitem")
    attrs = l.select(
        F.col("l_partkey").alias("sku_id"), F.col("l_returnflag").alias("attr_id"), F.col("l_linestatus").alias("value_id"),
        F.lower("l_returnflag").alias("attr_name"), F.lower("l_linestatus").alias("value_name"),
    )
    return sku, spu, cat3, cat2, cat1, tm, attrs


@query("d01_sku_dimension", """
WITH attrs AS (SELECT l_partkey AS sku, string_agg(x, ';' ORDER BY x) AS attrs FROM (
    SELECT DISTINCT l_partkey, l_returnflag || ':' || l_linestatus || ':' || lower(l_returnflag) || ':' || lower(l_linestatus) AS x
    FROM lineitem) GROUP BY 1)
SELECT p_partkey AS id, p_name AS sku_name, CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_size % 2 = 1 AS is_sale,
       p_partkey % 100 AS spu_id, 'spu ' || CAST(p_partkey % 100 AS VARCHAR) AS spu_name,
       p_type || '-' || CAST(p_size AS VARCHAR) AS category3_id, lower(p_type || '-' || CAST(p_size AS VARCHAR)) AS category3_name,
       p_type AS category2_id, lower(p_type) AS category2_name, substr(p_type, 1, 1) AS category1_id,
       lower(substr(p_type, 1, 1)) AS category1_name, p_brand AS tm_id, lower(p_brand) AS tm_name, attrs
FROM part LEFT JOIN attrs ON p_partkey = sku
""")
def d01(spark, sf):
    *parts, attrs = _sku_tables(spark, sf)
    out = dims.sku_dimension(*parts, attributes=attrs)
    joined = F.array_join(F.transform("attrs", lambda s: F.concat_ws(":", s["attr_id"], s["value_id"], s["attr_name"], s["value_name"])), ";")
    return out.withColumn("attrs", joined)


@query("d02_activity_dimension", """
WITH rule AS (SELECT p_partkey AS activity_rule_id, p_partkey % 50 AS activity_id,
    CASE p_size % 3 WHEN 0 THEN '3101' WHEN 1 THEN '3102' ELSE '3103' END AS activity_type_code,
    p_size * 10 AS condition_amount, p_size AS condition_num, p_size + 1 AS benefit_amount, p_size % 10 AS benefit_discount FROM part),
info AS (SELECT DISTINCT p_partkey % 50 AS aid, 'act ' || CAST(p_partkey % 50 AS VARCHAR) AS activity_name FROM part)
SELECT activity_rule_id, activity_id, activity_type_code, condition_amount, condition_num, benefit_amount, benefit_discount,
       activity_name, 'act ' || CAST(activity_id AS VARCHAR) || ' text' AS activity_desc, DATE '2001-01-01' AS start_time,
       DATE '2001-12-31' AS end_time, DATE '2000-12-01' AS create_time,
       CASE activity_type_code WHEN '3101' THEN 'full' WHEN '3102' THEN 'number' END AS activity_type_name,
       CASE activity_type_code
         WHEN '3101' THEN '满' || CAST(condition_amount AS VARCHAR) || '元减' || CAST(benefit_amount AS VARCHAR) || '元'
         WHEN '3102' THEN '满' || CAST(condition_num AS VARCHAR) || '件打' || CAST(benefit_discount AS VARCHAR) || ' 折'
         WHEN '3103' THEN '打' || CAST(benefit_discount AS VARCHAR) || '折' END AS benefit_rule
FROM rule JOIN info ON activity_id = aid
""")
def d02_activity(spark, sf):
    p = a.table(spark, sf, "part")
    kind = F.when(F.col("p_size") % 3 == 0, "3101").when(F.col("p_size") % 3 == 1, "3102").otherwise("3103")
    rules = p.select(
        F.col("p_partkey").alias("id"), (F.col("p_partkey") % 50).alias("activity_id"), kind.alias("activity_type"),
        (F.col("p_size") * 10).alias("condition_amount"), F.col("p_size").alias("condition_num"),
        (F.col("p_size") + 1).alias("benefit_amount"), (F.col("p_size") % 10).alias("benefit_discount"),
    )
    info = p.select((F.col("p_partkey") % 50).alias("id")).distinct().select(
        "id", F.concat(F.lit("act "), "id").alias("activity_name"), F.concat(F.lit("act "), "id", F.lit(" text")).alias("activity_desc"),
        a.day("2001-01-01").alias("start_time"), a.day("2001-12-31").alias("end_time"), a.day("2000-12-01").alias("create_time"),
    )
    dic = p.select(kind.alias("dic_code")).distinct().filter(F.col("dic_code") != "3103").select(
        "dic_code", F.when(F.col("dic_code") == "3101", "full").otherwise("number").alias("dic_name"), F.lit("31").alias("parent_code")
    )
    return dims.activity_dimension(rules, info, dic)


@query("d02_coupon_dimension", """
SELECT p_partkey AS id, p_name AS coupon_name, CASE p_size % 3 WHEN 0 THEN '3201' WHEN 1 THEN '3202' ELSE '3203' END AS coupon_type_code,
       CAST(NULL AS VARCHAR) AS coupon_type_name, p_brand AS range_type_code, lower(p_brand) AS range_type_name,
       p_size * 10 AS condition_amount, p_size AS condition_num, p_size + 1 AS benefit_amount, p_size % 10 AS benefit_discount,
       CASE p_size % 3 WHEN 0 THEN '满' || CAST(p_size * 10 AS VARCHAR) || '元减' || CAST(p_size + 1 AS VARCHAR) || '元'
         WHEN 1 THEN '满' || CAST(p_size AS VARCHAR) || '件打' || CAST(p_size % 10 AS VARCHAR) || ' 折'
         ELSE '减' || CAST(p_size + 1 AS VARCHAR) || '元' END AS benefit_rule
FROM part
""")
def d02_coupon(spark, sf):
    p = a.table(spark, sf, "part")
    kind = F.when(F.col("p_size") % 3 == 0, "3201").when(F.col("p_size") % 3 == 1, "3202").otherwise("3203")
    coupons = p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("coupon_name"), kind.alias("coupon_type"),
        F.col("p_brand").alias("range_type"), (F.col("p_size") * 10).alias("condition_amount"),
        F.col("p_size").alias("condition_num"), (F.col("p_size") + 1).alias("benefit_amount"),
        (F.col("p_size") % 10).alias("benefit_discount"),
    )
    return dims.coupon_dimension(coupons, a.dictionary(spark, sf))


@query("d03_province_dimension", """
SELECT n_nationkey AS id, n_name AS province_name, n_regionkey AS region_id, n_name AS iso_code, r_name AS region_name
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
""")
def d03(spark, sf):
    return dims.province_dimension(a.province(spark, sf), a.region(spark, sf))


@query("d03_date_dimension", """
SELECT d AS date_id, CAST(weekofyear(d) AS INTEGER) AS week_id, CAST(isodow(d) AS INTEGER) AS week_day,
       CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(year(d) AS INTEGER) AS year, CASE WHEN isodow(d) <= 5 THEN 'true' ELSE 'false' END AS is_workday,
       coalesce(n, 0) AS order_count
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n FROM orders GROUP BY 1) ON d = od
""")
def d03_date(spark, sf):
    n = a.table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("_d")).agg(F.count(F.lit(1)).alias("order_count"))
    cal = dims.date_dimension(spark, "1995-01-01", "2001-12-31")
    return cal.join(n, F.col("date_id") == F.col("_d"), "left").drop("_d").fillna(0, ["order_count"])


def _users(spark, sf):
    c = a.table(spark, sf, "customer")
    key = F.col("c_custkey")
    phone = F.when(key % 3 == 0, F.concat(F.lit("138"), F.lpad(key.cast("string"), 8, "0"))).when(
        key % 3 == 1, F.concat(F.lit("999"), key))
    mail = F.when(key % 2 == 0, F.concat(F.lit("user"), key, F.lit("@mail.example"))).otherwise(F.concat(F.lit("user"), key))
    return c.select(
        key.alias("id"), F.col("c_name").alias("name"), phone.alias("phone_num"), mail.alias("email"),
        F.col("c_mktsegment").alias("user_level"),
    )


USERS = """
users AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS user_level,
    CASE c_custkey % 3 WHEN 0 THEN '138' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') WHEN 1 THEN '999' || CAST(c_custkey AS VARCHAR) END AS phone_num,
    CASE WHEN c_custkey % 2 = 0 THEN 'user' || CAST(c_custkey AS VARCHAR) || '@mail.example' ELSE 'user' || CAST(c_custkey AS VARCHAR) END AS email
  FROM customer
)"""
PHONE_SQL = r"'^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$'"
EMAIL_SQL = r"'^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$'"


@query("d04_user_history", with_(USERS) + f"""
SELECT id, substr(name, 1, 1) || '*' AS name,
       CASE WHEN regexp_matches(phone_num, {PHONE_SQL}) THEN substr(phone_num, 1, 3) || '*' END AS phone_num,
       CASE WHEN regexp_matches(email, {EMAIL_SQL}) THEN '*@' || split_part(email, '@', 2) END AS email,
       user_level, DATE '2001-07-31' AS start_date, DATE '9999-12-31' AS end_date
FROM users
""")
def d04(spark, sf):
    return dims.user_history(_users(spark, sf), _shop_day())


@query("d04_history_from_changes", """
WITH daily AS (
  SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS d, arg_max(o_orderpriority, o_orderkey) AS level
  FROM orders GROUP BY 1, 2)
SELECT user_id, level, d AS start_date,
       coalesce(CAST(lead(d) OVER (PARTITION BY user_id ORDER BY d) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS end_date
FROM daily
""")
def d04_history(spark, sf):
    """Order priority as a slowly changing attribute of the customer."""
    o = a.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").cast("date").alias("d"),
        F.col("o_orderpriority").alias("level"), F.col("o_orderkey").alias("seq"),
    )
    return build_history(o, ["user_id"], "d", ["seq"]).drop("seq")


APPLIED_SQL = """
WITH chg AS (SELECT o_custkey AS k, arg_max(o_orderpriority, o_orderkey) AS v FROM orders
             WHERE CAST(o_orderdate AS DATE) >= DATE '2001-07-01' GROUP BY 1)
SELECT c_custkey AS user_id, c_mktsegment AS level, DATE '1995-01-01' AS start_date,
       CASE WHEN k IS NULL THEN DATE '9999-12-31' ELSE DATE '2001-07-30' END AS end_date
FROM customer LEFT JOIN chg ON c_custkey = k
UNION ALL SELECT k, v, DATE '2001-07-31', DATE '9999-12-31' FROM chg
"""


@query("d04_history_apply_changes", APPLIED_SQL)
def d04_apply(spark, sf):
    base = a.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("level"))
    history = open_history(base, a.day("1995-01-01"))
    o = a.table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp"))
    changes = o.groupBy(F.col("o_custkey").alias("user_id")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("level"))
    return apply_changes(history, changes, ["user_id"], _shop_day())


@query("d04_history_applied_twice", APPLIED_SQL)
def d04_twice(spark, sf):
    """The last day runs again over its own result, as after a failed job; the table is that of one run."""
    once = checkpointed(d04_apply(spark, sf))
    o = a.table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp"))
    changes = o.groupBy(F.col("o_custkey").alias("user_id")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("level"))
    return apply_changes(once, changes, ["user_id"], _shop_day())


# -- summaries --------------------------------------------------------------------

AMOUNTS = """CAST(sum(orig) AS DECIMAL(16,2)) AS order_original_amount_1d, CAST(sum(act) AS DECIMAL(16,2)) AS activity_reduce_amount_1d,
CAST(sum(cou) AS DECIMAL(16,2)) AS coupon_reduce_amount_1d, CAST(sum(total) AS DECIMAL(16,2)) AS order_total_amount_1d"""

PROVINCE_DAILY = f"""
pd AS (SELECT dt, province_id, count(DISTINCT order_id) AS order_count_1d, {AMOUNTS} FROM detail GROUP BY 1, 2)"""


@query("s01_province_order_1d", with_(DETAIL, PROVINCE_DAILY) + "SELECT pd.*, n_name AS province_name, n_name AS iso_code FROM pd LEFT JOIN nation ON province_id = n_nationkey")
def s01(spark, sf):
    return sums.province_order_1d(_detail(spark, sf), a.province_dim(spark, sf))


def _nd(names: list[str], days: list[int], table_day: str = SHOP_DAY) -> str:
    out = []
    for d in days:
        for n in names:
            kind = "DECIMAL(26,2)" if "amount" in n else "BIGINT"
            out.append(f"CAST(sum(CASE WHEN dt > {table_day} - {d} THEN {n}_1d ELSE 0 END) AS {kind}) AS {n}_{d}d")
    return ",\n".join(out)


ORDER_MEASURES = sums.ORDER_MEASURES


@query("s02_province_order_nd", with_(DETAIL, PROVINCE_DAILY) + f"""
SELECT province_id, n_name AS province_name, n_name AS iso_code, {_nd(ORDER_MEASURES, [7, 30])}
FROM pd LEFT JOIN nation ON province_id = n_nationkey WHERE dt > {SHOP_DAY} - 30 AND dt <= {SHOP_DAY} GROUP BY 1, 2, 3
""")
def s02(spark, sf):
    return sums.province_order_nd(s01(spark, sf), _shop_day())


@query("s03_sku_favourite_1d", with_(SKU) + """
SELECT dt, sku_id, favor_add_count_1d, sku_name, category1_id, category2_id, category3_id, tm_id, tm_name
FROM (SELECT CAST(ts AS DATE) AS dt, event_id % 1000 AS sku_id, count(*) AS favor_add_count_1d FROM events
      WHERE event_type = 'view' GROUP BY 1, 2) LEFT JOIN sku ON sku_id = sku
""")
def s03(spark, sf):
    return sums.sku_favourite_1d(f02(spark, sf), a.sku_dim(spark, sf))


@query("s04_user_coupon_used_1d", """
SELECT CAST(o_orderdate AS DATE) AS dt, o_custkey AS user_id, substr(o_orderpriority, 1, 1) AS coupon_id, count(*) AS used_count_1d,
       max(o_orderpriority) AS coupon_name
FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1, 2, 3
""")
def s04(spark, sf):
    names = a.dictionary(spark, sf).filter(F.col("parent_code") == "11").select(
        F.col("dic_code").alias("id"), F.col("dic_name").alias("coupon_name")
    )
    return sums.user_coupon_used_1d(f05_coupon(spark, sf), names)


@query("s05_user_cart_add_1d", """
SELECT CAST(l_shipdate AS DATE) AS dt, l_suppkey AS user_id, count(*) AS cart_add_count_1d,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS cart_add_num_1d FROM lineitem GROUP BY 1, 2
""")
def s05(spark, sf):
    return sums.user_cart_add_1d(f05_add(spark, sf))


USER_DAILY = f"""
ud AS (SELECT dt, user_id, count(DISTINCT order_id) AS order_count_1d, CAST(sum(sku_num) AS BIGINT) AS order_num_1d, {AMOUNTS}
       FROM detail GROUP BY 1, 2)"""


@query("s06_user_order_1d", with_(DETAIL, USER_DAILY) + "SELECT * FROM ud")
def s06(spark, sf):
    return sums.user_order_1d(_detail(spark, sf))


TO_DATE = """
td AS (SELECT user_id, min(dt) AS order_date_first, max(dt) AS order_date_last, CAST(sum(order_count_1d) AS BIGINT) AS order_count_td,
  CAST(sum(order_num_1d) AS BIGINT) AS order_num_td, CAST(sum(order_original_amount_1d) AS DECIMAL(26,2)) AS original_amount_td,
  CAST(sum(activity_reduce_amount_1d) AS DECIMAL(26,2)) AS activity_reduce_amount_td,
  CAST(sum(coupon_reduce_amount_1d) AS DECIMAL(26,2)) AS coupon_reduce_amount_td,
  CAST(sum(order_total_amount_1d) AS DECIMAL(26,2)) AS total_amount_td FROM ud GROUP BY 1)"""


@query("s07_user_order_td", with_(DETAIL, USER_DAILY, TO_DATE) + "SELECT * FROM td")
def s07(spark, sf):
    return sums.user_order_td(s06(spark, sf))


@query("s08_user_payment_1d", with_(DETAIL, PAYMENTS) + """
SELECT CAST(p.callback_time AS DATE) AS dt, p.user_id, count(DISTINCT p.order_id) AS payment_count_1d,
       CAST(sum(sku_num) AS BIGINT) AS payment_num_1d, CAST(sum(total) AS DECIMAL(16,2)) AS payment_amount_1d
FROM detail d JOIN payments p ON d.order_id = p.order_id GROUP BY 1, 2
""")
def s08(spark, sf):
    return sums.user_payment_1d(_paid_detail(spark, sf, spread=True))


USER_SKU_DAILY = f"""
us AS (SELECT dt, user_id, sku_id, count(*) AS order_count_1d, CAST(sum(sku_num) AS BIGINT) AS order_num_1d, {AMOUNTS}
       FROM detail GROUP BY 1, 2, 3),
usk AS (SELECT us.*, sku_name, category1_id, category2_id, category3_id, tm_id, tm_name FROM us LEFT JOIN sku ON sku_id = sku)"""


@query("s09_user_sku_order_1d", with_(DETAIL, SKU, USER_SKU_DAILY) + "SELECT * FROM usk")
def s09(spark, sf):
    return _sku_daily(spark, sf)


@query("s10_user_sku_order_nd", with_(DETAIL, SKU, USER_SKU_DAILY) + f"""
SELECT user_id, sku_id, sku_name, category1_id, category2_id, category3_id, tm_id, tm_name,
{_nd(["order_count", "order_num", *ORDER_MEASURES[1:]], [7, 30])}
FROM usk WHERE dt > {SHOP_DAY} - 30 AND dt <= {SHOP_DAY} GROUP BY ALL
""")
def s10(spark, sf):
    return sums.user_sku_order_nd(_sku_daily(spark, sf), _shop_day())


@query("s11_device_page_view_1d", with_(VIEWS) + """
SELECT dt, mid_id, page_id, CAST(sum(during_time) AS DECIMAL(26,2)) AS during_time_1d, count(*) AS view_count_1d FROM views GROUP BY 1, 2, 3
""")
def s11(spark, sf):
    return sums.device_page_view_1d(a.page_views(spark, sf))


SESSIONS = """
sessions AS (SELECT dt, session_id, mid_id, channel, CAST(sum(during_time) AS DECIMAL(26,2)) AS during_time_1d, count(*) AS page_count_1d
             FROM views GROUP BY 1, 2, 3, 4)"""


@query("s12_session_page_view_1d", with_(VIEWS, SESSIONS) + "SELECT * FROM sessions")
def s12(spark, sf):
    return sums.session_page_view_1d(a.page_views(spark, sf))


def _login_users(spark, sf):
    """Customers below the event users' range and beyond it, so some never logged in."""
    return a.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 30).cast("int")).alias("create_time")
    )


LOGIN = """
logins AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS dt FROM events),
ltd AS (SELECT c_custkey AS user_id, coalesce(l.d, DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER)) AS login_date_last,
        DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS login_date_first, coalesce(l.n, 1) AS login_count_td
        FROM customer LEFT JOIN (SELECT user_id, max(dt) AS d, count(*) AS n FROM logins GROUP BY 1) l ON c_custkey = l.user_id)"""


@query("s13_user_login_td", with_(LOGIN) + "SELECT * FROM ltd")
def s13(spark, sf):
    return sums.user_login_td(_login_users(spark, sf), a.user_days(spark, sf).distinct())


# -- reports ----------------------------------------------------------------------


@query("m01_coupon_stats", f"""
SELECT {SHOP_DAY} AS dt, substr(o_orderpriority, 1, 1) AS coupon_id, max(o_orderpriority) AS coupon_name, count(*) AS used_count,
       count(DISTINCT o_custkey) AS used_user_count
FROM orders WHERE o_orderstatus <> 'O' AND CAST(o_orderdate AS DATE) = {SHOP_DAY} GROUP BY 2
""")
def m01(spark, sf):
    return reports.coupon_stats(s04(spark, sf), _shop_day())


@query("m02_new_order_users", with_(DETAIL, USER_DAILY, TO_DATE) + f"""
SELECT {SHOP_DAY} AS dt, recent_days, count(CASE WHEN order_date_first > {SHOP_DAY} - recent_days AND order_date_first <= {SHOP_DAY} THEN 1 END) AS new_order_user_count
FROM td CROSS JOIN {HORIZONS} GROUP BY recent_days
""")
def m02(spark, sf):
    return reports.new_order_users(s07(spark, sf), _shop_day())


@query("m03_orders_by_province", with_(DETAIL, PROVINCE_DAILY) + f"""
SELECT {SHOP_DAY} AS dt, recent_days, province_id, n_name AS province_name, n_name AS iso_code,
       CAST(sum(CASE WHEN dt > {SHOP_DAY} - recent_days THEN order_count_1d ELSE 0 END) AS BIGINT) AS order_count,
       CAST(sum(CASE WHEN dt > {SHOP_DAY} - recent_days THEN order_total_amount_1d ELSE 0 END) AS DECIMAL(26,2)) AS order_total_amount
FROM pd LEFT JOIN nation ON province_id = n_nationkey CROSS JOIN {HORIZONS}
WHERE pd.dt > {SHOP_DAY} - 30 AND pd.dt <= {SHOP_DAY}
GROUP BY recent_days, province_id, n_name
HAVING recent_days > 1 OR sum(CASE WHEN dt > {SHOP_DAY} - recent_days THEN 1 ELSE 0 END) > 0
""".replace("THEN order_count_1d", "THEN order_count_1d").replace("WHEN dt >", "WHEN pd.dt >"))
def m03(spark, sf):
    return reports.orders_by_province(s01(spark, sf), _shop_day())


DAYS7 = f"""
days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events
         WHERE event_type = 'purchase' AND CAST(ts AS DATE) > {EVENT_DAY} - 7 AND CAST(ts AS DATE) <= {EVENT_DAY})"""


def _streak(method):
    def run(spark, sf):
        return reports.consecutive_order_users(a.user_days(spark, sf, "purchase"), _event_day(), method)

    return run


STREAK_SQL = with_(DAYS7) + """
SELECT DATE '2024-01-30' AS dt, 7 AS recent_days, count(DISTINCT x.user_id) AS order_continuously_user_count
FROM days x JOIN days y ON x.user_id = y.user_id AND y.d = x.d + 1 JOIN days z ON x.user_id = z.user_id AND z.d = x.d + 2
"""
query("m04_consecutive_users_lead", STREAK_SQL)(_streak("lead"))
query("m05_consecutive_users_islands", STREAK_SQL)(_streak("islands"))
query("m06_consecutive_users_bitmap", STREAK_SQL)(_streak("bitmap"))
query("m07_near_consecutive_users", with_(DAYS7) + """
SELECT DATE '2024-01-30' AS dt, 7 AS recent_days, count(DISTINCT user_id) AS order_continuously_user_count
FROM (SELECT user_id, lead(d, 2) OVER (PARTITION BY user_id ORDER BY d) - d AS gap FROM days) WHERE gap <= 3
""")(_streak("near"))


@query("m04_consecutive_users_all", with_(DAYS7) + """
, n AS (SELECT count(DISTINCT x.user_id) AS c FROM days x JOIN days y ON x.user_id = y.user_id AND y.d = x.d + 1
        JOIN days z ON x.user_id = z.user_id AND z.d = x.d + 2),
near AS (SELECT count(DISTINCT user_id) AS c FROM (SELECT user_id, lead(d, 2) OVER (PARTITION BY user_id ORDER BY d) - d AS gap FROM days) WHERE gap <= 3)
SELECT DATE '2024-01-30' AS dt, 7 AS recent_days, c AS order_continuously_user_count, m AS method
FROM (SELECT c, unnest(['lead', 'islands', 'bitmap']) AS m FROM n UNION ALL SELECT c, 'near' FROM near)
""")
def m04_all(spark, sf):
    return reports.consecutive_order_users_all(a.user_days(spark, sf, "purchase"), _event_day())


def _by(keys: str) -> str:
    return f"""
SELECT {SHOP_DAY} AS dt, recent_days, {keys},
       CAST(sum(CASE WHEN usk.dt > {SHOP_DAY} - recent_days THEN order_count_1d ELSE 0 END) AS BIGINT) AS order_count,
       count(DISTINCT CASE WHEN usk.dt > {SHOP_DAY} - recent_days THEN user_id END) AS order_user_count
FROM usk CROSS JOIN {HORIZONS} WHERE usk.dt > {SHOP_DAY} - 30 AND usk.dt <= {SHOP_DAY}
GROUP BY recent_days, {keys} HAVING recent_days > 1 OR sum(CASE WHEN usk.dt > {SHOP_DAY} - recent_days THEN 1 ELSE 0 END) > 0
"""


@query("m08_order_stats_by_category", with_(DETAIL, SKU, USER_SKU_DAILY) + _by("category1_id, category2_id, category3_id"))
def m08(spark, sf):
    return reports.order_stats_by_category(_sku_daily(spark, sf), _shop_day())


@query("m09_order_stats_by_brand", with_(DETAIL, SKU, USER_SKU_DAILY) + _by("tm_id, tm_name"))
def m09(spark, sf):
    return reports.order_stats_by_brand(_sku_daily(spark, sf), _shop_day())


@query("m10_order_to_pay_seconds", with_(PAYMENTS, FLOW) + f"""
SELECT {SHOP_DAY} AS dt, CAST(trunc(avg(epoch(payment_time) - epoch(order_time))) AS BIGINT) AS order_to_pay_interval_avg
FROM flow WHERE payment_date_id <= {SHOP_DAY}
""")
def m10(spark, sf):
    return reports.order_to_pay_seconds(_flow(spark, sf), _shop_day())


@query("m11_page_path", with_(VIEWS) + """
, steps AS (SELECT page_id, lead(page_id) OVER w AS nxt, row_number() OVER w AS rn FROM views WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id))
SELECT 'step-' || CAST(rn AS VARCHAR) || ':' || page_id AS source,
       coalesce('step-' || CAST(rn + 1 AS VARCHAR) || ':' || nxt, 'null') AS target, count(*) AS path_count
FROM steps GROUP BY 1, 2
""")
def m11(spark, sf):
    return reports.page_path(a.page_views(spark, sf), ["ts", "event_id"], "ts")


@query("m12_repeat_purchase_by_brand", with_(DETAIL, SKU, USER_SKU_DAILY) + f"""
, pu AS (SELECT tm_id, tm_name, user_id, sum(order_count_1d) AS n FROM usk WHERE dt > {SHOP_DAY} - 30 AND dt <= {SHOP_DAY} GROUP BY 1, 2, 3)
SELECT {SHOP_DAY} AS dt, 30 AS recent_days, tm_id, tm_name,
       CAST({ratio("count(CASE WHEN n >= 2 THEN 1 END)", "count(CASE WHEN n >= 1 THEN 1 END)")} AS DECIMAL(16,2)) AS order_repeat_rate
FROM pu GROUP BY tm_id, tm_name
""")
def m12(spark, sf):
    return reports.repeat_purchase_by_brand(_sku_daily(spark, sf), _shop_day())


@query("m13_top_cart_skus_by_category", with_(SKU) + """
, c AS (SELECT l_partkey AS sku_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS cart_num FROM lineitem WHERE l_linestatus <> 'F' GROUP BY 1)
SELECT sku_id, cart_num, category1_id, category2_id, category3_id, sku_name, rk FROM (
  SELECT c.*, sku.*, CAST(rank() OVER (PARTITION BY category1_id, category2_id, category3_id ORDER BY cart_num DESC) AS INTEGER) AS rk
  FROM c LEFT JOIN sku ON sku_id = sku) WHERE rk <= 3
""")
def m13(spark, sf):
    return reports.top_cart_skus_by_category(f05_open(spark, sf), a.sku_dim(spark, sf))


@query("m14_top_favourite_skus_by_brand", with_(SKU) + f"""
, f AS (SELECT event_id % 1000 AS sku_id, count(*) AS favor_add_count_1d FROM events
        WHERE event_type = 'view' AND CAST(ts AS DATE) = {EVENT_DAY} GROUP BY 1)
SELECT tm_id, tm_name, sku_id, sku_name, favor_add_count_1d, rk FROM (
  SELECT *, CAST(rank() OVER (PARTITION BY tm_id ORDER BY favor_add_count_1d DESC) AS INTEGER) AS rk FROM f LEFT JOIN sku ON sku_id = sku) WHERE rk <= 3
""")
def m14(spark, sf):
    return reports.top_favourite_skus_by_brand(s03(spark, sf), _event_day())


@query("m15_traffic_by_channel", with_(VIEWS, SESSIONS) + f"""
SELECT {EVENT_DAY} AS dt, recent_days, channel, count(DISTINCT mid_id) AS uv_count,
       CAST(trunc(CAST(sum(during_time_1d) AS DOUBLE) / count(*)) AS BIGINT) AS avg_duration_sec,
       CAST(sum(page_count_1d) // count(*) AS BIGINT) AS avg_page_count, count(*) AS sv_count,
       CAST({ratio("count(CASE WHEN page_count_1d = 1 THEN 1 END)", "count(*)")} AS DECIMAL(16,2)) AS bounce_rate
FROM sessions CROSS JOIN {HORIZONS} WHERE sessions.dt > {EVENT_DAY} - recent_days AND sessions.dt <= {EVENT_DAY} GROUP BY recent_days, channel
""")
def m15(spark, sf):
    return reports.traffic_by_channel(s12(spark, sf), _event_day(), millis=False)


@query("m16_user_actions", f"""
SELECT {EVENT_DAY} AS dt,
  (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events WHERE CAST(ts AS DATE) = {EVENT_DAY} AND event_type = 'view')) AS home_count,
  (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events WHERE CAST(ts AS DATE) = {EVENT_DAY} AND event_type = 'click')) AS good_detail_count,
  (SELECT count(DISTINCT user_id) FROM events WHERE CAST(ts AS DATE) = {EVENT_DAY} AND event_type = 'signup') AS cart_count,
  (SELECT count(DISTINCT user_id) FROM events WHERE CAST(ts AS DATE) = {EVENT_DAY} AND event_type = 'purchase') AS order_count,
  (SELECT count(DISTINCT user_id) FROM events WHERE CAST(ts AS DATE) = {EVENT_DAY} AND event_type = 'error') AS payment_count
""")
def m16(spark, sf):
    pages = s11(spark, sf).withColumn(
        "page_id", F.when(F.col("page_id") == "view", "home").when(F.col("page_id") == "click", "good_detail")
    )

    def daily(kind):
        return a.user_days(spark, sf, kind).groupBy("dt", "user_id").agg(F.count(F.lit(1)).alias("n"))

    return reports.user_actions(pages, daily("signup"), daily("purchase"), daily("error"), _event_day())


@query("m17_user_change", with_(LOGIN) + f"""
, u AS (SELECT user_id, max(dt) AS l, max(CASE WHEN dt < {EVENT_DAY} THEN dt END) AS p FROM logins WHERE dt <= {EVENT_DAY} GROUP BY 1)
SELECT {EVENT_DAY} AS dt, count(CASE WHEN l = {EVENT_DAY} - 7 THEN 1 END) AS user_churn_count,
       count(CASE WHEN l = {EVENT_DAY} AND l - p >= 8 THEN 1 END) AS user_back_count FROM u
""")
def m17(spark, sf):
    return reports.user_change(a.user_days(spark, sf), _event_day())


PURCHASE_TD = """
td AS (SELECT user_id, max(CAST(ts AS DATE)) AS l FROM events WHERE event_type = 'purchase' GROUP BY 1),
yd AS (SELECT user_id, max(CAST(ts AS DATE)) AS l FROM events WHERE event_type = 'purchase' AND CAST(ts AS DATE) < DATE '2024-01-30' GROUP BY 1)"""


@query("m17_user_change_from_snapshots", with_(PURCHASE_TD) + f"""
SELECT {EVENT_DAY} AS dt, (SELECT count(*) FROM td WHERE l = {EVENT_DAY} - 7) AS user_churn_count,
       (SELECT count(*) FROM td JOIN yd USING (user_id) WHERE td.l = {EVENT_DAY} AND td.l - yd.l >= 8) AS user_back_count
""")
def m17_snap(spark, sf):
    days = a.user_days(spark, sf, "purchase")
    last = F.max("dt").alias("login_date_last")
    today = days.groupBy("user_id").agg(last)
    yesterday = days.filter(F.col("dt") < _event_day()).groupBy("user_id").agg(last)
    return reports.user_change_from_snapshots(today, yesterday, _event_day())


@query("m18_user_retention", with_(LOGIN) + f"""
SELECT {EVENT_DAY} AS dt, login_date_first AS create_date, CAST({EVENT_DAY} - login_date_first AS INTEGER) AS retention_day,
       count(CASE WHEN login_date_last = {EVENT_DAY} THEN 1 END) AS retention_count, count(*) AS new_user_count,
       CAST({ratio(f"count(CASE WHEN login_date_last = {EVENT_DAY} THEN 1 END) * 100", "count(*)")} AS DECIMAL(16,2)) AS retention_rate
FROM ltd WHERE login_date_first >= {EVENT_DAY} - 7 AND login_date_first < {EVENT_DAY} GROUP BY login_date_first
""")
def m18(spark, sf):
    return reports.user_retention(s13(spark, sf), _event_day())


@query("m19_user_stats", with_(LOGIN) + f"""
SELECT {EVENT_DAY} AS dt, recent_days,
  count(CASE WHEN login_date_first > {EVENT_DAY} - recent_days AND login_date_first <= {EVENT_DAY} THEN 1 END) AS new_user_count,
  count(*) AS active_user_count
FROM ltd CROSS JOIN {HORIZONS} WHERE login_date_last > {EVENT_DAY} - recent_days AND login_date_last <= {EVENT_DAY} GROUP BY recent_days
""")
def m19(spark, sf):
    return reports.user_stats(s13(spark, sf), _event_day())


@query("m02_new_order_users_latest_day", with_(DETAIL, USER_DAILY, TO_DATE) + f"""
, x AS (SELECT max(CAST(l_shipdate AS DATE)) AS d FROM lineitem)
SELECT (SELECT d FROM x) AS dt, recent_days,
  count(CASE WHEN order_date_first > (SELECT d FROM x) - recent_days THEN 1 END) AS new_order_user_count
FROM td CROSS JOIN {HORIZONS} GROUP BY recent_days
""")
def m02_latest(spark, sf):
    """The same with the report day taken from the data by a scalar sub-query."""
    return reports.new_order_users(s07(spark, sf), latest_date(a.table(spark, sf, "lineitem"), "l_shipdate"))


@query("str02_masking_of_documents", r"""
SELECT doc_id, substr(text, 1, 1) || '*' AS name,
       CASE WHEN regexp_matches(mail, '^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$') THEN '*@' || split_part(mail, '@', 2) END AS email,
       CASE WHEN mail <> '' THEN md5(mail) END AS mail_id
FROM (SELECT doc_id, text, regexp_extract(text, '[A-Za-z0-9_.-]+@[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)+') AS mail FROM documents)
""")
def str02(spark, sf):
    d = a.table(spark, sf, "documents").withColumn("mail", F.regexp_extract("text", r"[A-Za-z0-9_.-]+@[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)+", 0))
    return d.select(
        "doc_id", text.mask_name(F.col("text")).alias("name"), text.mask_email(F.col("mail")).alias("email"),
        text.pseudonym(F.col("mail"), "^.+$").alias("mail_id"),
    )
