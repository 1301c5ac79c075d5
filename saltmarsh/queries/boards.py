"""Dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from saltmarsh.operators import quality
from saltmarsh.operators.relations import with_group_mean
from saltmarsh.plans import boards as b
from saltmarsh.queries import adapters as a
from saltmarsh.queries.fragments import BEHAVIOUR, EVENT_DAY, percent, with_
from saltmarsh.queries.registry import query


def _day():
    return a.day(a.EVENT_DAY)


# -- product efficiency: lines shipped as views, returned as collects, open as carts ----


def _views(spark, sf):
    l = a.table(spark, sf, "lineitem")
    return b.view_fact(l.select(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("user_id"), F.col("l_shipdate").alias("visit_time"),
        F.lit("app").alias("platform"),
    ))


def _collects(spark, sf):
    l = a.table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    return b.collect_fact(l.select(
        (F.col("l_partkey") + 7).alias("product_id"), F.col("l_suppkey").alias("user_id"), F.col("l_shipdate").alias("collect_time")
    ))


def _carts(spark, sf):
    l = a.table(spark, sf, "lineitem").filter(F.col("l_linestatus") == "O")
    return b.cart_fact(l.select(
        (F.col("l_partkey") + 11).alias("product_id"), F.col("l_suppkey").alias("user_id"), F.col("l_shipdate").alias("add_time"),
        F.col("l_quantity").alias("quantity"),
    ))


def _orders(spark, sf, paid_code=0):
    l = a.table(spark, sf, "lineitem")
    return b.order_fact(l.select(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("user_id"), F.col("l_shipdate").alias("order_time"),
        F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("amount"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("is_paid"),
    ), paid_code)


@query("w01_order_fact", """
SELECT l_partkey AS product_id, l_suppkey AS user_id, CAST(l_shipdate AS DATE) AS dt, CAST(l_quantity AS BIGINT) AS quantity,
  CAST(l_tax AS DECIMAL(16,2)) AS amount, CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS paid_quantity,
  CAST(CASE WHEN l_linestatus = 'F' THEN l_tax ELSE 0 END AS DECIMAL(16,2)) AS paid_amount,
  CASE WHEN l_linestatus = 'F' THEN l_suppkey END AS paid_user_id FROM lineitem
""")
def w01(spark, sf):
    return _orders(spark, sf)


@query("w01_view_fact", """
SELECT l_partkey AS product_id, l_suppkey AS user_id, CAST(l_shipdate AS DATE) AS dt, 'app' AS platform FROM lineitem
""")
def w01_view(spark, sf):
    return _views(spark, sf)


@query("w01_collect_fact", """
SELECT l_partkey + 7 AS product_id, l_suppkey AS user_id, CAST(l_shipdate AS DATE) AS dt FROM lineitem WHERE l_returnflag = 'R'
""")
def w01_collect(spark, sf):
    return _collects(spark, sf)


@query("w01_cart_fact", """
SELECT l_partkey + 11 AS product_id, l_suppkey AS user_id, CAST(l_shipdate AS DATE) AS dt, CAST(l_quantity AS BIGINT) AS cart_quantity
FROM lineitem WHERE l_linestatus = 'O'
""")
def w01_cart(spark, sf):
    return _carts(spark, sf)


def _products(spark, sf):
    p = a.table(spark, sf, "part")
    return b.product_dimension(p.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category_name"),
        F.when(F.col("p_size") > 5, F.col("p_brand")).alias("brand"), (F.col("p_retailprice") / 4).alias("price"),
    ))


@query("w01_product_dimension", """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category_name, CASE WHEN p_size > 5 THEN p_brand ELSE '' END AS brand,
       CAST(floor(p_retailprice * 100) AS BIGINT) AS price_cents FROM part
""")
def w01_product(spark, sf):
    cents = a.table(spark, sf, "part").select(F.col("p_partkey").alias("_p"), F.floor(F.col("p_retailprice") * 100).alias("price_cents"))
    return _products(spark, sf).drop("price").join(cents, F.col("product_id") == F.col("_p")).drop("_p")


@query("w01_category_dimension", """
SELECT category_name, '0' AS parent_id, 1 AS level, 1 AS is_leaf FROM (SELECT DISTINCT p_type AS category_name FROM part)
""")
def w01_category(spark, sf):
    return b.category_dimension(_products(spark, sf)).drop("category_id")


@query("w01_category_ids", """
SELECT md5(category_name) AS category_id, category_name, '0' AS parent_id, 1 AS level, 1 AS is_leaf FROM (SELECT DISTINCT p_type AS category_name FROM part)
""")
def w01_category_ids(spark, sf):
    """The whole dimension; the SQL of the query above has no id."""
    return b.category_dimension(_products(spark, sf))


EFFICIENCY = """
eff AS (
  SELECT product_id, coalesce(view_count, 0) AS view_count, coalesce(visitor_count, 0) AS visitor_count, coalesce(collect_count, 0) AS collect_count,
    coalesce(cart_quantity, 0) AS cart_quantity, coalesce(cart_user_count, 0) AS cart_user_count, coalesce(order_quantity, 0) AS order_quantity,
    coalesce(order_amount, 0) AS order_amount, coalesce(order_user_count, 0) AS order_user_count, coalesce(paid_quantity, 0) AS paid_quantity,
    coalesce(paid_amount, 0) AS paid_amount, coalesce(paid_user_count, 0) AS paid_user_count
  FROM (SELECT l_partkey AS product_id, count(*) AS view_count, count(DISTINCT l_suppkey) AS visitor_count,
          CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS order_quantity, CAST(sum(CAST(l_tax AS DECIMAL(16,2))) AS DECIMAL(18,2)) AS order_amount,
          count(DISTINCT l_suppkey) AS order_user_count,
          CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS paid_quantity,
          CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_tax AS DECIMAL(16,2)) ELSE 0 END) AS DECIMAL(18,2)) AS paid_amount,
          count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_suppkey END) AS paid_user_count FROM lineitem GROUP BY 1) v
  FULL JOIN (SELECT l_partkey + 7 AS product_id, count(DISTINCT l_suppkey) AS collect_count FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) c USING (product_id)
  FULL JOIN (SELECT l_partkey + 11 AS product_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS cart_quantity, count(DISTINCT l_suppkey) AS cart_user_count
             FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) k USING (product_id)
)"""


def _efficiency(spark, sf):
    return b.product_efficiency(_views(spark, sf), _collects(spark, sf), _carts(spark, sf), _orders(spark, sf))


@query("w02_product_efficiency", with_(EFFICIENCY) + "SELECT * FROM eff")
def w02(spark, sf):
    return _efficiency(spark, sf)


def _priced(spark, sf):
    """Products with a whole-number price, so both engines agree on the cast."""
    return a.table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category_name"),
        (F.col("p_size") * 12).cast("decimal(10,2)").alias("price"),
    )


RANGES = """
rng AS (
  SELECT category_name, price_range, quantity_range, amount_range, count(*) AS product_count, CAST(sum(paid_amount) AS DECIMAL(18,2)) AS paid_amount,
    CAST(sum(paid_quantity) AS BIGINT) AS paid_quantity,
    CAST(CASE WHEN sum(paid_quantity) > 0 THEN round(CAST(sum(paid_amount) AS DOUBLE) / CAST(sum(paid_quantity) AS DOUBLE), 2) ELSE 0 END AS DECIMAL(18,2)) AS avg_price
  FROM (SELECT p_type AS category_name, paid_amount, paid_quantity,
    CASE WHEN p_size * 12 <= 50 THEN '0-50元' WHEN p_size * 12 <= 100 THEN '51-100元' WHEN p_size * 12 <= 200 THEN '101-200元' WHEN p_size * 12 <= 500 THEN '201-500元' ELSE '500元以上' END AS price_range,
    CASE WHEN paid_quantity <= 50 THEN '0-50件' WHEN paid_quantity <= 100 THEN '51-100件' WHEN paid_quantity <= 150 THEN '101-150件' WHEN paid_quantity <= 300 THEN '151-300件' ELSE '300件以上' END AS quantity_range,
    CASE WHEN paid_amount <= 1000 THEN '0-1000元' WHEN paid_amount <= 3000 THEN '1001-3000元' WHEN paid_amount <= 5000 THEN '3001-5000元' WHEN paid_amount <= 10000 THEN '5001-10000元' ELSE '10000元以上' END AS amount_range
    FROM eff LEFT JOIN part ON product_id = p_partkey) GROUP BY 1, 2, 3, 4
)"""


def _ranges(spark, sf):
    return b.range_analysis(_efficiency(spark, sf), _priced(spark, sf))


@query("w03_range_analysis", with_(EFFICIENCY, RANGES) + "SELECT * FROM rng")
def w03(spark, sf):
    return _ranges(spark, sf)


@query("w04_efficiency_monitor", with_(EFFICIENCY) + """
SELECT CAST(sum(view_count) AS BIGINT) AS view_count, CAST(sum(visitor_count) AS BIGINT) AS visitor_count, CAST(sum(collect_count) AS BIGINT) AS collect_count,
 CAST(sum(cart_quantity) AS BIGINT) AS cart_quantity, CAST(sum(cart_user_count) AS BIGINT) AS cart_user_count, CAST(sum(order_quantity) AS BIGINT) AS order_quantity,
 CAST(sum(order_amount) AS DECIMAL(18,2)) AS order_amount, CAST(sum(order_user_count) AS BIGINT) AS order_user_count, CAST(sum(paid_quantity) AS BIGINT) AS paid_quantity,
 CAST(sum(paid_amount) AS DECIMAL(18,2)) AS paid_amount, CAST(sum(paid_user_count) AS BIGINT) AS paid_user_count,
 CASE WHEN sum(visitor_count) > 0 THEN round(CAST(sum(paid_user_count) AS DOUBLE) / CAST(sum(visitor_count) AS DOUBLE), 4) ELSE 0.0 END AS conversion_rate FROM eff
""")
def w04(spark, sf):
    return b.efficiency_monitor(_efficiency(spark, sf))


@query("w04_range_report", with_(EFFICIENCY, RANGES) + """
SELECT category_name, product_count, paid_amount, paid_quantity, avg_price, '价格' AS range_type, price_range AS range_value, CAST(avg_price AS VARCHAR) AS sort_metric FROM rng
UNION ALL SELECT category_name, product_count, paid_amount, paid_quantity, avg_price, '件数', quantity_range, CAST(paid_quantity AS VARCHAR) FROM rng
UNION ALL SELECT category_name, product_count, paid_amount, paid_quantity, avg_price, '金额', amount_range, CAST(paid_amount AS VARCHAR) FROM rng
""")
def w04_ranges(spark, sf):
    return b.range_report(_ranges(spark, sf))


# -- shop day: lines as sales, events as visits and searches ----------------------------


def _catalogue(spark, sf):
    return a.table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category_id"),
        (F.col("p_size") * 10).alias("stock_num"),
    )


def _categories(spark, sf):
    return a.table(spark, sf, "part").select(F.col("p_type").alias("category_id"), F.lower("p_type").alias("category_name")).distinct()


def _visits(spark, sf):
    e = a.events(spark, sf).filter(F.col("event_type").isin("view", "click"))
    visits = e.select(
        "user_id", (F.col("event_id") % 150).alias("product_id"), F.date_trunc("hour", "ts").alias("visit_time"),
        F.concat(F.lit("src"), F.col("user_id") % 4).alias("visit_source"),
    )
    sources = a.table(spark, sf, "region").select(
        F.concat(F.lit("src"), F.col("r_regionkey")).alias("source_name"), F.lower("r_name").alias("source_type")
    ).filter(F.col("source_name") != "src3")
    return b.visit_detail(visits, _catalogue(spark, sf), sources)


def _sales(spark, sf):
    e = a.events(spark, sf).filter(F.col("event_type").isin("purchase", "signup"))
    sales = e.select(
        F.floor(F.col("event_id") / 3).alias("order_id"), (F.col("event_id") % 150).alias("product_id"), (F.col("event_id") % 7).alias("sku_id"),
        "user_id", F.floor("value").cast("decimal(16,2)").alias("pay_amount"), (F.col("event_id") % 5).alias("pay_num"), F.col("ts").alias("pay_time"),
    ).join(_catalogue(spark, sf).select("product_id", "category_id"), "product_id", "left")
    return b.sale_detail(sales, _categories(spark, sf))


def _searches(spark, sf):
    e = a.events(spark, sf).filter(F.col("event_type") == "error")
    rows = e.select(
        "user_id", F.concat(F.lit(" word"), F.col("event_id") % 40, F.lit(" ")).alias("search_word"),
        (F.col("event_id") % 150).alias("product_id"), F.date_trunc("hour", "ts").alias("search_time"),
    )
    return b.search_detail(rows, _catalogue(spark, sf), _categories(spark, sf))


VISITS = """
vis AS (
  SELECT user_id, product_id, p_type AS category_id, visit_time, md5(s.source_name) AS source_id, s.source_name, s.source_type, 60 AS stay_time,
         CAST(visit_time AS DATE) AS dt
  FROM (SELECT user_id, event_id % 150 AS product_id, date_trunc('hour', ts) AS visit_time, min('src' || CAST(user_id % 4 AS VARCHAR)) AS src
        FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2, 3)
  JOIN part ON product_id = p_partkey
  LEFT JOIN (SELECT 'src' || CAST(r_regionkey AS VARCHAR) AS source_name, lower(r_name) AS source_type FROM region WHERE r_regionkey <> 3) s ON src = s.source_name
)"""
SALES = """
sal AS (
  SELECT order_id, product_id, sku_id, user_id, pay_amount, pay_num, pay_time, p_type AS category_id, lower(p_type) AS category_name, CAST(pay_time AS DATE) AS dt
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, sku_id ORDER BY pay_time, pay_amount, product_id) AS rn
    FROM (SELECT event_id // 3 AS order_id, event_id % 150 AS product_id, event_id % 7 AS sku_id, user_id,
          CAST(floor(value) AS DECIMAL(16,2)) AS pay_amount, event_id % 5 AS pay_num, ts AS pay_time FROM events WHERE event_type IN ('purchase', 'signup'))
    WHERE pay_amount > 0 AND pay_num > 0)
  LEFT JOIN part ON product_id = p_partkey WHERE rn = 1
)"""
SEARCHES = """
sea AS (
  SELECT user_id, search_word, product_id, search_time, p_type AS category_id, lower(p_type) AS category_name, CAST(search_time AS DATE) AS dt
  FROM (SELECT user_id, 'word' || CAST(event_id % 40 AS VARCHAR) AS search_word, date_trunc('hour', ts) AS search_time, min(event_id % 150) AS product_id
        FROM events WHERE event_type = 'error' GROUP BY 1, 2, 3) JOIN part ON product_id = p_partkey
)"""


@query("w05_visit_detail", with_(VISITS) + "SELECT * FROM vis")
def w05_visit(spark, sf):
    return _visits(spark, sf)


@query("w05_sale_detail", with_(SALES) + "SELECT * FROM sal")
def w05_sale(spark, sf):
    return _sales(spark, sf)


@query("w05_search_detail", with_(SEARCHES) + "SELECT * FROM sea")
def w05_search(spark, sf):
    return _searches(spark, sf)


SALE_SUMMARY = """
ss AS (SELECT product_id, p_name AS product_name, category_id, category_name, CAST(sum(pay_amount) AS DECIMAL(26,2)) AS total_sales_amount,
  CAST(sum(pay_num) AS BIGINT) AS total_sales_num, count(DISTINCT order_id) AS total_order_num, round(CAST(sum(pay_amount) AS DOUBLE) / count(*), 4) AS avg_price
  FROM sal JOIN part ON product_id = p_partkey GROUP BY 1, 2, 3, 4)"""


@query("w06_product_sale_summary", with_(SALES, SALE_SUMMARY) + "SELECT * FROM ss")
def w06_sale(spark, sf):
    return b.product_sale_summary(_sales(spark, sf), _catalogue(spark, sf))


VISIT_SUMMARY = """
vs AS (SELECT x.product_id, category_id, source_visitors, total_visitor_num, total_visit_num, coalesce(pay_user_num, 0) AS pay_user_num,
  CASE WHEN total_visitor_num > 0 THEN round(CAST(coalesce(pay_user_num, 0) AS DOUBLE) * 100.0 / total_visitor_num, 2) ELSE 0.0 END AS pay_conversion_rate
  FROM (SELECT product_id, category_id, string_agg(s || '=' || CAST(u AS VARCHAR), ',' ORDER BY s) AS source_visitors,
          CAST(sum(u) AS BIGINT) AS total_visitor_num, CAST(sum(n) AS BIGINT) AS total_visit_num
        FROM (SELECT product_id, category_id, coalesce(source_name, 'unknown') AS s, count(DISTINCT user_id) AS u, count(*) AS n FROM vis GROUP BY 1, 2, 3) GROUP BY 1, 2) x
  LEFT JOIN (SELECT product_id, count(DISTINCT user_id) AS pay_user_num FROM sal GROUP BY 1) p ON x.product_id = p.product_id)"""


@query("w06_product_visit_summary", with_(VISITS, SALES, VISIT_SUMMARY) + "SELECT * FROM vs")
def w06_visit(spark, sf):
    out = b.product_visit_summary(_visits(spark, sf), _sales(spark, sf))
    entries = F.transform(F.map_entries("source_visitor_map"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.withColumn("source_visitors", F.array_join(F.array_sort(entries), ",")).drop("source_visitor_map")


@query("w06_sku_sale_summary", with_(SALES) + """
, k AS (SELECT sku_id, product_id, CAST(sum(pay_num) AS BIGINT) AS total_pay_num FROM sal GROUP BY 1, 2)
SELECT sku_id, k.product_id, total_pay_num, round(CAST(total_pay_num AS DOUBLE) * 100.0 / t, 2) AS pay_num_ratio, p_size * 10 AS current_stock,
  CAST(CASE WHEN total_pay_num > 0 THEN (p_size * 10) // total_pay_num ELSE 999 END AS BIGINT) AS stock_sale_days
FROM k JOIN (SELECT product_id, sum(total_pay_num) AS t FROM k GROUP BY 1) x ON k.product_id = x.product_id LEFT JOIN part ON k.product_id = p_partkey
""")
def w06_sku(spark, sf):
    return b.sku_sale_summary(_sales(spark, sf), _catalogue(spark, sf))


WORDS = """
ws AS (SELECT search_word, count(*) AS total_search_num, count(DISTINCT user_id) AS total_visitor_num, count(DISTINCT product_id) AS related_product_num FROM sea GROUP BY 1)"""


@query("w06_search_word_summary", with_(SEARCHES, WORDS) + "SELECT * FROM ws")
def w06_words(spark, sf):
    return b.search_word_summary(_searches(spark, sf))


@query("w06_search_word_products", with_(SEARCHES) + "SELECT DISTINCT search_word, product_id FROM sea")
def w06_word_products(spark, sf):
    return b.search_word_products(_searches(spark, sf))


def _growth(name: str) -> str:
    return f"CASE WHEN coalesce({name}, 0) <> 0 THEN round((CAST(s AS DOUBLE) - CAST({name} AS DOUBLE)) / CAST({name} AS DOUBLE) * 100, 2) ELSE 0.0 END"


@query("w07_core_index", with_(VISITS, SALES) + f"""
, v AS (SELECT CAST(sum(u) AS BIGINT) AS u, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT product_id, category_id, coalesce(source_name, 'unknown') AS q, count(DISTINCT user_id) AS u, count(*) AS n FROM vis WHERE dt = {EVENT_DAY} GROUP BY 1, 2, 3)),
o AS (SELECT CAST(sum(c) AS BIGINT) AS o FROM (SELECT product_id, count(DISTINCT order_id) AS c FROM sal WHERE dt = {EVENT_DAY} GROUP BY 1)),
m AS (SELECT CAST(sum(CASE WHEN dt = {EVENT_DAY} THEN pay_amount END) AS DECIMAL(26,2)) AS s, sum(CASE WHEN dt = {EVENT_DAY} - 1 THEN pay_amount END) AS y,
      sum(CASE WHEN dt = {EVENT_DAY} - 7 THEN pay_amount END) AS w FROM sal)
SELECT {EVENT_DAY} AS stat_date, u AS total_visitor_num, n AS total_visit_num, o AS total_order_num, s AS total_sales_amount,
  round(CAST(s AS DOUBLE) / o * 1.0, 2) AS avg_order_amount, round(CAST(o AS DOUBLE) / u * 100.0, 2) AS pay_conversion_rate, CAST(60.0 AS DOUBLE) AS visitor_avg_stay_time,
  {_growth("y")} AS dod_growth, {_growth("w")} AS wow_growth FROM v, o, m
""")
def w07(spark, sf):
    visits = _visits(spark, sf)
    today = visits.filter(F.col("dt") == _day())
    sales = _sales(spark, sf)
    return b.core_index(visits, b.product_visit_summary(today, sales), sales, _day())


@query("w08_category_ranking", with_(SALES, SALE_SUMMARY) + """
, c AS (SELECT category_id, category_name, CAST(sum(total_sales_amount) AS DECIMAL(20,2)) AS total_sales_amount, CAST(sum(total_sales_num) AS BIGINT) AS total_sales_num FROM ss GROUP BY 1, 2)
SELECT *, round(CAST(total_sales_amount AS DOUBLE) / CAST((SELECT sum(total_sales_amount) FROM c) AS DOUBLE) * 100, 2) AS sales_contribution,
  row_number() OVER (ORDER BY total_sales_amount DESC, category_id) AS sales_rank FROM c
""")
def w08(spark, sf):
    return b.category_ranking(w06_sale(spark, sf))


HOT = """
hot AS (SELECT *, row_number() OVER (ORDER BY hot_score DESC, product_id) AS hot_rank FROM (
  SELECT product_id, product_name, category_id, coalesce(total_sales_amount, 0) AS total_sales_amount, coalesce(total_visit_num, 0) AS total_visit_num,
    coalesce(conversion_rate, 0.0) AS conversion_rate,
    round(CAST(coalesce(total_sales_amount, 0) AS DOUBLE) * CAST(0.6 AS DOUBLE) + coalesce(total_visit_num, 0) * CAST(0.3 AS DOUBLE) + coalesce(conversion_rate, 0.0) * CAST(0.1 AS DOUBLE), 4) AS hot_score
  FROM (SELECT product_id, product_name, category_id, total_sales_amount FROM ss)
  FULL JOIN (SELECT product_id, total_visit_num, pay_conversion_rate AS conversion_rate FROM vs) USING (product_id)))"""


def _hot(spark, sf):
    return b.hot_products(w06_sale(spark, sf), b.product_visit_summary(_visits(spark, sf), _sales(spark, sf)))


@query("w09_hot_products", with_(VISITS, SALES, SALE_SUMMARY, VISIT_SUMMARY, HOT) + "SELECT * FROM hot")
def w09(spark, sf):
    return _hot(spark, sf)


@query("w10_hot_search_words", with_(VISITS, SALES, SALE_SUMMARY, VISIT_SUMMARY, HOT, SEARCHES, WORDS) + """
, r AS (SELECT search_word, round(CAST(count(DISTINCT order_id) AS DOUBLE) / count(*) * 100, 2) AS click_rate
        FROM sea LEFT JOIN sal ON sea.user_id = sal.user_id AND sea.product_id = sal.product_id GROUP BY 1),
z AS (SELECT ws.*, click_rate, round(total_search_num * CAST(0.7 AS DOUBLE) + click_rate * CAST(0.3 AS DOUBLE), 4) AS search_score FROM ws JOIN r ON ws.search_word = r.search_word)
SELECT *, row_number() OVER (ORDER BY search_score DESC, search_word) AS search_rank,
  (SELECT string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY hot_rank) FROM hot WHERE hot_rank <= 10) AS related_hot_product_ids FROM z
""")
def w10(spark, sf):
    searches = _searches(spark, sf)
    out = b.hot_search_words(b.search_word_summary(searches), searches, _sales(spark, sf), _hot(spark, sf))
    return out.withColumn("related_hot_product_ids", F.array_join("related_hot_product_ids", ","))


# -- the same day on order lines: the parts, orders and buyers of the tables as they are ----


def _lines(spark, sf):
    l, o = a.table(spark, sf, "lineitem"), a.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left")


def _line_visits(spark, sf):
    rows = _lines(spark, sf).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("visit_time"),
        F.concat(F.lit("src"), F.col("l_linenumber") % 4).alias("visit_source"),
    )
    sources = a.table(spark, sf, "region").select(
        F.concat(F.lit("src"), F.col("r_regionkey")).alias("source_name"), F.lower("r_name").alias("source_type")
    ).filter(F.col("source_name") != "src3")
    return b.visit_detail(rows, _catalogue(spark, sf), sources)


def _line_sales(spark, sf):
    rows = _lines(spark, sf).filter(F.col("l_returnflag") != "R").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("sku_id"),
        F.col("o_custkey").alias("user_id"), F.col("l_extendedprice").cast("decimal(16,2)").alias("pay_amount"),
        F.col("l_quantity").cast("bigint").alias("pay_num"), F.col("l_shipdate").alias("pay_time"),
    ).join(_catalogue(spark, sf).select("product_id", "category_id"), "product_id", "left")
    return b.sale_detail(rows, _categories(spark, sf))


def _line_searches(spark, sf):
    rows = _lines(spark, sf).filter(F.col("l_linenumber") < 4).select(
        F.col("o_custkey").alias("user_id"), F.concat(F.lit(" from "), F.col("l_suppkey"), F.lit(" ")).alias("search_word"),
        F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("search_time"),
    )
    return b.search_detail(rows, _catalogue(spark, sf), _categories(spark, sf))


LINE_VISITS = """
vis AS (
  SELECT user_id, product_id, p_type AS category_id, visit_time, md5(s.source_name) AS source_id, s.source_name, s.source_type, 60 AS stay_time, CAST(visit_time AS DATE) AS dt
  FROM (SELECT o_custkey AS user_id, l_partkey AS product_id, l_shipdate AS visit_time, min('src' || CAST(l_linenumber % 4 AS VARCHAR)) AS src
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)
  JOIN part ON product_id = p_partkey
  LEFT JOIN (SELECT 'src' || CAST(r_regionkey AS VARCHAR) AS source_name, lower(r_name) AS source_type FROM region WHERE r_regionkey <> 3) s ON src = s.source_name
)"""
LINE_SALES = """
sal AS (
  SELECT order_id, product_id, sku_id, user_id, pay_amount, pay_num, pay_time, p_type AS category_id, lower(p_type) AS category_name, CAST(pay_time AS DATE) AS dt
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, sku_id ORDER BY pay_time, pay_amount, product_id) AS rn
    FROM (SELECT l_orderkey AS order_id, l_partkey AS product_id, l_partkey * 10 + l_linenumber AS sku_id, o_custkey AS user_id,
          CAST(l_extendedprice AS DECIMAL(16,2)) AS pay_amount, CAST(l_quantity AS BIGINT) AS pay_num, l_shipdate AS pay_time
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R')
    WHERE pay_amount > 0 AND pay_num > 0)
  LEFT JOIN part ON product_id = p_partkey WHERE rn = 1
)"""
LINE_SEARCHES = """
sea AS (
  SELECT user_id, search_word, product_id, search_time, p_type AS category_id, lower(p_type) AS category_name, CAST(search_time AS DATE) AS dt
  FROM (SELECT o_custkey AS user_id, 'from ' || CAST(l_suppkey AS VARCHAR) AS search_word, l_shipdate AS search_time, min(l_partkey) AS product_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber < 4 GROUP BY 1, 2, 3) JOIN part ON product_id = p_partkey
)"""
# the mean price rounded half up in whole numbers, as ties are common with lines of two decimals
LINE_SALE_SUMMARY = """
ss AS (SELECT product_id, product_name, category_id, category_name, total_sales_amount, total_sales_num, total_order_num,
    CAST((CAST(total_sales_amount * 100 AS BIGINT) * 200 + n) // (2 * n) AS DOUBLE) / 10000 AS avg_price
  FROM (SELECT product_id, p_name AS product_name, category_id, category_name, CAST(sum(pay_amount) AS DECIMAL(26,2)) AS total_sales_amount,
      CAST(sum(pay_num) AS BIGINT) AS total_sales_num, count(DISTINCT order_id) AS total_order_num, count(*) AS n
    FROM sal JOIN part ON product_id = p_partkey GROUP BY 1, 2, 3, 4))"""
LINE_VISIT_SUMMARY = """
vs AS (SELECT x.product_id, x.category_id, source_visitors, total_visitor_num, total_visit_num, coalesce(pay_user_num, 0) AS pay_user_num,
  round(CAST(coalesce(pay_user_num, 0) AS DOUBLE) * 100.0 / total_visitor_num, 2) AS pay_conversion_rate
  FROM (SELECT product_id, category_id, count(DISTINCT user_id) AS total_visitor_num, count(*) AS total_visit_num FROM vis GROUP BY 1, 2) x
  JOIN (SELECT product_id, string_agg(s || '=' || CAST(u AS VARCHAR), ',' ORDER BY s) AS source_visitors FROM (
      SELECT product_id, coalesce(source_name, 'unknown') AS s, count(DISTINCT user_id) AS u FROM vis GROUP BY 1, 2) GROUP BY 1) m ON x.product_id = m.product_id
  LEFT JOIN (SELECT product_id, count(DISTINCT user_id) AS pay_user_num FROM sal GROUP BY 1) p ON x.product_id = p.product_id)"""


def _source_text(summary):
    entries = F.transform(F.map_entries("source_visitor_map"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return summary.withColumn("source_visitors", F.array_join(F.array_sort(entries), ",")).drop("source_visitor_map")


@query("w05_line_visit_detail", with_(LINE_VISITS) + "SELECT * FROM vis")
def w05_line_visit(spark, sf):
    return _line_visits(spark, sf)


@query("w05_line_sale_detail", with_(LINE_SALES) + "SELECT * FROM sal")
def w05_line_sale(spark, sf):
    return _line_sales(spark, sf)


@query("w05_line_search_detail", with_(LINE_SEARCHES) + "SELECT * FROM sea")
def w05_line_search(spark, sf):
    return _line_searches(spark, sf)


@query("w06_line_product_sales", with_(LINE_SALES, LINE_SALE_SUMMARY) + "SELECT * FROM ss")
def w06_line_sale(spark, sf):
    return b.product_sale_summary(_line_sales(spark, sf), _catalogue(spark, sf))


@query("w06_line_product_visits", with_(LINE_VISITS, LINE_SALES, LINE_VISIT_SUMMARY) + "SELECT * FROM vs")
def w06_line_visit(spark, sf):
    """Visitors of several sources count once per product."""
    return _source_text(b.product_visit_summary(_line_visits(spark, sf), _line_sales(spark, sf)))


@query("w06_line_search_words", with_(LINE_SEARCHES, WORDS) + "SELECT * FROM ws")
def w06_line_words(spark, sf):
    return b.search_word_summary(_line_searches(spark, sf))


@query("w08_line_category_ranking", with_(LINE_SALES, LINE_SALE_SUMMARY) + """
, c AS (SELECT category_id, category_name, CAST(sum(total_sales_amount) AS DECIMAL(20,2)) AS total_sales_amount, CAST(sum(total_sales_num) AS BIGINT) AS total_sales_num FROM ss GROUP BY 1, 2)
SELECT *, round(CAST(total_sales_amount AS DOUBLE) / CAST((SELECT sum(total_sales_amount) FROM c) AS DOUBLE) * 100, 2) AS sales_contribution,
  row_number() OVER (ORDER BY total_sales_amount DESC, category_id) AS sales_rank FROM c
""")
def w08_line(spark, sf):
    return b.category_ranking(w06_line_sale(spark, sf))


@query("w09_line_hot_products", with_(LINE_VISITS, LINE_SALES, LINE_SALE_SUMMARY, LINE_VISIT_SUMMARY, HOT) + "SELECT * FROM hot")
def w09_line(spark, sf):
    return b.hot_products(w06_line_sale(spark, sf), b.product_visit_summary(_line_visits(spark, sf), _line_sales(spark, sf)))


# -- scorecards ---------------------------------------------------------------------------


def _log(spark, sf):
    """Behaviour log with content events added for the scorecard."""
    log = a.behaviour(spark, sf)
    return log.withColumn("event_type", F.when((F.col("event_type") == "view") & (F.col("duration") % 3 == 0), "content_view")
                          .when((F.col("event_type") == "view") & (F.col("duration") % 3 == 1), "content_share").otherwise(F.col("event_type")))


LOG = """
lg AS (SELECT * REPLACE (CASE WHEN event_type = 'view' AND duration % 3 = 0 THEN 'content_view' WHEN event_type = 'view' AND duration % 3 = 1 THEN 'content_share' ELSE event_type END AS event_type) FROM behaviour)"""


def _u(cond: str) -> str:
    return f"count(DISTINCT CASE WHEN {cond} THEN user_id END)"


def _n(cond: str) -> str:
    return f"count(CASE WHEN {cond} THEN 1 END)"


HOME = "count(DISTINCT CASE WHEN page_type = 'home' THEN session_id END)"
TRAFFIC = f"""
tr AS (SELECT store_id, item_id, {HOME} AS store_total_clicks, {_n("page_type LIKE 'item%'")} AS item_visits, {percent(_n("page_type LIKE 'item%'"), HOME)} AS item_click_rate,
  round(coalesce(avg(CASE WHEN event_type = 'search' AND search_rank BETWEEN 0 AND 100 THEN CAST(100 - search_rank AS DOUBLE) END), 0.0), 2) AS search_rank_score,
  {percent(_n("page_type = 'item_detail'"), _n("page_type LIKE 'item%'"))} AS detail_click_rate FROM lg GROUP BY 1, 2)"""
CONV = f"""
cv AS (SELECT store_id, item_id, {percent(_u("event_type = 'payment'"), _u("page_type LIKE 'item%'"))} AS conversion_rate,
  {percent(_u("event_type = 'add_to_cart'"), _u("page_type LIKE 'item%'"))} AS cart_conversion_rate,
  {percent(_u("event_type = 'payment_success'"), _u("event_type = 'payment'"))} AS payment_success_rate FROM lg GROUP BY 1, 2)"""
CONTENT = f"""
ct AS (SELECT store_id, item_id,
  CASE WHEN {_n("event_type = 'content_view'")} > 0 THEN round(CAST(sum(CASE WHEN event_type = 'content_view' THEN duration END) AS DOUBLE) / {_n("event_type = 'content_view'")}, 2) ELSE 0.0 END AS avg_content_duration,
  {percent(_u("event_type = 'content_share'"), _u("event_type = 'content_view'"))} AS content_share_rate,
  {percent(_u("event_type = 'comment'"), _u("event_type = 'content_view'"))} AS comment_interaction_rate FROM lg GROUP BY 1, 2)"""
COST = "CAST(sum(CASE WHEN is_new_customer = 1 THEN acquisition_cost END) AS DOUBLE)"
ACQ = f"""
aq AS (SELECT store_id, item_id, {percent(_u("is_new_customer = 1 AND event_type = 'payment'"), _u("event_type = 'payment'"))} AS new_customer_purchase_ratio,
  {percent(_u("is_new_customer = 1 AND repurchase_flag = 1"), _u("is_new_customer = 1"))} AS new_customer_repurchase_rate,
  round(CASE WHEN {COST} > 0 THEN greatest(0.0, 100 - {COST} / greatest(CAST({_u("is_new_customer = 1")} AS DOUBLE), 1.0) * 10) ELSE 100.0 END, 2) AS acquisition_cost_score
  FROM lg GROUP BY 1, 2)"""


@query("w11_item_traffic", with_(BEHAVIOUR, LOG, TRAFFIC) + "SELECT * FROM tr")
def w11_traffic(spark, sf):
    return b.item_traffic(_log(spark, sf))


@query("w11_item_conversion", with_(BEHAVIOUR, LOG, CONV) + "SELECT * FROM cv")
def w11_conversion(spark, sf):
    return b.item_conversion(_log(spark, sf))


@query("w11_item_content", with_(BEHAVIOUR, LOG, CONTENT) + "SELECT * FROM ct")
def w11_content(spark, sf):
    return b.item_content(_log(spark, sf))


@query("w11_item_acquisition", with_(BEHAVIOUR, LOG, ACQ) + "SELECT * FROM aq")
def w11_acquisition(spark, sf):
    return b.item_acquisition(_log(spark, sf))


def _service_orders(spark, sf):
    l = a.table(spark, sf, "lineitem")
    return l.select(
        (F.col("l_suppkey") % 10).alias("store_id"), (F.col("l_partkey") % 20).alias("item_id"),
        F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_returnflag") == "A", "completed").otherwise("shipped").alias("order_status"),
        (F.col("l_linenumber") == 7).cast("int").alias("has_complaint"),
        F.when(F.col("l_linenumber") < 6, F.col("l_linenumber")).alias("rating"),
    )


SERVICE = """
sv AS (SELECT store_id, item_id, CASE WHEN done > 0 THEN round(100 - CAST(ret AS DOUBLE) * 100.0 / done, 2) ELSE 100.0 END AS return_rate_score,
  CASE WHEN done > 0 THEN round(100 - CAST(com AS DOUBLE) * 100.0 / done, 2) ELSE 100.0 END AS complaint_rate_score,
  round(coalesce(rating * 20, 0.0), 2) AS positive_feedback_rate
  FROM (SELECT l_suppkey % 10 AS store_id, l_partkey % 20 AS item_id, count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS done,
    count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS ret, count(CASE WHEN l_linenumber = 7 THEN 1 END) AS com,
    avg(CASE WHEN l_linenumber < 6 THEN l_linenumber END) AS rating FROM lineitem GROUP BY 1, 2))"""


@query("w11_item_service", with_(SERVICE) + "SELECT * FROM sv")
def w11_service(spark, sf):
    return b.item_service(_service_orders(spark, sf))


def _score(parts: list[tuple[str, str, str]]) -> str:
    any_data = " OR ".join(f"coalesce({m}, 0) > 0" for m, _, _ in parts)

    def value(m):
        exact = f"coalesce(CAST({m} AS DECIMAL(12,2)), 0)"
        return f"CAST(CAST(least({exact}, 300) AS DOUBLE) / 3.0 AS DECIMAL(12,6))" if m == "avg_content_duration" else exact

    total = " + ".join(f"least({value(m)} * {f}, 100) * {w}" for m, w, f in parts)
    return f"CASE WHEN {any_data} THEN CAST(round({total}, 2) AS DOUBLE) ELSE 20.0 END"


SCORE_COLUMNS = ", ".join(f"{_score(parts)} AS {name}" for name, (_, parts) in b.SCORE_PARTS.items())
TOTAL = " + ".join(f"CAST({name} AS DECIMAL(12,2)) * {w}" for name, (w, _) in b.SCORE_PARTS.items())
SCORES = f"""
sc AS (SELECT *, CASE WHEN total_score >= 85 THEN 'A' WHEN total_score >= 70 THEN 'B' WHEN total_score >= 50 THEN 'C' ELSE 'D' END AS grade FROM (
  SELECT *, CAST(round({TOTAL}, 2) AS DOUBLE) AS total_score FROM (
  SELECT tr.store_id, tr.item_id, {SCORE_COLUMNS} FROM tr LEFT JOIN cv USING (store_id, item_id) LEFT JOIN ct USING (store_id, item_id)
  LEFT JOIN aq USING (store_id, item_id) LEFT JOIN sv USING (store_id, item_id))))"""
ALL5 = (BEHAVIOUR, LOG, TRAFFIC, CONV, CONTENT, ACQ, SERVICE, SCORES)


def _scores(spark, sf):
    return b.product_scores_from_logs(_log(spark, sf), _service_orders(spark, sf))


@query("w12_product_scores", with_(*ALL5) + "SELECT * FROM sc")
def w12(spark, sf):
    return _scores(spark, sf)


def _gap(n: str) -> str:
    """Mean of the store and gap to it in whole cents, half away from zero."""
    short, cents = n.removesuffix("_score"), f"CAST(round({n} * 100) AS BIGINT)"
    s, k = f"sum({cents}) OVER w", "count(*) OVER w"
    d = f"({cents} * {k} - {s})"
    return (
        f"CAST((2 * {s} + {k}) // (2 * {k}) AS DOUBLE) / 100 AS competitor_avg_{short}, "
        f"CAST(sign({d}) * ((2 * abs({d}) + {k}) // (2 * {k})) AS DOUBLE) / 100 AS {short}_gap"
    )


_GAPS = ", ".join(_gap(n) for n in [*b.SCORE_PARTS, "total_score"])


@query("w13_diagnosis", with_(*ALL5) + f"SELECT store_id, item_id, {_GAPS} FROM sc WINDOW w AS (PARTITION BY store_id)")
def w13(spark, sf):
    return b.diagnosis(_scores(spark, sf))


@query("w14_store_dimension", """
SELECT store_id, max(c) AS create_time, max(u) AS update_time FROM (
  SELECT user_id % 10 AS store_id, ts AS c, ts AS u FROM events UNION ALL SELECT l_suppkey % 12, l_shipdate, l_shipdate FROM lineitem) GROUP BY 1
""")
def w14_store(spark, sf):
    e = a.events(spark, sf).select((F.col("user_id") % 10).alias("store_id"), F.col("ts").alias("create_time"), F.col("ts").alias("update_time"))
    l = a.table(spark, sf, "lineitem").select((F.col("l_suppkey") % 12).alias("store_id"), F.col("l_shipdate").alias("create_time"), F.col("l_shipdate").alias("update_time"))
    return b.store_dimension(e, l)


@query("w14_user_dimension", """
SELECT user_id, min(t) AS register_time, max(t) AS last_login_time FROM (
  SELECT user_id, ts AS t FROM events UNION ALL SELECT o_custkey, o_orderdate FROM orders) GROUP BY 1
""")
def w14_user(spark, sf):
    o = a.table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderdate")
    return b.user_dimension((a.events(spark, sf), "ts"), (o, "o_orderdate"))


@query("w15_clean_behaviour", """
SELECT event_id, coalesce(CAST(CASE WHEN user_id % 11 <> 0 THEN user_id END AS VARCHAR), 'UNKNOWN_USER') AS user_id, CAST(event_id % 9 AS VARCHAR) AS session_id,
  'UNKNOWN_STORE' AS store_id, CAST(event_id % 20 AS VARCHAR) AS item_id,
  CASE event_id % 8 WHEN 1 THEN 'home' WHEN 2 THEN 'item_list' WHEN 3 THEN 'item_detail' WHEN 4 THEN 'search_result' WHEN 5 THEN 'content' ELSE 'home' END AS page_type,
  CASE event_id % 7 WHEN 1 THEN 'view' WHEN 2 THEN 'search' WHEN 3 THEN 'add_to_cart' WHEN 4 THEN 'payment' WHEN 5 THEN 'payment_success' ELSE 'view' END AS event_type,
  CASE WHEN k BETWEEN 0 AND 50 THEN k * 2 END AS search_rank, CAST(floor(value) AS INTEGER) AS duration, 0 AS is_new_customer, CAST(event_id % 2 AS INTEGER) AS repurchase_flag,
  CAST(CASE WHEN value <= 5 THEN floor(value) * 100 ELSE 0 END AS DECIMAL(10,2)) AS acquisition_cost,
  CAST(CASE WHEN event_id % 7 BETWEEN 1 AND 5 THEN event_id % 7 ELSE 3 END AS INTEGER) AS rating
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
""")
def w15(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    log = a.events(spark, sf).select(
        "event_id", F.when(F.col("user_id") % 11 != 0, F.col("user_id")).alias("user_id"), (F.col("event_id") % 9).alias("session_id"),
        F.lit(None).cast("bigint").alias("store_id"), (F.col("event_id") % 20).alias("item_id"), (F.col("event_id") % 8).alias("page_type"),
        (F.col("event_id") % 7).alias("event_type"), (k * 2).alias("search_rank"), F.floor("value").alias("duration"),
        F.lit(None).cast("int").alias("is_new_customer"), (F.col("event_id") % 2).alias("repurchase_flag"),
        F.when(F.col("value") <= 5, F.floor("value") * 100).otherwise(F.lit(9999)).alias("acquisition_cost"), (F.col("event_id") % 7).alias("rating"),
    )
    return b.clean_behaviour(log)


PT = f"""
pt AS (SELECT store_id, page_type, {_n("event_type = 'view'")} AS page_views, {_u("event_type = 'view'")} AS unique_visitors,
  round(coalesce(avg(CASE WHEN event_type = 'view' THEN duration END), 0.0), 2) AS avg_stay_duration,
  {percent(_n("event_type = 'view' AND duration < 10"), _n("event_type = 'view'"))} AS bounce_rate, {_n("event_type = 'search'")} AS search_count,
  round(coalesce(avg(CASE WHEN event_type = 'search' THEN search_rank END), 0.0), 2) AS avg_search_rank FROM behaviour GROUP BY 1, 2)"""
TURN = _n("event_type IN ('add_to_cart', 'payment')")
PC = f"""
pc AS (SELECT store_id, page_type, {_n("event_type = 'view'")} AS click_count, {_u("event_type = 'view'")} AS click_users, {TURN} AS conversion_clicks,
  {percent(TURN, _n("event_type = 'view'"))} AS conversion_rate FROM behaviour GROUP BY 1, 2)"""
ON = _n("event_type = 'view' AND page_type = 'item_list'")
PG = f"""
pg AS (SELECT store_id, page_type, {_n("event_type = 'view'")} AS page_views, {ON} AS to_item_detail_views, {percent(ON, _n("event_type = 'view'"))} AS guidance_rate,
  {_u("event_type = 'payment'")} AS payment_users, CAST(coalesce(sum(CASE WHEN event_type = 'payment' THEN acquisition_cost END), 0) AS DECIMAL(21,2)) AS payment_amount FROM behaviour GROUP BY 1, 2)"""


@query("w16_page_traffic", with_(BEHAVIOUR, PT) + "SELECT * FROM pt")
def w16_traffic(spark, sf):
    return b.page_traffic(a.behaviour(spark, sf))


@query("w16_page_clicks", with_(BEHAVIOUR, PC) + "SELECT * FROM pc")
def w16_clicks(spark, sf):
    return b.page_clicks(a.behaviour(spark, sf))


@query("w16_page_guidance", with_(BEHAVIOUR, PG) + "SELECT * FROM pg")
def w16_guidance(spark, sf):
    return b.page_guidance(a.behaviour(spark, sf))


def _points(columns: dict[str, str]) -> str:
    return " + ".join(f"CAST({c} AS DECIMAL(12,2)) * {w}" for c, w in columns.items())


PAGE_SCORES = f"""
ps AS (SELECT store_id, page_type,
  CASE WHEN pt.page_views > 0 OR unique_visitors > 0 THEN CAST(round(least({_points({"pt.page_views": "0.03", "unique_visitors": "0.3", "avg_stay_duration": "2"})}
     + (100 - CAST(bounce_rate AS DECIMAL(12,2))) * 20, 100), 2) AS DOUBLE) ELSE 0.0 END AS traffic_score,
  CASE WHEN click_count > 0 OR click_users > 0 THEN CAST(round(least({_points({"click_count": "0.4", "click_users": "0.6", "conversion_clicks": "3"})}, 100), 2) AS DOUBLE) ELSE 0.0 END AS click_score,
  CASE WHEN guidance_rate > 0 OR payment_users > 0 THEN CAST(round(least({_points({"guidance_rate": "0.4", "payment_users": "0.03", "payment_amount": "0.0003"})}, 100), 2) AS DOUBLE) ELSE 0.0 END AS guidance_score
  FROM pt LEFT JOIN pc USING (store_id, page_type) LEFT JOIN pg USING (store_id, page_type))"""


@query("w17_page_scores", with_(BEHAVIOUR, PT, PC, PG, PAGE_SCORES) + """
SELECT *, CASE WHEN overall_score >= 85 THEN 'A' WHEN overall_score >= 70 THEN 'B' WHEN overall_score >= 50 THEN 'C' ELSE 'D' END AS grade FROM (
  SELECT *, CAST(round(""" + _points({"traffic_score": "0.4", "click_score": "0.3", "guidance_score": "0.3"}) + """, 2) AS DOUBLE) AS overall_score FROM ps)
""")
def w17(spark, sf):
    log = a.behaviour(spark, sf)
    return b.page_scores(
        b.page_traffic_board(b.page_traffic(log)), b.page_click_board(b.page_clicks(log)), b.page_guidance_board(b.page_guidance(log))
    )


ACTIVITY = f"""
act AS (SELECT user_id, count(DISTINCT dt) AS active_days, round(CAST(count(CASE WHEN dt > {EVENT_DAY} - 7 THEN 1 END) AS DOUBLE) / 7, 4) AS active_freq,
  round(CAST(sum(CASE WHEN page_type = 'item_detail' THEN page_count ELSE 0 END) AS DOUBLE) / count(*), 4) AS visit_depth
  FROM behaviour WHERE dt > {EVENT_DAY} - 30 AND dt <= {EVENT_DAY} GROUP BY 1)"""


@query("w18_user_activity", with_(BEHAVIOUR, ACTIVITY) + "SELECT * FROM act")
def w18_activity(spark, sf):
    return b.user_activity(a.behaviour(spark, sf), _day())


@query("w18_user_value", with_(BEHAVIOUR, ACTIVITY) + """
, m AS (SELECT CAST(max(active_days) AS DOUBLE) AS a, max(active_freq) AS b, max(visit_depth) AS c FROM act),
s AS (SELECT user_id, round(CAST(active_days AS DOUBLE) / a * 100 * CAST(0.4 AS DOUBLE) + active_freq / b * 100 * CAST(0.3 AS DOUBLE) + visit_depth / c * 100 * CAST(0.3 AS DOUBLE), 2) AS active_score,
  CAST(user_id % 101 AS DOUBLE) AS consume_score, CAST(user_id * 7 % 101 AS DOUBLE) AS repurchase_score, CAST(user_id * 3 % 101 AS DOUBLE) AS interaction_score,
  CAST(user_id * 5 % 101 AS DOUBLE) AS retention_score FROM act, m)
SELECT *, CASE WHEN total_score >= 85 THEN '高价值/A' WHEN total_score >= 70 THEN '中价值/B' WHEN total_score >= 50 THEN '潜力用户/C' ELSE '流失预警/D' END AS user_grade FROM (
SELECT *, CAST(round(""" + _points(b.VALUE_WEIGHTS) + """, 2) AS DOUBLE) AS total_score FROM s)
""")
def w18_value(spark, sf):
    act = b.active_score(w18_activity(spark, sf))
    u = F.col("user_id")
    parts = act.select(
        "user_id", "active_score", (u % 101).cast("double").alias("consume_score"), (u * 7 % 101).cast("double").alias("repurchase_score"),
        (u * 3 % 101).cast("double").alias("interaction_score"), (u * 5 % 101).cast("double").alias("retention_score"),
    )
    return b.user_value(parts)


@query("w19_clicks_above_visits", with_(BEHAVIOUR) + """
, v AS (SELECT store_id, item_id, count(*) AS visit_count FROM behaviour WHERE event_type = 'view' GROUP BY 1, 2),
c AS (SELECT store_id, item_id, count(*) AS total_other FROM behaviour WHERE event_type = 'add_to_cart' GROUP BY 1, 2)
SELECT store_id, item_id, visit_count, total_other FROM v LEFT JOIN c USING (store_id, item_id) WHERE visit_count < total_other
""")
def w19(spark, sf):
    log = a.behaviour(spark, sf)
    keys = ["store_id", "item_id"]
    visits = log.filter(F.col("event_type") == "view").groupBy(*keys).agg(F.count(F.lit(1)).alias("visit_count"))
    clicks = log.filter(F.col("event_type") == "add_to_cart").select(*keys, F.lit(1).cast("long").alias("click_count"))
    return quality.exceeding(visits, clicks, keys, "visit_count", "click_count")


@query("quality_coverage", """
SELECT count(*) AS total_rows, count(CASE WHEN event_type IN ('view', 'click', 'signup') THEN 1 END) AS covered_rows,
  round(count(CASE WHEN event_type IN ('view', 'click', 'signup') THEN 1 END) * 100.0 / count(*), 2) AS coverage_pct FROM events
""")
def quality_coverage(spark, sf):
    return quality.coverage(a.events(spark, sf), "event_type", ["view", "click", "signup"]).withColumn(
        "coverage_pct", F.col("coverage_pct").cast("double")
    )


@query("quality_layered_equals_direct", with_(BEHAVIOUR) + """
SELECT CAST(NULL AS BIGINT) AS store_id, CAST(NULL AS BIGINT) AS left_value, CAST(NULL AS BIGINT) AS right_value WHERE false
""")
def quality_layered(spark, sf):
    """Visits per store from the page summary and straight from the log: no row may differ."""
    log = a.behaviour(spark, sf)
    layered = b.page_traffic(log).groupBy("store_id").agg(F.sum("page_views").alias("n"))
    direct = log.filter(F.col("event_type") == "view").groupBy("store_id").agg(F.count(F.lit(1)).alias("n"))
    return quality.differing(layered, direct, ["store_id"], "n", 0.0)


@query("win06_partition_mean_gap", """
SELECT o_orderkey, CAST((2 * sum(c) OVER w + count(*) OVER w) // (2 * count(*) OVER w) AS BIGINT) AS mean_cents
FROM (SELECT o_orderkey, o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders) WINDOW w AS (PARTITION BY o_custkey)
""")
def win06(spark, sf):
    o = a.table(spark, sf, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(16,2)"))
    out = with_group_mean(o, ["o_custkey"], ["price"], "_avg_")
    return out.select("o_orderkey", F.round(F.col("_avg_price") * 100, 0).cast("long").alias("mean_cents"))
