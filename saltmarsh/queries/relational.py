"""Single relational constructs and column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from saltmarsh.functions import dates, geo, numbers, text
from saltmarsh.functions.documents import parse_records
from saltmarsh.operators.horizons import horizon_distinct, horizon_sums, to_date
from saltmarsh.operators.ranking import first_per_key, streak_by_islands, top_n
from saltmarsh.operators.relations import align, climb, decode, net_balance, one_row
from saltmarsh.operators.sequences import ordered_columns, time_slice
from saltmarsh.queries import adapters as a
from saltmarsh.queries.fragments import EVENT_DAY, SHOP_DAY
from saltmarsh.queries.registry import query

T = a.table


def rows():
    """Row count."""
    return F.count(F.lit(1))


@query("prj01_projection_and_literals", "SELECT c_custkey AS customer, c_mktsegment AS segment, 'shop' AS source FROM customer")
def prj01(spark, sf):
    return T(spark, sf, "customer").select(F.col("c_custkey").alias("customer"), F.col("c_mktsegment").alias("segment"), F.lit("shop").alias("source"))


@query("prj02_case", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'part' END AS state, CASE WHEN o_totalprice > 300000 THEN 'big' ELSE 'small' END AS size FROM orders")
def prj02(spark, sf):
    s = F.col("o_orderstatus")
    return T(spark, sf, "orders").select("o_orderkey", F.when(s == "F", "done").when(s == "O", "open").otherwise("part").alias("state"),
                                         F.when(F.col("o_totalprice") > 300000, "big").otherwise("small").alias("size"))


@query("prj03_if", "SELECT event_id, CASE WHEN value > 50 THEN 1 ELSE 0 END AS high FROM events")
def prj03(spark, sf):
    return T(spark, sf, "events").selectExpr("event_id", "if(value > 50, 1, 0) AS high")


@query("prj04_struct_and_map_access", "SELECT event_id, user_id AS who, event_type AS kind FROM events")
def prj04(spark, sf):
    e = T(spark, sf, "events").select("event_id", F.struct("user_id", "ts").alias("s"), F.create_map(F.lit("kind"), "event_type").alias("m"))
    return e.select("event_id", F.col("s.user_id").alias("who"), F.col("m")["kind"].alias("kind"))


@query("prj05_array_element", "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS rank, split_part(o_orderpriority, '-', 2) AS label FROM orders")
def prj05(spark, sf):
    parts = F.split("o_orderpriority", "-")
    return T(spark, sf, "orders").select("o_orderkey", parts.getItem(0).alias("rank"), parts.getItem(1).alias("label"))


@query("flt01_filters", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag IN ('A', 'R') AND l_linestatus NOT IN ('F')
  AND l_shipdate IS NOT NULL AND NOT (l_discount > 0.08 OR l_tax = 0)
""")
def flt01(spark, sf):
    f = F.col("l_quantity").between(10, 20) & F.col("l_returnflag").isin("A", "R") & ~F.col("l_linestatus").isin("F") & F.col("l_shipdate").isNotNull()
    return T(spark, sf, "lineitem").filter(f & ~((F.col("l_discount") > 0.08) | (F.col("l_tax") == 0))).select("l_orderkey", "l_linenumber", "l_partkey")


@query("flt02_like", "SELECT p_partkey FROM part WHERE p_name LIKE '%ring%' OR p_brand LIKE 'Brand#1_'")
def flt02(spark, sf):
    return T(spark, sf, "part").filter(F.col("p_name").like("%ring%") | F.col("p_brand").like("Brand#1_")).select("p_partkey")


@query("flt03_regex", r"SELECT page_id FROM pages WHERE regexp_matches(url, '^https?://[a-z.]+/(en|fr)/[0-9]+')")
def flt03(spark, sf):
    return T(spark, sf, "pages").filter(F.col("url").rlike("^https?://[a-z.]+/(en|fr)/[0-9]+")).select("page_id")


@query("flt06_scalar_subquery_filter", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - 30")
def flt06(spark, sf):
    o = T(spark, sf, "orders")
    return o.filter(F.col("o_orderdate").cast("date") > F.date_sub(dates.latest_date(o, "o_orderdate"), 30)).select("o_orderkey")


@query("jon01_inner_join", "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'")
def jon01(spark, sf):
    o = T(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    l = T(spark, sf, "lineitem")
    return l.join(o, l.l_orderkey == o.o_orderkey).select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey")


@query("jon02_star_join", """
SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def jon02(spark, sf):
    o, c, n, r = (T(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    return (o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(r, n.n_regionkey == r.r_regionkey, "left").select("o_orderkey", "c_name", "n_name", "r_name"))


@query("jon04_four_source_outer_join", """
SELECT k, a, b, c, d FROM (SELECT c_custkey AS k, count(*) AS a FROM customer GROUP BY 1) FULL JOIN (SELECT s_suppkey AS k, count(*) AS b FROM supplier GROUP BY 1) USING (k)
FULL JOIN (SELECT p_partkey AS k, count(*) AS c FROM part GROUP BY 1) USING (k) FULL JOIN (SELECT user_id AS k, count(*) AS d FROM events GROUP BY 1) USING (k)
""")
def jon04(spark, sf):
    def per(t, key, name):
        return T(spark, sf, t).groupBy(F.col(key).alias("k")).agg(rows().alias(name))

    return align({n: per(t, k, n) for n, t, k in (("a", "customer", "c_custkey"), ("b", "supplier", "s_suppkey"), ("c", "part", "p_partkey"), ("d", "events", "user_id"))}, ["k"])


@query("jon05_one_row_aggregates", "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS lines, (SELECT count(DISTINCT user_id) FROM events) AS users")
def jon05(spark, sf):
    return one_row([
        T(spark, sf, "orders").agg(rows().alias("orders")), T(spark, sf, "lineitem").agg(rows().alias("lines")),
        T(spark, sf, "events").agg(F.count_distinct("user_id").alias("users")),
    ])


@query("jon07_snapshot_self_join", """
WITH t AS (SELECT o_custkey AS k, max(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY 1), y AS (SELECT o_custkey AS k, max(CAST(o_orderdate AS DATE)) AS d FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01' GROUP BY 1)
SELECT t.k, CAST(t.d - y.d AS INTEGER) AS gap FROM t JOIN y ON t.k = y.k WHERE t.d - y.d >= 30
""")
def jon07(spark, sf):
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("date").alias("d"))
    today = o.groupBy("k").agg(F.max("d").alias("d"))
    old = o.filter(F.col("d") < a.day("2001-01-01")).groupBy("k").agg(F.max("d").alias("p"))
    return today.join(old, "k").select("k", F.datediff("d", "p").alias("gap")).filter(F.col("gap") >= 30)


@query("jon08_place_hierarchy", """
SELECT s_suppkey, n_name AS district_name, r_name AS city_name, 'TOP_' || CAST(r_regionkey % 2 AS VARCHAR) AS province_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def jon08(spark, sf):
    s = T(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return climb(s, a.places(spark, sf), "s_nationkey", ["district", "city", "province"]).select("s_suppkey", "district_name", "city_name", "province_name")


@query("jon09_dictionary_decode", """
SELECT o_orderkey, coalesce(n, 'none') AS priority_name FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '9' ELSE substr(o_orderpriority, 1, 1) END AS c FROM orders)
LEFT JOIN (SELECT DISTINCT substr(o_orderpriority, 1, 1) AS k, o_orderpriority AS n FROM orders) ON c = k
""")
def jon09(spark, sf):
    code = F.when(F.col("o_orderkey") % 7 == 0, "9").otherwise(F.substring("o_orderpriority", 1, 1))
    o = T(spark, sf, "orders").select("o_orderkey", code.alias("c"))
    return decode(o, a.dictionary(spark, sf), "c", "priority_name", "11", missing="none").drop("c")


@query("jon10_multi_key_join", """
SELECT user_id, d, n, coalesce(m, 0) AS m FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2)
LEFT JOIN (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS m FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) USING (user_id, d)
""")
def jon10(spark, sf):
    e = T(spark, sf, "events").withColumn("d", F.to_date("ts"))
    n = e.groupBy("user_id", "d").agg(rows().alias("n"))
    m = e.filter(F.col("event_type") == "purchase").groupBy("user_id", "d").agg(rows().alias("m"))
    return n.join(m, ["user_id", "d"], "left").fillna(0, ["m"])


@query("agg01_group_aggregates", """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(16,2))) AS DECIMAL(26,2)) AS qty, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1, 2
""")
def agg01(spark, sf):
    q = F.col("l_quantity").cast("decimal(16,2)")
    return T(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(rows().alias("n"), F.sum(q).alias("qty"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))


@query("agg02_global_aggregate", "SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(16,2))) AS DECIMAL(26,2)) AS total FROM orders")
def agg02(spark, sf):
    return T(spark, sf, "orders").agg(rows().alias("n"), F.sum(numbers.money(F.col("o_totalprice"))).alias("total"))


@query("agg03_count_distinct", "SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def agg03(spark, sf):
    return T(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_partkey").alias("parts"))


@query("agg05_one_amount_per_order", """
SELECT s, count(*) AS n, CAST(sum(amount) AS DECIMAL(26,2)) AS amount FROM (SELECT l_orderkey, l_linestatus AS s, max(CAST(l_extendedprice AS DECIMAL(16,2))) AS amount FROM lineitem GROUP BY 1, 2) GROUP BY 1
""")
def agg05(spark, sf):
    per = T(spark, sf, "lineitem").groupBy("l_orderkey", F.col("l_linestatus").alias("s")).agg(F.max(numbers.money(F.col("l_extendedprice"))).alias("amount"))
    return per.groupBy("s").agg(rows().alias("n"), F.sum("amount").alias("amount"))


@query("agg06_multi_horizon_distinct", f"""
SELECT event_type, recent_days, count(DISTINCT CASE WHEN CAST(ts AS DATE) > {EVENT_DAY} - recent_days THEN user_id END) AS users,
  CAST(count(CASE WHEN CAST(ts AS DATE) > {EVENT_DAY} - recent_days THEN 1 END) AS BIGINT) AS n
FROM events CROSS JOIN (VALUES (1), (7), (30)) h(recent_days) WHERE CAST(ts AS DATE) <= {EVENT_DAY} GROUP BY 1, 2
""")
def agg06(spark, sf):
    e = T(spark, sf, "events").withColumn("dt", F.to_date("ts"))
    return horizon_distinct(e, ["event_type"], "user_id", "dt", a.day(a.EVENT_DAY), {"n": F.lit(1).cast("long")}, member_name="users")


@query("agg07_pivoted_sums", f"""
SELECT l_suppkey, CAST(sum(CASE WHEN CAST(l_shipdate AS DATE) > {SHOP_DAY} - 7 THEN q ELSE 0 END) AS BIGINT) AS qty_7d, CAST(sum(q) AS BIGINT) AS qty_30d
FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q FROM lineitem) WHERE CAST(l_shipdate AS DATE) > {SHOP_DAY} - 30 AND CAST(l_shipdate AS DATE) <= {SHOP_DAY} GROUP BY 1
""")
def agg07(spark, sf):
    l = T(spark, sf, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("dt"), F.col("l_quantity").cast("long").alias("q"))
    return horizon_sums(l, ["l_suppkey"], "dt", a.day(a.SHOP_DAY), {"qty": F.col("q")}, (7, 30))


@query("agg08_to_date", "SELECT l_suppkey, min(CAST(l_shipdate AS DATE)) AS first_day, max(CAST(l_shipdate AS DATE)) AS last_day, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem GROUP BY 1")
def agg08(spark, sf):
    l = T(spark, sf, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("dt"), F.col("l_quantity").cast("long").alias("q"))
    return to_date(l, ["l_suppkey"], "dt", {"qty": F.col("q")}, "first_day", "last_day")


@query("agg09_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12")
def agg09(spark, sf):
    return T(spark, sf, "orders").groupBy("o_custkey").agg(rows().alias("n")).filter(F.col("n") >= 12)


@query("agg10_collected_sets", """
SELECT l_partkey, string_agg(x, ',' ORDER BY x) AS states FROM (SELECT DISTINCT l_partkey, l_returnflag || l_linestatus AS x FROM lineitem) GROUP BY 1
""")
def agg10(spark, sf):
    """At most six values per part, so the sets stay small whatever the rows."""
    state = F.concat("l_returnflag", "l_linestatus")
    return T(spark, sf, "lineitem").groupBy("l_partkey").agg(F.array_join(F.sort_array(F.collect_set(state)), ",").alias("states"))


@query("agg11_map_aggregate", """
SELECT user_id, string_agg(event_type || '=' || CAST(n AS VARCHAR), ',' ORDER BY event_type) AS counts FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1
""")
def agg11(spark, sf):
    per = T(spark, sf, "events").groupBy("user_id", "event_type").agg(rows().alias("n"))
    m = per.groupBy("user_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("event_type", "n")))).alias("m"))
    return m.select("user_id", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("counts"))


@query("agg12_first_value_per_group", "SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS first_priority, arg_max(o_orderpriority, o_orderkey) AS last_priority FROM orders GROUP BY 1")
def agg12(spark, sf):
    return T(spark, sf, "orders").groupBy("o_custkey").agg(F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"), F.max_by("o_orderpriority", "o_orderkey").alias("last_priority"))


@query("agg13_guarded_ratio", """
SELECT user_id, CASE WHEN v > 0 THEN CAST((2 * p * 10000 + v) // (2 * v) AS DOUBLE) / 10000 END AS rate
FROM (SELECT user_id, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS p, count(CASE WHEN event_type = 'view' AND user_id % 5 > 0 THEN 1 END) AS v FROM events GROUP BY 1)
""")
def agg13(spark, sf):
    p = F.count(F.when(F.col("event_type") == "purchase", 1))
    v = F.count(F.when((F.col("event_type") == "view") & (F.col("user_id") % 5 > 0), 1))
    return T(spark, sf, "events").groupBy("user_id").agg(numbers.exact_ratio(p, v, 4).cast("double").alias("rate"))


@query("agg14_net_balance", """
SELECT k, CAST(sum(q) AS BIGINT) AS q FROM (SELECT l_suppkey AS k, CAST(l_quantity AS BIGINT) AS q FROM lineitem UNION ALL SELECT l_suppkey, -CAST(l_quantity AS BIGINT) FROM lineitem WHERE l_linestatus = 'F') GROUP BY 1
""")
def agg14(spark, sf):
    l = T(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").cast("long").alias("q"), "l_linestatus")
    return net_balance(l, l.filter(F.col("l_linestatus") == "F"), ["k"], ["q"])


@query("win01_keep_first", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1")
def win01(spark, sf):
    e = T(spark, sf, "events").select("user_id", "event_id", "ts", F.to_date("ts").alias("d"))
    return first_per_key(e, ["user_id", "d"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id")


@query("win02_rank_top_three", "SELECT p_brand, p_partkey, rk FROM (SELECT p_brand, p_partkey, CAST(rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS INTEGER) AS rk FROM part) WHERE rk <= 3")
def win02(spark, sf):
    return top_n(T(spark, sf, "part").select("p_brand", "p_partkey", "p_size"), ["p_brand"], "p_size", 3).select("p_brand", "p_partkey", "rk")


@query("win04_next_value", "SELECT event_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events")
def win04(spark, sf):
    e = T(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return ordered_columns(e, ["user_id"], ["ts", "event_id"], time_slice(F.col("ts"), "day"), following={"next_type": "event_type"}).select("event_id", "next_type")


@query("win05_islands", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS dt FROM events), i AS (SELECT user_id, dt - CAST(row_number() OVER (PARTITION BY user_id ORDER BY dt) AS INTEGER) AS g FROM d)
SELECT DISTINCT user_id FROM (SELECT user_id, g, count(*) AS n FROM i GROUP BY 1, 2) WHERE n >= 10
""")
def win05(spark, sf):
    return streak_by_islands(a.user_days(spark, sf).distinct(), "user_id", "dt", 10)


@query("srt01_ordered_summary", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type")
def srt01(spark, sf):
    return T(spark, sf, "events").groupBy("event_type").agg(rows().alias("n")).orderBy(F.col("n").desc(), "event_type")


@query("srt02_top_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def srt02(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(50)


@query("set01_union_distinct", "SELECT o_custkey AS k FROM orders UNION SELECT user_id FROM events")
def set01(spark, sf):
    return T(spark, sf, "orders").select(F.col("o_custkey").alias("k")).union(T(spark, sf, "events").select("user_id")).distinct()


@query("set02_union_all", "SELECT k, count(*) AS n FROM (SELECT o_custkey AS k FROM orders UNION ALL SELECT user_id FROM events) GROUP BY 1")
def set02(spark, sf):
    return T(spark, sf, "orders").select(F.col("o_custkey").alias("k")).union(T(spark, sf, "events").select("user_id")).groupBy("k").agg(rows().alias("n"))


@query("set03_union_by_name", "SELECT s_suppkey AS k, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer")
def set03(spark, sf):
    s = T(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return s.unionByName(T(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("k")))


@query("set04_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def set04(spark, sf):
    return T(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("str01_text_functions", """
SELECT c_custkey, c_name || ':' || c_mktsegment AS joined, substr(c_name, 1, 8) AS head, split_part(c_name, '#', 2) AS number, trim('  ' || c_mktsegment || ' ') AS trimmed FROM customer
""")
def str01(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit(":"), "c_mktsegment").alias("joined"), F.substring("c_name", 1, 8).alias("head"),
                                           F.split("c_name", "#")[1].alias("number"), F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"))


@query("str03_pseudonyms", "SELECT c_custkey, md5(c_name) AS id, CASE WHEN c_mktsegment LIKE 'B%' THEN md5(c_mktsegment) END AS segment_id FROM customer")
def str03(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", text.pseudonym(F.col("c_name")).alias("id"), text.pseudonym(F.col("c_mktsegment"), "^B").alias("segment_id"))


@query("str04_defaults", "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END, 'none') AS p, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN o_custkey END, 0) AS c FROM orders")
def str04(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("p"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_custkey")).alias("c"))
    return o.fillna({"p": "none", "c": 0})


@query("str05_cut_and_case", "SELECT doc_id, substr(text, 1, 255) AS cut, upper(substr(source, 1, 1)) || substr(source, 2) AS source FROM documents")
def str05(spark, sf):
    return T(spark, sf, "documents").select("doc_id", text.cut(F.col("text")).alias("cut"), text.upper_first(F.col("source")).alias("source"))


@query("dat01_date_arithmetic", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 7 AS plus, CAST(o_orderdate AS DATE) - 7 AS minus, CAST(DATE '2001-12-31' - CAST(o_orderdate AS DATE) AS INTEGER) AS gap, strftime(o_orderdate, '%Y%m%d') AS txt FROM orders
""")
def dat01(spark, sf):
    d = F.col("o_orderdate").cast("date")
    return T(spark, sf, "orders").select("o_orderkey", F.date_add(d, 7).alias("plus"), F.date_sub(d, 7).alias("minus"), F.datediff(a.day("2001-12-31"), d).alias("gap"), F.date_format("o_orderdate", "yyyyMMdd").alias("txt"))


@query("dat02_epoch_and_zone", "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS local, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def dat02(spark, sf):
    return T(spark, sf, "events").select("event_id", dates.millis_to_text(F.unix_millis("ts"), "GMT+8").alias("local"), F.unix_timestamp("ts").alias("seconds"))


@query("dat03_epoch_day", "SELECT c_custkey, DATE '1970-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS birthday FROM customer")
def dat03(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", dates.epoch_day(F.col("c_custkey") % 20000).alias("birthday"))


@query("dat04_truncate", "SELECT event_id, date_trunc('hour', ts) AS h, date_trunc('day', ts) AS d FROM events")
def dat04(spark, sf):
    return T(spark, sf, "events").select("event_id", F.date_trunc("hour", "ts").alias("h"), F.date_trunc("day", "ts").alias("d"))


@query("mth01_arithmetic", "SELECT event_id, CAST(floor(value) AS BIGINT) AS f, abs(event_id - 5000) AS dist, least(event_id, 100) AS small FROM events")
def mth01(spark, sf):
    return T(spark, sf, "events").select("event_id", F.floor("value").alias("f"), F.abs(F.col("event_id") - 5000).alias("dist"), F.least("event_id", F.lit(100).cast("long")).alias("small"))


@query("mth02_amount_parsing", """
SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE CAST(event_id AS DECIMAL(18,2)) / 4 END AS DECIMAL(18,2)) AS amount FROM events
""")
def mth02(spark, sf):
    raw = F.when(F.col("event_id") % 3 == 0, "bad").otherwise((F.col("event_id").cast("decimal(18,2)") / 4).cast("string"))
    return T(spark, sf, "events").select("event_id", numbers.parse_amount(raw).alias("amount"))


@query("mth03_casts", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(16,2)) AS money, TRY_CAST(o_orderpriority AS BIGINT) AS bad, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS good FROM orders")
def mth03(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", numbers.money(F.col("o_totalprice")).alias("money"), F.col("o_orderpriority").try_cast("bigint").alias("bad"), F.substring("o_orderpriority", 1, 1).cast("bigint").alias("good"))


@query("mth04_haversine", """
SELECT c_custkey, round(2 * 6371008.8::DOUBLE * asin(sqrt(power(sin(radians((c_custkey % 90)::DOUBLE) / 2), 2))), 1) AS metres FROM customer
""")
def mth04(spark, sf):
    lat = (F.col("c_custkey") % 90).cast("double")
    return T(spark, sf, "customer").select("c_custkey", F.round(geo.haversine(F.lit(0.0), F.lit(10.0), lat, F.lit(10.0)), 1).alias("metres"))


@query("arr01_explode", "SELECT o_orderkey, unnest([1, 7, 30]) AS recent_days FROM orders")
def arr01(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", F.explode(F.array(F.lit(1), F.lit(7), F.lit(30))).alias("recent_days"))


@query("jsn01_json_paths", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def jsn01(spark, sf):
    return T(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("jsn02_json_tuple", "SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing FROM events")
def jsn02(spark, sf):
    return T(spark, sf, "events").select("event_id", F.json_tuple("props", "k", "missing").alias("k", "missing"))


@query("jsn03_dirty_json", "SELECT event_id, CASE WHEN event_id % 8 = 0 THEN true ELSE false END AS is_dirty, CASE WHEN event_id % 8 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events")
def jsn03(spark, sf):
    v = F.when(F.col("event_id") % 8 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    return parse_records(T(spark, sf, "events").withColumn("v", v), "v", "k bigint").select("event_id", "is_dirty", F.col("rec.k").alias("k"))


@query("jsn05_flatten_struct", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def jsn05(spark, sf):
    from saltmarsh.functions.documents import flatten_struct

    e = T(spark, sf, "events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    return flatten_struct(e, "p")


@query("win06_mean_over_partition_check", "SELECT count(*) AS n FROM part")
def win06_check(spark, sf):
    """The join-back mean equals the window mean for every part of a brand."""
    from saltmarsh.operators.relations import with_group_mean

    p = T(spark, sf, "part").select("p_partkey", "p_brand", F.col("p_size").cast("decimal(16,2)").alias("size"))
    both = with_group_mean(p, ["p_brand"], ["size"], "_avg_").withColumn("w", F.avg("size").over(Window.partitionBy("p_brand")))
    return both.filter(F.col("w") == F.col("_avg_size")).agg(rows().alias("n"))
