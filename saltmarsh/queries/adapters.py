"""The shared test tables in the shapes the plans expect.

All functions are lazy projections and joins of whole tables, so the work of a
query grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.functions.dates import in_days
from saltmarsh.functions.numbers import money

# Report days: the last full days the tables cover.
SHOP_DAY = "2001-07-31"
EVENT_DAY = "2024-01-30"


# Columns of the shared tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A shared table with a declared schema, so no file is opened to plan a query."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def day(text: str):
    return F.lit(text).cast("date")


# -- shop -----------------------------------------------------------------------


def line_id():
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def order_info(spark, sf) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
        F.col("c_nationkey").alias("province_id"), F.col("o_orderdate").alias("create_time"),
        F.col("o_orderstatus").alias("order_status"), money(F.col("o_totalprice")).alias("total_amount"),
        money(F.col("o_totalprice")).alias("original_total_amount"),
        money(F.lit(0)).alias("activity_reduce_amount"), money(F.lit(0)).alias("coupon_reduce_amount"),
        F.col("o_orderpriority").alias("order_priority"),
    )


def order_detail(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        line_id().alias("id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.col("l_shipdate").alias("create_time"), F.col("l_quantity").cast("long").alias("sku_num"),
        money(F.col("l_extendedprice")).alias("order_price"),
        F.when(F.col("l_returnflag") == "R", money(F.col("l_discount"))).alias("split_activity_amount"),
        F.when(F.col("l_linestatus") == "F", money(F.col("l_tax"))).alias("split_coupon_amount"),
        money(F.col("l_extendedprice")).alias("split_total_amount"),
    )


def detail_activity(spark, sf) -> DataFrame:
    rows = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    return rows.groupBy(line_id().alias("order_detail_id")).agg(
        F.min("l_suppkey").alias("activity_id"), F.max("l_suppkey").alias("activity_rule_id")
    )


def detail_coupon(spark, sf) -> DataFrame:
    rows = table(spark, sf, "lineitem").filter(F.col("l_linestatus") == "F")
    return rows.groupBy(line_id().alias("order_detail_id")).agg(F.min("l_partkey").alias("coupon_id"))


def payments(spark, sf) -> DataFrame:
    """Orders that are not open, paid at their first shipment."""
    l = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("callback_time"))
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "O")
    return o.join(l, o.o_orderkey == l.l_orderkey).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.substring("o_orderpriority", 1, 1).alias("payment_type"), "callback_time",
        money(F.col("o_totalprice")).alias("total_amount"),
    )


def status_log(spark, sf) -> DataFrame:
    """Finished orders end at their last shipment."""
    l = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("operate_time"))
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return o.join(l, o.o_orderkey == l.l_orderkey).select(
        F.col("o_orderkey").alias("order_id"), F.lit("1004").alias("order_status"), "operate_time"
    )


def dictionary(spark, sf) -> DataFrame:
    """Code table: order priorities under parent 11, part types under 32, brands under 33."""
    o = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("dic_code"), F.col("o_orderpriority").alias("dic_name"),
        F.lit("11").alias("parent_code"),
    ).distinct()
    p = table(spark, sf, "part")
    t = p.select(F.col("p_type").alias("dic_code"), F.lower("p_type").alias("dic_name"), F.lit("32").alias("parent_code")).distinct()
    b = p.select(F.col("p_brand").alias("dic_code"), F.lower("p_brand").alias("dic_name"), F.lit("33").alias("parent_code")).distinct()
    return o.unionByName(t).unionByName(b)


def province(spark, sf) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region_id"),
        F.col("n_name").alias("iso_code"),
    )


def province_dim(spark, sf) -> DataFrame:
    return province(spark, sf).withColumnRenamed("name", "province_name")


def region(spark, sf) -> DataFrame:
    return table(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("region_name"))


def sku_dim(spark, sf) -> DataFrame:
    """Part as SKU with three category levels and a brand, without lookups."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
        F.substring("p_type", 1, 1).alias("category1_id"), F.col("p_type").alias("category2_id"),
        F.concat_ws("-", "p_type", "p_size").alias("category3_id"),
        F.col("p_brand").alias("tm_id"), F.lower("p_brand").alias("tm_name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


# -- events ---------------------------------------------------------------------


def events(spark, sf) -> DataFrame:
    return table(spark, sf, "events")


def page_views(spark, sf) -> DataFrame:
    """Events as page views: session = user and day, page and channel = event type."""
    return events(spark, sf).select(
        F.col("user_id").alias("mid_id"), F.col("user_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("session_id"),
        F.col("event_type").alias("page_id"), F.col("event_type").alias("channel"),
        F.to_date("ts").alias("dt"), "ts", "event_id",
        F.col("value").cast("decimal(16,2)").alias("during_time"),
    )


def user_days(spark, sf, kind: str | None = None) -> DataFrame:
    rows = events(spark, sf)
    rows = rows if kind is None else rows.filter(F.col("event_type") == kind)
    return rows.select("user_id", F.to_date("ts").alias("dt"))


def behaviour(spark, sf) -> DataFrame:
    """Events as the dashboards' behaviour log: ten stores, twenty items."""
    e = F.col("event_type")
    return events(spark, sf).select(
        F.col("user_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("session_id"),
        (F.col("user_id") % 10).alias("store_id"), (F.col("event_id") % 20).alias("item_id"),
        F.when(e == "click", "item_list").when(e == "view", "item_detail").when(e == "signup", "home")
        .when(e == "error", "search_result").otherwise("content").alias("page_type"),
        F.when(e == "purchase", "payment").when(e == "click", "add_to_cart").when(e == "error", "search")
        .when(e == "signup", "payment_success").otherwise("view").alias("event_type"),
        F.get_json_object("props", "$.k").cast("int").alias("search_rank"),
        F.floor("value").cast("int").alias("duration"),
        (F.col("user_id") % 3 == 0).cast("int").alias("is_new_customer"),
        (F.col("event_id") % 2).cast("int").alias("repurchase_flag"),
        F.col("value").cast("decimal(10,2)").alias("acquisition_cost"),
        F.lit(1).alias("page_count"), F.to_date("ts").alias("dt"), "ts", "event_id",
    )


# -- logistics ------------------------------------------------------------------


def organs(spark, sf) -> DataFrame:
    """One organisation per nation; regions of even number hold level-1 organisations."""
    return table(spark, sf, "nation").select(
        (F.col("n_nationkey") + 1000).alias("id"), F.concat(F.lit("ORG_"), F.col("n_name")).alias("org_name"),
        F.when(F.col("n_regionkey") % 2 == 0, 1).otherwise(2).alias("org_level"),
        F.col("n_nationkey").alias("region_id"), (F.col("n_regionkey") + 1000).alias("org_parent_id"),
    )


def places(spark, sf) -> DataFrame:
    """Place tree: nation (district) -> region (city) -> continent group (province)."""
    n = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), (F.col("n_regionkey") + 100).alias("parent_id"),
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("dict_code"), F.col("n_name").alias("short_name"),
    )
    r = table(spark, sf, "region").select(
        (F.col("r_regionkey") + 100).alias("id"), F.col("r_name").alias("name"),
        (F.col("r_regionkey") % 2 + 200).alias("parent_id"),
        F.concat(F.lit("R"), F.col("r_regionkey")).alias("dict_code"), F.col("r_name").alias("short_name"),
    )
    top = table(spark, sf, "region").select(
        (F.col("r_regionkey") % 2 + 200).alias("id"), F.concat(F.lit("TOP_"), F.col("r_regionkey") % 2).alias("name"),
        F.lit(None).cast("int").alias("parent_id"), F.concat(F.lit("T"), F.col("r_regionkey") % 2).alias("dict_code"),
        F.lit(None).cast("string").alias("short_name"),
    ).distinct()
    return n.unionByName(r).unionByName(top)


def cargo(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        line_id().alias("id"), F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("cargo_type"),
        F.col("l_quantity").cast("decimal(16,2)").alias("weight"), F.lit("0").alias("is_deleted"),
        F.col("l_shipdate").alias("create_time"),
    )


def parcel_orders(spark, sf) -> DataFrame:
    """Orders as parcels: status from the order status, places from customer and key."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    s = F.col("o_orderstatus")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("N"), F.col("o_orderkey")).alias("order_no"),
        F.when(s == "F", "60070").when(s == "P", "60050").otherwise(
            F.when(F.col("o_orderkey") % 2 == 0, "60030").otherwise("60020")
        ).alias("status"),
        F.substring("o_orderpriority", 1, 1).alias("collect_type"), F.col("o_custkey").alias("user_id"),
        F.col("c_nationkey").alias("sender_district_id"), F.col("c_nationkey").alias("sender_city_id"),
        (F.col("o_orderkey") % 25).cast("int").alias("receiver_district_id"),
        F.col("c_name").alias("sender_name"), F.col("c_name").alias("receiver_name"),
        money(F.col("o_totalprice")).alias("amount"), F.col("o_orderdate").alias("update_time"),
        F.lit("0").alias("is_deleted"),
    )


def parcel_dictionary(spark, sf) -> DataFrame:
    l = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("id"), F.concat(F.lit("cargo "), F.col("l_returnflag")).alias("name")
    ).distinct()
    o = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("id"), F.col("o_orderpriority").alias("name")
    ).distinct()
    return l.unionByName(o)


def shipped_around(spark, sf, days) -> DataFrame:
    """Order lines shipped from a day before ``days`` to their last day; tasks and scans of ``days`` begin at most hours before."""
    l = table(spark, sf, "lineitem")
    return l if days is None else l.filter(in_days(l, "l_shipdate", F.date_sub(days[0], 1), days[1]))


def transport_tasks(spark, sf, days=None) -> DataFrame:
    """Order lines as transport tasks of a supplier's truck."""
    l, s = shipped_around(spark, sf, days), table(spark, sf, "supplier")
    start = F.unix_millis("l_shipdate")
    return l.join(s, l.l_suppkey == s.s_suppkey, "left").select(
        line_id().alias("id"), (F.col("l_partkey") % 50).alias("shift_id"), (F.col("l_partkey") % 10).alias("line_id"),
        (F.col("s_nationkey") + 1000).alias("start_org_id"),
        F.concat(F.lit("ORG_NATION_"), F.col("s_nationkey")).alias("start_org_name"),
        F.col("l_suppkey").alias("driver1_emp_id"), F.concat(F.lit("d"), F.col("l_suppkey")).alias("driver1_name"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey") + 1).alias("driver2_emp_id"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("d"), F.col("l_suppkey") + 1)).alias("driver2_name"),
        F.col("l_suppkey").alias("truck_id"), F.concat(F.lit("P"), F.col("l_suppkey")).alias("truck_no"),
        start.alias("actual_start_time"), (start + F.col("l_quantity").cast("long") * 60000).alias("actual_end_time"),
        F.col("l_quantity").cast("decimal(16,2)").alias("actual_distance"), F.col("l_linenumber").cast("long").alias("order_num"),
        F.lit("0").alias("is_deleted"),
    )


def transports(spark, sf, days=None) -> DataFrame:
    """Finished transports in the shape of the fact."""
    from saltmarsh.plans.logistics import transport_finish_fact

    return transport_finish_fact(transport_tasks(spark, sf, days), days=days)


def trucks(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), (F.col("s_nationkey") % 3).alias("truck_model_type"),
        F.concat(F.lit("model "), F.col("s_nationkey") % 3).alias("truck_model_type_name"),
    )


def shift_lines(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        (F.col("p_partkey") % 50).alias("id"), F.concat(F.lit("line "), F.col("p_partkey") % 10).alias("line_name")
    ).distinct()
