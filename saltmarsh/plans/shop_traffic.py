"""Shop traffic: cleaned detail, hourly summaries and reports.

Each function works on batch frames and, where it only projects and filters, on
streaming frames as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saltmarsh.functions.numbers import ratio
from saltmarsh.operators.quality import valid_rows
from saltmarsh.operators.ranking import top_n_rows
from saltmarsh.operators.relations import align

DEFAULT_SHOP = 10001
CROWD_TYPES = ["shop_entry", "product_visit", "conversion"]


def _hour(millis: str) -> Column:
    return F.date_trunc("hour", F.timestamp_millis(F.col(millis)))


def _day(millis: str) -> Column:
    return F.date_trunc("day", F.timestamp_millis(F.col(millis)))


def _shop(df: DataFrame) -> Column:
    return F.col("shop_id") if "shop_id" in df.columns else F.lit(DEFAULT_SHOP).cast("long").alias("shop_id")


def visit_detail(log: DataFrame) -> DataFrame:
    rows = valid_rows(log, text_keys=["visitor_id"], not_null=["visit_time"])
    return rows.select("*", _hour("visit_time").alias("stat_time"), *([] if "shop_id" in log.columns else [_shop(log)]))


def interaction_detail(log: DataFrame) -> DataFrame:
    rows = log.filter(F.coalesce(F.col("is_cancel").cast("int"), F.lit(0)) != 1)
    return rows.select("*", _hour("interact_time").alias("stat_time"), *([] if "shop_id" in log.columns else [_shop(log)]))


def pay_detail(log: DataFrame, paid_code: int = 1) -> DataFrame:
    rows = log.filter(F.col("is_paid").cast("int") == paid_code)
    return rows.select(
        "*", _hour("pay_time").alias("stat_time"), F.lit(1).alias("pay_quantity"),
        *([] if "shop_id" in log.columns else [_shop(log)]),
    )


def search_detail(log: DataFrame) -> DataFrame:
    rows = valid_rows(log, text_keys=["keyword"], not_null=["search_time"])
    return rows.select(
        "*", _hour("search_time").alias("stat_time"), F.lit("day").alias("stat_dimension"),
        *([] if "shop_id" in log.columns else [_shop(log)]),
    )


def page_click_detail(log: DataFrame) -> DataFrame:
    rows = valid_rows(log, not_null=["page_id", "click_time"])
    return rows.select("*", _hour("click_time").alias("stat_time"), *([] if "shop_id" in log.columns else [_shop(log)]))


def crowd_detail(log: DataFrame) -> DataFrame:
    rows = valid_rows(log, text_keys=["visitor_id"], not_null=["update_time"])
    return rows.select("*", _day("update_time").alias("stat_time"), *([] if "shop_id" in log.columns else [_shop(log)]))


GRAIN = ["stat_time", "terminal_type", "shop_id"]


def overview(visits: DataFrame, interactions: DataFrame, pays: DataFrame) -> DataFrame:
    """Visitors, views, new and old visitors, collections and payments per hour.

    Visits are reduced to one row per visitor first, so the four distinct
    visitor counts are sums and a hot shop spreads over its visitors.
    """
    kind = F.col("visit_object_type")
    shop, product = kind == "shop", kind == "product"
    per_visitor = visits.groupBy(*GRAIN, "visitor_id").agg(
        F.max(F.when(shop, 1).otherwise(0)).alias("_shop"),
        F.max(F.when(product, 1).otherwise(0)).alias("_product"),
        F.max(F.when(shop & (F.col("is_new_visitor") == 1), 1).otherwise(0)).alias("_new"),
        F.sum(F.when(shop, F.col("page_view"))).alias("_shop_pv"),
        F.sum(F.when(product, F.col("page_view"))).alias("_product_pv"),
    )
    v = per_visitor.groupBy(*GRAIN).agg(
        F.sum("_shop").alias("shop_visitor_count"),
        F.coalesce(F.sum("_shop_pv"), F.lit(0)).cast("long").alias("shop_page_view"),
        F.sum("_new").alias("new_visitor_count"),
        F.sum(F.col("_shop") - F.col("_new")).alias("old_visitor_count"),
        F.sum("_product").alias("product_visitor_count"),
        F.coalesce(F.sum("_product_pv"), F.lit(0)).cast("long").alias("product_page_view"),
    )
    c = interactions.filter(F.col("interact_type") == "collect").groupBy(*GRAIN).agg(
        F.count(F.lit(1)).alias("add_collection_count")
    )
    p = pays.groupBy(*GRAIN).agg(
        F.count_distinct("buyer_id").alias("pay_buyer_count"),
        F.sum(F.col("pay_amount").cast("decimal(18,2)")).cast("decimal(20,2)").alias("pay_amount"),
    )
    return align({"v": v, "c": c, "p": p}, GRAIN).fillna(0)


def overview_report(summary: DataFrame) -> DataFrame:
    """Overview with the payment conversion of shop visitors."""
    return summary.withColumn(
        "pay_conversion_rate", ratio(F.col("pay_buyer_count"), F.col("shop_visitor_count"), 4, 0.0)
    )


SOURCE_KEYS = ["traffic_source_first", "traffic_source_second"]


def source_summary(visits: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    product = F.max(F.when(F.col("visit_object_type") == "product", 1).otherwise(0))
    per_visitor = visits.groupBy(*grain, *SOURCE_KEYS, "visitor_id").agg(product.alias("_p"))
    return per_visitor.groupBy(*grain, *SOURCE_KEYS).agg(
        F.count("visitor_id").alias("visitor_count"), F.sum("_p").alias("product_visitor_count")
    )


def keyword_summary(searches: DataFrame) -> DataFrame:
    """Searchers and clicking searchers per day and keyword."""
    keys = ["stat_date", "stat_dimension", "terminal_type", "shop_id", "keyword"]
    clicked = F.max(F.when(F.col("is_click_result") == 1, 1).otherwise(0))
    rows = searches.withColumn("stat_date", F.to_date("stat_time"))
    per_visitor = rows.groupBy(*keys, "visitor_id").agg(clicked.alias("_c"))
    return per_visitor.groupBy(*keys).agg(
        F.count("visitor_id").alias("search_visitor_count"), F.sum("_c").alias("click_visitor_count")
    )


def product_summary(visits: DataFrame, interactions: DataFrame, pays: DataFrame) -> DataFrame:
    keys = [*GRAIN, "product_id"]
    v = (
        visits.filter(F.col("visit_object_type") == "product")
        .withColumn("product_id", F.col("visit_object_id"))
        .groupBy(*keys)
        .agg(
            F.count_distinct("visitor_id").alias("visitor_count"),
            F.sum("page_view").cast("long").alias("page_view"),
            F.round(F.avg("stay_time"), 4).alias("avg_stay_time"),
        )
    )
    i = interactions.groupBy(*keys).agg(
        F.count(F.when(F.col("interact_type") == "cart", 1)).alias("add_cart_count"),
        F.count(F.when(F.col("interact_type") == "collect", 1)).alias("collection_count"),
    )
    p = pays.groupBy(*keys).agg(
        F.count_distinct("buyer_id").alias("pay_buyer_count"),
        F.sum(F.col("pay_amount").cast("decimal(18,2)")).cast("decimal(20,2)").alias("pay_amount"),
    )
    return align({"v": v, "i": i, "p": p}, keys).fillna(0)


def page_summary(visits: DataFrame, clicks: DataFrame) -> DataFrame:
    keys = [*GRAIN, "page_id"]
    v = (
        visits.filter(F.col("visit_object_type") == "page")
        .withColumn("page_id", F.col("visit_object_id"))
        .groupBy(*keys)
        .agg(
            F.count_distinct("visitor_id").alias("visitor_count"),
            F.sum("page_view").cast("long").alias("page_view"),
            F.round(F.avg("stay_time"), 4).alias("avg_stay_time"),
        )
    )
    c = clicks.groupBy(*keys).agg(F.count(F.lit(1)).alias("click_count"))
    return align({"v": v, "c": c}, keys).fillna(0)


CROWD_KEYS = ["stat_time", "terminal_type", "shop_id", "crowd_type", "gender", "age_range", "city", "taoqi_value"]


def crowd_summary(crowd: DataFrame) -> DataFrame:
    """People per attribute group, for the three crowd types.

    Groups are counted once and the counted rows are unfolded, not the people.
    """
    grain = ["stat_time", "shop_id", "gender", "age_range", "city", "taoqi_value"]
    counted = crowd.groupBy(*grain).agg(F.count(F.lit(1)).alias("crowd_count"))
    kinds = F.explode(F.array(*[F.lit(k) for k in CROWD_TYPES])).alias("crowd_type")
    return counted.select("*", F.lit("overall").alias("terminal_type"), kinds).select(*CROWD_KEYS, "crowd_count")


def crowd_report(summary: DataFrame) -> DataFrame:
    """Share of each group in its time, terminal, shop and crowd type."""
    keys = CROWD_KEYS[:4]
    total = summary.groupBy(*keys).agg(F.sum("crowd_count").alias("total_crowd_count"))
    return summary.join(total, keys, "inner").withColumn(
        "crowd_ratio", ratio(F.col("crowd_count"), F.col("total_crowd_count"), 4, 0.0)
    )


def ranked(summary: DataFrame, window: list[str], keys: list[str], measure: str, n: int = 10) -> DataFrame:
    """Top ``n`` per window; rows of one key are summed before, ties go by key."""
    measures = [c for c in summary.columns if c not in (*window, *keys) and not c.startswith("avg_")]
    per_key = summary.groupBy(*window, *keys).agg(*[F.sum(m).alias(m) for m in measures])
    return top_n_rows(per_key, window, [F.col(measure).desc(), *[F.col(k) for k in keys]], n)


def product_ranking(summary: DataFrame, n: int = 10) -> DataFrame:
    out = ranked(summary, GRAIN, ["product_id"], "visitor_count", n)
    return out.withColumn("pay_conversion_rate", ratio(F.col("pay_buyer_count"), F.col("visitor_count"), 4, 0.0))


def page_ranking(summary: DataFrame, n: int = 10) -> DataFrame:
    return ranked(summary, GRAIN, ["page_id"], "visitor_count", n)


def keyword_ranking(summary: DataFrame, n: int = 10) -> DataFrame:
    window = ["stat_date", "stat_dimension", "terminal_type", "shop_id"]
    return ranked(summary, window, ["keyword"], "search_visitor_count", n)


def source_ranking(summary: DataFrame, n: int = 10) -> DataFrame:
    return ranked(summary, GRAIN, SOURCE_KEYS, "visitor_count", n)


# -- designed report tables ----------------------------------------------------


def channel_day_report(page_views: DataFrame) -> DataFrame:
    """Views, visitors, sessions and mean stay per day and channel."""
    per_session = page_views.groupBy("dt", "channel", "mid_id", "session_id").agg(
        F.count(F.lit(1)).alias("_pv"), F.sum("during_time").alias("_t")
    )
    per_visitor = per_session.groupBy("dt", "channel", "mid_id").agg(
        F.sum("_pv").alias("_pv"), F.count(F.lit(1)).alias("_sv"), F.sum("_t").alias("_t")
    )
    return per_visitor.groupBy(F.col("dt").alias("stat_date"), "channel").agg(
        F.sum("_pv").alias("pv"), F.count("mid_id").alias("uv"), F.sum("_sv").alias("sv"),
        F.round(F.sum("_t").cast("double") / F.sum("_pv"), 2).alias("avg_duration"),
    )


def daily_sales_top(detail: DataFrame, n: int = 10) -> DataFrame:
    per = detail.groupBy(F.col("dt").alias("stat_date"), "sku_id", "sku_name").agg(
        F.sum("split_total_amount").cast("decimal(20,2)").alias("sale_amount")
    )
    return top_n_rows(per, ["stat_date"], [F.col("sale_amount").desc(), F.col("sku_id")], n, "rank")


def activity_rate(active: DataFrame, registered: DataFrame) -> DataFrame:
    """New users, active users and active over all users known by the day."""
    known = active.groupBy("dt").agg(F.count_distinct("user_id").alias("active_user_ct"))
    new = registered.groupBy("dt").agg(F.count_distinct("user_id").alias("new_user_ct"))
    both = align({"a": known, "n": new}, ["dt"]).fillna(0)
    # one row per day, so the running total is a window over the calendar
    running = F.sum("new_user_ct").over(Window.orderBy("dt"))
    return both.select(
        F.col("dt").alias("stat_date"), "new_user_ct", "active_user_ct",
        ratio(F.col("active_user_ct") * 100, running, 2, 0.0).alias("active_rate"),
    )
