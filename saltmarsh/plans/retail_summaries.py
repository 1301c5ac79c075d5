"""Day, n-day and to-date summaries of the shop.

Facts are aggregated before any dimension is joined, so joins see summary rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.numbers import money
from saltmarsh.operators.horizons import horizon_sums, to_date

CATEGORY_COLUMNS = [
    "category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name",
]
SKU_COLUMNS = ["sku_name", *CATEGORY_COLUMNS, "tm_id", "tm_name"]
PROVINCE_COLUMNS = ["province_name", "area_code", "iso_code", "iso_3166_2"]
COUPON_COLUMNS = ["coupon_name", "coupon_type_code", "coupon_type_name", "benefit_rule"]


def _attach(df: DataFrame, dim: DataFrame | None, on: str, columns: list[str]) -> DataFrame:
    """Left join the wanted dimension columns that exist."""
    if dim is None:
        return df
    have = [c for c in columns if c in dim.columns]
    side = dim.select(F.col("id").alias("_d"), *have)
    return df.join(side, F.col(on) == F.col("_d"), "left").drop("_d")


def _amount_sums(suffix: str) -> dict[str, Column]:
    return {
        "order_original_amount" + suffix: money(F.sum("split_original_amount")),
        "activity_reduce_amount" + suffix: money(F.sum(F.coalesce("split_activity_amount", F.lit(0)))),
        "coupon_reduce_amount" + suffix: money(F.sum(F.coalesce("split_coupon_amount", F.lit(0)))),
        "order_total_amount" + suffix: money(F.sum("split_total_amount")),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in columns.items()]


def province_order_1d(detail: DataFrame, province: DataFrame | None = None) -> DataFrame:
    """Orders of a day by province (distinct orders, not lines)."""
    base = detail.groupBy("dt", "province_id").agg(
        F.count_distinct("order_id").alias("order_count_1d"), *_named(_amount_sums("_1d"))
    )
    return _attach(base, province, "province_id", PROVINCE_COLUMNS)


ORDER_MEASURES = [
    "order_count", "order_original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_total_amount",
]


def province_order_nd(daily: DataFrame, as_of: Column, horizons=(7, 30)) -> DataFrame:
    keys = ["province_id", *[c for c in PROVINCE_COLUMNS if c in daily.columns]]
    measures = {m: F.col(m + "_1d") for m in ORDER_MEASURES}
    return horizon_sums(daily, keys, "dt", as_of, measures, horizons)


def sku_favourite_1d(favourites: DataFrame, sku: DataFrame | None = None) -> DataFrame:
    base = favourites.groupBy("dt", "sku_id").agg(F.count(F.lit(1)).alias("favor_add_count_1d"))
    return _attach(base, sku, "sku_id", SKU_COLUMNS)


def user_coupon_used_1d(used: DataFrame, coupon: DataFrame | None = None) -> DataFrame:
    base = used.groupBy("dt", "user_id", "coupon_id").agg(F.count(F.lit(1)).alias("used_count_1d"))
    return _attach(base, coupon, "coupon_id", COUPON_COLUMNS)


def user_cart_add_1d(cart_adds: DataFrame) -> DataFrame:
    return cart_adds.groupBy("dt", "user_id").agg(
        F.count(F.lit(1)).alias("cart_add_count_1d"), F.sum("sku_num").alias("cart_add_num_1d")
    )


def user_order_1d(detail: DataFrame) -> DataFrame:
    return detail.groupBy("dt", "user_id").agg(
        F.count_distinct("order_id").alias("order_count_1d"),
        F.sum("sku_num").alias("order_num_1d"),
        *_named(_amount_sums("_1d")),
    )


def user_order_td(daily: DataFrame) -> DataFrame:
    sums = {
        "order_count_td": F.col("order_count_1d"),
        "order_num_td": F.col("order_num_1d"),
        "original_amount_td": F.col("order_original_amount_1d"),
        "activity_reduce_amount_td": F.col("activity_reduce_amount_1d"),
        "coupon_reduce_amount_td": F.col("coupon_reduce_amount_1d"),
        "total_amount_td": F.col("order_total_amount_1d"),
    }
    return to_date(daily, ["user_id"], "dt", sums, "order_date_first", "order_date_last")


def user_payment_1d(paid: DataFrame) -> DataFrame:
    return paid.groupBy("dt", "user_id").agg(
        F.count_distinct("order_id").alias("payment_count_1d"),
        F.sum("sku_num").alias("payment_num_1d"),
        money(F.sum("split_total_amount")).alias("payment_amount_1d"),
    )


def user_sku_order_1d(detail: DataFrame, sku: DataFrame | None = None) -> DataFrame:
    base = detail.groupBy("dt", "user_id", "sku_id").agg(
        F.count(F.lit(1)).alias("order_count_1d"),
        F.sum("sku_num").alias("order_num_1d"),
        *_named(_amount_sums("_1d")),
    )
    return _attach(base, sku, "sku_id", SKU_COLUMNS)


def user_sku_order_nd(daily: DataFrame, as_of: Column, horizons=(7, 30)) -> DataFrame:
    keys = ["user_id", "sku_id", *[c for c in SKU_COLUMNS if c in daily.columns]]
    measures = {m: F.col(m + "_1d") for m in ["order_count", "order_num", *ORDER_MEASURES[1:]]}
    return horizon_sums(daily, keys, "dt", as_of, measures, horizons)


def device_page_view_1d(page_views: DataFrame) -> DataFrame:
    keys = [c for c in ("dt", "mid_id", "brand", "model", "operate_system", "page_id") if c in page_views.columns]
    return page_views.groupBy(*keys).agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("view_count_1d")
    )


def session_page_view_1d(page_views: DataFrame) -> DataFrame:
    names = ("dt", "session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel")
    keys = [c for c in names if c in page_views.columns]
    return page_views.groupBy(*keys).agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("page_count_1d")
    )


def user_login_td(users: DataFrame, logins: DataFrame) -> DataFrame:
    """Every known user; without a login the registration counts as the first one."""
    seen = logins.groupBy(F.col("user_id").alias("_u")).agg(
        F.max("dt").alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    registered = F.col("create_time").cast("date")
    return users.join(seen, F.col("id") == F.col("_u"), "left").select(
        F.col("id").alias("user_id"),
        F.coalesce("_last", registered).alias("login_date_last"),
        registered.alias("login_date_first"),
        F.coalesce("_n", F.lit(1).cast("long")).alias("login_count_td"),
    )
