"""Detail facts of the shop: trade, tool, traffic and user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.dates import OPEN_END
from saltmarsh.functions.documents import LOG_RECORD, parse_records
from saltmarsh.functions.numbers import money
from saltmarsh.operators.ranking import first_per_key
from saltmarsh.operators.relations import dealt, decode

ORDER_FINISHED = "1004"
PAY_TYPE_PARENT = "11"
LOG_ZONE = "GMT+8"


def _day(ts: Column) -> Column:
    return ts.cast("date")


def _with_promotions(detail: DataFrame, activity: DataFrame | None, coupon: DataFrame | None) -> DataFrame:
    out = detail
    if activity is not None:
        side = activity.select(
            F.col("order_detail_id").alias("_a"), "activity_id", "activity_rule_id"
        )
        out = out.join(side, F.col("id") == F.col("_a"), "left").drop("_a")
    if coupon is not None:
        side = coupon.select(F.col("order_detail_id").alias("_c"), "coupon_id")
        out = out.join(side, F.col("id") == F.col("_c"), "left").drop("_c")
    return out


def _amounts() -> list[Column]:
    return [
        F.col("sku_num"),
        money(F.col("sku_num") * F.col("order_price")).alias("split_original_amount"),
        F.coalesce(money(F.col("split_activity_amount")), money(F.lit(0))).alias("split_activity_amount"),
        F.coalesce(money(F.col("split_coupon_amount")), money(F.lit(0))).alias("split_coupon_amount"),
        money(F.col("split_total_amount")).alias("split_total_amount"),
    ]


def order_detail_fact(
    order_detail: DataFrame, order_info: DataFrame,
    activity: DataFrame | None = None, coupon: DataFrame | None = None, spread: bool = False,
) -> DataFrame:
    """Order lines with buyer, province, activity and coupon.

    With ``spread`` the lines are dealt by order for a summary that groups them.
    """
    order_detail = dealt(order_detail, "order_id") if spread else order_detail
    info = order_info.select(F.col("id").alias("_oid"), "user_id", "province_id")
    joined = order_detail.join(info, F.col("order_id") == F.col("_oid"), "left").drop("_oid")
    joined = _with_promotions(joined, activity, coupon)
    extra = (["activity_id", "activity_rule_id"] if activity is not None else []) + (
        ["coupon_id"] if coupon is not None else []
    )
    return joined.select(
        "id", "order_id", "user_id", "sku_id", "province_id", *extra,
        _day(F.col("create_time")).alias("dt"), "create_time", *_amounts(),
    )


def paid_detail_fact(
    order_detail: DataFrame, payment: DataFrame, order_info: DataFrame, dictionary: DataFrame,
    activity: DataFrame | None = None, coupon: DataFrame | None = None, spread: bool = False,
) -> DataFrame:
    """Lines of paid orders with the payment type decoded; with ``spread`` dealt by order for a summary that groups them."""
    order_detail = dealt(order_detail, "order_id") if spread else order_detail
    pay = payment.select(F.col("order_id").alias("_po"), "user_id", "payment_type", "callback_time")
    info = order_info.select(F.col("id").alias("_oid"), "province_id")
    joined = (
        order_detail.join(pay, F.col("order_id") == F.col("_po"), "inner")
        .join(info, F.col("order_id") == F.col("_oid"), "left")
        .drop("_po", "_oid")
    )
    joined = _with_promotions(joined, activity, coupon)
    joined = decode(joined, dictionary, "payment_type", "payment_type_name", PAY_TYPE_PARENT)
    extra = (["activity_id", "activity_rule_id"] if activity is not None else []) + (
        ["coupon_id"] if coupon is not None else []
    )
    return joined.select(
        "id", "order_id", "user_id", "sku_id", "province_id", *extra,
        F.col("payment_type").alias("payment_type_code"), "payment_type_name",
        _day(F.col("callback_time")).alias("dt"), "callback_time", *_amounts(),
    )


def trade_flow(order_info: DataFrame, payment: DataFrame, status_log: DataFrame) -> DataFrame:
    """Accumulating snapshot of an order: placed, paid, finished.

    Open steps carry the open date; ``dt`` is the finish day or the open date.
    """
    pay = payment.select(
        F.col("order_id").alias("_p"), "callback_time", F.col("total_amount").alias("_paid")
    )
    done = status_log.filter(F.col("order_status") == ORDER_FINISHED).select(
        F.col("order_id").alias("_f"), F.col("operate_time").alias("finish_time")
    )
    open_day = F.lit(OPEN_END).cast("date")
    finish_day = F.coalesce(_day(F.col("finish_time")), open_day)
    return (
        order_info.join(pay, F.col("id") == F.col("_p"), "left")
        .join(done, F.col("id") == F.col("_f"), "left")
        .select(
            F.col("id").alias("order_id"),
            "user_id",
            "province_id",
            _day(F.col("create_time")).alias("order_date_id"),
            F.col("create_time").alias("order_time"),
            F.coalesce(_day(F.col("callback_time")), open_day).alias("payment_date_id"),
            F.col("callback_time").alias("payment_time"),
            finish_day.alias("finish_date_id"),
            "finish_time",
            money(F.col("original_total_amount")).alias("order_original_amount"),
            money(F.col("activity_reduce_amount")).alias("order_activity_amount"),
            money(F.col("coupon_reduce_amount")).alias("order_coupon_amount"),
            money(F.col("total_amount")).alias("order_total_amount"),
            F.coalesce(money(F.col("_paid")), money(F.lit(0))).alias("payment_amount"),
            finish_day.alias("dt"),
        )
    )


def cart_add_fact(cart_info: DataFrame) -> DataFrame:
    return cart_info.select(
        "id", "user_id", "sku_id", _day(F.col("create_time")).alias("dt"), "create_time", "sku_num"
    )


def open_cart_fact(cart_info: DataFrame) -> DataFrame:
    """Cart rows that have not been ordered."""
    return cart_info.filter(F.col("is_ordered").cast("string") == "0").select(
        "id", "user_id", "sku_id", "sku_name", "sku_num"
    )


def coupon_used_fact(coupon_use: DataFrame) -> DataFrame:
    return coupon_use.filter(F.col("used_time").isNotNull()).select(
        "id", "coupon_id", "user_id", "order_id", _day(F.col("used_time")).alias("dt"), "used_time"
    )


def favourite_add_fact(favourites: DataFrame) -> DataFrame:
    return favourites.select("id", "user_id", "sku_id", _day(F.col("create_time")).alias("dt"), "create_time")


# Log field -> fact column.
COMMON_FIELDS = {
    "ar": "province_id", "ba": "brand", "ch": "channel", "is_new": "is_new", "md": "model",
    "mid": "mid_id", "os": "operate_system", "uid": "user_id", "vc": "version_code", "sid": "session_id",
}
PAGE_FIELDS = {
    "item": "page_item", "item_type": "page_item_type", "last_page_id": "last_page_id",
    "page_id": "page_id", "from_pos_id": "from_pos_id", "from_pos_seq": "from_pos_seq",
    "refer_id": "refer_id", "during_time": "during_time",
}


def _local(ts_millis: Column) -> Column:
    return F.from_utc_timestamp(F.timestamp_millis(ts_millis), LOG_ZONE)


def page_view_fact(logs: DataFrame, column: str = "log") -> DataFrame:
    """Page views from JSON log records, parsed once per record."""
    rec = parse_records(logs, column, LOG_RECORD).filter(~F.col("is_dirty") & F.col("rec.page").isNotNull())
    local = _local(F.col("rec.ts"))
    return rec.select(
        *[F.col(f"rec.common.{src}").alias(new) for src, new in COMMON_FIELDS.items()],
        *[F.col(f"rec.page.{src}").alias(new) for src, new in PAGE_FIELDS.items()],
        local.cast("date").alias("dt"),
        F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("view_time"),
        F.col("rec.ts").alias("ts"),
    )


def page_view_fact_by_path(logs: DataFrame, column: str = "log") -> DataFrame:
    """The same fact with path expressions and ``json_tuple``, for records of unknown shape."""
    base = logs.select(
        F.get_json_object(column, "$.common").alias("_common"),
        F.get_json_object(column, "$.page").alias("_page"),
        F.get_json_object(column, "$.ts").try_cast("long").alias("ts"),
    ).filter(F.col("_page").isNotNull())
    step = base.select("*", F.json_tuple("_common", *COMMON_FIELDS).alias(*COMMON_FIELDS.values()))
    step = step.select("*", F.json_tuple("_page", *PAGE_FIELDS).alias(*PAGE_FIELDS.values()))
    local = _local(F.col("ts"))
    return step.select(
        *COMMON_FIELDS.values(),
        *[c for c in PAGE_FIELDS.values() if c != "during_time"],
        F.col("during_time").try_cast("long").alias("during_time"),
        local.cast("date").alias("dt"),
        F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("view_time"),
        "ts",
    )


LOGIN_COLUMNS = ["channel", "province_id", "version_code", "mid_id", "brand", "model", "operate_system"]


def login_fact(page_views: DataFrame) -> DataFrame:
    """First page of each session that has a user."""
    rows = page_views.filter(F.col("user_id").isNotNull())
    first = first_per_key(rows, ["session_id"], [F.col("ts"), F.col("page_id"), F.col("user_id")])
    return first.select(
        "user_id", "dt", F.col("view_time").alias("login_time"), *LOGIN_COLUMNS
    )


def register_fact(user_info: DataFrame, page_views: DataFrame) -> DataFrame:
    """New users with the device of their registration page, if it was logged."""
    log = page_views.filter((F.col("page_id") == "register") & F.col("user_id").isNotNull()).select(
        F.col("user_id").alias("_u"), *LOGIN_COLUMNS
    )
    return user_info.select(F.col("id").cast("string").alias("user_id"), "create_time").join(
        log, F.col("user_id") == F.col("_u"), "left"
    ).select("user_id", F.col("create_time").cast("date").alias("dt"), "create_time", *LOGIN_COLUMNS)
