"""Report metrics of the shop; every function returns one small result frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.dates import OPEN_END
from saltmarsh.functions.numbers import exact_ratio
from saltmarsh.operators.horizons import HORIZONS, horizon_distinct, horizon_sums, recent, unfold, within
from saltmarsh.operators.ranking import (
    streak_by_bitmap,
    streak_by_islands,
    streak_by_lead,
    top_n,
)
from saltmarsh.operators.relations import one_row
from saltmarsh.operators.sequences import ordered_columns, time_slice
from saltmarsh.plans.retail_summaries import CATEGORY_COLUMNS, PROVINCE_COLUMNS


def _stamp(df: DataFrame, as_of: Column) -> DataFrame:
    return df.select(as_of.alias("dt"), *df.columns)


def coupon_stats(user_coupon_used: DataFrame, as_of: Column) -> DataFrame:
    """Uses and using users per coupon on the report day."""
    used = user_coupon_used.filter(F.col("dt") == as_of)
    keys = ["coupon_id", *[c for c in ("coupon_name",) if c in used.columns]]
    return _stamp(
        used.groupBy(*keys).agg(
            F.sum("used_count_1d").alias("used_count"), F.count(F.lit(1)).alias("used_user_count")
        ),
        as_of,
    )


def new_order_users(user_order_td: DataFrame, as_of: Column) -> DataFrame:
    """Users whose first order falls into the last 1, 7 and 30 days."""
    first = F.col("order_date_first")
    wide = user_order_td.agg(
        *[F.count(F.when(within(first, as_of, d), 1)).alias(f"new_order_user_count_{d}d") for d in HORIZONS]
    )
    return _stamp(unfold(wide, [], ["new_order_user_count"]), as_of)


def orders_by_province(daily: DataFrame, as_of: Column) -> DataFrame:
    """Orders and amount by province for 1, 7 and 30 days."""
    keys = ["province_id", *[c for c in PROVINCE_COLUMNS if c in daily.columns]]
    measures = {
        "order_count": F.col("order_count_1d"),
        "order_total_amount": F.col("order_total_amount_1d"),
        "_days": F.lit(1),
    }
    rows = unfold(horizon_sums(daily, keys, "dt", as_of, measures), keys, list(measures))
    # a one-day row exists only for provinces with orders on that day
    rows = rows.filter((F.col("recent_days") > 1) | (F.col("_days") > 0)).drop("_days")
    return _stamp(rows, as_of)


def consecutive_order_users(user_days: DataFrame, as_of: Column, method: str = "lead") -> DataFrame:
    """Users with three active days in a row within the last seven days.

    ``method``: ``lead``, ``islands``, ``bitmap``; ``near`` allows one missing day.
    """
    days = recent(user_days, "dt", as_of, 7).select("user_id", "dt").distinct()
    users = {
        "lead": lambda: streak_by_lead(days, "user_id", "dt"),
        "near": lambda: streak_by_lead(days, "user_id", "dt", span=3),
        "islands": lambda: streak_by_islands(days, "user_id", "dt"),
        "bitmap": lambda: streak_by_bitmap(days, "user_id", "dt", as_of),
    }[method]()
    counted = users.agg(F.count(F.lit(1)).alias("order_continuously_user_count"))
    return _stamp(counted.select(F.lit(7).alias("recent_days"), "order_continuously_user_count"), as_of)


def consecutive_order_users_all(user_days: DataFrame, as_of: Column) -> DataFrame:
    """The four variants stacked under their method name."""
    parts = [
        consecutive_order_users(user_days, as_of, m).withColumn("method", F.lit(m))
        for m in ("lead", "islands", "bitmap", "near")
    ]
    return reduce(DataFrame.unionByName, parts)


def order_stats_by(user_sku_daily: DataFrame, keys: list[str], as_of: Column) -> DataFrame:
    """Orders and distinct buyers by ``keys`` for 1, 7 and 30 days."""
    rows = horizon_distinct(
        user_sku_daily, keys, "user_id", "dt", as_of,
        {"order_count": F.col("order_count_1d")}, member_name="order_user_count",
    )
    rows = rows.filter((F.col("recent_days") > 1) | (F.col("order_count") > 0))
    return _stamp(rows.select("recent_days", *keys, "order_count", "order_user_count"), as_of)


def order_stats_by_category(user_sku_daily: DataFrame, as_of: Column) -> DataFrame:
    return order_stats_by(user_sku_daily, [c for c in CATEGORY_COLUMNS if c in user_sku_daily.columns], as_of)


def order_stats_by_brand(user_sku_daily: DataFrame, as_of: Column) -> DataFrame:
    return order_stats_by(user_sku_daily, ["tm_id", "tm_name"], as_of)


def order_to_pay_seconds(flow: DataFrame, as_of: Column) -> DataFrame:
    """Mean seconds from order to payment over orders paid by the report day."""
    gap = F.unix_timestamp("payment_time") - F.unix_timestamp("order_time")
    paid = flow.filter(
        (F.col("payment_date_id") <= as_of) & (F.col("payment_date_id") != F.lit(OPEN_END).cast("date"))
    )
    return _stamp(paid.agg(F.avg(gap).cast("long").alias("order_to_pay_interval_avg")), as_of)


def page_path(page_views: DataFrame, order: list[str], ts: str, slice_width: str = "hour") -> DataFrame:
    """Edges ``step-n:page -> step-n+1:page`` with counts; exits have target ``null``."""
    steps = ordered_columns(
        page_views, ["session_id"], order, time_slice(F.col(ts), slice_width),
        row_number="_step", following={"_next_page": "page_id"},
    )
    source = F.concat(F.lit("step-"), F.col("_step"), F.lit(":"), F.col("page_id"))
    target = F.concat(F.lit("step-"), F.col("_step") + 1, F.lit(":"), F.col("_next_page"))
    return (
        steps.select(source.alias("source"), F.coalesce(target, F.lit("null")).alias("target"))
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).alias("path_count"))
    )


def repeat_purchase_by_brand(user_sku_daily: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Users with at least two orders over users with at least one, per brand."""
    per_user = (
        recent(user_sku_daily, "dt", as_of, days)
        .groupBy("tm_id", "tm_name", "user_id")
        .agg(F.sum("order_count_1d").alias("_orders"))
    )
    again = F.count(F.when(F.col("_orders") >= 2, 1))
    once = F.count(F.when(F.col("_orders") >= 1, 1))
    rows = per_user.groupBy("tm_id", "tm_name").agg(exact_ratio(again, once).alias("order_repeat_rate"))
    return _stamp(rows.select(F.lit(days).alias("recent_days"), "tm_id", "tm_name", "order_repeat_rate"), as_of)


def top_cart_skus_by_category(open_carts: DataFrame, sku: DataFrame, n: int = 3) -> DataFrame:
    """Most carted SKUs per category; carts are summed before the SKU is joined."""
    per_sku = open_carts.groupBy("sku_id").agg(F.sum("sku_num").alias("cart_num"))
    wanted = [c for c in (*CATEGORY_COLUMNS, "sku_name") if c in sku.columns]
    side = sku.select(F.col("id").alias("_s"), *wanted)
    named = per_sku.join(side, F.col("sku_id") == F.col("_s"), "left").drop("_s")
    return top_n(named, [c for c in CATEGORY_COLUMNS if c in wanted and c.endswith("_id")], "cart_num", n)


def top_favourite_skus_by_brand(favourites: DataFrame, as_of: Column | None, n: int = 3) -> DataFrame:
    rows = favourites if as_of is None else favourites.filter(F.col("dt") == as_of)
    rows = rows.select("tm_id", "tm_name", "sku_id", "sku_name", "favor_add_count_1d")
    return top_n(rows, ["tm_id"], "favor_add_count_1d", n)


def traffic_by_channel(sessions: DataFrame, as_of: Column, millis: bool = True) -> DataFrame:
    """Visitors, mean stay, mean pages, sessions and bounce rate by channel.

    Sessions are first reduced to one row per (channel, device) with sums per
    horizon; all five metrics come from these rows, visitors by latest day.
    """
    seconds = F.col("during_time_1d") / 1000 if millis else F.col("during_time_1d")
    sums = {
        "_time": seconds.cast("double"),
        "_pages": F.col("page_count_1d"),
        "sv_count": F.lit(1).cast("long"),
        "_bounced": F.when(F.col("page_count_1d") == 1, 1).otherwise(0).cast("long"),
    }
    rows = horizon_distinct(sessions, ["channel"], "mid_id", "dt", as_of, sums, member_name="uv_count")
    n = F.col("sv_count")
    return _stamp(
        rows.filter(n > 0).select(
            "recent_days",
            "channel",
            "uv_count",
            (F.col("_time") / n).cast("long").alias("avg_duration_sec"),
            F.floor(F.col("_pages") / n).cast("long").alias("avg_page_count"),
            n.cast("long").alias("sv_count"),
            exact_ratio(F.col("_bounced"), n).alias("bounce_rate"),
        ),
        as_of,
    )


def user_actions(
    device_pages: DataFrame, cart_daily: DataFrame, order_daily: DataFrame, paid_daily: DataFrame, as_of: Column
) -> DataFrame:
    """Funnel counts of the day in one row: home, detail, cart, order, pay."""
    today = F.col("dt") == as_of
    pages = device_pages.filter(today & F.col("page_id").isin("home", "good_detail")).agg(
        F.count(F.when(F.col("page_id") == "home", 1)).alias("home_count"),
        F.count(F.when(F.col("page_id") == "good_detail", 1)).alias("good_detail_count"),
    )
    counts = [
        df.filter(today).agg(F.count(F.lit(1)).alias(name))
        for df, name in ((cart_daily, "cart_count"), (order_daily, "order_count"), (paid_daily, "payment_count"))
    ]
    return _stamp(one_row([pages, *counts]), as_of)


def user_change(login_days: DataFrame, as_of: Column, churn_days: int = 7, back_gap: int = 8) -> DataFrame:
    """Users last seen exactly ``churn_days`` ago, and users back after ``back_gap`` days.

    From login days, the snapshot of the previous day is the latest day before
    ``as_of``, so no second snapshot has to be kept.
    """
    day = F.col("dt")
    per_user = login_days.filter(day <= as_of).groupBy("user_id").agg(
        F.max("dt").alias("_last"), F.max(F.when(day < as_of, day)).alias("_previous")
    )
    churned = F.col("_last") == F.date_sub(as_of, churn_days)
    back = (F.col("_last") == as_of) & (F.datediff(F.col("_last"), F.col("_previous")) >= back_gap)
    return _stamp(
        per_user.agg(
            F.count(F.when(churned, 1)).alias("user_churn_count"), F.count(F.when(back, 1)).alias("user_back_count")
        ),
        as_of,
    )


def user_change_from_snapshots(today: DataFrame, yesterday: DataFrame, as_of: Column, back_gap: int = 8) -> DataFrame:
    """The same from two kept to-date snapshots, joined on the user."""
    churn = today.filter(F.col("login_date_last") == F.date_sub(as_of, 7)).agg(
        F.count(F.lit(1)).alias("user_churn_count")
    )
    old = yesterday.select(F.col("user_id").alias("_u"), F.col("login_date_last").alias("_prev"))
    back = (
        today.filter(F.col("login_date_last") == as_of)
        .join(old, F.col("user_id") == F.col("_u"))
        .filter(F.datediff("login_date_last", "_prev") >= back_gap)
        .agg(F.count(F.lit(1)).alias("user_back_count"))
    )
    return _stamp(one_row([churn, back]), as_of)


def user_retention(login_td: DataFrame, as_of: Column, cohorts: int = 7) -> DataFrame:
    """Retained users and rate per registration day of the last ``cohorts`` days."""
    first, last = F.col("login_date_first"), F.col("login_date_last")
    rows = login_td.filter((first >= F.date_sub(as_of, cohorts)) & (first < as_of))
    kept, total = F.count(F.when(last == as_of, 1)), F.count(F.lit(1))
    return _stamp(
        rows.groupBy(first.alias("create_date")).agg(
            F.datediff(as_of, F.max("login_date_first")).alias("retention_day"),
            kept.alias("retention_count"),
            total.alias("new_user_count"),
            exact_ratio(kept * 100, total).alias("retention_rate"),
        ),
        as_of,
    )


def user_stats(login_td: DataFrame, as_of: Column) -> DataFrame:
    """New and active users of the last 1, 7 and 30 days."""
    first, last = F.col("login_date_first"), F.col("login_date_last")
    aggs = []
    for d in HORIZONS:
        active = within(last, as_of, d)
        aggs.append(F.count(F.when(active & within(first, as_of, d), 1)).alias(f"new_user_count_{d}d"))
        aggs.append(F.count(F.when(active, 1)).alias(f"active_user_count_{d}d"))
    return _stamp(unfold(login_td.agg(*aggs), [], ["new_user_count", "active_user_count"]), as_of)
