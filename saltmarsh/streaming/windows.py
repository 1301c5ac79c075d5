"""Event-time window aggregates of the streaming jobs (also usable on batch frames)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.numbers import clamp_zero, parse_amount
from saltmarsh.functions.text import cut


def window_bounds() -> list[Column]:
    """Window start, end and day as the report layer names them."""
    return [
        F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("stt"),
        F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("edt"),
        F.date_format("window.start", "yyyy-MM-dd").alias("cur_date"),
    ]


def tumbling(df: DataFrame, ts: str, size: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Keyed (or with no keys, global) tumbling window aggregate."""
    out = df.groupBy(F.window(ts, size), *keys).agg(*aggs)
    names = [c for c in out.columns if c not in ("window", *keys)]
    return out.select(*window_bounds(), *keys, *names)


def with_lateness(df: DataFrame, ts: str, disorder_seconds: int = 5, lateness_seconds: int = 10) -> DataFrame:
    """Watermark that keeps windows open for late rows.

    Out-of-orderness and allowed lateness add up; in update mode a late row
    emits its window again and a keyed sink replaces the earlier result.
    """
    return df.withWatermark(ts, f"{disorder_seconds + lateness_seconds} seconds")


def counted_late(df: DataFrame, ts: str, size: str, watermark: object | None, name: str = "lateness") -> DataFrame:
    """The same rows; how many of them come after their window has closed at ``watermark`` goes into the progress of the query.

    Such rows no longer change a window.  ``watermark`` is the one the
    micro-batch works with (None before the first one has ended).
    """
    width = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {size})")
    end = F.timestamp_micros((F.floor(F.unix_micros(ts) / width) + 1) * width)
    late = F.lit(False) if watermark is None else end <= F.lit(watermark)
    return df.observe(name, F.count(F.when(late, 1)).alias("late"), F.count(F.lit(1)).alias("rows"))


def late_count(progress: dict, name: str = "lateness") -> int:
    """Late rows of a micro-batch from its progress report."""
    return int(progress.get("observedMetrics", {}).get(name, {}).get("late", 0))


def keyword_counts(df: DataFrame, ts: str, keyword: str = "keyword", size: str = "1 minute") -> DataFrame:
    rows = df.filter(F.col(keyword).isNotNull() & (F.trim(keyword) != ""))
    return tumbling(rows, ts, size, [keyword], [F.count(F.lit(1)).alias("keyword_count")])


AMOUNTS = {
    "split_original_amount": "original_amount", "split_activity_amount": "activity_reduce_amount",
    "split_coupon_amount": "coupon_reduce_amount", "split_total_amount": "order_amount",
}


def sku_amounts(df: DataFrame, ts: str, size: str = "1 minute") -> DataFrame:
    """Four amount sums per SKU, two decimals, never below zero."""
    sums = [
        clamp_zero(F.round(F.sum(parse_amount(F.col(src))), 2).cast("decimal(18,2)")).alias(new)
        for src, new in AMOUNTS.items()
    ]
    name = F.min(F.when(F.col("sku_name") != "", cut(F.col("sku_name")))).alias("sku_name")
    return tumbling(df, ts, size, ["sku_id"], [name, *sums])


def login_users(df: DataFrame, ts: str, size: str = "1 minute", user: str = "user_id") -> DataFrame:
    """Distinct users and distinct returning users (``is_new = '0'``) per window.

    Streaming has no exact distinct count, so users are first reduced to one row
    per window and user; on batch frames the second step is a plain count.
    """
    per_user = df.filter(F.col(user).isNotNull()).groupBy(F.window(ts, size), user).agg(
        F.max(F.when(F.col("is_new").cast("string") == "0", 1).otherwise(0)).alias("_back")
    )
    if df.isStreaming:
        # windows of the first step feed the second one (append mode)
        again = per_user.groupBy(F.window(F.window_time("window"), size)).agg(
            F.count(F.lit(1)).alias("uu_ct"), F.sum("_back").alias("back_ct")
        )
    else:
        again = per_user.groupBy("window").agg(F.count(F.lit(1)).alias("uu_ct"), F.sum("_back").alias("back_ct"))
    return again.select(*window_bounds(), "uu_ct", "back_ct")


def last_per_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Last record per key of a micro-batch (processing-time window = trigger interval)."""
    box = F.struct(*df.columns)
    return df.groupBy(*[F.col(k).alias("_k" + k) for k in keys]).agg(F.max_by(box, F.col(ts)).alias("_r")).select("_r.*")


def running_count(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Keyed running counter; a stream emits it in update mode."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
