"""User profile scoring by age band (device, search, time, amount, brand, category).

The factors form one small table ``(factor, value, band, weight)``.  Scoring is
a join with that table followed by a sum, instead of branches in code.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.functions.dates import age_years, birth_decade, time_slot, zodiac_sign

BANDS = ["18-24", "25-29", "30-34", "35-39", "40-49", "50"]

# Share of each factor in the total score.
FACTOR_RATES = {"device": "0.10", "search": "0.15", "time": "0.10", "amount": "0.15", "brand": "0.20", "category": "0.30"}

# Weight of a factor value for the bands 18-24, 25-29, 30-34, 35-39,
# 40-49, 50.  "*" applies to values that are not listed.
FACTOR_WEIGHTS = {
    "device": {
        "iOS": "0.7 0.6 0.5 0.4 0.3 0.2",
        "Android": "0.8 0.7 0.6 0.5 0.4 0.3",
    },
    "search": {
        "时尚与潮流": "0.9 0.7 0.5 0.3 0.2 0.1",
        "性价比": "0.2 0.4 0.6 0.7 0.8 0.8",
        "健康与养生": "0.1 0.2 0.4 0.6 0.8 0.7",
        "家庭与育儿": "0.1 0.2 0.4 0.6 0.8 0.7",
        "科技与数码": "0.8 0.6 0.4 0.3 0.2 0.1",
        "学习与发展": "0.4 0.5 0.6 0.7 0.8 0.7",
    },
    "time": {
        "凌晨": "0.2 0.1 0.1 0.1 0.1 0.1",
        "早晨": "0.1 0.1 0.1 0.1 0.2 0.3",
        "上午": "0.2 0.2 0.2 0.2 0.3 0.4",
        "中午": "0.4 0.4 0.4 0.4 0.4 0.3",
        "下午": "0.4 0.5 0.5 0.5 0.5 0.4",
        "晚上": "0.8 0.7 0.6 0.5 0.4 0.3",
        "夜间": "0.9 0.7 0.5 0.3 0.2 0.1",
    },
    "amount": {
        "低消费": "0.8 0.6 0.4 0.3 0.2 0.1",
        "中消费": "0.2 0.4 0.6 0.7 0.8 0.7",
        "高消费": "0.1 0.2 0.3 0.4 0.5 0.6",
    },
    "brand": {
        "TCL": "0.2 0.3 0.4 0.5 0.6 0.7",
        "苹果": "0.9 0.8 0.7 0.7 0.7 0.5",
        "联想": "0.9 0.8 0.7 0.7 0.7 0.5",
        "小米": "0.9 0.8 0.7 0.7 0.7 0.5",
        "欧莱雅": "0.5 0.6 0.8 0.8 0.9 0.2",
        "香奈儿": "0.3 0.4 0.6 0.8 0.9 0.2",
        "*": "0.1 0.2 0.3 0.4 0.5 0.6",
    },
    "category": {
        "数码": "0.9 0.8 0.6 0.4 0.2 0.1",
        "手机": "0.9 0.8 0.6 0.4 0.2 0.1",
        "电脑办公": "0.9 0.8 0.6 0.4 0.2 0.1",
        "个护化妆": "0.9 0.8 0.6 0.4 0.2 0.1",
        "服饰内衣": "0.9 0.8 0.6 0.4 0.2 0.1",
        "家居家装": "0.2 0.4 0.6 0.8 0.9 0.7",
        "图书、音像、电子书刊": "0.2 0.4 0.6 0.8 0.9 0.7",
        "厨具": "0.2 0.4 0.6 0.8 0.9 0.7",
        "鞋靴": "0.2 0.4 0.6 0.8 0.9 0.7",
        "母婴": "0.2 0.4 0.6 0.8 0.9 0.7",
        "汽车用品": "0.2 0.4 0.6 0.8 0.9 0.7",
        "珠宝": "0.2 0.4 0.6 0.8 0.9 0.7",
        "家用电器": "0.2 0.4 0.6 0.8 0.9 0.7",
        "*": "0.1 0.2 0.4 0.5 0.8 0.9",
    },
}

# Spending power by order amount (below the limit).
SPENDING = [(1000, "低消费"), (4000, "中消费")]
SPENDING_REST = "高消费"


def weight_rows(weights: dict[str, dict[str, str]] | None = None, rates: dict[str, str] | None = None):
    """(factor, value, {band: points}) with each product rounded half-up to three digits."""
    weights, rates = weights or FACTOR_WEIGHTS, rates or FACTOR_RATES
    for factor, values in weights.items():
        for value, numbers in values.items():
            points = [
                (Decimal(w) * Decimal(rates[factor])).quantize(Decimal("0.001"), ROUND_HALF_UP)
                for w in numbers.split()
            ]
            yield factor, value, points


def band_column(prefix: str, band: str) -> str:
    return f"{prefix}_{band.replace('-', '_')}"


def weight_table(spark: SparkSession, weights=None, rates=None) -> DataFrame:
    """One row per factor value with a decimal column per band."""
    columns = ", ".join(f"{band_column('w', b)} decimal(6,3)" for b in BANDS)
    return spark.createDataFrame(
        [(f, v, *points) for f, v, points in weight_rows(weights, rates)], f"factor string, value string, {columns}"
    )


def spending_power(amount: Column) -> Column:
    expr = None
    for below, label in SPENDING:
        cond = amount < below
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(amount.isNotNull(), expr.otherwise(SPENDING_REST))


def score_factors(df: DataFrame, table: DataFrame, factors: dict[str, str]) -> DataFrame:
    """Add ``<factor>_<band>`` points for each factor; ``factors`` maps factor to column.

    Missing values score zero, unlisted ones the "*" row of the factor.  The
    table is configuration of a few dozen rows: it becomes one value holding a
    small map per factor, and rows look their points up without a join.
    """
    points = F.array(*[F.col(band_column("w", b)).cast("double") for b in BANDS])
    parts = []
    for factor in factors:
        mine = F.col("factor") == factor
        entries = F.collect_list(F.when(mine & (F.col("value") != "*"), F.struct("value", points)))
        parts.append(F.map_from_entries(entries).alias(factor))
        parts.append(F.max(F.when(mine & (F.col("value") == "*"), points)).alias(factor + "_rest"))
    lookup = table.agg(F.struct(*parts).alias("lookup")).scalar()
    zero = F.array(*[F.lit(0.0) for _ in BANDS])
    boxes = {}
    for factor, column in factors.items():
        own = F.try_element_at(lookup.getField(factor), F.col(column))
        usable = F.col(column).isNotNull() & (F.col(column) != "")
        boxes["_" + factor] = F.when(usable, F.coalesce(own, lookup.getField(factor + "_rest"), zero)).otherwise(zero)
    return df.withColumns(boxes).select(
        *df.columns, *[F.col("_" + f)[i].alias(band_column(f, b)) for f in factors for i, b in enumerate(BANDS)]
    )


def device_search_scores(profile: DataFrame, table: DataFrame, category_names: DataFrame) -> DataFrame:
    """Points for operating system (first of the list) and search category.

    ``category_names`` maps a searched item to its search category.
    """
    lookup = category_names.select(F.col("search_item").alias("_i"), "search_category")
    rows = profile.withColumn("judge_os", F.substring_index("os", ",", 1)).join(
        lookup, F.col("search_item") == F.col("_i"), "left"
    ).drop("_i")
    return score_factors(rows, table, {"device": "judge_os", "search": "search_category"})


def order_scores(orders: DataFrame, table: DataFrame, sku: DataFrame) -> DataFrame:
    """Points for pay time slot, amount, brand and top category of an order line."""
    side = sku.select(F.col("sku_id").alias("_s"), "tname", "b1_name")
    rows = orders.join(side, F.col("sku_id") == F.col("_s"), "left").drop("_s").withColumns(
        {
            "pay_time_slot": time_slot(F.col("pay_time")),
            "spending_pow": spending_power(F.coalesce(F.col("total_amount"), F.lit(0))),
        }
    )
    return score_factors(
        rows, table, {"time": "pay_time_slot", "amount": "spending_pow", "brand": "tname", "category": "b1_name"}
    )


def total_scores(df: DataFrame, factors: list[str] | None = None) -> DataFrame:
    """Sum of the factor points per band and the best band (ties: younger band).

    Points have three digits, so rounding the sum to three digits is exact.
    """
    factors = factors or list(FACTOR_RATES)
    sums = {}
    for b in BANDS:
        total = reduce(lambda x, y: x + y, [F.coalesce(F.col(band_column(f, b)), F.lit(0.0)) for f in factors])
        sums[band_column("sum", b)] = F.round(total, 3)
    out = df.withColumns(sums)
    ranked = F.array(
        *[
            F.struct(F.col(band_column("sum", b)).alias("score"), F.lit(-i).alias("place"), F.lit(b).alias("band"))
            for i, b in enumerate(BANDS)
        ]
    )
    best = F.array_max(ranked)
    return out.withColumns({"best_band": best["band"], "best_score": best["score"]})


def base_labels(users: DataFrame, on: Column) -> DataFrame:
    """Age, decade and zodiac sign from the birthday."""
    b = F.col("birthday").cast("date")
    return users.withColumns({"age": age_years(b, on), "decade": birth_decade(b), "zodiac_sign": zodiac_sign(b)})


def label_document(df: DataFrame) -> DataFrame:
    """Nested result document of a scored profile as JSON text."""
    def group(*names: str) -> Column:
        return F.struct(*[F.col(n) for n in names if n in df.columns])

    document = F.struct(
        F.col("uid"),
        group("decade", "zodiac_sign", "gender", "login_name", "judge_os", "user_level", "birthday", "age").alias("user_base_label"),
        group("pv", "search_item").alias("user_log_label"),
        group("md", "ba", "os", "ch", "pay_time_slot").alias("user_device_label"),
        F.struct(
            F.struct(*[F.col(band_column("sum", b)).alias(b) for b in BANDS]).alias("computer_age_info"),
            F.col("spending_pow"),
            F.struct("best_band", "best_score").alias("calculate_age"),
        ).alias("user_calculate_label"),
        group("sku_id", "tname", "b1_name").alias("sup_info_message"),
    )
    return df.select("uid", F.to_json(document).alias("label"))
