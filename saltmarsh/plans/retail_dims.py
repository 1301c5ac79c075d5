"""Dimensions of the shop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.functions import text
from saltmarsh.operators.history import open_history
from saltmarsh.operators.relations import decode

ACTIVITY_PARENT, COUPON_PARENT, RANGE_PARENT = "31", "32", "33"


def _lookup(df: DataFrame, side: DataFrame, on: str, columns: dict[str, str]) -> DataFrame:
    """Left join ``side.id`` and keep the named columns (new -> source)."""
    s = side.select(F.col("id").alias("_id"), *[F.col(src).alias(new) for new, src in columns.items()])
    return df.join(s, F.col(on) == F.col("_id"), "left").drop("_id")


def sku_dimension(
    sku: DataFrame, spu: DataFrame, category3: DataFrame, category2: DataFrame, category1: DataFrame,
    trademark: DataFrame, attributes: DataFrame | None = None, sale_attributes: DataFrame | None = None,
) -> DataFrame:
    """SKU with its names, three category levels, brand and attribute sets.

    The attribute sets are arrays because a SKU has as many of them as the
    catalogue defines attributes; they are sorted so equal sets compare equal.
    """
    out = sku.withColumn("is_sale", F.col("is_sale").cast("int").cast("boolean"))
    out = _lookup(out, spu, "spu_id", {"spu_name": "spu_name"})
    out = _lookup(out, category3, "category3_id", {"category3_name": "name", "category2_id": "category2_id"})
    out = _lookup(out, category2, "category2_id", {"category2_name": "name", "category1_id": "category1_id"})
    out = _lookup(out, category1, "category1_id", {"category1_name": "name"})
    out = _lookup(out, trademark, "tm_id", {"tm_name": "tm_name"})
    if attributes is not None:
        out = _attribute_set(out, attributes, "attrs", ["attr_id", "value_id", "attr_name", "value_name"])
    if sale_attributes is not None:
        out = _attribute_set(
            out, sale_attributes, "sale_attrs",
            ["sale_attr_id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name"],
        )
    return out


def _attribute_set(df: DataFrame, rows: DataFrame, name: str, fields: list[str]) -> DataFrame:
    box = F.struct(*[F.col(f).cast("string").alias(f) for f in fields])
    sets = rows.groupBy(F.col("sku_id").alias("_s")).agg(F.sort_array(F.collect_set(box)).alias(name))
    return df.join(sets, F.col("id") == F.col("_s"), "left").drop("_s")


def activity_dimension(rules: DataFrame, activities: DataFrame, dictionary: DataFrame) -> DataFrame:
    info = activities.select(
        F.col("id").alias("_aid"), "activity_name", "activity_desc", "start_time", "end_time", "create_time"
    )
    out = rules.join(info, F.col("activity_id") == F.col("_aid"), "left").drop("_aid")
    out = decode(out, dictionary, "activity_type", "activity_type_name", ACTIVITY_PARENT)
    return out.withColumn(
        "benefit_rule",
        text.activity_rule(
            F.col("activity_type").cast("string"), F.col("condition_amount"), F.col("condition_num"),
            F.col("benefit_amount"), F.col("benefit_discount"),
        ),
    ).withColumnRenamed("id", "activity_rule_id").withColumnRenamed("activity_type", "activity_type_code")


def coupon_dimension(coupons: DataFrame, dictionary: DataFrame) -> DataFrame:
    out = decode(coupons, dictionary, "coupon_type", "coupon_type_name", COUPON_PARENT)
    out = decode(out, dictionary, "range_type", "range_type_name", RANGE_PARENT)
    return out.withColumn(
        "benefit_rule",
        text.coupon_rule(
            F.col("coupon_type").cast("string"), F.col("condition_amount"), F.col("condition_num"),
            F.col("benefit_amount"), F.col("benefit_discount"),
        ),
    ).withColumnRenamed("coupon_type", "coupon_type_code").withColumnRenamed("range_type", "range_type_code")


def province_dimension(province: DataFrame, region: DataFrame) -> DataFrame:
    return _lookup(
        province.withColumnRenamed("name", "province_name"), region, "region_id", {"region_name": "region_name"}
    )


def promotion_position_dimension(positions: DataFrame) -> DataFrame:
    return positions.select("id", "pos_location", "pos_type", "promotion_type", "create_time", "operate_time")


def promotion_referrer_dimension(referrers: DataFrame) -> DataFrame:
    return referrers.select("id", "refer_name", "create_time", "operate_time")


def date_dimension(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar rows between two dates, inclusive."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date_id")
    )
    d = F.col("date_id")
    return days.select(
        "date_id",
        F.weekofyear(d).alias("week_id"),
        (F.pmod(F.dayofweek(d) + 5, F.lit(7)) + 1).alias("week_day"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (F.dayofweek(d).between(2, 6)).cast("string").alias("is_workday"),
    )


def mask_users(users: DataFrame) -> DataFrame:
    """Personal columns reduced to first characters or dropped when malformed."""
    return users.withColumns(
        {
            "name": text.mask_name(F.col("name")),
            "phone_num": text.mask_phone(F.col("phone_num")),
            "email": text.mask_email(F.col("email")),
        }
    )


def user_history(users: DataFrame, start) -> DataFrame:
    """Masked users as open history rows; later days go through ``apply_changes``."""
    return open_history(mask_users(users), start)
