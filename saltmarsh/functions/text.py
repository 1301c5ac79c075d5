"""Text column functions: masking, pseudonyms, rule texts, buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of a valid mobile number and mail address.
PHONE_PATTERN = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
CLEAN_TEXT_PATTERN = (
    r"^[\u4e00-\u9fa5a-zA-Z0-9\[\]\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)\"]+$"
)
EMAIL_PATTERN = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"


def mask_name(name: Column) -> Column:
    return F.concat(F.substring(name, 1, 1), F.lit("*"))


def mask_phone(phone: Column) -> Column:
    """First three digits and a star, null when the number is malformed."""
    return F.when(phone.rlike(PHONE_PATTERN), F.concat(F.substring(phone, 1, 3), F.lit("*")))


def mask_email(email: Column) -> Column:
    """Only the domain survives, null when the address is malformed."""
    domain = F.substring_index(email, "@", -1)
    return F.when(email.rlike(EMAIL_PATTERN), F.concat(F.lit("*@"), domain))


def pseudonym(value: Column, pattern: str | None = None) -> Column:
    """md5 of a value; with a pattern, only of values that match it."""
    return F.md5(value) if pattern is None else F.when(value.rlike(pattern), F.md5(value))


def cut(value: Column, limit: int = 255) -> Column:
    return F.substring(value, 1, limit)


def upper_first(value: Column) -> Column:
    return F.concat(F.upper(F.substring(value, 1, 1)), _tail(value))


def lower_first(value: Column) -> Column:
    return F.concat(F.lower(F.substring(value, 1, 1)), _tail(value))


def _tail(value: Column) -> Column:
    return F.substring(value, F.lit(2), F.length(value))


def last_token(value: Column, separator: str = ",") -> Column:
    """Text after the last separator; trailing separators do not count."""
    return F.substring_index(F.rtrim(value, F.lit(separator)), separator, -1)


def array_text(values: Column) -> Column:
    """``[a,b]`` text of an array, ``[]`` for null."""
    joined = F.array_join(F.transform(values, lambda v: v.cast("string")), ",")
    return F.concat(F.lit("["), F.coalesce(joined, F.lit("")), F.lit("]"))


def activity_rule(kind: Column, amount: Column, number: Column, benefit: Column, discount: Column) -> Column:
    """Rule text of an activity by its type code."""
    return (
        F.when(kind == "3101", F.concat(F.lit("满"), amount, F.lit("元减"), benefit, F.lit("元")))
        .when(kind == "3102", F.concat(F.lit("满"), number, F.lit("件打"), discount, F.lit(" 折")))
        .when(kind == "3103", F.concat(F.lit("打"), discount, F.lit("折")))
    )


def coupon_rule(kind: Column, amount: Column, number: Column, benefit: Column, discount: Column) -> Column:
    """Rule text of a coupon by its type code."""
    return (
        F.when(kind == "3201", F.concat(F.lit("满"), amount, F.lit("元减"), benefit, F.lit("元")))
        .when(kind == "3202", F.concat(F.lit("满"), number, F.lit("件打"), discount, F.lit(" 折")))
        .when(kind == "3203", F.concat(F.lit("减"), benefit, F.lit("元")))
    )


def hash_bucket(value: Column, buckets: int, overrides: dict[str, str] | None = None) -> Column:
    """Four-digit bucket from the last three hex digits of md5; overrides win."""
    number = F.conv(F.right(F.md5(value), F.lit(3)), 16, 10).cast("int")
    bucket = F.lpad(F.pmod(number, F.lit(buckets)).cast("string"), 4, "0")
    for key, fixed in sorted((overrides or {}).items(), reverse=True):
        bucket = F.when(value == key, F.lit(fixed)).otherwise(bucket)
    return bucket


def is_clean_text(value: Column) -> Column:
    """True for non-empty text made only of accepted characters; null counts as unclean."""
    return F.coalesce(value.rlike(CLEAN_TEXT_PATTERN), F.lit(False))
