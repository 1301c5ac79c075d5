"""Date and time column functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN_END = "9999-12-31"

# Time-of-day slots as (hour below which the slot applies, label).
TIME_SLOTS = [
    (6, "凌晨"),
    (9, "早晨"),
    (12, "上午"),
    (14, "中午"),
    (18, "下午"),
    (22, "晚上"),
    (24, "夜间"),
]

# Zodiac signs as (last month*100+day of the sign, label).
ZODIAC = [
    (119, "摩羯座"),
    (218, "水瓶座"),
    (320, "双鱼座"),
    (419, "白羊座"),
    (520, "金牛座"),
    (621, "双子座"),
    (722, "巨蟹座"),
    (822, "狮子座"),
    (922, "处女座"),
    (1023, "天秤座"),
    (1122, "天蝎座"),
    (1221, "射手座"),
    (1231, "摩羯座"),
]


def as_date(value) -> Column:
    """A date column from a Column, a ``date`` or ISO text."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, (dt.date, str)):
        return F.lit(str(value)[:10]).cast("date")
    raise TypeError(f"cannot read a date from {value!r}")


def in_days(df: DataFrame, column: str, first: Column, last: Column) -> Column:
    """The days ``first`` to ``last`` as a range on the raw column, so that it reaches the scan.

    Timestamps, dates, epoch millis and texts that begin with an ISO date each
    get bounds of their own kind; the bounds are constants where the days are.
    """
    kind, after = df.schema[column].dataType, F.date_add(last, 1)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        low, high = first.cast(kind), after.cast(kind)
    elif isinstance(kind, T.DateType):
        low, high = first, after
    elif isinstance(kind, T.StringType):
        low, high = first.cast("string"), after.cast("string")
    elif isinstance(kind, T.LongType):
        low, high = F.unix_millis(first.cast("timestamp")), F.unix_millis(after.cast("timestamp"))
    else:
        raise TypeError(f"{column} of type {kind.simpleString()} has no days")
    return (F.col(column) >= low) & (F.col(column) < high)


def latest_date(df: DataFrame, column: str) -> Column:
    """``max(column)`` as a scalar sub-query, so no value passes through Python."""
    return df.agg(F.max(F.col(column)).cast("date")).scalar()


def resolve_as_of(df: DataFrame, column: str, as_of) -> Column:
    """The report date: the given one, else the latest date in the data."""
    return latest_date(df, column) if as_of is None else as_date(as_of)


def epoch_day(days: Column) -> Column:
    """Days since 1970-01-01 to a date."""
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def millis_to_timestamp(millis: Column) -> Column:
    return F.timestamp_millis(millis.cast("long"))


def millis_to_text(millis: Column, zone: str = "UTC", fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.from_utc_timestamp(millis_to_timestamp(millis), zone), fmt)


def seconds_or_millis(value: Column) -> Column:
    """Epoch values below 10^10 are seconds and are promoted to milliseconds."""
    number = value.try_cast("long")
    return F.when(number < F.lit(10_000_000_000), number * 1000).otherwise(number)


def time_slot(ts: Column) -> Column:
    """One of seven bands of the day."""
    hour = F.hour(ts)
    expr = None
    for below, label in TIME_SLOTS[:-1]:
        cond = hour < below
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(ts.isNotNull(), expr.otherwise(TIME_SLOTS[-1][1]))


def age_years(birthday: Column, on: Column) -> Column:
    """Completed years between two dates."""
    early = (F.month(on) * 100 + F.dayofmonth(on)) < (F.month(birthday) * 100 + F.dayofmonth(birthday))
    return (F.year(on) - F.year(birthday) - F.when(early, 1).otherwise(0)).cast("int")


def birth_decade(birthday: Column) -> Column:
    return (F.floor(F.year(birthday) / 10) * 10).cast("int")


def zodiac_sign(birthday: Column) -> Column:
    """Sign by comparing month*100+day with the last day of each sign."""
    md = F.month(birthday) * 100 + F.dayofmonth(birthday)
    expr = None
    for last, label in ZODIAC:
        cond = md <= last
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def day_numbers(start: Column, end: Column) -> Column:
    """Inclusive list of ``yyyyMMdd`` texts."""
    return F.transform(F.sequence(start, end), lambda d: F.date_format(d, "yyyyMMdd"))


def compact_stamp_to_millis(text: Column, zone: str = "GMT+8") -> Column:
    """``yyyyMMddHHmmss`` in ``zone`` to epoch millis; any other text gives 0."""
    valid = text.rlike("^[0-9]{14}$")
    parsed = F.try_to_timestamp(F.when(valid, text), F.lit("yyyyMMddHHmmss"))
    return F.coalesce(F.unix_millis(F.to_utc_timestamp(parsed, zone)), F.lit(0).cast("long"))
