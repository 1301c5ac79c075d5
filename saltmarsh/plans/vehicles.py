"""Vehicle GPS intake and track distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.dates import compact_stamp_to_millis
from saltmarsh.functions.documents import flatten_struct
from saltmarsh.functions.geo import ellipsoid_distance, haversine
from saltmarsh.operators.sequences import ordered_columns, time_slice


def snapshot_rows(changes: DataFrame) -> DataFrame:
    """Rows read by the initial snapshot of a change stream."""
    return changes.filter((F.col("op") == "r") | (F.col("source")["snapshot"] == "true"))


def flatten_location(rows: DataFrame, column: str = "upexgmsgreallocation") -> DataFrame:
    """Location fields at the top level with day and epoch millis of the fix."""
    flat = flatten_struct(rows, column)
    millis = compact_stamp_to_millis(F.col("dateTime"))
    return flat.withColumn("ts", millis).withColumn("ds", F.date_format(F.timestamp_millis(millis), "yyyyMMdd"))


def track_distance(
    points: DataFrame, vehicle: str, ts: str, lat: str, lon: str, tie: str, exact: bool = True, slice_width: str = "hour"
) -> DataFrame:
    """Metres driven per vehicle and day: sum over consecutive points.

    ``exact`` uses the ellipsoid, otherwise the sphere.
    """
    day = F.to_date(ts)
    dated = points.withColumn("dt", day)
    nxt = ordered_columns(
        dated, [vehicle, "dt"], [ts, tie], time_slice(F.col(ts), slice_width),
        following={"_lat2": lat, "_lon2": lon},
    )
    step: Column = (ellipsoid_distance if exact else haversine)(F.col(lat), F.col(lon), F.col("_lat2"), F.col("_lon2"))
    legs = nxt.withColumn("_leg", F.when(F.col("_lat2").isNotNull(), step))
    # the tiniest representation noise of a sum of doubles is rounded away
    return legs.groupBy(vehicle, "dt").agg(
        F.count(F.lit(1)).alias("points"), F.round(F.coalesce(F.sum("_leg"), F.lit(0.0)), 1).alias("metres")
    )
