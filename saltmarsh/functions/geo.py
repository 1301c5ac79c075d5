"""Distances on the earth."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS-84 ellipsoid and the mean earth radius in metres.
SEMI_MAJOR = 6378137.0
FLATTENING = 1.0 / 298.257223563
MEAN_RADIUS = 6371008.8


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres, native columns."""
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.lit(2 * MEAN_RADIUS) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def ellipsoid_metres(lat1, lon1, lat2, lon2, tolerance: float = 1e-12, rounds: int = 100) -> np.ndarray:
    """Inverse geodesic on WGS-84 for whole arrays; NaN where it does not converge."""
    a, f = SEMI_MAJOR, FLATTENING
    b = (1 - f) * a
    lat1, lon1, lat2, lon2 = (np.radians(np.asarray(v, dtype="float64")) for v in (lat1, lon1, lat2, lon2))
    u1, u2 = np.arctan((1 - f) * np.tan(lat1)), np.arctan((1 - f) * np.tan(lat2))
    # the short way round, so a track across the date line stays short
    span = (lon2 - lon1 + np.pi) % (2 * np.pi) - np.pi
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = span.copy()
    open_rows = np.ones_like(lam, dtype=bool)
    sin_s = cos_s = sigma = cos2a = cos2m = np.zeros_like(lam)
    with np.errstate(invalid="ignore", divide="ignore"):
        for _ in range(rounds):
            sl, cl = np.sin(lam), np.cos(lam)
            sin_s = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cos_s = su1 * su2 + cu1 * cu2 * cl
            sigma = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s == 0, 0.0, cu1 * cu2 * sl / np.where(sin_s == 0, 1.0, sin_s))
            cos2a = 1 - sin_a**2
            cos2m = np.where(cos2a == 0, 0.0, cos_s - 2 * su1 * su2 / np.where(cos2a == 0, 1.0, cos2a))
            c = f / 16 * cos2a * (4 + f * (4 - 3 * cos2a))
            nxt = span + (1 - c) * f * sin_a * (
                sigma + c * sin_s * (cos2m + c * cos_s * (2 * cos2m**2 - 1))
            )
            moved = np.abs(nxt - lam)
            lam = np.where(open_rows, nxt, lam)
            open_rows &= ~(moved < tolerance)
            if not open_rows.any():
                break
        k2 = cos2a * (a * a - b * b) / (b * b)
        big_a = 1 + k2 / 16384 * (4096 + k2 * (-768 + k2 * (320 - 175 * k2)))
        big_b = k2 / 1024 * (256 + k2 * (-128 + k2 * (74 - 47 * k2)))
        inner = cos_s * (2 * cos2m**2 - 1) - big_b / 6 * cos2m * (4 * sin_s**2 - 3) * (4 * cos2m**2 - 3)
        metres = b * big_a * (sigma - big_b * sin_s * (cos2m + big_b / 4 * inner))
    metres = np.where(sin_s == 0, np.where(open_rows, np.nan, 0.0), metres)
    return np.where(open_rows, np.nan, metres)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def ellipsoid_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column, tolerance: float = 1e-12, rounds: int = 100) -> Column:
    """Ellipsoidal metres between two points, native columns; NaN where it does not converge, null for null points.

    The inverse geodesic as a fixed point: each round of the aggregation takes
    the longitude difference one step on, rounds after the last move are idle.
    """
    a, f = SEMI_MAJOR, FLATTENING
    b = (1 - f) * a

    def reduced(lat: Column) -> Column:
        return F.atan(F.tan(F.radians(lat)) * (1 - f))

    span = F.radians(lon2 - lon1) + math.pi
    # the short way round, so a track across the date line stays short
    start = F.struct(
        F.sin(reduced(lat1)).alias("su1"), F.cos(reduced(lat1)).alias("cu1"), F.sin(reduced(lat2)).alias("su2"), F.cos(reduced(lat2)).alias("cu2"),
        (span - F.floor(span / (2 * math.pi)) * (2 * math.pi) - math.pi).alias("span"),
    )

    def solved(p: Column) -> Column:
        def step(lam: Column) -> Column:
            across = p["cu1"] * p["su2"] - p["su1"] * p["cu2"] * F.cos(lam)
            return _let(F.struct(
                F.hypot(p["cu2"] * F.sin(lam), across).alias("sin_s"), (p["su1"] * p["su2"] + p["cu1"] * p["cu2"] * F.cos(lam)).alias("cos_s"),
                (p["cu1"] * p["cu2"] * F.sin(lam)).alias("turn"), lam.alias("lam"),
            ), angles)

        def angles(q: Column) -> Column:
            sin_a = F.when(q["sin_s"] == 0, 0.0).otherwise(F.try_divide(q["turn"], q["sin_s"]))
            return _let(F.struct(
                q["sin_s"].alias("sin_s"), q["cos_s"].alias("cos_s"), q["lam"].alias("lam"), F.atan2(q["sin_s"], q["cos_s"]).alias("sigma"),
                sin_a.alias("sin_a"), (1 - sin_a * sin_a).alias("cos2a"),
            ), middle)

        def middle(q: Column) -> Column:
            cos2m = F.when(q["cos2a"] == 0, 0.0).otherwise(q["cos_s"] - F.try_divide(2 * p["su1"] * p["su2"], q["cos2a"]))
            return _let(F.struct(
                *[q[n].alias(n) for n in ("sin_s", "cos_s", "lam", "sigma", "sin_a", "cos2a")], cos2m.alias("cos2m"),
                (q["cos2a"] * (4 + f * (4 - 3 * q["cos2a"])) * (f / 16)).alias("c"),
            ), moved)

        def moved(q: Column) -> Column:
            bend = q["cos2m"] + q["c"] * q["cos_s"] * (2 * q["cos2m"] * q["cos2m"] - 1)
            nxt = p["span"] + (1 - q["c"]) * f * q["sin_a"] * (q["sigma"] + q["c"] * q["sin_s"] * bend)
            return F.struct(
                nxt.alias("lam"), (F.abs(nxt - q["lam"]) < tolerance).alias("done"),
                *[q[n].alias(n) for n in ("sin_s", "cos_s", "sigma", "cos2a", "cos2m")],
            )

        zero = F.lit(0.0)
        first = F.struct(p["span"].alias("lam"), F.lit(False).alias("done"), *[zero.alias(n) for n in ("sin_s", "cos_s", "sigma", "cos2a", "cos2m")])
        return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, lambda acc, _: F.when(acc["done"], acc).otherwise(step(acc["lam"])))

    def metres(q: Column) -> Column:
        k2 = q["cos2a"] * ((a * a - b * b) / (b * b))
        return _let(F.struct(
            (1 + k2 / 16384 * (4096 + k2 * (-768 + k2 * (320 - 175 * k2)))).alias("big_a"),
            (k2 / 1024 * (256 + k2 * (-128 + k2 * (74 - 47 * k2)))).alias("big_b"), (q["cos2m"] * q["cos2m"]).alias("m2"),
        ), lambda w: _let(
            q["cos_s"] * (2 * w["m2"] - 1) - w["big_b"] / 6 * q["cos2m"] * (4 * q["sin_s"] * q["sin_s"] - 3) * (4 * w["m2"] - 3),
            lambda inner: w["big_a"] * b * (q["sigma"] - w["big_b"] * q["sin_s"] * (q["cos2m"] + w["big_b"] / 4 * inner)),
        ))

    length = _let(start, lambda p: _let(solved(p), lambda q: F.when(~q["done"], F.lit(float("nan"))).when(q["sin_s"] == 0, 0.0).otherwise(metres(q))))
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(known, length)
