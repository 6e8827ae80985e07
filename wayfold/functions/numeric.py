"""Comparisons, distances, scores and weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_MILES = 3963.1676


def near_equal(a: Column, b: Column, rel: float = 1e-9, absolute: float = 1e-6) -> Column:
    return F.abs(a - b) <= F.greatest(rel * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))


def great_circle_miles(x1: Column, y1: Column, x2: Column, y2: Column, digits: int | None = None) -> Column:
    """Miles between two points in degrees (x: longitude); the cosine is clamped before it is inverted."""
    a, b = F.radians(y1), F.radians(y2)
    c = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(x2) - F.radians(x1))
    miles = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))) * EARTH_MILES
    return F.round(miles, digits) if digits is not None else miles


def plane_xy(lon: Column, lat: Column, lat0: float, radius: float = EARTH_MILES) -> tuple[Column, Column]:
    """A local projection around the latitude lat0, in the radius's unit."""
    return radius * F.radians(lon) * F.cos(F.radians(F.lit(lat0))), radius * F.radians(lat)


def lerp_score(minutes: Column, knots: list[Column], step: int = 60) -> Column:
    """Between knots at 0, step, 2 * step, ... the score is a straight line; beyond the last one it is flat.

    Null for null or negative minutes.
    """
    table, last = F.array(*knots), len(knots) - 1
    k = F.least(F.floor(minutes / step), F.lit(last)).cast("int")
    low, high = F.get(table, k), F.get(table, F.least(k + 1, F.lit(last)))
    return F.when(minutes >= 0, F.when(k >= last, low).otherwise(low + (high - low) * (minutes - k * step) / step))


def cap(weight: Column, most: float | None) -> Column:
    return weight if most is None else F.least(weight, F.lit(most))


def share(weight: Column, n: Column, counts: Column) -> Column:
    """weight / n where counts holds; 0 elsewhere, for n of 0 and for nulls."""
    return F.coalesce(F.when(counts, F.try_divide(weight, n)), F.lit(0.0))
