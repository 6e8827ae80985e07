"""Clock times: HHMM integers, minutes of a day, text, and durations across midnight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 1440


def div(a: Column, b: int) -> Column:
    """Integer quotient, rounded down also below zero."""
    return F.floor(a / F.lit(b)).cast("int")


def hhmm_to_min(c: Column) -> Column:
    return div(c, 100) * 60 + c % 100


def min_to_hhmm(minutes: Column) -> Column:
    """Minutes, also beyond a day, as HHMM of the day."""
    m = minutes % DAY
    return div(m, 60) * 100 + m % 60


def hm_to_hhmm(hour: Column, minute: Column) -> Column:
    return hour * 100 + minute


def clock_text(hour: Column, minute: Column, second: Column) -> Column:
    return F.format_string("%02d:%02d:%02d", hour.cast("int"), minute.cast("int"), second.cast("int"))


def wrapped(minutes: Column) -> Column:
    """A difference of two times of day that is negative passes midnight."""
    return F.when(minutes < 0, minutes + DAY).otherwise(minutes)


def hours_and_minutes(minutes: Column) -> tuple[Column, Column]:
    """A duration, a day longer if negative, as hours and minutes."""
    m = wrapped(minutes)
    return div(m, 60), m % 60


def midpoint(start: Column, end: Column) -> Column:
    """The minute halfway, rounded down."""
    return start + div(end - start, 2)
