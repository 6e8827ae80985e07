"""Complete days and expansion weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cap, share
from .relational import pivot_fixed, row_sum, unpivot_flags

DAYS = {1: "mon", 2: "tue", 3: "wed", 4: "thu", 5: "fri", 6: "sat", 7: "sun"}
COMPLETE = {d: f"{n}_complete" for d, n in DAYS.items()}
#: Weekdays counted as three, four and five: the middle of the week first.
WEEKS = {3: (2, 3, 4), 4: (1, 2, 3, 4), 5: (1, 2, 3, 4, 5)}


def day_completeness(days: DataFrame, keys: list[str], flag: str = "is_complete", day: str = "day") -> DataFrame:
    """One row per person: a flag for each day of the week, and how many of 3, 4 and 5 weekdays are complete."""
    out = pivot_fixed(days, keys, day, COMPLETE, F.max(flag))
    return out.withColumns({f"num_days_complete_{n}dayweekday": row_sum(*(COMPLETE[d] for d in week)) for n, week in WEEKS.items()})


def expansion_weights(rows: DataFrame, weight: str, complete: str, day: Column, days: tuple[int, ...] = (1, 2, 3, 4, 5), most: float | None = None, name: str = "expansion") -> DataFrame:
    """A person's weight, capped, divided by the complete days; 0 on other days than those analysed and without any."""
    return rows.withColumn(name, share(cap(F.col(weight).cast("double"), most), F.col(complete), day.isin(*days)))


def complete_person_days(persons: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each complete day of each person."""
    return unpivot_flags(persons, keys, {c: d for d, c in COMPLETE.items()}, "day")
