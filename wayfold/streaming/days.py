"""Person-days counted while events arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def person_day_counts(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Events of each person and day of a stream with ts and user_id; a day is final once `late` has passed."""
    days = events.withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("w"), "user_id").agg(F.count("*").alias("events"))
    return days.select(F.expr("user_id div 3").alias("hh"), (F.col("user_id") % 3 + 1).cast("int").alias("pno"), F.to_date("w.start").alias("date"), "events")
