"""A travel diary as a view over the table of events.

Users are persons, three to a household; an event is an arrival, its type the purpose: signup home (0), click work (1),
purchase shop (5), view social (7), error change of mode (10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.recode import recode

PURPOSES = {"signup": 0, "click": 1, "purchase": 5, "view": 7}
HOME, WORK, CHANGE = 0, 1, 10

#: Persons. Rows are dealt by household once, which serves every window and group over households, persons and their tours.
PERSON = ["hh", "pno"]

#: Events that are dealt to one task: its windows sort them several times, and their memory is held together.
ROWS = 50_000


def dealt(spark: SparkSession, folder: str) -> int:
    """How many tasks households are dealt to: as many as there are events for, so that a task's memory doesn't grow with the table."""
    return max(spark.sparkContext.defaultParallelism, -(-spark.read.parquet(f"{folder}/events.parquet").count() // ROWS))


def diary(spark: SparkSession, folder: str) -> DataFrame:
    """hh, pno, seq, event_id, day (1: Monday), day_ix, arr (minute), k, mode, x, y, dpurp; and the origin: opurp, ox, oy."""
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "ts", "user_id", "event_type", "props")
    base = events.select(
        "event_id",
        "ts",
        F.expr("user_id div 3").alias("hh"),
        (F.col("user_id") % 3 + 1).cast("int").alias("pno"),
        (F.weekday("ts") + 1).alias("day"),
        F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("day_ix"),
        (F.hour("ts") * 60 + F.minute("ts")).alias("arr"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        recode(F.col("event_type"), PURPOSES, strict=True, default=CHANGE).alias("dpurp"),
    ).withColumns({"mode": F.col("k") % 10, "x": F.col("k") % 10, "y": F.expr("cast(k div 10 as int)")})
    w = W.partitionBy(*PERSON).orderBy("ts", "event_id")
    return base.repartition(dealt(spark, folder), "hh").withColumns(
        {"seq": F.row_number().over(w), "opurp": F.lag("dpurp").over(w), "ox": F.lag("x").over(w), "oy": F.lag("y").over(w)}
    )


#: The same view for DuckDB, as the first of a query's common tables.
SQL = """WITH b AS (
  SELECT event_id, ts, user_id // 3 AS hh, (user_id % 3 + 1)::INT AS pno, isodow(ts)::INT AS day, datediff('day', DATE '2024-01-01', CAST(ts AS DATE))::INT AS day_ix,
    (hour(ts) * 60 + minute(ts))::INT AS arr, CAST(json_extract_string(props, '$.k') AS INT) AS k,
    CASE event_type WHEN 'signup' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 5 WHEN 'view' THEN 7 ELSE 10 END AS dpurp
  FROM events
), d AS (
  SELECT *, (k % 10)::INT AS mode, (k % 10)::INT AS x, (k // 10)::INT AS y, row_number() OVER p AS seq, lag(dpurp) OVER p AS opurp,
    lag((k % 10)::INT) OVER p AS ox, lag((k // 10)::INT) OVER p AS oy
  FROM b WINDOW p AS (PARTITION BY hh, pno ORDER BY ts, event_id)
)"""
