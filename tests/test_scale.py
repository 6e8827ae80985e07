"""How rows are dealt: tasks by rows, and no exchange for rows that are dealt by household."""

from pyspark.sql import functions as F

from wayfold.operators import joint, relational
from wayfold.sources import diary

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_of_the_diary_grow_with_the_events(spark, monkeypatch):
    assert diary.dealt(spark, FOLDER) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(diary, "ROWS", 100)
    n = diary.dealt(spark, FOLDER)
    assert n == -(-spark.read.parquet(f"{FOLDER}/events.parquet").count() // 100) > spark.sparkContext.defaultParallelism
    assert f", {n}), REPARTITION_BY_NUM" in plan(diary.diary(spark, FOLDER))


def test_members_join_households_where_they_are(spark):
    trips = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, None, 3), (2, 1, 4), (None, 1, 5)], "hh int, pno int, seq int").repartition(3, "hh")
    members = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 2, "c"), (None, 1, "d"), (3, 1, "e")], "hh int, pno int, kind string").repartition(3, "hh")
    out = relational.of_household(trips, members.hint("merge"))
    want = trips.join(members, ["hh", "pno"], "left").select(out.columns)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert "ENSURE_REQUIREMENTS" not in plan(out)


def test_parties_are_found_without_another_exchange(spark):
    trips = spark.range(200).select((F.col("id") % 7).alias("hh"), (F.col("id") % 3).cast("int").alias("pno"), (F.col("id") % 50).cast("int").alias("dep"), (F.col("id") % 50 + 5).cast("int").alias("arr"), F.lit(1).alias("x"))
    found = plan(joint.detect_parties(trips.repartition(3, "hh"), places=("x",)))
    assert found.count("Exchange") == 1 and "Join" not in found
