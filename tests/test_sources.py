import pytest
from pyspark.sql import functions as F

from wayfold.sources import tables
from wayfold.sources.tables import Config
from wayfold.streaming.days import person_day_counts


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    tables.write_csv(df.coalesce(1), str(tmp_path / "t"))
    back = tables.read_csv(spark, str(tmp_path / "t"), "k int, v string", ["k"])
    assert sorted(r.k for r in back.collect()) == [1, 2]


def test_bulk_load_fails_on_a_bad_line(spark, tmp_path):
    (tmp_path / "good.csv").write_text('k,v\n1,"a\n')
    assert tables.bulk_load(spark, str(tmp_path / "good.csv"), "k int, v string").collect()[0].v == '"a'
    (tmp_path / "bad.csv").write_text("k,v\nx,a\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ"):
        tables.bulk_load(spark, str(tmp_path / "bad.csv"), "k int, v string").collect()


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, 5), (1, 6)], "depart_seconds int, k int")
    assert tables.alias_columns(df, {"depart_seconds": "depart_second", "x": "y"}).columns == ["depart_second", "k"]
    assert tables.with_fallback(df, "z", "k").columns[-1] == "z"
    assert tables.empty_like(df).count() == 0
    assert tables.repeated_keys(df, ["depart_seconds"]).count() == 1
    assert tables.repeated_keys(df, ["k"]).count() == 0
    assert Config(app_only=True).weight("trip_weight") == "trip_weight_app_only"
    assert Config(app_only=True, app_suffix="_x").weight("w") == "w_x"


def test_append_to_a_table(spark):
    df = spark.createDataFrame([(1,)], "k int")
    spark.sql("DROP TABLE IF EXISTS appended_rows")
    tables.append(df, "appended_rows")
    tables.append(df.withColumn("k", df.k + 1), "appended_rows")
    assert sorted(r.k for r in spark.table("appended_rows").collect()) == [1, 2]
    spark.sql("DROP TABLE appended_rows")


def test_stream_of_person_days(spark, tmp_path):
    spark.sql("SELECT timestamp'2024-01-01 10:00:00' AS ts, 4L AS user_id UNION ALL SELECT timestamp'2024-01-01 12:00:00', 4L UNION ALL SELECT timestamp'2024-02-01 12:00:00', 4L").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, user_id long").parquet(str(tmp_path / "in"))
    q = person_day_counts(stream).writeStream.format("memory").queryName("days").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.hh, r.pno, r.events) for r in spark.table("days").collect()) == [(1, 2, 1), (1, 2, 2)]


def test_tables_bucketed_alike_are_joined_without_an_exchange(spark):
    left = spark.range(1000).select((F.col("id") % 70).alias("hh"), F.col("id").alias("a"), (F.col("id") % 3).alias("part"))
    for t in ("bucketed_a", "bucketed_b"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    a = tables.create_table(left, "bucketed_a", bucket_by=("hh",), buckets=4)
    b = tables.create_table(left.groupBy("hh").agg(F.sum("a").alias("s")), "bucketed_b", bucket_by=("hh",), buckets=4)
    joined = a.join(b.hint("merge"), "hh").groupBy("hh").agg(F.max("s").alias("s"), F.sum("a").alias("t"))
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.where("s <> t").count() == 0 and joined.count() == 70
    with pytest.raises(Exception, match="(?i)exists"):
        tables.create_table(left, "bucketed_a")
    spark.sql("DROP TABLE IF EXISTS parted")
    parted = tables.create_table(left, "parted", partition_by=("part",))
    assert "part=1" in next(f for f in parted.inputFiles() if "part=1" in f)
    for t in ("bucketed_a", "bucketed_b", "parted"):
        spark.sql(f"DROP TABLE {t}")


def test_a_batch_appended_again_adds_nothing(spark):
    spark.sql("DROP TABLE IF EXISTS batches")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "hh int, v string")
    tables.append_batch(rows, "batches", "mon", bucket_by=("hh",), buckets=2)
    tables.append_batch(rows.withColumn("hh", F.col("hh") + 10), "batches", "tue", bucket_by=("hh",), buckets=2)
    tables.append_batch(rows.select("v", "hh"), "batches", "mon", bucket_by=("hh",), buckets=2)
    have = lambda: sorted((r.batch, r.hh, r.v) for r in spark.table("batches").collect())
    assert have() == [("mon", 1, "a"), ("mon", 2, "b"), ("tue", 11, "a"), ("tue", 12, "b")]
    tables.append_batch(rows.where("hh > 1"), "batches", "mon", bucket_by=("hh",), buckets=2)
    tables.append_batch(rows.limit(0), "batches", "tue", bucket_by=("hh",), buckets=2)
    assert have() == [("mon", 2, "b")]
    with pytest.raises(ValueError, match="only one side"):
        tables.append_batch(rows.select("hh"), "batches", "wed")
    with pytest.raises(ValueError, match="letters"):
        tables.append_batch(rows, "batches", "x' OR '1'='1")
    spark.sql("DROP TABLE batches")


def test_stages_are_computed_once_and_dropped(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(100).select((F.col("id") % 7).alias("hh"), "id").repartition(4, "hh").mapInArrow(count, "hh long, id long")
    with tables.Stages(spark, buckets=4) as stages:
        kept = stages.keep(rows, "x")
        assert kept.count() == 100 and kept.groupBy("hh").count().count() == 7
        plan = kept.groupBy("hh").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and stages.folder.startswith(tables.shared_folder(spark))
        assert seen.value == 100
        table = stages.kept[0]
    assert not spark.catalog.tableExists(table)
    with pytest.raises(Exception, match="(?i)path|exist|not found"):
        spark.read.parquet(f"{stages.folder}/x").count()


def test_bad_lines_are_counted_and_shown(spark, tmp_path):
    lines = ["k,v", *(f"{i},x{i}" for i in range(2000))]
    lines[700] = "seven,y"
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text('k,v\n5,"q\n')
    rows, bad = tables.bulk_load_counted(spark, str(tmp_path), "k int, v string", max_errors=5)
    assert rows.count() == 2000 and rows.where("k = 5").count() == 2
    assert [(r.file.rsplit("/", 1)[1], r.line) for r in bad.collect()] == [("a.csv", "seven,y")]
    with pytest.raises(tables.BadLines, match="1 lines don't fit.*seven,y"):
        tables.bulk_load_counted(spark, str(tmp_path), "k int, v string")
    (tmp_path / "b.csv").write_text("k,v\n1\n2,3,4\n")
    with pytest.raises(tables.BadLines, match="3 lines"):
        tables.bulk_load_counted(spark, str(tmp_path), "k int, v string", max_errors=2)
