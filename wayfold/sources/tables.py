"""CSV and Parquet tables with explicit schemas."""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class Config:
    """Switches of the pipelines."""

    weighted: bool = True
    app_only: bool = False
    app_suffix: str = "_app_only"
    weight_cap: float | None = None
    analysis_days: tuple[int, ...] = (1, 2, 3, 4, 5)
    counties: tuple[int, ...] = ()
    max_stops: int = 20
    link_minutes: int = 35
    short_link_minutes: int = 15

    def weight(self, name: str) -> str:
        """A weight column's name: its suffix depends on whose diaries are used."""
        return f"{name}{self.app_suffix}" if self.app_only else name


def read_csv(spark: SparkSession, path: str, schema: StructType | str, columns: list[str] | None = None) -> DataFrame:
    """A CSV file with a header; columns (if any) are the only ones parsed."""
    df = spark.read.csv(path, header=True, schema=schema)
    return df.select(*columns) if columns else df


def bulk_load(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """Delimited text with one header line, without quotes; the first malformed line fails the job."""
    return spark.read.csv(path, header=True, schema=schema, sep=sep, quote="", mode="FAILFAST", enforceSchema=True)


class BadLines(ValueError):
    """Lines of a bulk load that don't fit the schema, more than were allowed."""


def bulk_load_counted(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", max_errors: int = 0, shown: int = 10) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines) of delimited text with one header line in each file, without quotes.

    Lines that don't fit the schema are left out of rows and are listed with file, byte (where the line begins in it)
    and line; with more than max_errors of them BadLines tells how many there are and shows the first. Files are split
    among tasks; no line is counted from the beginning of its file, so what is told of a line is where it begins.
    """
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_n"))
    # a header is the first line of a file: the first row of the block that begins at 0
    first = text.where("_start = 0").groupBy("file").agg(F.min("_n").alias("_h"))
    lines = text.join(first, "file", "left").where("_n <> _h OR _h IS NULL").drop("_h", "_start")
    wide = StructType([*schema.fields, StructField("_bad", StringType())])
    options = {"sep": sep, "quote": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = lines.select("file", "value", F.from_csv("value", wide.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    bad = parsed.where("r._bad IS NOT NULL").select("file", F.col("value").alias("line"))
    found = bad.limit(max_errors + 1).count() if max_errors < 10_000 else bad.count()
    if found > max_errors:
        examples = "; ".join(f"{r.file}: {r.line[:200]!r}" for r in bad.orderBy("file", "line").limit(shown).collect())
        raise BadLines(f"{bad.count()} lines don't fit the schema, {max_errors} are allowed: {examples}")
    return parsed.where("r._bad IS NULL").select(*(F.col(f"r.`{f.name}`") for f in schema.fields)), bad


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", quote: str = '"') -> None:
    """A CSV file with a header for each partition; with an empty quote, values are written as they are."""
    df.write.mode(mode).option("header", True).option("quote", quote or "\x00").csv(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def create_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = (), bucket_by: tuple[str, ...] = (), buckets: int | None = None, sort_by: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """A new table of the rows of df, partitioned and bucketed as told, and read again; a table of that name is an error.

    Tables with the same number of buckets by the same columns are joined and grouped by these without an exchange.
    Rows are dealt by the bucket columns first, so that each bucket of a partition is one file.
    """
    n = buckets or partitions(df.sparkSession)
    rows = df.repartition(n, *bucket_by) if bucket_by else df
    writer = rows.write.format("parquet").mode("errorifexists")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    if bucket_by:
        writer = writer.bucketBy(n, *bucket_by).sortBy(*(sort_by or bucket_by))
    writer = writer.option("path", path) if path else writer
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def append(df: DataFrame, table: str) -> None:
    """Rows added to a table, which is created if it isn't there; said twice, they are there twice."""
    df.write.mode("append").saveAsTable(table)


def append_batch(df: DataFrame, table: str, batch: str, column: str = "batch", bucket_by: tuple[str, ...] = (), buckets: int | None = None) -> None:
    """The rows of a batch in place of what the table has of the same batch, so that an append can be tried again.

    The table is partitioned by the batch's name in `column`, bucketed as told, and created by its first batch. Only
    the batch's own partition is overwritten, also by a batch without rows.
    """
    spark = df.sparkSession
    if not re.fullmatch(r"[\w.:-]+", batch):
        raise ValueError("a batch's name has letters, digits and _.:- only")
    if not spark.catalog.tableExists(table):
        create_table(df.limit(0).withColumn(column, F.lit(batch)), table, (column,), bucket_by, buckets)
    columns = [c for c in spark.table(table).columns if c != column]
    clash = set(df.columns) ^ set(columns)
    if clash:
        raise ValueError(f"columns that only one side has: {sorted(clash)}")
    n = buckets or partitions(spark)
    rows = (df.repartition(n, *bucket_by) if bucket_by else df).select(*(f"`{c}`" for c in columns))
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({column} = '{batch}') SELECT * FROM {{rows}}", rows=rows)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share, that of spark.checkpoint.dir; a session in one process gets one of its own."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="wayfold-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


class Stages:
    """Intermediate tables that several results read: written once to the shared folder, bucketed by `keys`.

    A stage is computed when it is kept, and read from then on: its rows are not computed again, whatever reads them
    and whichever executor is lost, and windows and groups by the keys begin without an exchange. A task reads a bucket,
    so there should be as many of them as the tables are dealt to. As a context manager it drops its tables and files in the end; without, they stay for whoever owns the folder.
    """

    def __init__(self, spark: SparkSession, keys: tuple[str, ...] = ("hh",), buckets: int | None = None):
        self.spark, self.keys, self.buckets = spark, keys, buckets or partitions(spark)
        self.name = f"stage_{uuid.uuid4().hex}"
        self.folder = f"{shared_folder(spark)}/{self.name}"
        self.kept: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """df as a table. Its rows should be dealt by the keys already; they aren't dealt again."""
        table = f"{self.name}_{name}"
        df.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", f"{self.folder}/{name}").saveAsTable(table)
        self.kept.append(table)
        return self.spark.table(table)

    def drop(self) -> None:
        for table in self.kept:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.kept = []
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


def empty_like(df: DataFrame) -> DataFrame:
    """No rows with the schema of df."""
    return df.sparkSession.createDataFrame([], df.schema)


def alias_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename those of the columns that are there: vintages of a survey name them differently."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def with_fallback(df: DataFrame, name: str, other: str) -> DataFrame:
    """The column `name`, copied from `other` where df lacks it."""
    return df if name in df.columns else df.withColumn(name, F.col(other))


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """The values of a key that several rows have; empty if the key is one."""
    return df.groupBy(*key).count().where("count > 1")


def tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{folder}/{n}.parquet") for n in names]
