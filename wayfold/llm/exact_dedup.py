"""Exact deduplication: tree-merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, lower_ascii

#: Runs that one merge joins.
FAN_IN = 16


def _verified(winner: Column) -> list[Column]:
    """A merge's result: the winner, the rows it stands for, and a check that equal digests belong to equal texts.

    The check compares byte length and a second, independent hash of all rows that share a digest.
    """
    same = (F.min("_len") == F.max("_len")) & (F.min("_check") == F.max("_check"))
    return [
        winner.alias("_best"),
        F.when(same, F.sum("_n")).otherwise(F.raise_error(F.lit("two texts share a digest"))).cast("long").alias("_n"),
        F.min("_len").alias("_len"),
        F.min("_check").alias("_check"),
    ]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", normalise=lower_ascii, fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size long, kept boolean, digest binary (SHA-256).

    Every partition is a run of (digest, best id, rows) entries, one for each digest it has. In each round, fan_in
    neighbouring runs are merged into one, digest ranges in parallel, and every merge keeps one verified entry per
    digest: log_fan_in(partitions) rounds leave one run. The results then go back to the first round's entries (a
    digest has one for each run at most) and from them to the rows, by (digest, run), so that a text which a third of
    all rows share is never gathered in one place.

    keep: "max" or "min" doc_id stays. Nulls: a null text equals an empty one; a null id loses against any id, and
    keep_id is null only if no row of the group has one. Repeated rows (same id and text) count in group_size and one
    of them stays. Very long texts are hashed whole and go no further than that. Only the named columns are used, whatever
    others are called; an empty table gives an empty result.
    """
    text = normalise(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    ids = F.col(f"`{id_col}`").cast("long")
    rows = cut(
        docs.select(ids.alias("doc_id"), text.alias("_t")).select(
            "doc_id",
            F.unhex(F.sha2("_t", 256)).alias("digest"),
            F.octet_length("_t").cast("long").alias("_len"),
            F.xxhash64("_t").alias("_check"),
            F.spark_partition_id().alias("_run"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    # the larger is the better; a null id is smaller than any
    sign = F.lit(1 if keep == "max" else -1)
    best = F.struct((F.col("doc_id") * sign).alias("id"), (-F.col("_row")).alias("row"))
    leaves = rows.withColumns({"_best": best, "_n": F.lit(1).cast("long")}).groupBy("digest", "_run").agg(*_verified(F.max("_best")))
    runs, level = rows.rdd.getNumPartitions(), leaves
    while runs > 1:
        level = level.withColumn("_run", F.expr(f"cast(_run div {fan_in} as int)"))
        level = level.groupBy("digest", "_run").agg(*_verified(F.max("_best")))
        runs = -(-runs // fan_in)
    whole = level.select("digest", F.col("_best").alias("_keep"), F.col("_n").alias("group_size"))
    by_run = leaves.select("digest", "_run").join(whole, "digest")
    out = rows.join(by_run, ["digest", "_run"])
    return out.select(
        "doc_id",
        (F.col("_keep.id") * sign).alias("keep_id"),
        "group_size",
        (F.col("_row") == -F.col("_keep.row")).alias("kept"),
        "digest",
    )


def keep_rows(docs: DataFrame, keep: str = "max") -> DataFrame:
    """The rows of docs (doc_id, text and any others) that exact_dedup keeps, with all their columns."""
    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    kept = exact_dedup(docs, keep=keep).where("kept").select(F.col("doc_id").alias("id"), "digest")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"), F.struct("*").alias("row"))
    out = rows.join(kept, rows["id"].eqNullSafe(kept["id"]) & (rows["digest"] == kept["digest"]), "left_semi")
    # rows that repeat an id and its text would all have come through
    return out.dropDuplicates(["id", "digest"]).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""
