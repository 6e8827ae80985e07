"""Small helpers that the corpus operators share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few bytes that may be broadcast once they have been counted (some 8 MB); more are joined by a shuffle.
BROADCAST_ROWS = 250_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(col):
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, UPPER, UPPER.lower())


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints, that of spark.checkpoint.dir.

    Without one, a session in a single process gets a temporary folder; on a cluster that would be another folder on
    each machine, so it is an error there.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not re.match(r"local($|\[)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="wayfold-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_of(id_col: str, text_col: str):
    """The id as a long; without one a key made from the text, below all usual ids."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.shiftright(F.xxhash64(text), 3) - F.lit(1 << 62))


def text_hash(text_col: str):
    """64 bits of a text, others than those in key_of; null is empty. It tells rows apart that repeat an id."""
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.lit(1))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple | list = ()) -> DataFrame:
    """(_key, _text, doc_id, text) and the columns in more: null texts become empty.

    _key is the id as a long. Rows without an id get a key made from their text, below all usual ids, so that rows
    with different texts stay apart. _text is a hash of the text: rows that share _key and _text are one document,
    those that repeat an id with another text aren't. Other columns are left behind, whatever their names.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(key_of(id_col, text_col).alias("_key"), text_hash(text_col).alias("_text"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), *more)


def tagged(docs: DataFrame) -> DataFrame:
    """keyed docs with _tag instead of _text: the text's hash where rows share an id or have none, else 0.

    (_key, _tag) is a document; its order is that of ids, and of text hashes among rows that repeat an id with
    different texts. That most tags are 0 keeps what is shuffled small. Only ids are read to find repeated ones.
    """
    again = cut(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("again")))
    again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    tag = F.when(F.col("doc_id").isNull() | F.col("again").isNotNull(), F.col("_text")).otherwise(F.lit(0).cast("long"))
    rest = [c for c in docs.columns if c not in ("_key", "_text", "again")]
    return docs.join(again, F.col("doc_id") == F.col("again"), "left").select("_key", tag.alias("_tag"), *rest)


def narrow(left: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """left_semi join; the distinct keys (of something checkpointed) are broadcast only if their counted rows allow it."""
    keys = keys.select(*on).distinct()
    return left.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, on, "left_semi")


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], by: str, most: int = 4096) -> DataFrame:
    """rows joined with table (one row per keys), also where very many rows have the same keys.

    Keys of more than `most` rows are dealt into as many slots as they need, by a hash of the column `by`; the table's
    row goes to each of them. rows should be checkpointed: they are counted by keys first.
    """
    hot = cut(rows.groupBy(*keys).count().where(F.col("count") > most).select(*keys, F.expr(f"cast(1 + count div {most} as int)").alias("_slots")))
    hot = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    slots = F.coalesce("_slots", F.lit(1))
    rows = rows.join(hot, keys, "left").withColumn("_slot", F.pmod(F.xxhash64(by), slots.cast("long")).cast("int")).drop("_slots")
    table = table.join(hot, keys, "left").withColumn("_slot", F.explode(F.sequence(F.lit(0), slots - 1))).drop("_slots")
    return rows.join(table, [*keys, "_slot"]).drop("_slot")


def lookup(rows: DataFrame, key: str, table: DataFrame, spread: str) -> DataFrame:
    """rows left joined with table (one row per key), also where very many rows have the same key.

    Rows are dealt by (key, salt), the salt made from the column `spread`; table's row goes to each salt once.
    """
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(partitions(rows.sparkSession))).cast("int"))
    slots = rows.select(key, "_salt").distinct().join(table, key)
    return rows.join(slots, [key, "_salt"], "left").drop("_salt")
