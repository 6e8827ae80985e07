"""The corpus pipeline: toxicity, exact duplicates, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the docs of
the next one. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wayfold.llm import exact_dedup, ngram_jaccard, packing, substring_dedup, toxicity
from wayfold.llm.common import shared_folder

#: Words of a passage that counts as repeated.
PASSAGE = 30
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model accepts (score under 0.5); all of them where no label says what is toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, f"NOT {toxicity.HELD_OUT}")
    return toxicity.keep_rows(docs.select(COLUMNS), model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.keep_rows(docs).select(COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8), the document with the smallest id."""
    return ngram_jaccard.keep_rows(docs).select(COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of PASSAGE words that an earlier document has; documents with nothing left go."""
    return substring_dedup.cut_rows(docs, window=PASSAGE).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", toxic), ("exact_dedup", exact), ("near_dedup", near), ("substring_dedup", passages), ("packing", packed)]

#: SQL cannot express a fitted model; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
