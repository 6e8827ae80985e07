"""Quality rules: a ledger of failure bits and measurements, and versioned policies over it. Spark expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
#: Words of a window in n_repeat_words.
WINDOW = 5

#: Rules in the order of their bits: name and the SQL condition of a failure. New rules go to the end.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > 5 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 25 * n_words"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}

#: Policies by version: the rules of which a document may fail none.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length"),
}


def mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (all long), one row per row of docs."""
    df = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    trimmed = F.expr(r"trim(BOTH ' \t\n\x0b\f\r' FROM text)".replace(r"\x0b", "\\u000b").replace(r"\f", "\\u000c"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select("doc_id", words.alias("words"), lines.alias("lines"), F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    df = df.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    grams = F.when(F.col("n_words") < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")), lambda i: F.xxhash64(*(F.get("h", i + k) for k in range(WINDOW))))
    )
    rest = ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    df = df.select(*rest, grams.alias("grams"))
    # most texts repeat no window; only the others are sorted
    again = F.size(F.array_distinct("grams")) < F.size("grams")
    placed = F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    df = df.select(*rest, F.when(again, placed).alias("placed"))
    same = lambda x, k: F.coalesce(F.get("placed", k)["g"] == x["g"], F.lit(False))
    found = F.array_sort(F.transform(F.filter("placed", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))
    df = df.select(*rest, found.alias("found"))
    # a window covers WINDOW words, or those up to the next found window
    gain = F.transform("found", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("found", k + 1) - i, F.lit(WINDOW))))
    return df.select(*rest, F.coalesce(F.aggregate(gain, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long").alias("n_repeat_words"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements and fail_bits (long): bit k is set if rule k fails. Every rule is evaluated once.

    Nulls and empty texts have no words and fail few_words only. Rows that repeat are judged each; a very long text is
    measured whole, in one task. Only the named columns are used, whatever others are called; an empty table gives an
    empty ledger.
    """
    bits = " + ".join(f"CASE WHEN {condition} THEN {BIT[name]}L ELSE 0L END" for name, condition in RULES)
    return measure(docs, id_col, text_col).withColumn("fail_bits", F.expr(bits))


def apply_policy(judged: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with kept: no rule of the policy fails."""
    return judged.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0)


def ablations(judged: DataFrame, policy: str = "v1") -> DataFrame:
    """One row per rule of a policy: rule, failed, only_this (documents that would be kept without the rule), kept.

    Counted in one pass over the ledger's bits; texts are not read again.
    """
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long"))
    by_bits = judged.groupBy(bits.alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).cast("long").alias("bit")) for name in POLICIES[policy])))
    each = by_bits.select("bits", "n", rules.alias("r")).select("bits", "n", "r.*")
    some = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.groupBy("rule").agg(
        some(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        some(F.col("bits") == F.col("bit")).alias("only_this"),
        some(F.col("bits") == 0).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_policy(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")), "v1")
    base = F.col("fail_bits").bitwiseAND(F.lit(mask("base")).cast("long")) != 0
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "n_lines", "fail_bits")


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 4], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS k FROM g) WHERE k > 1),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, range(5) AS t(j) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN c ON d.doc_id = c.doc_id
), b AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 5 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 16 ELSE 0 END)::BIGINT AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, n_lines, fail_bits FROM b
"""
