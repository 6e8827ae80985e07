"""Joins, groups and reshapes that survey tables need again and again. Results don't depend on the order of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import partitions, shared_folder


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on all columns that both sides have."""
    on = [c for c in left.columns if c in right.columns]
    return left.join(right, on, "left")


def of_household(rows: DataFrame, members: DataFrame, hh: str = "hh", member: str = "pno") -> DataFrame:
    """Left join of members (hh, pno, ...) to rows by both keys, for rows that are dealt by household and stay where they are.

    A join by both keys would deal both sides anew. Here the other columns of a household's few members come as a list.
    """
    rest = [c for c in members.columns if c not in (hh, member)]
    listed = members.where(F.col(hh).isNotNull()).groupBy(hh).agg(F.collect_list(F.struct(F.col(member).alias("_m"), *rest)).alias("_all"))
    own = F.explode_outer(F.filter("_all", lambda m: m["_m"] == F.col(member)))
    return rows.join(listed, hh, "left").withColumn("_own", own).select(*rows.columns, *(F.col(f"_own.{c}") for c in rest))


def update_from(target: DataFrame, source: DataFrame, on: list[str], columns: dict[str, str], order: Column | None = None) -> DataFrame:
    """target with columns replaced by those of its match in source, where these aren't null.

    columns: column of target to column of source. Of several matches the first by `order` counts (by all replaced
    values, if none is given).
    """
    values = F.struct(*(F.col(s).alias(f"_{t}") for t, s in columns.items()))
    one = source.groupBy(*on).agg(F.min_by(values, order if order is not None else values).alias("_new"))
    joined = target.join(one, on, "left").withColumns({t: F.coalesce(F.col(f"_new._{t}"), F.col(t)) for t in columns})
    return joined.select(target.columns)


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each group by order; combined in each task before any row moves."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*").select(df.columns)


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first by order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def modal_value(df: DataFrame, keys: list[str], value: str, name: str | None = None) -> DataFrame:
    """The most frequent value of each group; of equally frequent ones the smallest."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("_n", -F.col(value))).alias(name or value))


def pivot_fixed(df: DataFrame, keys: list[str], column: str, names: dict, value: Column, fill=0) -> DataFrame:
    """One column for each value in names, aggregated; names decides the schema, whatever values occur."""
    out = df.groupBy(*keys).pivot(column, list(names)).agg(value)
    return out.select(*keys, *(F.coalesce(F.col(f"`{v}`"), F.lit(fill)).alias(n) for v, n in names.items()))


def unpivot_flags(df: DataFrame, keys: list[str], flags: dict[str, object], name: str) -> DataFrame:
    """A row for each flag that is 1, with the flag's value as the column `name`."""
    each = F.explode(F.array(*(F.struct(F.lit(v).alias(name), F.col(c).alias("_on")) for c, v in flags.items())))
    return df.select(*keys, each.alias("_f")).where("_f._on = 1").select(*keys, f"_f.{name}")


def renumber(df: DataFrame, keys: list[str], order: list[str], name: str, dense: bool = False) -> DataFrame:
    """Number the rows of each group from 1; dense numbers rows of equal order the same."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, (F.dense_rank() if dense else F.row_number()).over(w))


def dense_numbers(df: DataFrame, order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """df with its dense rank by the columns `order` over the whole table, from 1; nulls come first.

    A window without keys would be one task. Distinct keys are dealt by range and counted in each part; the counts,
    one for each part, give the number before each part, and only ranks within parts are windows.
    """
    spark = df.sparkSession
    shared_folder(spark)
    n = parts or partitions(spark)
    # dealing by range looks at a sample, so what is dealt is kept: counts and ranks must see the same parts
    keys = df.select(*order).distinct().repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    counts = {r["_part"]: r["count"] for r in keys.groupBy("_part").count().collect()}
    before = [(p, sum(c for q, c in counts.items() if q < p)) for p in counts]
    offsets = F.broadcast(spark.createDataFrame(before, "_part int, _before long"))
    ranked = keys.withColumn(name, F.row_number().over(W.partitionBy("_part").orderBy(*order))).join(offsets, "_part")
    ranked = ranked.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(order)), (F.col(name) + F.col("_before")).alias(name))
    return df.join(ranked, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(order)))).select(*df.columns, name)


def exclude_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """df without the rows whose key is in a table of keys."""
    return df.join(keys.distinct(), keys.columns, "left_anti")


def flag_exists(df: DataFrame, other: DataFrame, on: list[str], name: str) -> DataFrame:
    """1 if other has a row with the key, else 0."""
    return df.join(other.select(*on).distinct().withColumn(name, F.lit(1)), on, "left").fillna(0, [name])


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_sum(*columns: str) -> Column:
    """The sum of columns, nulls as 0."""
    return reduce(lambda a, b: a + b, (F.coalesce(F.col(c), F.lit(0)) for c in columns))


def joined_text(key: str, value: Column, sep: str = "-") -> Column:
    """An aggregate: values of a group joined in the order of key."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: p["v"].cast("string")), sep)


#: Rows of a lookup table that may be broadcast once they have been counted.
SMALL = 250_000


def small(df: DataFrame) -> DataFrame:
    """df, broadcast if it has SMALL rows at most; counting it is a job, so df should be cheap to make."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df
