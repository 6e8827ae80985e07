"""Ranked lexical search: bundles of items carry sparse accumulators of documents through the owners of their terms."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, UPPER, cut, lower_ascii
from .words import LOWER, pieces, slices, text_bytes, tokens

#: Documents that are returned for an item.
TOP = 50
#: Items of a bundle, and documents of a block: an array of BUNDLE x BLOCK scores is what a task holds at a time.
BUNDLE, BLOCK = 256, 2048
#: Postings of a block at most, but for those of its last document.
POSTINGS = 1 << 20
#: Shares of all additions up to the end of each stage; the terms of the greatest weights come first.
STAGES = (0.1, 0.3, 0.6, 1.0)
CHUNK = 1 << 19
#: The characters of terms, in a pattern that Java and RE2 read alike; in bytes: letters, digits and all beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])

_BLOCKS = "block long, filled long, n_terms long, ids array<bigint>, n binary, term binary, doc binary, tf binary"
_POSTINGS = "bundle int, block long, ids array<bigint>, n_docs int, term binary, doc binary, part binary"
_CARRIED = "bundle int, block long, item binary, doc binary, score binary, tops array<struct<item:int,bucket:int,n:bigint>>"


class Plan(NamedTuple):
    """What all stages know of one batch of items. Terms and items go by numbers."""

    pairs: np.ndarray  # (item, term), by item
    n_items: int
    weight: np.ndarray  # of each term
    owner: np.ndarray  # stage of each term, -1 for terms that add nothing
    rest: np.ndarray  # [stage, item]: what terms of later stages can add at most


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term), each once; rows of the same item are put together."""
    terms = F.regexp_extract_all(lower_ascii(F.col(f"`{text_col}`").cast("string")), F.lit(f"({TERM})"), 1)
    return items.select(F.col(f"`{id_col}`").alias("item"), F.explode(terms).alias("term")).distinct()


def blocks_of(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> DataFrame:
    """Blocks of up to BLOCK documents with the postings of the given terms, by term: document's place and count."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array([t.encode() for t in shared.value], pa.large_binary())
        base, made = TaskContext.get().partitionId() << 32, 0
        ids: list = []
        counts: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            n = np.zeros(len(ids), np.int64)
            for at, k in counts:
                n[at : at + len(k)] += k
            key, tf = _sums(*(np.concatenate(x) for x in zip(*keys, strict=True))) if keys else (np.zeros(0, np.int64),) * 2
            raw = lambda a, kind: pa.array([a.astype(kind).tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([base + made]), pa.array([int((n > 0).sum())]), pa.array([int(n.sum())]), pa.array([ids], pa.list_(pa.int64())), raw(n, "i8"), raw(key // BLOCK, "i4"), raw(key % BLOCK, "i4"), raw(tf, "i4")],
                ["block", "filled", "n_terms", "ids", "n", "term", "doc", "tf"],
            )

        for batch in slices(batches):
            buf, offsets = text_bytes(batch.column("text"))
            names, row = batch.column("doc_id").to_pylist(), 0
            for i, j, p, q in pieces(offsets, buf, CHUNK):
                found, first = tokens(LOWER[buf[p:q]], np.clip(offsets[i : j + 1], p, q) - p, _TERM)
                at = pc.fill_null(pc.index_in(found, value_set=known), -1).to_numpy().astype(np.int64)
                doc, n = np.repeat(np.arange(j - i), np.diff(first)), np.diff(first)
                while i < j:  # the piece's rows may belong to several blocks
                    if i >= row and (len(ids) == BLOCK or size >= POSTINGS):
                        yield block()
                        made, ids, counts, keys, size = made + 1, [], [], [], 0
                    again = i < row  # a further piece of a long text
                    place = len(ids) - again
                    k = min(j, i + BLOCK - place)
                    here = (doc < k - i) & (at >= 0)
                    keys.append(_sums(at[here] * BLOCK + doc[here] + place))
                    size += len(keys[-1][0])
                    counts.append((place, n[: k - i]))
                    ids += names[i + again : k]
                    at, doc, n = at[doc >= k - i], doc[doc >= k - i] - (k - i), n[k - i :]
                    i = row = k
        if ids:
            yield block()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(blocked, _BLOCKS)


def _sums(key: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their n (how many there are, without one)."""
    if n is not None:
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
    else:
        key = np.sort(key)
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[begin], np.diff(np.append(begin, len(key))) if n is None else np.add.reduceat(n, begin) if len(begin) else n


def _parts(row: dict, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, document, part): what a posting adds to a score, without the term's weight."""
    term, doc, tf = (np.frombuffer(row[c], "<i4").astype(np.int64) for c in ("term", "doc", "tf"))
    length = np.frombuffer(row["n"], "<i8")
    m = 100 - 50 + (50 * length * n_docs) // max(1, n_terms)
    return term, doc, (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])


def _term_stats(blocks: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(term, df, most): documents that have the term, and the largest part that it adds to one."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                term, _, part = _parts(row, n_docs, n_terms)
                begin = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
                most = np.maximum.reduceat(part, begin) if len(begin) else part
                yield pa.RecordBatch.from_arrays([pa.array(term[begin], pa.int32()), pa.array(np.diff(np.append(begin, len(term)))), pa.array(most)], ["term", "df", "most"])

    return blocks.select("n", "term", "doc", "tf").mapInArrow(counted, "term int, df long, most long").groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"))


def make_plan(pairs: np.ndarray, n_items: int, df: np.ndarray, most: np.ndarray, n_docs: int) -> Plan:
    """Weights, the owner of each term, and what later owners can add to an item's scores at most."""
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(k) + 1))) if k else 0 for k in df], np.int64)
    load = df * np.bincount(pairs[:, 1], minlength=len(df))
    order = np.lexsort((np.arange(len(df)), -weight))
    done = np.cumsum(load[order]) / max(1, load.sum())
    owner = np.zeros(len(df), np.int64)
    owner[order] = np.minimum(np.searchsorted(STAGES, done - 1e-12), len(STAGES) - 1)
    owner[(weight <= 0) | (df == 0)] = -1
    rest = np.zeros((len(STAGES), n_items), np.int64)
    for s in range(len(STAGES)):
        later = pairs[owner[pairs[:, 1]] > s]
        np.add.at(rest[s], later[:, 0], weight[later[:, 1]] * most[later[:, 1]])
    return Plan(pairs, n_items, weight, owner, rest)


def _owned(blocks: DataFrame, plan: Plan, stage: int, n_docs: int, n_terms: int) -> DataFrame:
    """The postings of a stage's terms, for each bundle of items those of its own terms."""
    bundles = []
    for k in range(-(-plan.n_items // BUNDLE)):
        of = np.unique(plan.pairs[(plan.pairs[:, 0] // BUNDLE == k), 1])
        bundles.append(of[plan.owner[of] == stage])
    shared = blocks.sparkSession.sparkContext.broadcast(bundles)
    last = stage == len(STAGES) - 1

    def owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                term, doc, part = _parts(row, n_docs, n_terms)
                for k, of in enumerate(shared.value):
                    lo, hi = np.searchsorted(term, of), np.searchsorted(term, of, "right")
                    size = hi - lo
                    at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                    raw = [pa.array([a[at].astype("<i4").tobytes()], pa.binary()) for a in (term, doc, part)]
                    ids = pa.array([row["ids"] if last else None], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([row["block"]]), ids, pa.array([len(row["ids"])], pa.int32()), *raw], ["bundle", "block", "ids", "n_docs", "term", "doc", "part"])

    return blocks.mapInArrow(owned, _POSTINGS)


def _buckets(score: np.ndarray) -> np.ndarray:
    """Numbers that grow with positive scores: the leading 7 bits and how many follow."""
    shift = np.maximum(np.frexp(score.astype(float))[1].astype(np.int64) - 7, 0)
    return shift * 128 + (score >> shift)


def _floor(bucket: int) -> int:
    """No score of a bucket is less."""
    return (bucket % 128) << (bucket // 128)


def _stage(carried: DataFrame, postings: DataFrame, plan: Plan, stage: int, least: np.ndarray, top: int) -> DataFrame:
    """One owner: its postings are added to the accumulators of each bundle and block, which then go on.

    What can't reach the `top` best of its item any more goes: less than the best known bound of the item (least, or
    the top-th accumulator of the block), even with the most that later owners can add. The last stage gives the best
    `top` of each item and block.
    """
    shared = carried.sparkSession.sparkContext.broadcast((plan, least))
    last = stage == len(STAGES) - 1

    def add(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        plan, least = shared.value
        bundle, block = (k.as_py() for k in key)
        lo, hi = bundle * BUNDLE, min(plan.n_items, bundle * BUNDLE + BUNDLE)
        (own,) = right.to_pylist()
        score = np.zeros((hi - lo, own["n_docs"]), np.int64)
        for row in left.to_pylist():
            score[np.frombuffer(row["item"], "<i4"), np.frombuffer(row["doc"], "<i4")] = np.frombuffer(row["score"], "<i8")
        term, doc, part = (np.frombuffer(own[c], "<i4") for c in ("term", "doc", "part"))
        part = part.astype(np.int64)
        pairs = plan.pairs[np.searchsorted(plan.pairs[:, 0], lo) : np.searchsorted(plan.pairs[:, 0], hi)]
        pairs = pairs[plan.owner[pairs[:, 1]] == stage]
        for (item, t), a, b in zip(pairs.tolist(), np.searchsorted(term, pairs[:, 1]).tolist(), np.searchsorted(term, pairs[:, 1], "right").tolist(), strict=True):
            if b > a:
                score[item - lo, doc[a:b]] += plan.weight[t] * part[a:b]
        best = np.partition(score, -top, axis=1)[:, -top:] if score.shape[1] > top else score
        kth = best.min(axis=1) if score.shape[1] >= top else np.zeros(hi - lo, np.int64)
        bound = np.maximum(np.maximum(least[lo:hi], kth) - plan.rest[stage, lo:hi], 1)
        item, at = np.nonzero(score >= bound[:, None])
        value = score[item, at]
        if last:
            ids = np.array([np.iinfo(np.int64).max if i is None else i for i in own["ids"]], np.int64)
            order = np.lexsort((ids[at], -value, item))
            item, at, value = item[order], at[order], value[order]
            good = np.arange(len(item)) - np.searchsorted(item, item) < top
            ids = pa.array([own["ids"][k] for k in at[good].tolist()], pa.int64())
            return pa.table([pa.array(item[good] + lo, pa.int32()), ids, pa.array(value[good], pa.int64())], ["item", "doc_id", "score"])
        of, k = np.nonzero(best > 0)
        pair, n = _sums(of * (1 << 20) + _buckets(best[of, k]))
        tops = pa.StructArray.from_arrays([pa.array(pair >> 20, pa.int32()), pa.array(pair & ((1 << 20) - 1), pa.int32()), pa.array(n, pa.int64())], ["item", "bucket", "n"])
        tops = pa.ListArray.from_arrays(pa.array([0, len(tops)], pa.int32()), tops)
        raw = [pa.array([x.astype(kind).tobytes()], pa.binary()) for x, kind in ((item, "<i4"), (at, "<i4"), (value, "<i8"))]
        return pa.table([pa.array([bundle], pa.int32()), pa.array([block], pa.int64()), *raw, tops], ["bundle", "block", "item", "doc", "score", "tops"])

    keys = ["bundle", "block"]
    return carried.groupBy(*keys).cogroup(postings.groupBy(*keys)).applyInArrow(add, "item int, doc_id long, score long" if last else _CARRIED)


def _least(carried: DataFrame, n_items: int, top: int) -> np.ndarray:
    """Of each item, a score that `top` accumulators have reached, from counts of scores by bucket over all blocks."""
    counts = carried.select("bundle", F.explode("tops").alias("t")).groupBy((F.col("bundle") * BUNDLE + F.col("t.item")).alias("item"), F.col("t.bucket").alias("bucket")).agg(F.sum("t.n").alias("n"))
    above = F.sum("n").over(W.partitionBy("item").orderBy(F.desc("bucket")))
    out = np.zeros(n_items, np.int64)
    for r in counts.withColumn("above", above).where(f"above >= {top}").groupBy("item").agg(F.max("bucket").alias("bucket")).collect():
        out[r.item] = _floor(r.bucket)
    return out


def _search(docs: DataFrame, pairs: DataFrame, top: int, id_col: str, text_col: str) -> DataFrame:
    """(item, doc_id, score): the best `top` documents of each item of a batch, and some more."""
    spark = docs.sparkSession
    table = pairs.toArrow()
    item_ids, terms = pc.unique(table["item"]), sorted(pc.unique(table["term"]).to_pylist())
    number = {t: k for k, t in enumerate(terms)}
    item = pc.fill_null(pc.index_in(table["item"], value_set=item_ids), 0).to_numpy().astype(np.int64)
    numbered = np.stack([item, np.array([number[t] for t in table["term"].to_pylist()], np.int64)], axis=1) if len(item) else np.zeros((0, 2), np.int64)
    numbered = numbered[np.lexsort((numbered[:, 1], numbered[:, 0]))]
    blocks = cut(blocks_of(docs, terms, id_col, text_col))
    n_docs, n_terms = (int(x or 0) for x in blocks.agg(F.sum("filled"), F.sum("n_terms")).first())
    stats = _term_stats(blocks, n_docs, n_terms).toArrow()
    df, most = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
    df[stats["term"].to_numpy()], most[stats["term"].to_numpy()] = stats["df"].to_numpy(), stats["most"].to_numpy()
    plan = make_plan(numbered, len(item_ids), df, most, n_docs)
    carried, least = spark.createDataFrame([], _CARRIED), np.zeros(len(item_ids), np.int64)
    for stage in range(len(STAGES)):
        carried = _stage(carried, _owned(blocks, plan, stage, n_docs, n_terms), plan, stage, least, top)
        if stage < len(STAGES) - 1:
            carried = cut(carried)
            least = np.maximum(least, _least(carried, len(item_ids), top))
    names = spark.createDataFrame(pa.table({"_n": pa.array(range(len(item_ids)), pa.int32()), "name": item_ids}))
    return carried.join(F.broadcast(names), F.col("item") == F.col("_n")).select(F.col("name").alias("item"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The `top` best documents of each item: item_id, rank int (from 1), doc_id, score long (above 0).

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. A term's weight
    is floor(1000 ln((2N + 2) / (2 df + 1))); it adds weight * (10^9 tf div (1000 tf + 20 m)), m = 50 + 50 n N div L.
    Equal scores go by doc_id, without one last.

    Every row of docs is a document, also where rows repeat or have no id; null and empty texts have no terms and are
    in no result. Rows with the same item_id, or none, are one item with the terms of all of them; an item without
    terms that any document has gives no rows. A very long text is read in pieces; empty tables give an empty result;
    only the named columns are used, whatever others are called.

    Pairs of item and term are broadcast once they are counted: items are searched in batches of BROADCAST_ROWS pairs,
    or of one item. A group of a stage is a bundle of items and a block of documents, of bounded size whatever words
    are frequent.
    """
    pairs = cut(item_terms(items, item_col, item_text))
    n, of = pairs.count(), F.pmod(F.xxhash64("item"), F.lit(1).cast("long"))
    k = 1
    while n > BROADCAST_ROWS:
        k *= 2
        of = F.pmod(F.xxhash64("item"), F.lit(k).cast("long"))
        worst = pairs.groupBy(of.alias("b")).agg(F.count("*").alias("n"), F.count_distinct(F.struct("item")).alias("items")).where(f"n > {BROADCAST_ROWS} AND items > 1")
        if k > 2 * n or worst.isEmpty():
            break
    batches = [pairs] if k == 1 else [pairs.where(of == b) for b in range(k)]
    found = reduce(DataFrame.unionByName, [_search(docs, batch, top, id_col, text_col) for batch in batches])
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(f"rank <= {top}").select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs, items)


SQL = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}') AS t FROM documents
), size AS (SELECT doc_id, len(t)::BIGINT AS n FROM words WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM size),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}')) AS term FROM benchmark
), counts AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(t) AS term FROM words) WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, total GROUP BY term, docs
), scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN size USING (doc_id), total GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
