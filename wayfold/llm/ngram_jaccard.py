"""N-gram Jaccard self-join with adaptive multi-match prefixes."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, key_of, keyed, lookup, narrow, text_hash
from .components import components
from .repeats import find
from .words import doc_hashes, ngram_hash

#: Most tokens that two prefixes can be asked to share.
MOST_MATCHES = 4
#: Rows of a token that meet in one task, on either side, before they are dealt into more.
GRID = 4096


def shingle_sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, int, int, list[np.ndarray]]]:
    """For each chunk of rows i to j the sorted distinct shingle hashes of each document."""
    for batch, i, j, hashes, first in doc_hashes(batches, lower=True):
        grams = ngram_hash(hashes, n)
        sets = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= n:
                g = np.sort(grams[a : b - n + 1])
                sets.append(g[np.concatenate([[True], g[1:] != g[:-1]])])
            else:  # fewer words than a shingle has: the whole sequence is one
                sets.append(ngram_hash(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
        yield batch, i, j, sets


def _least(n, num: int, den: int):
    """The overlap that a set of n needs at least, with any partner; a number, an array or SQL."""
    return f"(({num} * {n} + {den - 1}) div {den})" if isinstance(n, str) else -(-num * n // den)


def _first_matches(n: int) -> int:
    """Tokens that the prefixes in hash order of the first filter must share; grows with n."""
    return max(1, n // 10)


def _digest(tokens: np.ndarray) -> bytes:
    return blake2b(tokens.tobytes(), digest_size=16).digest()


def _signatures(n: int):
    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, j, sets in shingle_sets(batches, n):
            digests = [_digest(s) for s in sets]
            rows = [batch.column(c).slice(i, j - i) for c in ("_key", "_text", "doc_id")]
            new = [pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(np.frombuffer(b"".join(digests), np.int64)[::2])]
            yield pa.RecordBatch.from_arrays([*rows, *new], ["_key", "_text", "doc_id", "n", "digest", "h"])

    return signatures


def _prefixes(n: int, num: int, den: int):
    def places(batches: Iterator[pa.RecordBatch]):
        for _, _, _, sets in shingle_sets(batches, n):
            heads = [s[: len(s) - _least(len(s), num, den) + _first_matches(len(s))] for s in sets]
            sizes = np.array([len(h) for h in heads])
            ids = np.frombuffer(b"".join(map(_digest, sets)), np.int64)[::2]
            pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield np.concatenate(heads), np.repeat(ids, sizes), pos.astype(np.int32)

    return places


def _sets(n: int):
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, sets in shingle_sets(batches, n):
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(list(map(_digest, sets)), pa.binary()), tokens], ["digest", "tokens"])

    return sets_of


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """pairs (a, b) with common, the size of the exact intersection, and linked."""
    side = lambda c: sets.select(F.col("node").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("n", "tokens")))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("common", F.size(F.array_intersect("tokens_a", "tokens_b")))
    return both.withColumn("linked", F.expr(f"{den} * common >= {num} * (n_a + n_b - common)"))


def _bits(tokens):
    """64 bits, those of the tokens' hashes set: as many tokens at least as there are bits."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(x, F.lit(64)).cast("int"))))


def _distinct(members: DataFrame) -> DataFrame:
    """The distinct sets that aren't empty: digest, h, n, and first and least, the smallest (key, text hash) and id that have the set."""
    return members.where("n > 0").groupBy("digest").agg(F.min("h").alias("h"), F.min("n").alias("n"), F.min(F.struct("_key", "_text")).alias("first"), F.min("doc_id").alias("least"))


def jaccard_links(docs: DataFrame, shingle: int = 4, num: int = 85, den: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, nodes, links) of keyed documents; two sets link when den * intersection >= num * union.

    members: _key, _text, doc_id, n (set size), digest of the set, h, for every row. nodes: digest, node, first, least,
    for the distinct sets that may have a partner. links: a, b, two nodes. Links between nodes that earlier links connect
    already may be missing; the connected components are those of all links.

    1. A first filter, in hash order: a prefix of n - t + m tokens (t: the least overlap for size n, m = n / 10) must
       share m tokens with prefixes of other sets (repeats.find). Few sets without a partner pass.
    2. The tokens of those are ordered by frequency. The number of matches l that a set's prefix asks for grows with
       the candidates its first prefix would bring, and so does its length, n - t + l.
    3. Each set is verified against one central set of those it shares prefix tokens with; those links merge most
       members of large groups of near copies.
    4. Candidates share l prefix tokens, aren't linked to the same central set, and bounds from sizes, positions and
       the overlap with the central set leave room for a link. They are verified on whole sets. Of a token, members of
       its largest group are only met by others, and a common token's rows are dealt into a grid of tasks.
    """
    least = lambda n: _least(n, num, den)
    members = cut(docs.mapInArrow(_signatures(shingle), "_key long, _text long, doc_id long, n long, digest binary, h long"))
    hits = find(docs.select("_key", "text"), _prefixes(shingle, num, den)).groupBy(F.col("_key").alias("h")).agg(F.sum(F.size("places")).alias("hits"))
    passed = _distinct(members).join(hits, "h").where(f"hits >= greatest(1, {least('n')} div 10)")
    nodes = cut(passed.select("digest", "first", "least", "n", F.monotonically_increasing_id().alias("node")))

    texts = narrow(docs.select("_key", "text"), nodes.select("first._key"), ["_key"])
    sets = texts.mapInArrow(_sets(shingle), "digest binary, tokens array<long>").dropDuplicates(["digest"]).join(nodes.select("digest", "n", "node"), "digest")
    tokens = cut(sets.select("node", "n", "tokens")).select("node", "n", F.explode("tokens").alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df >= 2")
    # tokens that occur once come first in the order and match nothing: u = n - e of them, e others
    ordered = tokens.join(common, "token").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("o"), (F.sum(F.log("df")) / F.first("n")).alias("central"))
    ordered = ordered.withColumns({"e": F.size("o").cast("long"), "t": F.expr(least("n"))}).where("e >= t")
    cost = F.aggregate(F.slice("o", F.lit(1), F.expr("cast(e - t + 1 as int)")), F.lit(0).cast("long"), lambda s, x: s + x["df"])
    ordered = ordered.withColumn("l", F.least(F.lit(MOST_MATCHES), "t", 1 + F.floor(F.log(16.0, 1.0 + cost))).cast("long"))
    ordered = cut(ordered.select("node", "n", "e", "t", "l", "central", F.col("o.token").alias("tokens")))
    head = F.slice("tokens", F.lit(1), F.expr(f"cast(e - t + {MOST_MATCHES} as int)"))

    places = ordered.select("node", "central", F.explode(head).alias("token"))
    centres = places.groupBy("token").agg(F.max_by("node", F.struct("central", -F.col("node"))).alias("centre"), F.count("*").alias("k")).where("k > 1")
    near = places.select("node", "token").join(centres, "token").where("centre <> node")
    near = near.groupBy("node").agg(F.max_by("centre", F.struct("k", -F.col("centre"))).alias("b")).select(F.col("node").alias("a"), "b")
    # of the central set, which tokens are missing, and which ones are besides it
    stars = _verified(near, ordered, num, den).select("a", "b", "linked", "common", F.size("tokens_b").alias("whole"), _bits(F.array_except("tokens_b", "tokens_a")).alias("lacks"), _bits(F.array_except("tokens_a", "tokens_b")).alias("adds"))
    stars = cut(stars)
    first_links = stars.where("linked").select("a", "b")

    about = stars.select(F.col("a").alias("node"), F.when(F.col("linked"), F.col("b")).alias("c"), F.col("b").alias("centre"), "common", "whole", "lacks", "adds")
    wide = ordered.select("node", "n", "e", "t", "l", "central", head.alias("head")).join(about, "node", "left").withColumn("c", F.coalesce("c", "node"))
    wide = wide.select("*", F.posexplode("head").alias("i", "token")).drop("head").withColumns({"i": F.expr("i + 1L"), "level": F.expr("greatest(1L, i + 1 - (e - t))")})
    # rows of the grid hold the sets outside of the token's hub group, whatever groups they are in
    of_group = wide.groupBy("token", "c").agg(F.count("*").alias("k"), F.max(F.struct("central", -F.col("node"))).alias("most"))
    groups = of_group.groupBy("token").agg(F.sum("k").alias("k"), F.max_by("c", "most").alias("hub"), F.max_by("k", "most").alias("held")).where("k > 1")
    groups = groups.select("token", "hub", F.expr(f"cast(1 + (k - held) div {GRID} as int)").alias("rows"), F.expr(f"cast(1 + k div {GRID} as int)").alias("columns"))
    wide = wide.drop("central").join(groups, "token").withColumn("outside", F.col("c") != F.col("hub"))
    spread = lambda size: F.pmod(F.xxhash64("node"), F.col(size).cast("long")).cast("int")
    slots = lambda size: F.explode(F.sequence(F.lit(0), F.col(size) - 1))
    side = lambda df, s: df.select("token", "row", "column", *(F.col(c).alias(f"{c}_{s}") for c in df.columns if c not in ("token", "row", "column", "hub", "rows", "columns")))
    x = side(wide.where("outside").withColumn("row", spread("rows")).select("*", slots("columns").alias("column")), "x")
    y = side(wide.withColumn("column", spread("columns")).select("*", slots("rows").alias("row")), "y")
    room = lambda shared: f"{num + den} * ({shared}) >= {num} * (n_x + n_y)"
    inner = "least(common_x, common_y, whole_x - bit_count(lacks_x | lacks_y))"
    outer = " + CASE WHEN adds_x & adds_y = 0 THEN 0 ELSE least(e_x - common_x, e_y - common_y) END"
    candidates = x.join(y, ["token", "row", "column"]).where(
        f"""c_x <> c_y AND (node_x < node_y OR NOT outside_y) AND greatest(level_x, level_y) <= least(greatest(l_x, l_y), t_x, t_y)
        AND {room("least(e_x, e_y)")} AND {room("least(i_x, i_y) + least(e_x - i_x, e_y - i_y)")}
        AND (coalesce(centre_x <> centre_y, true) OR {room(inner + outer)})"""
    )
    pairs = candidates.groupBy(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).agg(F.count("*").alias("k"), F.min(F.expr("least(greatest(l_x, l_y), t_x, t_y)")).alias("l"))
    more = _verified(pairs.where("k >= l").select("a", "b"), ordered, num, den).where("linked").select("a", "b")
    return members, nodes, cut(first_links.union(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """One row per row of docs: _key, _text, doc_id, n_shingles, component, component_id, kept.

    component is the smallest key reachable by links, component_id the smallest id, null if no row there has one.

    Sets are the distinct shingles of lower-cased (A-Z) words; with fewer words the whole sequence is one shingle.
    Nulls and empty texts have empty sets, which link with nothing. Equal sets always link. Rows without an id have
    a key made from their text. Rows that repeat an id are documents of their own if their texts differ. kept marks
    the rows of a component that have the smallest key and, of these, the smallest text hash: one document, or
    repeats of it. Texts are read in pieces of rows, so a very long one needs memory in proportion to its words in
    one task. Other columns are left behind, whatever their names. An empty table gives an empty result.
    """
    members, nodes, links = jaccard_links(keyed(docs, id_col, text_col), shingle, num, den)
    joined = components(links).join(nodes.select("node", "digest", "first", "least"), "node")
    labels = joined.groupBy("component").agg(F.min("first").alias("label"), F.min("least").alias("id"))
    labels = joined.select("component", "digest").join(labels, "component").select("digest", "label", "id")
    classes = _distinct(members).join(labels, "digest", "left").select("digest", F.coalesce("label", "first").alias("label"), F.coalesce("id", "least").alias("id"))
    own = F.struct("_key", "_text")
    out = lookup(members, "digest", classes, "_key").withColumn("label", F.when(F.col("n") == 0, own).otherwise(F.col("label")))
    least = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("id")).alias("component_id")
    return out.select("_key", "_text", "doc_id", F.col("n").alias("n_shingles"), F.col("label._key").alias("component"), least, (own == F.col("label")).alias("kept"))


def keep_rows(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs (doc_id, text and any others) that are the first (smallest id) of their component, with all columns.

    Repeats of one row (same id and text) stay once.
    """
    kept = near_duplicates(docs, shingle=shingle, num=num, den=den).where("kept").select("_key", "_text").distinct()
    rows = docs.select(key_of("doc_id", "text").alias("_key"), text_hash("text").alias("_text"), F.struct("*").alias("row"))
    return rows.join(kept, ["_key", "_text"], "left_semi").dropDuplicates(["_key", "_text"]).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM r WHERE r.a = d.doc_id) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id
"""
