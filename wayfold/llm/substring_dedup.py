"""Substring dedup: seed and extend on winnowed anchors.

1. Seeds. Every window has an anchor, the smallest hash of `anchor` neighbouring words in it, at the same place in each
   of its copies. A place of an anchor whose windows have the same words as those of an earlier place is a seed, with
   that place as its source. Anchors whose places differ are looked at window by window; each window that starts
   earlier, too, is a seed.
2. Chains. Seeds that follow each other in a document and in its source are chained.
3. Extension. Chains are joined with the texts of their sources and then with their own. Words are compared from the
   chain on both ways as far as they agree, up to `window` words beyond it: windows further on are seeds themselves, of
   this source or of an earlier one, so that all words of maximal repeats of `window` words or more are covered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import cut, keyed, narrow, spread_join, tagged
from .repeats import CHECK, ONE, REPEAT, arrays_of, attach, entries, find_classes, ranges_for
from .suffix_dedup import intervals
from .words import BLOCK_BYTES, IS_SPACE, Spans, doc_hashes, hashed, mix, ngram_hash, owned, shrink, slices, texts_of, winnow

#: Words of a repeat, and words of an anchor.
WINDOW, ANCHOR = 20, 6
_SPACES = re.compile(rb"[\x20\x09-\x0D]+")
_U = np.uint64


def _anchors(window: int, anchor: int):
    """Places (repeats.PLACE) of the anchors of all windows: key the anchor, class the words that its windows span."""

    def places(batches: Iterator[pa.RecordBatch]):
        for batch, i, _, hashes, first, base in hashed(batches, window - 1):
            if len(hashes) < window:
                continue
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_key", "_tag"))
            grams = ngram_hash(hashes, anchor)
            starts = len(hashes) - window + 1
            left = np.repeat(first[1:], np.diff(first)) - np.arange(len(hashes))
            inside = left[:starts] >= window
            least, chosen = winnow(grams, window - anchor + 1, inside)
            lo, hi, at = owned(grams, least, chosen, inside, window - anchor + 1)
            doc = np.searchsorted(first, lo, "right") - 1
            cls = mix(Spans(hashes).hash(lo, hi - lo + window) + ((at - lo) << 20 | (hi - lo)).astype(_U) * _U(0x9E3779B97F4A7C15))
            yield ids[i + doc], tags[i + doc], (lo - first[doc] + base).astype(np.int32), (hi - lo).astype(np.int32), grams[at], cls, np.full(len(lo), ONE, np.int8)

    return places


def _windows(window: int):
    """Places of every window of the spans in the column _check; key and class are fingerprints of its words."""

    def places(batches: Iterator[pa.RecordBatch]):
        for batch, i, j, hashes, first in doc_hashes(batches):
            rows, pos, ext = arrays_of(batch.column("_check").slice(i, j - i), "pos", "ext")
            ids, tags = (batch.column(c).slice(i, j - i).to_numpy(zero_copy_only=False) for c in ("_key", "_tag"))
            count = ext.astype(np.int64) + 1
            at = np.repeat(pos.astype(np.int64), count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            rows = np.repeat(rows, count)
            s = first[rows] + at
            zeros = np.zeros(len(s), np.int32)
            yield ids[rows], tags[rows], at.astype(np.int32), zeros, Spans(hashes).hash(s, window), Spans(mix(hashes ^ _U(0x5851F42D4C957F2D))).hash(s, window), zeros.astype(np.int8)

    return places


def cover(starts: np.ndarray, sizes: np.ndarray) -> list[int]:
    """Which of some intervals, in the order of their starts, are enough to cover what all of them cover."""
    kept, covered, best, reach = [], -1, -1, -1
    for k, (s, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
        if s > covered:
            if reach > covered:
                kept.append(best)
                covered = reach
            covered = max(covered, s)
        if s + n > reach:
            best, reach = k, s + n
    if reach > covered:
        kept.append(best)
    return kept


def _chains(window: int):
    """Seeds of a document that follow each other there and in the same source, as one row: start and size in words.

    Of chains that overlap, as those of a text that repeats itself do, only as many are kept as cover the same words.
    """

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pos, ext, key, tag, source = arrays_of(batch.column("_marks"), "pos", "ext", "src_key", "src_tag", "src_pos")
            pos, shift = pos.astype(np.int64), source.astype(np.int64) - pos
            end = pos + ext + window
            order = np.lexsort((pos, shift, tag, key, row))
            row, pos, end, key, tag, shift = (x[order] for x in (row, pos, end, key, tag, shift))
            same = np.zeros(len(pos), bool)
            same[1:] = np.logical_and.reduce([x[1:] == x[:-1] for x in (row, key, tag, shift)])
            reach = np.maximum.accumulate(end + (np.cumsum(~same) << 40)) - (np.cumsum(~same) << 40)
            new = ~same
            new[1:] |= pos[1:] > reach[:-1]
            at = np.flatnonzero(new)
            size = reach[np.append(at[1:], len(pos)) - 1] - pos[at] if len(at) else at
            order = np.lexsort((-size, pos[at], row[at]))
            kept = order[cover((pos[at] + (row[at].astype(np.int64) << 40))[order], size[order])]
            at, size = at[kept], size[kept]
            ids = [batch.column(c).to_numpy(zero_copy_only=False)[row[at]] for c in ("_key", "_tag")]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (*ids, pos[at], size, key[at], tag[at], pos[at] + shift[at])], ["_key", "_tag", "start", "size", "src_key", "src_tag", "src_start"])

    return chained


def word_starts(data: bytes) -> np.ndarray:
    """Where the words of a text begin, and its length at the end; the text is read in blocks."""
    buf = np.frombuffer(data, np.uint8)
    out = []
    for p in range(0, len(buf), BLOCK_BYTES):
        space = IS_SPACE[buf[max(0, p - 1) : p + BLOCK_BYTES]]
        if p == 0:
            space = np.concatenate([[True], space])
        out.append(np.flatnonzero(space[:-1] & ~space[1:]) + p)
    return np.concatenate([*out, [len(buf)]]).astype(np.int64)


def _sources(window: int):
    """Of each chain, the words of its source and `window` more on both sides; left counts those before it."""

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        last, data, starts = None, b"", np.zeros(1, np.int64)
        for batch in slices(batches):
            left, source = [], []
            for z, key, tag, start, size in zip(*(batch.column(c) for c in ("z", "src_key", "src_tag", "src_start", "size")), strict=True):
                if last != (key.as_py(), tag.as_py()):
                    last, data = (key.as_py(), tag.as_py()), unpacker.decompress(z.as_py())
                    starts = word_starts(data)
                a = max(0, start.as_py() - window)
                b = min(len(starts) - 1, start.as_py() + size.as_py() + window)
                left.append(start.as_py() - a)
                source.append(packer.compress(data[starts[a] : starts[b]]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_key", "_tag", "start", "size")), pa.array(left, pa.int64()), pa.array(source, pa.binary())], ["_key", "_tag", "start", "size", "left", "source"])

    return cut_out


def extended(own: list[bytes], other: list[bytes], start: int, size: int, window: int) -> list[tuple[int, int]]:
    """Maximal runs of `window` words or more that own and other have in common at the same places, from a chain on."""
    n = min(len(own), len(other))
    if own[start : start + size] == other[start : start + size] and start + size <= n:
        a, b = start, start + size
        while a > 0 and own[a - 1] == other[a - 1]:
            a -= 1
        while b < n and own[b] == other[b]:
            b += 1
        return [(a, b)] if b - a >= window else []
    differ = [-1, *(k for k in range(n) if own[k] != other[k]), n]
    return [(a + 1, b) for a, b in zip(differ, differ[1:], strict=False) if b - a - 1 >= window]


def repeats_in(data: bytes, starts: np.ndarray, chains: list[dict] | None, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of a text that its chains, extended both ways, cover: intervals."""
    unpacker, found = zstandard.ZstdDecompressor(), []
    for c in chains or ():
        other = unpacker.decompress(c["source"]).split()
        a = c["start"] - c["left"]
        own = data[starts[max(0, a)] : starts[min(len(starts) - 1, a + len(other))]].split()
        other = other[max(0, -a) :]
        a = max(0, a)
        found += [(a + x, a + y) for x, y in extended(own, other, c["start"] - a, c["size"], window)]
    s, e = np.array(found, np.int64).reshape(-1, 2).T
    return intervals(s, e)


def left_over(data: bytes, starts: np.ndarray, gone: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """The stretches of a text between intervals of words that go, without white space around them."""
    stretches = zip([0, *gone[1]], [*gone[0], len(starts) - 1], strict=True)
    return [data[starts[a] : starts[b]].strip(b" \t\n\r\x0b\x0c") for a, b in stretches if b > a]


def _spaced(data: bytes) -> bytes:
    return b" ".join(data.split()) if len(data) <= BLOCK_BYTES else _SPACES.sub(b" ", data).strip(b" ")


def _cut_text(window: int):
    def cut_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, total, removed = [], [], []
            for data, chains in zip(texts_of(batch), batch.column("_chains"), strict=True):
                starts = word_starts(data)
                gone = repeats_in(data, starts, chains.as_py(), window)
                total.append(len(starts) - 1)
                removed.append(int((gone[1] - gone[0]).sum()))
                kept.append(b" ".join(map(_spaced, left_over(data, starts, gone))) if len(gone[0]) else _spaced(data))
            new = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("doc_id"), *new], ["_key", "doc_id", "n_words", "n_removed", "kept_text"])

    return cut_text


def _matches(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """Chains of seeds in tagged docs, with the words of their sources: _key, _tag, found array<struct>."""
    buckets = ranges_for(docs)
    own = docs.select("_key", "_tag", "text")
    seed = ("pos", "ext", "src_key", "src_tag", "src_pos")
    classes = cut(find_classes(own, _anchors(window, anchor), True, True, buckets))
    check = entries(classes, CHECK, "pos", "ext")
    check = attach(shrink(narrow(own, check, ["_key", "_tag"])), check, "_check", "inner")
    windows = find_classes(check, _windows(window), True, False, buckets)
    seeds = entries(classes, REPEAT, *seed).union(entries(windows, REPEAT, *seed)).groupBy("_key", "_tag").agg(F.flatten(F.collect_list("found")).alias("_marks"))
    chains = cut(seeds.mapInArrow(_chains(window), "_key long, _tag long, start long, size long, src_key long, src_tag long, src_start long"))
    source = own.withColumnsRenamed({"_key": "src_key", "_tag": "src_tag"})
    source = narrow(source, chains, ["src_key", "src_tag"])
    again = F.col("src_tag") != 0  # of rows that share an id and a text, one is a source
    source = shrink(source.where(~again).union(source.where(again).dropDuplicates(["src_key", "src_tag"])))
    joined = spread_join(chains, source, ["src_key", "src_tag"], "_key").mapInArrow(_sources(window), "_key long, _tag long, start long, size long, left long, source binary")
    return joined.select("_key", "_tag", F.array(F.struct("start", "size", "left", "source")).alias("found"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """One row per row of docs: _key, doc_id, n_words, n_removed long, kept_text string.

    A word is removed if a window of `window` words around it also starts earlier: in a document with a smaller id,
    or before it in the same one. Windows are judged on the input. Kept words are joined by one space. What is removed
    was compared word by word; hashes only say where to look. A passage in a third of all documents is settled within
    tasks first, and each of its places has one source.

    Nulls and empty texts have no words. A null id counts as smaller than any id. Rows that repeat an id and its text
    are one document and don't remove each other; with different texts they are several, in the order of text hashes.
    Very long texts are read in pieces; what is held of one whole is its bytes and 8 bytes a word. Other columns are
    left behind, whatever their names. An empty table gives an empty result.
    """
    docs = tagged(keyed(docs, id_col, text_col))
    out = "_key long, doc_id long, n_words long, n_removed long, kept_text string"
    return attach(shrink(docs), _matches(docs, window, anchor), "_chains").mapInArrow(_cut_text(window), out)


def cut_rows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The rows of docs without the repeats in their texts, with all columns and n_chars as the text is then.

    What is left of a text keeps its white space; texts without repeats stay as they are, nulls too. Rows of which
    nothing is left go.
    """

    def cut_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, stays = [], np.ones(batch.num_rows, bool)
            for k, (data, chains) in enumerate(zip(texts_of(batch), batch.column("_chains"), strict=True)):
                if chains.is_valid:
                    starts = word_starts(data)
                    gone = repeats_in(data, starts, chains.as_py(), window)
                    if len(gone[0]):
                        data = b" ".join(left_over(data, starts, gone))
                        stays[k] = bool(data)
                texts.append(data)
            out = [batch.column("row"), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(out, ["row", "text"]).filter(pa.array(stays))

    rest = [c for c in docs.columns if c != "text"]
    own = tagged(keyed(docs))
    tags = tagged(keyed(docs.select("*", F.struct("*").alias("_row")), "doc_id", "text", ["_row"]))
    rows = tags.select("_key", "_tag", F.col("_row.text").cast("string").alias("text"), F.struct(*(F.col(f"_row.`{c}`") for c in rest)).alias("row"))
    schema = StructType([StructField("row", rows.schema["row"].dataType), StructField("text", StringType())])
    out = attach(shrink(rows), _matches(own, window, anchor), "_chains").mapInArrow(cut_text, schema)
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return out.select(*(new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS m
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS k FROM s) WHERE k > 1
), c AS (SELECT DISTINCT doc_id, i + j AS i FROM r, range(20) AS t(j)),
p AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (
  SELECT p.doc_id, coalesce(string_agg(x, ' ' ORDER BY p.i) FILTER (c.i IS NULL), '') AS t, count(c.i) AS n_removed
  FROM p LEFT JOIN c ON p.doc_id = c.doc_id AND p.i = c.i GROUP BY p.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
