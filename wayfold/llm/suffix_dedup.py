"""Suffix dedup: longest previous factors over suffix order, for bytes of strings that start at several places.

The longest previous factor of a position is the longest string from it that also starts earlier. In suffix order it is
the longer of what the suffix shares with the previous smaller and the next smaller position. Only factors of `length`
bytes or more remove anything, so suffixes are ordered by their first `length` bytes, and positions that cannot have
such a factor, or certainly have one, are settled before:

1. Anchors. A window (a string of `length` bytes) has an anchor, its smallest hash of GRAM bytes, at the same place in
   each of its copies. Windows whose anchor is found once only have no factor.
2. Classes. The windows of an anchor span a string. If every place of an anchor has the same one, all of them repeat it.
3. Ranges. Where places differ, RANGE neighbouring windows, counted from the anchor, share a core and span a string,
   which are judged alike: the key is the core now.
4. Suffixes. The rest, around the ends of repeats, is put in suffix order. A task takes previous and next smaller
   positions and the factors' lengths; of suffixes that agree on `length` bytes the first goes on to a range of
   fingerprints (128 bits), where it meets those of other tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, keyed, narrow, tagged
from .repeats import CHECK, ONE, REPEAT, SETTLED, SEVERAL, arrays_of, attach, entries, find_classes, ranges_for
from .words import BYTE_HASH, Spans, batch_bytes, chunks, mix, owned, shrink, slices, texts_of, winnow

LENGTH, GRAM, RANGE = 400, 64, 16
#: ext of a class: how far its first window begins before the anchor, and windows after the first one.
_EXT = 15
#: Bytes of texts whose anchors, and of spans whose suffixes, a task takes together.
CHUNK, SUFFIXES = 1 << 18, 1 << 18
_U = np.uint64
_SECOND = mix(BYTE_HASH)


def byte_pieces(offsets: np.ndarray, limit: int, overlap: int) -> Iterator[tuple[int, int, int, int]]:
    """(i, j, p, q): rows i to j with bytes p to q; a row of over 2 * limit bytes comes in pieces that share overlap bytes."""
    for i, j in chunks(offsets, limit):
        p, end = int(offsets[i]), int(offsets[j])
        while end - p > 2 * limit + overlap:
            yield i, j, p, p + limit + overlap
            p += limit
        yield i, j, p, end


def _anchors(length: int):
    """Places (repeats.PLACE) of the anchors of all windows: key the anchor, class the string that its windows span."""

    def places(batches: Iterator[pa.RecordBatch]):
        gram = min(GRAM, length)
        for batch in slices(batches):
            buf, offsets = batch_bytes(batch)
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_key", "_tag"))
            for i, j, p, q in byte_pieces(offsets, CHUNK, length - 1):
                if q - p < length:
                    continue
                bounds = np.clip(offsets[i : j + 1], p, q) - p
                spans = Spans(BYTE_HASH[buf[p:q]])
                n = q - p
                grams = spans.hash(np.arange(n - gram + 1), gram)
                ends = np.repeat(bounds[1:], np.diff(bounds))
                starts = n - length + 1
                inside = ends[:starts] - np.arange(starts) >= length
                least, chosen = winnow(grams, length - gram + 1, inside)
                lo, hi, anchor = owned(grams, least, chosen, inside, length - gram + 1)
                doc = np.searchsorted(bounds, lo, "right") - 1
                cls = mix(spans.hash(lo, hi - lo + length) + ((anchor - lo) << 20 | (hi - lo)).astype(_U) * _U(0x9E3779B97F4A7C15))
                pos = lo + p - offsets[i + doc]
                yield ids[i + doc], tags[i + doc], pos.astype(np.int32), ((anchor - lo) << _EXT | (hi - lo)).astype(np.int32), grams[anchor], cls, np.full(len(lo), ONE, np.int8)

    return places


def previous_smaller(x: np.ndarray, back: bool = False) -> np.ndarray:
    """Of each place the nearest one before it (back: after it) with a smaller value, -1 without one; values are distinct."""
    if back:
        out = len(x) - 1 - previous_smaller(x[::-1])[::-1]
        return np.where(out == len(x), -1, out)
    tables = [x]  # minima of 2**k places up to each
    while len(tables[-1]) and 1 << len(tables) <= len(x):
        step = 1 << (len(tables) - 1)
        tables.append(np.concatenate([tables[-1][:step], np.minimum(tables[-1][step:], tables[-1][:-step])]))
    at = np.arange(len(x)) - 1
    for k in range(len(tables) - 1, -1, -1):
        full = (at >= (1 << k) - 1) & (tables[k][np.maximum(at, 0)] > x)
        at = np.where(full, at - (1 << k), at)
    return at


class Suffixes:
    """Suffixes of a text from the given starts, compared on `length` bytes, all of which are there for each start."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, length: int):
        self.length, self.starts, self.step = length, starts, min(8, length)
        self.words = np.zeros(max(0, len(text) - self.step + 1), _U)  # the next bytes of each place as a number
        for k in range(self.step):
            self.words = self.words << _U(8) | text[k : len(self.words) + k].astype(_U)
        # rank: how many suffixes are smaller; those that agree so far share one and are told apart by their next bytes
        self.rank = np.zeros(len(starts), np.int64)
        live = np.arange(len(starts))
        for d in self._steps():
            if len(live) < 2:
                break
            word, rank = self.words[starts[live] + d], self.rank[live]
            order = np.lexsort((word, rank))
            live, word, rank = live[order], word[order], rank[order]
            first = np.concatenate([[True], rank[1:] != rank[:-1]])
            run = np.concatenate([[True], first[1:] | (word[1:] != word[:-1])])
            at = np.flatnonzero(run)
            begin = np.flatnonzero(first)[np.cumsum(first) - 1]
            size = np.diff(np.append(at, len(live)))
            of = np.cumsum(run) - 1
            self.rank[live] = rank + at[of] - begin
            live = live[size[of] > 1]

    def _steps(self) -> list[int]:
        return [*range(0, self.length - self.step, self.step), self.length - self.step]

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes a and b (numbers of starts) share, `length` at most."""
        n = np.full(len(a), self.length)
        live = np.flatnonzero(self.rank[a] != self.rank[b])
        for d in self._steps():
            x = self.words[self.starts[a[live]] + d] ^ self.words[self.starts[b[live]] + d]
            ends = np.flatnonzero(x)
            n[live[ends]] = d + sum((x[ends] >> _U(8 * k) == 0).astype(np.int64) for k in range(1, self.step))
            live = live[x == 0]
        return n

    def factors(self, which: np.ndarray) -> np.ndarray:
        """The longest previous factor of each start in which, starts being in the order of the corpus.

        which has all starts whose suffixes agree, if it has one of them.
        """
        array = which[np.lexsort((which, self.rank[which]))]  # the suffix array
        out = np.zeros(len(array), np.int64)
        for other in (previous_smaller(array), previous_smaller(array, back=True)):
            has = np.flatnonzero(other >= 0)
            out[has] = np.maximum(out[has], self.shared(array[has], array[other[has]]))
        lengths = np.zeros(len(self.starts), np.int64)
        lengths[array] = out
        return lengths[which]


class Bytes:
    """The bytes of the spans (pos and ext windows more) in a column of a batch, span by span, in chunks."""

    def __init__(self, batch: pa.RecordBatch, column: str, length: int, anchored: bool = False):
        rows, self.pos, ext = arrays_of(batch.column(column), "pos", "ext")
        self.pos = self.pos.astype(np.int64)
        self.anchor, self.ext = (ext >> _EXT, ext & (1 << _EXT) - 1) if anchored else (None, ext)
        self.ext = self.ext.astype(np.int64)
        self.ids, self.tags = (batch.column(c).to_numpy(zero_copy_only=False)[rows] for c in ("_key", "_tag"))
        self.rows, self.length, self.texts = rows, length, texts_of(batch)

    def chunks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """(spans, bytes, where each span's begin in them)"""
        size = self.ext + self.length
        for i, j in chunks(np.concatenate([[0], np.cumsum(size)]), SUFFIXES):
            text = b"".join(self.texts[r][a : a + n] for r, a, n in zip(self.rows[i:j], self.pos[i:j], size[i:j], strict=True))
            yield slice(i, j), np.frombuffer(text, np.uint8), np.cumsum(size[i:j]) - size[i:j]


def _steps(count: np.ndarray) -> np.ndarray:
    """0 to count - 1 for each count."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _ranges(length: int):
    """Places of the ranges of windows in the column _check: key the core, class the string that the windows span."""

    def places(batches: Iterator[pa.RecordBatch]):
        size = min(RANGE, length)
        for batch in slices(batches):
            b = Bytes(batch, "_check", length, anchored=True)
            for part, text, at in b.chunks():
                spans = Spans(BYTE_HASH[text])
                anchor, last = b.anchor[part].astype(np.int64), b.ext[part]
                # ranges of a span, counted from the anchor backwards
                low, high = (anchor - last) // size, anchor // size
                count = high - low + 1
                of = np.repeat(np.arange(len(count)), count)
                core = anchor[of] - size * (low[of] + _steps(count))
                first, end = np.maximum(core - size + 1, 0), np.minimum(core, last[of])
                s = at[of] + first
                cls = mix(spans.hash(s, end - first + length) + ((core - first) << 20 | (end - first)).astype(_U) * _U(0x9E3779B97F4A7C15))
                key = spans.hash(at[of] + core, length - size + 1)
                zeros = np.zeros(len(of), np.int8)
                yield b.ids[part][of], b.tags[part][of], (b.pos[part][of] + first).astype(np.int32), (end - first).astype(np.int32), key, cls, zeros

    return places


def _suffixes(length: int, first_stays: bool):
    """Places of every window of the spans in the column _check; class and key are fingerprints of the window.

    Suffixes with a previous factor of `length` bytes in the same task are settled here: found and not sent. The first
    of each run goes on; if no copy stays, it is found as well.
    """

    def settled(b: Bytes, part: slice, text: np.ndarray, at: np.ndarray):
        count = b.ext[part] + 1
        of, step = np.repeat(np.arange(len(count)), count), _steps(count)
        starts, ids, tags, pos = at[of] + step, b.ids[part][of], b.tags[part][of], b.pos[part][of] + step
        # of windows that two spans have in common, or repeated rows bring again, one stays
        order = np.lexsort((pos, tags, ids))
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in (ids, tags, pos)])
        starts, ids, tags, pos = (x[order[new]] for x in (starts, ids, tags, pos))
        suffixes = Suffixes(text, starts, length)
        alike = np.bincount(suffixes.rank)[suffixes.rank] > 1 if len(starts) else np.zeros(0, bool)
        later = np.zeros(len(starts), bool)
        later[alike] = suffixes.factors(np.flatnonzero(alike)) >= length
        known = later if first_stays else alike
        sent = ~later
        many = np.concatenate([np.full(known.sum(), SETTLED), np.where(alike, SEVERAL, ONE)[sent]]).astype(np.int8)
        one, two = (Spans(table[text]).hash(starts, length) for table in (BYTE_HASH, _SECOND))
        columns = (ids, tags, pos.astype(np.int32), np.zeros(len(pos), np.int32), one, two)
        return *(np.concatenate([x[known], x[sent]]) for x in columns), many

    def places(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches):
            b = Bytes(batch, "_check", length)
            for part, text, at in b.chunks():
                yield settled(b, part, text, at)

    return places


def intervals(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as maximal ones, in order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts)
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    at = np.flatnonzero(new)
    return starts[at], ends[np.append(at[1:], len(starts)) - 1]


def _cut_text(length: int):
    def cut_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, pos, ext = arrays_of(batch.column("_marks"), "pos", "ext")
            bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            total, removed, spans, kept, text = [], [], [], [], []
            for k, data in enumerate(texts_of(batch)):
                a, b = bounds[k], bounds[k + 1]
                s, e = intervals(pos[a:b].astype(np.int64), pos[a:b].astype(np.int64) + ext[a:b] + length)
                total.append(len(data))
                removed.append(int((e - s).sum()))
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(s, e, strict=True)])
                if len(s):
                    data = b"".join(data[x:y] for x, y in zip([0, *e], [*s, len(data)], strict=True))
                kept.append(data)
                text.append(data.decode("utf-8", "ignore"))
            kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            new = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kinds), pa.array(kept, pa.binary()), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("doc_id"), *new], ["_key", "doc_id", "n_bytes", "n_removed", "removed", "kept", "text"])

    return cut_text


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, first_stays: bool = True) -> DataFrame:
    """One row per row of docs: _key, doc_id, n_bytes, n_removed, removed array<struct<start, end>>, kept binary, text.

    A byte is removed if it lies in a string of `length` bytes that starts at another place too, and, if the first
    copy stays, earlier there: in a document with a smaller id, or before it in the same one. Texts are UTF-8 bytes,
    matches stay in one document, overlaps count, and strings are judged on the input; kept bytes needn't be whole
    characters, text is kept without broken ones. Strings are told apart by 128 bits.

    Nulls and empty texts have no bytes. Rows without an id have a key made from their text, below all ids. Rows that
    repeat an id and its text are one document and don't remove each other; with different texts they are several,
    in the order of text hashes. Very long texts are read in pieces of a quarter of a megabyte; only the last step holds one
    whole, with a few bytes for each of its own. Other columns are left behind, whatever their names. An empty table
    gives an empty result.
    """
    docs = tagged(keyed(docs, id_col, text_col))
    buckets = ranges_for(docs)
    own = docs.select("_key", "_tag", "text")
    classes = cut(find_classes(own, _anchors(length), first_stays, True, buckets))
    check = entries(classes, CHECK, "pos", "ext")
    with_text = lambda check: attach(shrink(narrow(own, check, ["_key", "_tag"])), check, "_check", "inner")
    ranges = cut(find_classes(with_text(check), _ranges(length), first_stays, True, buckets))
    suffixes = find_classes(with_text(entries(ranges, CHECK, "pos", "ext")), _suffixes(length, first_stays), first_stays, False, buckets)
    windows = F.transform("found", lambda x: F.struct(x["pos"].alias("pos"), x["ext"].bitwiseAND((1 << _EXT) - 1).alias("ext")))
    marks = entries(classes, REPEAT, "pos", "ext").withColumn("found", windows)
    for found in (ranges, suffixes):
        marks = marks.union(entries(found, REPEAT, "pos", "ext"))
    out = "_key long, doc_id long, n_bytes long, n_removed long, removed array<struct<start: long, end: long>>, kept binary, text string"
    return attach(shrink(docs), marks, "_marks").mapInArrow(_cut_text(length), out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = suffix_dedup(docs, first_stays=False)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "text")
