"""Periodic runs of words: a dictionary of basic factors proposes periods, progressions are extended to runs, told once."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import IS_SPACE, batch_bytes, chunks, slices, tokens

#: A run has at least so many words, and at least so many times its period.
MIN_WORDS, MIN_REPEATS = 24, 3
#: Bytes of texts that are looked at together; a longer text is looked at alone.
CHUNK = 1 << 19

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(words: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in documents, by start, then period.

    words are numbers of words, document d has those from first[d] to first[d + 1]. The dictionary of basic factors
    names every factor of 1, 2, 4, ... words that is found again in its document: equal factors have equal names, and
    a name of 2k words is a pair of names of k words. A factor of k words whose next occurrence is d words on, k / 2 <
    d <= k, proposes d: as the factor is no shorter, d is the smallest period of the k + d words from it on. Places of
    such factors that are d apart are progressions; those of neighbouring places belong to one stretch, and a gap
    means that the stretch can't be extended. A run of period d and 3d words or more has such factors at each of its
    places but the last k + d - 1, k being the least power of two of d or more, so it is proposed at this k only.
    """
    n = len(words)
    ends = np.repeat(first[1:], np.diff(first))
    longest = int(np.diff(first).max()) if n else 0
    key = words.astype(np.int64) + (np.repeat(np.arange(len(first) - 1), np.diff(first)) * (int(words.max()) + 1 if n else 1))
    at, size = np.arange(n), 1
    out: list[np.ndarray] = [np.zeros((3, 0), np.int64)]
    while len(at) and min_repeats * (size // 2 + 1) <= longest:
        # names: ranks of the keys, and places in the order of names
        order = np.argsort(key)
        rank = np.zeros(len(at), np.int64)
        ranked = key[order]
        rank[order[1:]] = np.cumsum(ranked[1:] != ranked[:-1])
        by_name = np.sort(rank * n + at)
        place = by_name % n
        again = by_name[1:] // n == by_name[:-1] // n
        gap = np.diff(place)
        found = again & (gap <= size) & (2 * gap > size)
        out.append(_stretches(place[:-1][found], gap[found], size, n))
        # factors of twice the size, both halves of which are found again
        often = np.zeros(n, bool)
        often[place[1:][again]] = True
        often[place[:-1][again]] = True
        name = np.zeros(n, np.int64)
        name[at] = rank
        at = at[often[at] & (at + 2 * size <= ends[at])]
        at = at[often[at + size]]
        key = name[at] * n + name[at + size]
        size *= 2
    start, length, period = np.concatenate(out, axis=1)
    good = length >= np.maximum(min_words, min_repeats * period)
    start, length, period = start[good], length[good], period[good]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _stretches(place: np.ndarray, gap: np.ndarray, size: int, n: int) -> np.ndarray:
    """Progressions of factors put together: (start, length, period) of stretches in which words `gap` apart are equal."""
    key = np.sort(gap * (n + 1) + place)
    if not len(key):
        return np.zeros((3, 0), np.int64)
    begin = np.concatenate([[True], np.diff(key) != 1])
    last = np.append(np.flatnonzero(begin)[1:] - 1, len(key) - 1)
    period, start = key[begin] // (n + 1), key[begin] % (n + 1)
    return np.stack([start, key[last] - key[begin] + period + size, period])


def repeated_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Of n words, those that a run contains after its first `period` words."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges[:n]) > 0


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS, order: Callable[[int | None, int], np.ndarray | None] | None = None
) -> DataFrame:
    """One row per row of docs: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    Words are runs of characters other than 0x20 and 0x09-0x0D. A run is a stretch of words with smallest period p and
    at least max(min_words, min_repeats * p) words that no neighbouring word extends; start is a word's number, from 0.
    min_repeats is 3 or more. collapsed is the text without the words that a run contains after its first p words, joined by blanks. Of runs
    that overlap each counts by itself. order(doc_id, n) may give the numbers of words that are to be read in place
    of 0 to n - 1, None for the words as they are.

    Nulls and empty texts have no words and no runs; rows may repeat, and are judged each; ids may be null; an empty
    table gives an empty result; only the named columns are used, whatever others are called. A very long text is
    held whole in one task, some 100 bytes a word, and takes n log n time. There is no shuffle.
    """
    if min_repeats < 3:
        raise ValueError("shorter runs than three periods aren't proposed")

    def part(ids: list, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
        words, first = tokens(buf, offsets, ~IS_SPACE)
        if order is not None:
            each = []
            for i, a, b in zip(ids, first[:-1], first[1:], strict=True):
                o = order(i, int(b - a))
                each.append(np.arange(a, b) if o is None else a + o)
            words = words.take(pa.array(np.concatenate([np.zeros(0, np.int64), *each])))
            first = np.cumsum([0, *map(len, each)])
        codes = words.dictionary_encode().indices.to_numpy()
        start, length, period = find_runs(codes, first, min_words, min_repeats)
        kept = np.flatnonzero(~repeated_words(len(codes), start, length, period))
        lists = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(kept, first)), words.take(pa.array(kept)).cast(pa.large_string()))
        bounds = np.searchsorted(start, first)
        local = start - first[np.searchsorted(first, start, "right") - 1]
        runs = pa.StructArray.from_arrays([pa.array(local), pa.array(length), pa.array(period)], ["start", "length", "period"])
        return np.diff(first), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs), pc.binary_join(lists, pa.scalar(" ", pa.large_string()))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            buf, offsets = batch_bytes(batch)
            for i, j in chunks(offsets, CHUNK):
                ids = batch.column("doc_id").slice(i, j - i)
                n, runs, text = part(ids.to_pylist() if order else [], buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), runs, text.cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(found, SCHEMA)


def echoed(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order of words that makes every tenth document (by its id's CRC-32) end in a repeated stretch."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent, and digests of the runs and of the collapsed text."""
    best = F.expr("aggregate(runs, cast(null AS struct<start:bigint,length:bigint,period:bigint>), (b, r) -> if(b IS NULL OR r.length * b.period > b.length * r.period, r, b))")
    lines = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256", "n_words")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), order=echoed))
