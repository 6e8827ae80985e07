"""Words and n-grams of Arrow text columns as numpy arrays of 64-bit hashes.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, so UTF-8 texts are cut without decoding. Work goes
through chunks of a few megabytes; only one document's words must fit in memory together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

CHUNK_BYTES = 1 << 19
BLOCK_BYTES = 1 << 18
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


BYTE_HASH = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0xD6E8FEB86659FD93
BASE_INV = pow(BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse, for i < n at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        one = np.ones(1, _U)
        _powers[:] = [np.concatenate([one, np.cumprod(np.full(size, b, _U))]) for b in (BASE, BASE_INV)]
    return _powers[0], _powers[1]


def prefix_hash(buf: np.ndarray, table: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = BASE**i times the hash of bytes i to j."""
    up, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, _U)
    np.cumsum(table[buf] * up[: len(buf)], out=out[1:])
    return out


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_string() if pa.types.is_string(column.type) else pa.large_binary()).fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most limit bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


class Words:
    """The words of some documents: byte spans, hashes, and the range first[d] to first[d + 1] of each document d."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lower: bool = False):
        space = IS_SPACE[buf]
        begin, end = ~space, ~space
        if len(buf):
            edge = np.zeros(len(buf) + 1, bool)
            edge[offsets] = True
            begin[1:] &= space[:-1] | edge[1:-1]
            end[:-1] &= space[1:] | edge[1:-1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)
        self.hash = self._hash(buf, BYTE_HASH[LOWER] if lower else BYTE_HASH)

    def _hash(self, buf: np.ndarray, table: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.start), _U)
        i = 0
        while i < len(self.start):
            a = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, a + BLOCK_BYTES, "right")))
            s = prefix_hash(buf[a : self.end[j - 1]], table)
            at = self.start[i:j] - a
            out[i:j] = (s[self.end[i:j] - a] - s[at]) * powers(len(s))[1][at]
            i = j
        return mix(out)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def left(self) -> np.ndarray:
        """Of each word, how many words its document has from it on."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.start))


def ngram_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of n neighbours at each place; places too near the end are missing. Documents must be told apart outside."""
    size = max(0, len(h) - n + 1)
    out = h[:size].copy()
    for k in range(1, n):
        out *= _U(BASE)
        out += h[k : k + size]
    return mix(out)


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of w neighbours at each place, by doubling."""
    if len(h) < w:
        return h[:0]
    step = 1
    while 2 * step <= w:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[: len(h) - (w - step)], h[w - step :]) if w > step else h


def winnow(h: np.ndarray, w: int, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, chosen): the smallest of w neighbours at each place, and the places that are smallest in some window.

    inside marks the windows that count, those in one document. Ties are all chosen, so a chosen place depends on the
    window's content alone and is found in every copy of it.
    """
    least = sliding_min(h, w)
    if not len(least):
        return least, np.zeros(0, np.int64)
    pad = np.zeros(w - 1, _U)
    most = ~sliding_min(~np.concatenate([pad, np.where(inside, least, _U(0)), pad]), w)
    return least, np.flatnonzero((most == h) & (most > 0))


def owned(h: np.ndarray, least: np.ndarray, chosen: np.ndarray, inside: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, anchor): of each anchor, a chosen place, the windows lo to hi whose first smallest hash it is.

    least and chosen are winnow's, w its size. Every window inside has one anchor, at the same place in each of its copies.
    """
    at = np.flatnonzero(inside)
    if not len(at):
        return at, at, at
    begin = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]])])
    s0, s1 = at[begin], at[np.append(np.flatnonzero(begin)[1:], len(at)) - 1]
    # the run of windows with an anchor's hash that begins last before it
    values = np.unique(least[s0])
    runs = (np.searchsorted(values, least[s0]).astype(np.int64) << 40) | s0
    order = np.argsort(runs)
    run = order[np.searchsorted(runs[order], (np.searchsorted(values, h[chosen]).astype(np.int64) << 40) | chosen, "right") - 1]
    order = np.lexsort((chosen, run))
    run, anchor = run[order], chosen[order]
    after = np.zeros(len(anchor), np.int64)
    after[1:] = np.where(run[1:] == run[:-1], anchor[:-1] + 1, 0)
    lo, hi = np.maximum(s0[run], after), np.minimum(s1[run], anchor)
    own = lo <= hi
    return lo[own], hi[own], anchor[own]


class Spans:
    """Hashes of spans of a sequence of 64-bit items, in time that doesn't depend on their length."""

    def __init__(self, items: np.ndarray):
        up, self.inverse = powers(len(items) + 1)
        self.sums = np.zeros(len(items) + 1, _U)
        np.cumsum(items * up[: len(items)], out=self.sums[1:])

    def hash(self, s: np.ndarray, size) -> np.ndarray:
        return mix((self.sums[s + size] - self.sums[s]) * self.inverse[s])


def pieces(offsets: np.ndarray, buf: np.ndarray, limit: int) -> Iterator[tuple[int, int, int, int]]:
    """(i, j, p, q): rows i to j with bytes p to q; a row of more than 2 * limit bytes comes in several pieces that end in white space."""
    for i, j in chunks(offsets, limit):
        p, end = int(offsets[i]), int(offsets[j])
        while end - p > 2 * limit:
            q = p + limit
            while q < end and not (space := IS_SPACE[buf[q : q + 4096]]).any():
                q += 4096
            q = min(end, q + int(space.argmax()) + 1) if q < end else end
            yield i, j, p, q
            p = q
        yield i, j, p, end


def hashed(batches: Iterator[pa.RecordBatch], overlap: int, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray, int]]:
    """(batch, i, j, hashes, first, base) for pieces of rows i to j.

    first are the documents' bounds in the words' hashes. A long document comes in pieces: base is the number of its
    first word, and the last `overlap` words of a piece come again at the start of the next.
    """
    for batch in slices(batches):
        buf, offsets = batch_bytes(batch)
        row, base, carry = -1, 0, np.zeros(0, _U)
        for i, j, p, q in pieces(offsets, buf, limit):
            words = Words(buf[p:q], np.clip(offsets[i : j + 1], p, q) - p, lower)
            if i != row:
                row, base, carry = i, 0, np.zeros(0, _U)
            hashes = np.concatenate([carry, words.hash]) if len(carry) else words.hash
            yield batch, i, j, hashes, np.concatenate([[0], words.first[1:] + len(carry)]), base
            carry = hashes[max(0, len(hashes) - overlap) :] if q < offsets[j] and overlap else np.zeros(0, _U)
            base += len(hashes) - len(carry)


def doc_hashes(batches: Iterator[pa.RecordBatch], lower: bool = False) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    """hashed() with the pieces of a long document put together: 8 bytes a word, not some 40 a byte."""
    held: list[np.ndarray] = []
    last = None
    for batch, i, j, hashes, first, base in hashed(batches, 0, lower):
        if held and not (last[0] is batch and last[1] == i):
            whole = np.concatenate(held)
            yield *last, whole, np.array([0, len(whole)])
            held = []
        if j == i + 1:
            held.append(hashes)
            last = (batch, i, j)
        else:
            yield batch, i, j, hashes, first
    if held:
        whole = np.concatenate(held)
        yield *last, whole, np.array([0, len(whole)])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is made of a batch stays small."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def shrink(docs: DataFrame) -> DataFrame:
    """docs with the column text replaced by z, the text compressed: what a shuffle of whole texts costs most is disk."""

    def shrunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            z = pa.array([packer.compress(t.as_py()) if t.is_valid else None for t in batch.column("text").cast(pa.binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), z], [*rest, "z"])

    rest = [c for c in docs.columns if c != "text"]
    return docs.mapInArrow(shrunk, StructType([docs.schema[c] for c in rest] + [StructField("z", BinaryType())]))


def texts_of(batch: pa.RecordBatch) -> list[bytes | None]:
    """The texts of a batch, from z where it has one."""
    if "z" not in batch.schema.names:
        return batch.column("text").cast(pa.binary()).to_pylist()
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(z) if z is not None else None for z in batch.column("z").to_pylist()]


def batch_bytes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """text_bytes of a batch's texts."""
    return text_bytes(pa.array(texts_of(batch), pa.large_binary()) if "z" in batch.schema.names else batch.column("text"))


def tokens(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(tokens, first): maximal runs of the bytes marked in `inside`, within documents; document d has first[d] to first[d + 1]."""
    held = inside[buf]
    begin = held.copy()
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    begin[1:] &= ~held[:-1] | edge[1:-1]
    start, data = np.flatnonzero(begin), buf[held]
    bounds = np.append((np.cumsum(held) - 1)[start], len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]), np.searchsorted(start, offsets)
