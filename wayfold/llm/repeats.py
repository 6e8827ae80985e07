"""Which places of a corpus share a 64-bit key with another place.

Places (id, pos) with a key come in large numbers (anchors, windows, prefix tokens), so tasks pack them into a few
binary rows per range of keys; a range is shuffled to one task, sorted there with numpy, and only the places found
are returned, as one array per document and range.

A key that very many places share stays cheap: each packing step first settles what it can see itself and sends a key
at most once, so a range receives a key once per some PACK places, however common the key is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions
from .words import mix

#: Places that a task gathers before it packs them, and bytes of text for a range of keys.
PACK, RANGE_BYTES = 400_000, 2 << 20
#: pos of a key that its sender knows to be repeated, with all its own places settled.
SETTLED = -1


def _settle(keys: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """What is sent on (keys, ids, pos) and what is found already (ids, pos): places of keys with two places or more."""
    order = np.lexsort((pos, ids, keys))
    keys, ids, pos = keys[order], ids[order], pos[order]
    if len(keys):  # one place that comes twice, from two rows with equal sets, counts once
        own = np.ones(len(keys), bool)
        own[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]) | (pos[1:] != pos[:-1])
        keys, ids, pos = keys[own], ids[own], pos[own]
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    group = np.cumsum(head) - 1
    count = np.bincount(group) if len(keys) else np.zeros(0, np.int64)
    settled = np.zeros(len(count), bool)
    settled[group[pos == SETTLED]] = True
    many = ((count > 1) | settled)[group]
    found = many & (pos != SETTLED)
    return keys[head], np.where(many[head], 0, ids[head]), np.where(many[head], SETTLED, pos[head]), ids[found], pos[found]


def planes(x: np.ndarray) -> bytes:
    """The array byte plane by byte plane: the upper bytes of small or sorted numbers compress to almost nothing."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() if len(x) else b""


def joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The arrays that planes() packed, one after the other."""
    size = np.dtype(kind).itemsize
    parts = [np.frombuffer(x, np.uint8).reshape(size, -1).T for x in column.to_pylist() if x]
    return np.ascontiguousarray(np.concatenate(parts)).view(kind).reshape(-1) if parts else np.zeros(0, kind)


def pack(keys: np.ndarray, buckets: int, sent: list[np.ndarray], found: list[np.ndarray]) -> pa.RecordBatch:
    """One row per range of keys: bucket, and the range's part of each array in sent, as binary columns.

    sent begins with ids and pos and is put in their order within a row. What is found already (ids, ...) goes along,
    an equal share with each row.
    """
    # keys are mixed first: anchors and prefix tokens are the smallest hashes of many, all near zero
    of = (((mix(keys) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
    order = np.lexsort((sent[1], sent[0], of))
    of, sent = of[order], [x[order] for x in sent]
    order = np.argsort(found[0], kind="stable")
    found = [x[order] for x in found]
    at = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    share = np.linspace(0, len(order), len(at) + 1).astype(np.int64)
    columns = [pa.array([planes(x[i:j]) for i, j in zip(at, np.append(at[1:], len(of)), strict=True)], pa.binary()) for x in sent]
    columns += [pa.array([planes(x[i:j]) for i, j in zip(share[:-1], share[1:], strict=True)], pa.binary()) for x in found]
    return pa.RecordBatch.from_arrays([pa.array(of[at], pa.int32()), *columns], ["bucket", *(f"s{k}" for k in range(len(sent))), *(f"f{k}" for k in range(len(found)))])


def packed_schema(sent: int, found: int) -> str:
    return ", ".join(["bucket int", *(f"s{k} binary" for k in range(sent)), *(f"f{k} binary" for k in range(found))])


def _sent(places: Callable, send: Callable) -> Callable:
    """A mapInArrow function: what places yields, gathered to some PACK entries and handed to send."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in places(batches):
            held.append(part)
            size += len(part[0])
            if size >= PACK:
                yield send([np.concatenate(x) for x in zip(*held, strict=True)])
                held, size = [], 0
        if size:
            yield send([np.concatenate(x) for x in zip(*held, strict=True)])

    return sent


def by_document(keys: list[np.ndarray], values: list[np.ndarray], names: list[str]) -> pa.Table:
    """One row per document (its keys: _key, or _key and _tag), and a list of its entries for each array of values."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    ends = pa.array(np.append(at, len(order)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in values]
    return pa.Table.from_arrays([*(pa.array(k[at], pa.int64()) for k in keys), *lists], [*("_key", "_tag")[: len(keys)], *names])


def size_of(docs: DataFrame) -> int:
    """Bytes of all texts: ranges of keys are cut by it."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def ranges_for(docs: DataFrame) -> int:
    """Ranges of keys: one for some RANGE_BYTES of text, and two for each shuffle partition at least."""
    return max(64, 2 * partitions(docs.sparkSession), size_of(docs) // RANGE_BYTES)


def find(docs: DataFrame, places: Callable, buckets: int | None = None) -> DataFrame:
    """(_key, places array<int>): places whose key occurs at another place too.

    places maps Arrow batches of docs to (keys uint64, ids int64, pos int32 >= 0) arrays. A document can have several
    rows, one for each range of keys.
    """
    buckets = buckets or ranges_for(docs)

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, ids, pos, *found = _settle(*held)
        return pack(keys, buckets, [ids, pos, keys], found)

    def resolve(table: pa.Table) -> pa.Table:
        ids, pos, keys = (joined(table[n], t) for n, t in (("s0", np.int64), ("s1", np.int32), ("s2", np.uint64)))
        *_, ids, pos = _settle(keys, ids, pos)
        ids = np.concatenate([ids, joined(table["f0"], np.int64)])
        pos = np.concatenate([pos, joined(table["f1"], np.int32)])
        return by_document([ids], [pos.astype(np.int32)], ["places"])

    packed = docs.mapInArrow(_sent(places, send), packed_schema(3, 2))
    return packed.groupBy("bucket").applyInArrow(resolve, "_key long, places array<int>").where(F.size("places") > 0)


#: Places of classes: document (id, tag), pos, ext (windows after the one at pos), key, cls, many; and their types.
PLACE = (np.int64, np.int64, np.int32, np.int32, np.uint64, np.uint64, np.int8)
#: many: one place; several, all but this one settled by the sender; its key has other classes in the same task, too.
ONE, SEVERAL, MIXED = 0, 1, 2
#: What is found: a place, whether it repeats (REPEAT) or shares its key only (CHECK), and the place it repeats.
FOUND = (np.int64, np.int64, np.int32, np.int32, np.int8, np.int64, np.int64, np.int32)
REPEAT, CHECK = 0, 1


def settle_classes(places: list[np.ndarray], first_stays: bool, split: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(sent, found): what goes on to the key's range, one place for each class (key, cls), and what is known here.

    Equal classes repeat: of their places, all but the first are found with the first as source, and without
    first_stays the first one too. With split, a key that has several classes lets the first place of each be checked,
    and one place with MIXED goes on in place of all: however many classes a key has, a task sends it once.
    """
    i, t, pos, ext, key, cls, many = places
    settled = many == SETTLED  # repeats that their sender knows of already
    if settled.any():
        sure = [x[settled] for x in (i, t, pos, ext)]
        none = np.zeros(len(sure[0]), np.int64)
        sent, found = settle_classes([x[~settled] for x in places], first_stays, split)
        return sent, [np.concatenate(x) for x in zip(found, [*sure, none.astype(np.int8), none, none, none.astype(np.int32)], strict=True)]
    order = np.lexsort((-many, pos, t, i, cls, key))
    i, t, pos, ext, key, cls, many = (x[order] for x in places)
    n = len(key)
    changed = lambda *cols: np.concatenate([np.ones(min(n, 1), bool), np.logical_or.reduce([c[1:] != c[:-1] for c in cols])]) if n else np.zeros(0, bool)
    own = changed(key, cls, i, t, pos)  # repeated rows are one document
    i, t, pos, ext, key, cls, many = (x[own] for x in (i, t, pos, ext, key, cls, many))
    n = len(key)
    head, top = changed(key, cls), changed(key)
    at = np.flatnonzero(head)
    group, size = np.cumsum(head) - 1, np.diff(np.append(at, n))
    lead = at[group] if n else group
    several = (size > 1) | (np.maximum.reduceat(many == SEVERAL, at) if n else np.zeros(0, bool))
    source = np.where(head, np.minimum(lead + 1, n - 1), lead)
    repeats = ~head if first_stays else (many != SEVERAL) & (size > 1)[group]
    kind = np.zeros(repeats.sum(), np.int8)
    found = [i[repeats], t[repeats], pos[repeats], ext[repeats], kind, *(x[source[repeats]] for x in (i, t, pos))]
    sent = head
    if split and n:
        first = np.flatnonzero(top)
        of = np.cumsum(top) - 1
        mixed = (np.add.reduceat(head.astype(np.int64), first) > 1) | np.maximum.reduceat(many == MIXED, first)
        check = head & mixed[of] & (many != MIXED)
        none = np.zeros(check.sum(), np.int64)
        found = [np.concatenate(x) for x in zip(found, [i[check], t[check], pos[check], ext[check], none.astype(np.int8) + np.int8(CHECK), none, none, none.astype(np.int32)], strict=True)]
        sent = head & (~mixed[of] | top)
        many = np.where(mixed[of], MIXED, np.where(several[group], SEVERAL, ONE)).astype(np.int8)
    else:
        many = np.where(several[group], SEVERAL, ONE).astype(np.int8) if n else many
    return [x[sent] for x in (i, t, pos, ext, key, cls, many)], found


def find_classes(docs: DataFrame, places: Callable, first_stays: bool, split: bool, buckets: int) -> DataFrame:
    """Places whose class occurs elsewhere, and with split those whose key only does, one row per document and range.

    places maps Arrow batches of docs to the arrays of PLACE. Columns: _key, _tag, and arrays pos, ext, kind, and the
    source of a repeat: src_key, src_tag, src_pos. Key and class together have 128 bits.
    """

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        sent, found = settle_classes(held, first_stays, split)
        return pack(sent[4], buckets, sent, found)

    def resolve(table: pa.Table) -> pa.Table:
        _, found = settle_classes([joined(table[f"s{k}"], kind) for k, kind in enumerate(PLACE)], first_stays, split)
        found = [np.concatenate([x, joined(table[f"f{k}"], kind)]) for k, (x, kind) in enumerate(zip(found, FOUND, strict=True))]
        return by_document(found[:2], found[2:], ["pos", "ext", "kind", "src_key", "src_tag", "src_pos"])

    packed = docs.mapInArrow(_sent(places, send), packed_schema(len(PLACE), len(FOUND)))
    out = "_key long, _tag long, pos array<int>, ext array<int>, kind array<byte>, src_key array<long>, src_tag array<long>, src_pos array<int>"
    return packed.groupBy("bucket").applyInArrow(resolve, out).where(F.size("pos") > 0)


def entries(found: DataFrame, kind: int, *columns: str) -> DataFrame:
    """_key, _tag, and found: an array of structs of columns, of the entries of one kind; rows without any are left out."""
    zipped = F.filter(F.arrays_zip("kind", *columns), lambda x: x["kind"] == kind)
    return found.select("_key", "_tag", F.transform(zipped, lambda x: F.struct(*(x[c].alias(c) for c in columns))).alias("found")).where(F.size("found") > 0)


def attach(docs: DataFrame, found: DataFrame, name: str, how: str = "left") -> DataFrame:
    """docs with an array column of the entries found in each document; null where there are none."""
    return docs.join(found.groupBy("_key", "_tag").agg(F.flatten(F.collect_list("found")).alias(name)), ["_key", "_tag"], how)


def arrays_of(column: pa.ListArray | pa.ChunkedArray, *fields: str) -> tuple[np.ndarray, ...]:
    """The row of each struct in a column that attach() made, and the structs' fields."""
    lengths = np.array(column.value_lengths().fill_null(0))
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), lengths), *(np.array(flat.field(f)) for f in fields)
