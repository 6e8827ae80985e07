"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, key_of

#: Permitted sequence lengths in words, what a sequence costs besides its words, the length at which attention costs as
#: much again as the words themselves, and pieces packed together.
CAPACITIES, OVERHEAD, ATTENTION, SHARD = (512, 1024, 2048, 4096), 64, 16_384, 20_000
#: Tokens that are packed together at most, about: 32 MB of ids.
SHARD_TOKENS = 1 << 23


def cost(capacity: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    """What a sequence of a capacity costs: a fixed part, its words, and attention among them."""
    return overhead + capacity + capacity * capacity / attention


def best_fit(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION) -> list[tuple[int, int, int]]:
    """(bin, offset, capacity) of each length, for lengths from 1 to the largest capacity in falling order.

    A length goes to the open bin with the least room that holds it. Where none does, a bin is opened of the capacity
    with the least cost per word that it can be expected to hold: this length, and shorter ones still to come as far
    as they fit the room and there are enough of them. Long sequences spare fixed costs and short ones attention, so
    which capacity is the cheapest depends on the length and on what is left. At last each bin gets the smallest
    capacity that holds its contents.
    """
    capacities = sorted(capacities)
    rest = list(accumulate(reversed(lengths), initial=0))[::-1]  # words from each place on
    rising = np.array(lengths[::-1])
    by_room: list[list[int]] = [[] for _ in range(capacities[-1] + 1)]
    rooms = 0  # bit r: some bin has room r
    used: list[int] = []
    room_of: list[int] = []
    out = []
    for k, size in enumerate(lengths):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            best, room = None, 0
            for c in capacities:
                if c >= size:
                    short = len(lengths) - int(np.searchsorted(rising, c - size, "right"))
                    fill = size + min(c - size, rest[max(short, k + 1)] if max(short, k + 1) < len(rest) else 0)
                    price = cost(c, overhead, attention) / fill
                    if best is None or price <= best:
                        best, room = price, c
            b = len(used)
            used.append(0)
            room_of.append(0)
        out.append((b, used[b]))
        used[b] += size
        room -= size
        by_room[room].append(b)
        rooms |= 1 << room
    final = [next(c for c in capacities if c >= u) for u in used]
    return [(b, at, final[b]) for b, at in out]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION, shard: int = SHARD, with_text: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start and length (words of the text), bin, position, capacity, fill.

    with_text adds the piece's words, joined by one space, as text; contents() puts them together.

    Texts longer than the largest capacity are cut into pieces of it, all of which are packed. Pieces are dealt by hash
    into shards of about `shard` pieces, as many as the input needs, and each shard is packed by itself; a shard ends
    with a few unfilled bins, so the loss is bounded by the number of shards.

    Nulls and texts without words are one piece of length 0 that no bin holds (bin, position, capacity and fill are
    null). Ids may be null; repeated rows are packed each and dealt like others; ties go by key and piece. A very long
    text is counted whole in one task and then cut. Only the named columns are used, whatever others are called. An
    empty table gives an empty result.
    """
    most = max(capacities)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    more = [F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), 0).alias("words")] if with_text else []
    rows = docs.select(key_of(id_col, text_col).alias("_key"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), words.alias("n"), *more)
    keep = ["words"] if with_text else []
    pieces = rows.select("_key", "doc_id", "n", *keep, F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.expr(f"(n - 1) div {most}")))).alias("piece"))
    pieces = pieces.select("_key", "doc_id", "piece", (F.col("piece") * most).alias("start"), F.least(F.lit(most).cast("long"), F.col("n") - F.col("piece") * most).alias("length"), *([F.array_join(F.expr(f"slice(words, cast(piece * {most} + 1 as int), {most})"), " ").alias("text")] if with_text else []))
    pieces = cut(pieces.withColumn("_row", F.monotonically_increasing_id()))
    shards = max(1, -(-pieces.count() // shard))
    dealt = pieces.where("length > 0").withColumn("shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))

    names = ["doc_id", "piece", "start", "length", "bin", "position", "capacity", "fill", *(["text"] if with_text else [])]

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("_key", "ascending"), ("piece", "ascending")])
        bins, at, capacity = (np.array(x, np.int64) for x in zip(*best_fit(table["length"].to_pylist(), capacities, overhead, attention), strict=True))
        fill = np.bincount(bins, table["length"].to_numpy()).astype(np.int64)[bins]
        bins = table["shard"].to_numpy() * (1 << 32) + bins
        columns = [table[c] for c in names[:4]]
        return pa.table([*columns, *map(pa.array, (bins, at, capacity, fill)), *(table[c] for c in names[8:])], names)

    schema = "doc_id long, piece long, start long, length long, bin long, position long, capacity long, fill long" + (", text string" if with_text else "")
    out = dealt.groupBy("shard").applyInArrow(packed, schema)
    none = [F.lit(None).cast("long").alias(c) for c in ("bin", "position", "capacity", "fill")]
    return out.unionByName(pieces.where("length <= 0").select("doc_id", "piece", "start", F.lit(0).cast("long").alias("length"), *none, *(["text"] if with_text else [])))


def contents(packed: DataFrame) -> DataFrame:
    """One row per bin of pack(with_text=True): bin, capacity, fill, pieces (doc_id, start, length in order), text.

    A bin holds no more words than its capacity, so that no group is large.
    """
    inside = F.array_sort(F.collect_list(F.struct("position", "doc_id", "start", "length", "text")))
    rows = packed.where("bin IS NOT NULL").groupBy("bin").agg(F.first("capacity").alias("capacity"), F.first("fill").alias("fill"), inside.alias("p"))
    pieces = F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["start"].alias("start"), x["length"].alias("length")))
    return rows.select("bin", "capacity", "fill", pieces.alias("pieces"), F.array_join(F.col("p.text"), " ").alias("text"))


def pack_ids(encoded: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION, shard: int = SHARD, shard_tokens: int = SHARD_TOKENS, end: int | None = None) -> DataFrame:
    """Sequences of token ids, one row each, from encoded texts (doc_id, ids; bpe.encode makes them).

    Columns: bin, capacity, fill long; pieces array<struct<doc_id, piece, start, length, position>>, by position (start
    counts tokens of the document, position those of the sequence); ids binary (little-endian unsigned 32-bit integers,
    fill of them, to be padded up to capacity). end is a token that closes each document.

    Lengths are tokens here, so a capacity is what a model's context holds. Ids are written once in the shared folder,
    then move once, to their shard: of `shard` pieces and `shard_tokens` tokens at most, about, dealt by row, so that no
    task holds much whatever one document or source has. Sequences are put together there.

    Documents without tokens are in no sequence, with or without end. Ids of documents may be null; repeated rows are
    packed each; ties go by id and piece; documents longer than the largest capacity are cut into pieces of it. Other
    columns are left behind, whatever their names. An empty table gives an empty result.
    """
    most = max(capacities)
    ids = F.col("ids").cast("binary")
    if end is not None:
        ids = F.concat(ids, F.lit(bytearray(np.array([end], "<u4").tobytes())))
    rows = encoded.where("octet_length(ids) > 0").select(F.col("doc_id").cast("long").alias("doc_id"), ids.alias("ids")).withColumn("n", F.expr("octet_length(ids) div 4"))
    piece = f"named_struct('piece', i, 'start', i * {most}, 'length', least({most}L, n - i * {most}), 'ids', substring(ids, cast(i * {4 * most} + 1 as int), {4 * most}))"
    pieces = rows.select("doc_id", F.explode(F.expr(f"transform(sequence(0L, (n - 1) div {most}), i -> {piece})")).alias("p")).select("doc_id", "p.*")
    pieces = cut(pieces.withColumn("_row", F.monotonically_increasing_id()))
    count, total = pieces.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    shards = max(1, -(-count // shard), -(-total // shard_tokens))

    def sequences(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("_row", "ascending")])
        placed = np.array(best_fit(table["length"].to_pylist(), capacities, overhead, attention), np.int64)
        order = np.lexsort((placed[:, 1], placed[:, 0]))
        bins, at, capacity = placed[order].T
        table = table.take(pa.array(order)).combine_chunks()
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        fill = np.add.reduceat(table["length"].to_numpy(), first)
        inside = [table[c].combine_chunks() for c in ("doc_id", "piece", "start", "length")]
        parts = pa.StructArray.from_arrays([*inside, pa.array(at)], ["doc_id", "piece", "start", "length", "position"])
        tokens = np.frombuffer(b"".join(table["ids"].to_pylist()), "<u4")
        stretches = [tokens[a : a + n].tobytes() for a, n in zip(np.cumsum(fill) - fill, fill, strict=True)]
        number = table["shard"].to_numpy()[first] * (1 << 32) + bins[first]
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(bins)), pa.int32()), parts)
        return pa.table([pa.array(number), pa.array(capacity[first]), pa.array(fill), lists, pa.array(stretches, pa.binary())], ["bin", "capacity", "fill", "pieces", "ids"])

    schema = "bin long, capacity long, fill long, pieces array<struct<doc_id: long, piece: long, start: long, length: long, position: long>>, ids binary"
    return pieces.withColumn("shard", F.pmod(F.xxhash64("_row"), F.lit(shards).cast("long"))).groupBy("shard").applyInArrow(sequences, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
