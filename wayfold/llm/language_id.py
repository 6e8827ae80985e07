"""Language identification: n-gram filters that answer with a bitmask of languages, and popcounts that decide."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import BYTE_HASH, mix, pieces, powers, prefix_hash, slices, text_bytes, tokens

#: Documents of a language that the filters are made from, about: those with the smallest hashes of their ids.
MAX_TRAIN = 3_000
#: Languages that are learned at most, the most frequent ones.
MAX_LANGS = 256
#: An n-gram is in a language's filter if so many of its documents have it, this share of them, and at least
#: RATIO times the largest share that any language has.
MIN_DOCS, MIN_SHARE, RATIO = 2, 0.002, 0.1
#: Bytes of the n-grams within a word and its two ends; whole words count as well.
SIZES = (2, 3, 4, 5)
#: Bits of a slot's number, and slots that an n-gram sets. The filters have 2 ** BITS words of 64 bits.
BITS, HASHES = 20, 3
CHUNK = 1 << 19
UNKNOWN = "und"
_U = np.uint64
_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])

HELD_OUT = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2, false)"


def grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash) of the n-grams of some words; a word is edged with a zero byte on both sides."""
    _, bounds, data = words.buffers()
    bounds = np.frombuffer(bounds, np.int64)[words.offset : words.offset + len(words) + 1]
    size = np.diff(bounds)
    start = bounds[:-1] - bounds[0] + 2 * np.arange(len(words))
    buf = np.zeros(int(size.sum()) + 2 * len(words), np.uint8)
    inner = np.ones(len(buf), bool)
    inner[start] = False
    inner[start + size + 1] = False
    buf[inner] = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if len(words) else buf[:0]
    sums, inverse = prefix_hash(buf, BYTE_HASH), powers(len(buf) + 1)[1]
    owner = np.repeat(np.arange(len(words)), size + 2)
    left = np.repeat(start + size + 2, size + 2) - np.arange(len(buf))
    out = [(np.arange(len(words)), mix((sums[start + size + 2] - sums[start]) * inverse[start] + _U(99)))]
    for n in SIZES:
        at = np.flatnonzero(left >= n)
        out.append((owner[at], mix((sums[at + n] - sums[at]) * inverse[at] + _U(n))))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def text_words(column: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """(i, j, distinct words, document, word) of pieces of rows i to j; pairs of document, from i, and word are distinct in a piece."""
    buf, offsets = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    for i, j, p, q in pieces(offsets, buf, CHUNK):
        found, first = tokens(buf[p:q], np.clip(offsets[i : j + 1], p, q) - p, _LETTER)
        coded = found.dictionary_encode()
        words = coded.dictionary
        pair = np.unique(np.repeat(np.arange(j - i), np.diff(first)) * max(1, len(words)) + coded.indices.to_numpy())
        yield i, j, words, pair // max(1, len(words)), pair % max(1, len(words))


def _sample(docs: DataFrame, where: str, max_train: int) -> DataFrame:
    """(lang, text) of documents to learn from: of the most frequent languages, those with the smallest hashes of their ids.

    A language of n documents gives those whose hash is in the first max_train / n of all hashes, so documents are only
    counted by language; no task sees all of a language.
    """
    rows = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(where)
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31).cast("long")) / (1 << 31)
    return rows.join(F.broadcast(sizes), "lang").where(share * F.col("count") < max_train).select("lang", "text")


def _doc_counts(sample: DataFrame) -> DataFrame:
    """(lang, gram, docs): how many documents of a language have an n-gram; gram 0 counts the documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs = batch.column("lang").dictionary_encode()
            lang = langs.indices.to_numpy()
            per_doc: list[tuple[np.ndarray, np.ndarray]] = [(np.arange(len(lang)), np.zeros(len(lang), _U))]
            for i, _, words, doc, word in text_words(batch.column("text")):
                owner, h = grams(words)
                order = np.argsort(owner, kind="stable")
                owner, h = owner[order], h[order]
                first = np.searchsorted(owner, np.arange(len(words) + 1))
                size = np.diff(first)[word]
                at = np.repeat(first[word] - np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size, size) + np.arange(int(size.sum()))
                per_doc.append(_distinct(np.repeat(doc + i, size), h[at]))
            doc, h = _distinct(*(np.concatenate(x) for x in zip(*per_doc, strict=True)))  # of a long text's pieces, too
            order = np.lexsort((h, lang[doc]))
            of, h = lang[doc][order], h[order]
            begin = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, np.int64)
            counts = np.diff(np.append(begin, len(h)))
            yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(of[begin])), pa.array(h[begin].view(np.int64)), pa.array(counts, pa.int64())], ["lang", "gram", "docs"])

    return sample.mapInArrow(counted, "lang string, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


class Filters(NamedTuple):
    """Bloom filters of all languages, bit-sliced: rows[slot, k] has a bit for each of the languages 64k to 64k + 63."""

    languages: list[str]
    shares: np.ndarray
    rows: np.ndarray

    def false_rates(self) -> np.ndarray:
        """Of each language, the share of n-grams that aren't in it but are answered with it."""
        return np.array([float(((self.rows[:, k // 64] >> _U(k % 64)) & _U(1)).mean()) ** HASHES for k in range(len(self.languages))])

    def masks(self, h: np.ndarray) -> np.ndarray:
        """The languages that contain each n-gram, as 64-bit masks: one look at HASHES rows for all languages."""
        bits = _U(len(self.rows).bit_length() - 1)
        out = self.rows[(h & _U(len(self.rows) - 1)).astype(np.int64)]
        for k in range(1, HASHES):
            out = out & self.rows[((h >> (bits * _U(k))) & _U(len(self.rows) - 1)).astype(np.int64)]
        return out

    def hits(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams of each word, n-grams of each word that each language contains)."""
        owner, h = grams(words)
        masks = self.masks(h)
        total = np.bincount(owner, minlength=len(words))
        each = [np.bincount(owner, ((masks[:, k // 64] >> _U(k % 64)) & _U(1)).astype(float), len(words)) for k in range(len(self.languages))]
        return total, np.stack(each, axis=1) if each else np.zeros((len(words), 0))


def train(docs: DataFrame, where: str = "true", max_train: int = MAX_TRAIN) -> Filters:
    """The filters of a table (doc_id, text, lang), made of some max_train documents of each language, all if there are fewer.

    where: SQL condition of rows to learn from. Rows without id or language aren't; rows that repeat count as often as
    they come. Documents are counted and filters put together by Spark; what comes to the driver are the filters, 2 **
    BITS words of 64 bits however many n-grams and languages there are.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = _doc_counts(_sample(texts, where, max_train)).persist()
    sizes = {r.lang: r.docs for r in counts.where("gram = 0").collect()}
    languages = sorted(sizes)
    words = max(1, -(-len(languages) // 64))
    bits = BITS - (words - 1).bit_length()
    number = F.create_map(*(F.lit(x) for k, lang in enumerate(languages) for x in (lang, k))) if languages else F.lit(None).cast("map<string,int>")
    n_docs = F.create_map(*(F.lit(x) for lang in languages for x in (lang, sizes[lang]))) if languages else F.lit(None).cast("map<string,bigint>")
    shares = counts.where("gram <> 0").select("gram", "docs", number[F.col("lang")].alias("k"), (F.col("docs") / n_docs[F.col("lang")]).alias("share"))
    typical = shares.groupBy("gram").agg(F.collect_list(F.struct("k", "share", "docs")).alias("langs"), F.max("share").alias("most"))  # a row for each language at most
    typical = typical.select("gram", F.explode(F.filter("langs", lambda x: (x["docs"] >= MIN_DOCS) & (x["share"] >= MIN_SHARE) & (x["share"] >= RATIO * F.col("most")))).alias("x"))
    slots = F.array(*(F.shiftrightunsigned("gram", bits * h).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) for h in range(HASHES)))
    bit = F.expr("shiftleft(1L, cast(x.k % 64 AS int))")
    rows = typical.select(F.explode(slots).alias("slot"), F.expr("x.k div 64").alias("word"), bit.alias("bit")).groupBy("slot", "word").agg(F.bit_or("bit").alias("bits"))
    table = rows.toArrow()
    counts.unpersist()
    out = np.zeros((1 << bits, words), _U)
    out[table["slot"].to_numpy(), table["word"].to_numpy()] = table["bits"].to_numpy().view(_U)
    total = sum(sizes.values())
    return Filters(languages, np.array([sizes[lang] / total for lang in languages]), out)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score (0 to 1), n_grams long, runner_up.

    The n-grams of a text's distinct words (of each piece, in a very long text) are looked up; each language's hits are corrected by the share
    that it answers by mistake. The language of most hits is taken, of equal ones the more frequent, then the first by
    name; score is its share of the hits of the best two. A text in which no language has a hit gets the most frequent
    language and that one's share of the documents learned from. Nulls and texts without a letter get `und` and 0, as
    does every text if nothing was learned. Rows may repeat; ids may be null; whole texts are read, very long ones in
    pieces; an empty table gives an empty result; only the named columns are used, whatever others are called.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(filters))

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Filters(*shared.value)
        wrong, n_langs = f.false_rates(), len(f.languages)
        by_share = np.argsort(-f.shares, kind="stable")
        for batch in slices(batches):
            text = batch.column("text")
            total, hits = np.zeros(len(text)), np.zeros((len(text), n_langs))
            for i, _, words, doc, word in text_words(text):
                n, each = f.hits(words)
                np.add.at(total, doc + i, n[word])
                for k in range(n_langs):
                    hits[:, k] += np.bincount(doc + i, each[word, k], len(text))
            sure = np.maximum(0, (hits - total[:, None] * wrong) / np.maximum(1 - wrong, 1e-9))[:, by_share]
            lettered = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False) & (n_langs > 0)
            best = sure.argmax(axis=1) if n_langs else np.zeros(len(text), np.int64)
            top = np.sort(np.pad(sure, ((0, 0), (2, 0))), axis=1)[:, -2:]
            found = top[:, 1] > 0
            score = np.where(found, top[:, 1] / np.maximum(top.sum(axis=1), 1e-9), f.shares[by_share[0]] if n_langs else 0.0)
            rest = sure.copy()
            if n_langs:
                rest[np.arange(len(text)), best] = -1
            second = rest.argmax(axis=1) if n_langs > 1 else best
            names = np.array([*(f.languages[k] for k in by_share), UNKNOWN], object)
            pick = lambda at, ok: pa.array(names[np.where(ok, at, n_langs)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pick(best, lettered), pa.array(np.where(lettered, score, 0.0)), pa.array(total.astype(np.int64)), pick(second, lettered & found & (top[:, 0] > 0))],
                ["doc_id", "lang_pred", "score", "n_grams", "runner_up"],
            )

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(decided, "doc_id long, lang_pred string, score double, n_grams long, runner_up string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs, train(docs, f"NOT {HELD_OUT}"))
    return out.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "lang_pred", "score", "n_grams", "runner_up")
