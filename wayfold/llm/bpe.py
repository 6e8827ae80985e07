"""BPE encoding and decoding with word-end vocabularies: a contiguous rank array per word."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import slices

VOCABULARY = "word_bpe_49k.json"
#: Words kept in a task's memory, and the longest one (in symbols) for which the whole rank array is scanned.
CACHE, SHORT = 200_000, 48
NONE = 1 << 62

# the white space that the vocabulary's pre-tokenizer leaves out
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + _SPACE + r"\p{L}\p{N}]+")
# on ASCII the same, with fewer properties to look up
_ASCII = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^" + _SPACE + "a-z0-9]+")


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte: itself where it prints, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordBPE:
    """A vocabulary file's model: ids of symbols, merges (pair of ids: rank and new id) and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.end = spec["model"]["end_of_word_suffix"]
        self.merges = {(vocab[a] << 20) | vocab[b]: (rank << 20) | vocab[a + b] for rank, (a, b) in reversed([*enumerate(pairs)])}
        symbols = byte_symbols()
        self.inner = [vocab[symbols[b]] for b in range(256)]
        self.last = [vocab[symbols[b] + self.end] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._cache: dict[str, bytes] | None = None

    def __getstate__(self):
        return self.__dict__ | {"_cache": None}

    def rank(self, a: int, b: int) -> int:
        return self.merges.get((a << 20) | b, NONE)

    def merge(self, ids: list[int]) -> list[int]:
        """Merge neighbours, always the pair of the least rank, the first of equal ones, until none has a rank."""
        if len(ids) > SHORT:
            return self._merge_long(ids)
        ranks = [self.rank(a, b) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (least := min(ranks)) != NONE:
            i = ranks.index(least)
            ids[i] = least & 0xFFFFF
            del ids[i + 1], ranks[i]  # the boundary between the two parts
            if i < len(ranks):
                ranks[i] = self.rank(ids[i], ids[i + 1])
            if i:
                ranks[i - 1] = self.rank(ids[i - 1], ids[i])
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links, as scanning a long array for each merge takes quadratic time."""
        n = len(ids)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.rank(ids[i], ids[i + 1])) != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r & 0xFFFFF, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k, m in ((before[i], i), (i, after[i])):
                if k >= 0 and m < n and (x := self.rank(ids[k], ids[m])) != NONE:
                    heapq.heappush(heap, (x, k, ids[k], ids[m]))
        return [i for i in ids if i >= 0]

    def _word(self, word: str) -> bytes:
        """A word's ids as little-endian 32-bit integers; words are kept until there are CACHE of them."""
        cache = self._cache
        data = word.encode()
        ids = self.merge([self.inner[b] for b in data[:-1]] + [self.last[data[-1]]])
        out = np.array(ids, "<u4").tobytes()
        if len(word) <= SHORT:
            if len(cache) >= CACHE:
                cache.clear()
            cache[word] = out
        return out

    def encode(self, text: str) -> bytes:
        """A text's ids as little-endian unsigned 32-bit integers."""
        if self._cache is None:
            self._cache = {}
        out, get, make = [], self._cache.get, self._word
        parts = self.split.split(text) if self.split and any(t in text for t in self.special) else (text,)
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
                continue
            # each capital is lowered by itself: a final sigma is like any other
            lowered = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            words = (_ASCII if lowered.isascii() else _WORDS).findall(lowered)
            out += [get(w) or make(w) for w in words]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens joined by blanks, as the vocabulary names no decoder; special tokens are kept."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, ids binary (little-endian unsigned 32-bit integers, no special tokens added).

    Strings of special tokens inside texts become these tokens. Nulls and empty texts have no ids; ids may be null and
    rows may repeat; only the named columns are used, whatever others are called; a very long text is held whole in
    one task, word by word; an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(WordBPE(path))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model.value
        for batch in slices(batches):
            ids = pa.array([bpe.encode(t.as_py() or "") for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(encoded, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded (doc_id, ids) with the decoded text; null ids give an empty text."""
    model = encoded.sparkSession.sparkContext.broadcast(WordBPE(path))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model.value
        for batch in slices(batches):
            texts = pa.array([bpe.decode(i.as_py() or b"") for i in batch.column("ids")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), texts], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, ids binary, decoded string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """decode(encode(docs)) in one pass: doc_id, ids, decoded."""
    model = docs.sparkSession.sparkContext.broadcast(WordBPE(path))

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model.value
        for batch in slices(batches):
            ids = [bpe.encode(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(both, "doc_id long, ids binary, decoded string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    out = round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return out.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
