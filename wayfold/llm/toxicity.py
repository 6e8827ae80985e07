"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_of
from .words import BASE, BYTE_HASH, LOWER, chunks, mix, powers, prefix_hash, slices, text_bytes

#: Labelled rows that the model is fitted on at most, those with the smallest hashes of their ids.
MAX_TRAIN = 12_000
#: Documents of the sample that a feature must be in.
MIN_DOCS = 3
EPOCHS, ALPHA, BETA, L1, L2 = 5, 1.0, 1.0, 3.0, 0.0
#: Bytes of the word beginnings that count as stems.
STEMS = (4, 6)
#: Bytes of texts that are looked at together.
CHUNK = 1 << 20
#: Training texts whose features are merged at a time.
BLOCK = 500
_U = np.uint64

#: Bytes of words: letters, digits and all of non-ASCII characters.
_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def features(buf: np.ndarray, offsets: np.ndarray, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash) of every feature of the texts, repeats included, and the hashes of the last words.

    Features are lower-cased words, their stems, pairs of neighbours, and pairs with one or two words between. before:
    of a text that comes in parts, the hashes of the last words of the part before; they pair with the words here.
    """
    word = _WORD[buf]
    begin, end = word.copy(), word.copy()
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    begin[1:] &= ~word[:-1] | edge[1:-1]
    end[:-1] &= ~word[1:] | edge[1:-1]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    sums = prefix_hash(buf, BYTE_HASH[LOWER])
    inverse = powers(len(sums))[1]
    h = mix((sums[stop] - sums[start]) * inverse[start])
    docs, out = [doc], [h]
    for k in STEMS:
        long = stop - start > k
        docs.append(doc[long])
        out.append(mix((sums[start[long] + k] - sums[start[long]]) * inverse[start[long]] + _U(k)))
    if before is not None and len(before):
        doc, h = np.concatenate([np.zeros(len(before), doc.dtype), doc]), np.concatenate([before, h])
    known = 0 if before is None else len(before)
    for gap in (1, 2, 3):
        a = max(0, known - gap)  # pairs of words before are in the part before
        near = doc[gap + a :] == doc[a : max(a, len(doc) - gap)]
        docs.append(doc[gap + a :][near])
        out.append(mix(h[a : max(a, len(h) - gap)][near] * _U(BASE) + h[gap + a :][near] + _U(100 + gap)))
    return np.concatenate(docs), np.concatenate(out), h[-3:]


def feature_parts(buf: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """features() of the texts; those of one long text come in parts that end with a word and know the last words before."""
    n, p, before = len(buf), 0, np.zeros(0, _U)
    if len(offsets) > 2 or n <= 2 * CHUNK:
        yield features(buf, offsets)[:2]
        return
    while p < n:
        q = min(n, p + CHUNK)
        while q < n and _WORD[buf[q - 1]] and _WORD[buf[q]]:
            q += 1
        doc, h, before = features(buf[p:q], np.array([0, q - p]), before)
        yield doc, h
        p = q


class Model(NamedTuple):
    """Weights that L1 has left, by sorted feature hash."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A score of each text; a feature counts once in a text."""
        n = len(offsets) - 1
        total = np.full(n, self.bias)
        if len(self.keys) and len(buf):
            seen = np.zeros(1 << 16, bool)  # most features are none of the model's: look at 16 bits first
            seen[self.keys & _U(0xFFFF)] = True
            pairs = []
            for doc, h in feature_parts(buf, offsets):
                maybe = np.flatnonzero(seen[h & _U(0xFFFF)])
                at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
                hit = self.keys[at] == h[maybe]
                pairs.append(np.unique(doc[maybe][hit] * len(self.keys) + at[hit]))
            pair = np.unique(np.concatenate(pairs))
            np.add.at(total, pair // len(self.keys), self.weights[pair % len(self.keys)])
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> Model:
    """FTRL-proximal: every coordinate has its own rate, falling with its gradients, and L1 keeps most at zero."""
    def distinct(text: bytes) -> np.ndarray:
        parts = feature_parts(np.frombuffer(text, np.uint8), np.array([0, len(text)])) if text else ()
        return np.unique(np.concatenate([np.zeros(0, _U), *(np.unique(h) for _, h in parts)]))

    # texts are read twice, as most features are rare: only those in MIN_DOCS documents or more are ever kept
    counts = np.zeros(1 << 24, np.uint8)
    for text in texts:
        slot = distinct(text) & _U(0xFFFFFF)
        counts[slot] = np.minimum(counts[slot], 254) + 1
    per_doc, keys = [], np.zeros(0, _U)
    for k in range(0, len(texts), BLOCK):
        some = [own[counts[own & _U(0xFFFFFF)] >= MIN_DOCS] for own in map(distinct, texts[k : k + BLOCK])]
        keys = np.union1d(keys, np.concatenate(some))
        per_doc += some
    rows = []
    while per_doc:  # hashes become places in keys document by document, from the last one, and are let go
        rows.append(np.searchsorted(keys, per_doc.pop()).astype(np.int32))
    rows.reverse()
    z, n = np.zeros(len(keys)), np.zeros(len(keys))
    bias_z = bias_n = 0.0

    def weights(z, n):
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    for _ in range(epochs):
        for row, y in zip(rows, labels, strict=True):
            zr, nr = z[row], n[row]
            w = weights(zr, nr)
            bias = -bias_z * alpha / (beta + np.sqrt(bias_n))
            g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -35, 35))) - y
            z[row] = zr + g - (np.sqrt(nr + g * g) - np.sqrt(nr)) / alpha * w
            n[row] = nr + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * bias
            bias_n += g * g
    w = weights(z, n)
    return Model(keys[w != 0], w[w != 0], float(-bias_z * alpha / (beta + np.sqrt(bias_n))))


def train(docs: DataFrame, labels: DataFrame, where: str = "true", max_train: int = MAX_TRAIN) -> Model:
    """The model of labels.toxic, from at most max_train labelled rows, in one task; only its weights come to the driver.

    where: SQL condition on doc_id of rows to learn from. Rows without id or label aren't used; of repeated labels the
    larger counts, of repeated documents one.
    """
    picked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    picked = picked.where(where).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])
        ids = table["doc_id"].to_numpy()
        once = np.concatenate([[True], ids[1:] != ids[:-1]])
        texts = [t.as_py() for t, o in zip(table["text"].cast(pa.binary()), once, strict=True) if o]
        m = fit(texts, table["toxic"].to_numpy()[once])
        return pa.table({"keys": [m.keys.tobytes()], "weights": [m.weights.tobytes()], "bias": [m.bias]}, pa.schema([("keys", pa.binary()), ("weights", pa.binary()), ("bias", pa.float64())]))

    rows = rows.select("doc_id", "text", "toxic", F.xxhash64("doc_id").alias("order"), F.lit(0).alias("one"))
    out = rows.groupBy("one").applyInArrow(fitted, "keys binary, weights binary, bias double").collect()
    if not out:
        return Model(np.zeros(0, _U), np.zeros(0), 0.0)
    return Model(np.frombuffer(out[0].keys, _U), np.frombuffer(out[0].weights, np.float64), out[0].bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: _key, doc_id, score (0 to 1, higher: more likely toxic).

    Nulls and empty texts get the score of a text without features. Rows that repeat are scored each; an empty table
    gives an empty result; without any labels every score is 0.5. Very long texts are looked at in parts. Only the named columns are
    used, whatever others are called.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in slices(batches, 2000):
            buf, offsets = text_bytes(batch.column("text"))
            out = [model.scores(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in chunks(offsets, CHUNK)]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("doc_id"), pa.array(np.concatenate([*out, np.zeros(0)]))], ["_key", "doc_id", "score"])

    rows = docs.select(key_of(id_col, text_col).alias("_key"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(scored, "_key long, doc_id long, score double")


def keep_rows(docs: DataFrame, model: Model, below: float = 0.5) -> DataFrame:
    """The rows of docs with a score below the limit, with all their columns; all of them if the model knows nothing.

    A model without weights and bias, fitted without labels, gives every text the same score of 0.5.
    """
    if not len(model.keys) and not model.bias:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in slices(batches, 2000):
            buf, offsets = text_bytes(batch.column("text"))
            out = [model.scores(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in chunks(offsets, CHUNK)]
            yield batch.filter(pa.array(np.concatenate([*out, np.zeros(0)]) < below))

    return docs.mapInArrow(kept, docs.schema)


HELD_OUT = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, false)"


def toxic_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """score() by the model of the labels that aren't held out, with held_out and predicted."""
    model = train(docs, labels, f"NOT {HELD_OUT}")
    return score(docs, model).select("_key", "doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return toxic_scores(docs, labels).drop("_key")
