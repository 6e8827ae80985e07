"""Quality classifier by co-training: a text view and a metadata view teach each other with confident pseudo-labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, partitions
from .words import Words, chunks, slices, text_bytes

#: Labelled rows that the views are fitted on at most, those with the smallest hashes of their ids.
MAX_LABELLED = 8_000
ROUNDS, TAKE, SURE, LIFT = 4, 0.05, 0.9, 4
#: Ranges of each measurement, slots of each hashed name, and names: source, language, and both with the length's range.
BINS, SLOTS, NAMES = 12, 64, 3
#: Share of the labelled rows that calibration keeps for itself.
CALIBRATE = 0.25
#: Levels of certainty that are counted, and of order within one; the rank of rows that aren't sure enough.
LEVELS = 1 << 12
NOT_SURE = LEVELS * LEVELS
#: Bits of a float that are left out where measurements are counted.
CELL = 14

#: Slots of hashed words: the text view sees which share of a text's words falls into each.
WORDS = 8
TEXT = ("symbols", "bars", "marks", "capitals", "digits", "stops", "lines", "word_length", "distinct", "echo", "words", *(f"words_{k}" for k in range(WORDS)))
META = ("chars",)
_CLASSES = [np.isin(np.arange(256), list(chars.encode())) for chars in ("#*$%&<>@^~", "|", "!?", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:", "\n")]


def measurements(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The TEXT measurements of each text, one row each: shares of kinds of bytes, and how words repeat and which there are."""
    words = Words(buf, offsets, lower=True)
    n = np.maximum(words.counts, 1)
    size = np.maximum(np.diff(offsets), 1)
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    shares = [total(of[buf]) / size for of in _CLASSES]
    length = np.diff(np.concatenate([[0], np.cumsum(words.end - words.start)])[words.first]) / n
    distinct = np.array([len(np.unique(words.hash[a:b])) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]) / n
    same = np.zeros(len(words.hash), bool)
    same[1:] = words.hash[1:] == words.hash[:-1]
    echo = np.diff(np.concatenate([[0], np.cumsum(same)])[words.first]) / n
    slots = np.bincount(words.doc_of() * WORDS + (words.hash % np.uint64(WORDS)).astype(np.int64), minlength=len(n) * WORDS).reshape(-1, WORDS) / n[:, None]
    return np.column_stack([*shares, length, distinct, echo, np.log2(words.counts + 1.0), slots])


class View(NamedTuple):
    """A logistic regression over ranges of measurements and slots of hashed names."""

    edges: np.ndarray
    weights: np.ndarray

    def columns(self, numbers: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """The weight of each measurement's range and each name's slot, as places in weights."""
        binned = [np.searchsorted(e, numbers[:, k], "right") + k * (BINS + 1) for k, e in enumerate(self.edges)]
        named = [slots[:, k] + len(self.edges) * (BINS + 1) + k * SLOTS for k in range(slots.shape[1])]
        return np.column_stack([*binned, *named]).astype(np.int64)

    def logits(self, numbers: np.ndarray, slots: np.ndarray) -> np.ndarray:
        return self.weights[-1] + self.weights[self.columns(numbers, slots)].sum(1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def sums(at: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Loss, gradient and curvature of weighted rows, one after the other; sums of parts are sums of the whole."""
    d = len(w)
    at = np.column_stack([at, np.full(len(at), d - 1)])
    z = w[at].sum(1)
    p = _sigmoid(z)
    grad = np.bincount(at.ravel(), np.repeat((p - y) * weight, at.shape[1]), d)
    curve = np.bincount((at[:, :, None] * d + at[:, None, :]).ravel(), np.repeat(p * (1 - p) * weight, at.shape[1] ** 2), d * d)
    return np.concatenate([[np.sum(weight * np.logaddexp(0, np.where(y > 0.5, -z, z)))], grad, curve])


def fit_views(total: Callable[[list[np.ndarray]], list[np.ndarray]], starts: list[np.ndarray], steps: int = 12, l2: float = 1e-3) -> list[np.ndarray]:
    """Weights of both views by Newton steps, halved where the loss rises; total gives sums() over all rows."""
    w, best, done = [x.copy() for x in starts], [(np.inf, x, x) for x in starts], [False, False]
    for _ in range(steps):
        for k, s in enumerate(total(w)):
            if done[k]:
                continue
            d = len(w[k])
            ridge = np.append(np.full(d - 1, l2), 1e-6)
            loss = s[0] + 0.5 * np.sum(ridge * w[k] ** 2)
            if loss > best[k][0]:
                w[k] = (w[k] + best[k][1]) / 2
                continue
            step = np.linalg.solve(s[1 + d :].reshape(d, d) + np.diag(ridge), s[1 : 1 + d] + ridge * w[k])
            best[k] = (loss, w[k], step)
            w[k] = w[k] - step
            done[k] = bool(np.abs(step).max() < 1e-2)
        if all(done):
            break
    return [w[k] if done[k] else best[k][1] for k in (0, 1)]


def _calibrated(x: np.ndarray, y: np.ndarray, steps: int = 500) -> np.ndarray:
    """Logistic regression of y on the columns of x (logits) and 1; by Newton steps with a small ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(min(steps, 30)):
        p = _sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + 1e-2 * w)
    return w


def _scale(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(factor, shift) that make the logits z of calibration rows chances; (0, 0) if they tell no more than the prior.

    Labels are drawn in by the number of rows of their class (Platt), so that a few rows can't make a view sure; and
    the two numbers have to earn their keep: the loss falls by one for each of them, or the view tells nothing.
    """
    good, bad = y.sum(), (1 - y).sum()
    if not good or not bad:
        return np.zeros(2)
    w = _calibrated(z[:, None], np.where(y > 0.5, (good + 1) / (good + 2), 1 / (bad + 2)))
    loss = lambda p: -np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))
    better = loss(np.clip(_sigmoid(z * w[0] + w[1]), 1e-9, 1 - 1e-9)) + 2 < loss(np.full(len(y), (good + 1) / (len(y) + 2)))
    return w if better and w[0] > 0 else np.zeros(2)


class Model(NamedTuple):
    text: View
    meta: View
    text_scale: np.ndarray
    meta_scale: np.ndarray
    both: np.ndarray

    def scores(self, numbers: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of both views, of the text view and of the metadata view."""
        none = np.zeros((len(numbers), 0), np.int64)
        a = self.text.logits(numbers[:, : len(TEXT)], none) * self.text_scale[0] + self.text_scale[1]
        b = self.meta.logits(numbers[:, len(TEXT) :], slots) * self.meta_scale[0] + self.meta_scale[1]
        return _sigmoid(np.column_stack([a, b]) @ self.both[:2] + self.both[2]), _sigmoid(a), _sigmoid(b)


class Round(NamedTuple):
    """What tells the labels of a round: weights of both views, and below which rank a row counts as good or bad."""

    weights: list[np.ndarray]
    cuts: list[tuple[int, int]]


def places(codes: np.ndarray) -> list[np.ndarray]:
    """Of rows of codes (ranges of the TEXT and META measurements, slots): the places of both views' weights."""
    codes, n, m = codes.astype(np.int64), len(TEXT), len(META)
    text = codes[:, :n] + np.arange(n) * (BINS + 1)
    meta = codes[:, n : n + m] + np.arange(m) * (BINS + 1)
    names = codes[:, n + m :] + m * (BINS + 1) + np.arange(codes.shape[1] - n - m) * SLOTS
    return [text, np.column_stack([meta, names])]


def ranks(at: np.ndarray, w: np.ndarray, order: np.ndarray, sure: float | tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row as good and as bad, the surest first, equal ones by order; NOT_SURE for those below `sure` (as good, as bad)."""
    sure = (sure, sure) if np.isscalar(sure) else sure
    z = np.clip(w[-1] + w[at].sum(1), -35, 35)
    level = np.floor((z + 35) / 70 * (LEVELS - 1)).astype(np.int64)
    tie, (good, bad) = (order >> 40) & (LEVELS - 1), (np.log(s / (1 - s)) for s in sure)
    return np.where(z >= good, (LEVELS - 1 - level) * LEVELS + tie, NOT_SURE), np.where(z <= -bad, level * LEVELS + tie, NOT_SURE)


def taught(at: list[np.ndarray], order: np.ndarray, rounds: list[Round], sure: float | tuple[float, float]) -> tuple[list[np.ndarray], np.ndarray]:
    """Labels that each view has got from the other one (NaN: none), and which rows are still in the pool."""
    labels, free = [np.full(len(order), np.nan) for _ in (0, 1)], np.ones(len(order), bool)
    for r in rounds:
        now = free.copy()
        for k in (0, 1):
            good, bad = (now & (x < c) for x, c in zip(ranks(at[k], r.weights[k], order, sure), r.cuts[k], strict=True))
            labels[1 - k][good], labels[1 - k][bad] = 1, 0
            free &= ~(good | bad)
    return labels, free


def _state(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    for batch in slices(batches, 4000):
        codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8)
        yield places(codes.reshape(batch.num_rows, -1)), batch.column("order").to_numpy()


def _counted(pool: DataFrame, found: Callable[[list[np.ndarray], np.ndarray], Iterator[tuple[int, np.ndarray]]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counts over all rows of the numbers that found gives of each kind: kind to (numbers, counts)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for state in _state(batches):
            for kind, x in found(*state):
                x, n = np.unique(x, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int32)), pa.array(x, pa.int64()), pa.array(n, pa.int64())], ["kind", "x", "n"])

    return _histograms(pool.mapInArrow(count, "kind int, x long, n long"))


def _histograms(counts: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    t = counts.groupBy("kind", "x").agg(F.sum("n").alias("n")).toArrow().sort_by([("kind", "ascending"), ("x", "ascending")])
    kind, x, n = (t[c].to_numpy() for c in ("kind", "x", "n"))
    return {int(k): (x[kind == k], n[kind == k]) for k in np.unique(kind)}


def _below(table: tuple[np.ndarray, np.ndarray] | None, want: int) -> tuple[int, int]:
    """The first number up to which there are more than `want` rows, and how many rows lie before it."""
    if table is None:
        return NOT_SURE, 0
    total = np.cumsum(table[1])
    at = int(np.searchsorted(total, want, "right"))
    return (int(table[0][at]) if at < len(total) else NOT_SURE), int(total[at - 1]) if at else 0


def cut_offs(pool: DataFrame, rounds: list[Round], weights: list[np.ndarray], share: float, take: float, sure: float | tuple[float, float]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Ranks below which rows of the pool get a label from each view, and how many rows (good, bad) that are.

    Counts over all rows tell the level at which `take` of them is reached, a second count the place within it.
    """

    def levels(at: list[np.ndarray], order: np.ndarray):
        _, free = taught(at, order, rounds, sure)
        yield -1, np.zeros(free.sum(), np.int64)
        for k in (0, 1):
            for j, x in enumerate(ranks(at[k], weights[k], order, sure)):
                yield 2 * k + j, x[free & (x < NOT_SURE)] // LEVELS

    counts = _counted(pool, levels)
    size = int(counts[-1][1].sum()) if -1 in counts else 0
    wanted = [int(take * (share, 1 - share)[j] * size) for _ in (0, 1) for j in (0, 1)]
    first = [_below(counts.get(i), wanted[i]) for i in range(4)]

    def within(at: list[np.ndarray], order: np.ndarray):
        _, free = taught(at, order, rounds, sure)
        for k in (0, 1):
            for j, x in enumerate(ranks(at[k], weights[k], order, sure)):
                yield 2 * k + j, x[free & (x < NOT_SURE) & (x // LEVELS == first[2 * k + j][0])]

    counts = _counted(pool, within) if any(x < NOT_SURE for x, _ in first) else {}
    second = [_below(counts.get(i), wanted[i] - first[i][1]) for i in range(4)]
    cuts, sizes = [c for c, _ in second], [first[i][1] + second[i][1] for i in range(4)]
    return [(cuts[0], cuts[1]), (cuts[2], cuts[3])], [(sizes[0], sizes[1]), (sizes[2], sizes[3])]


def pool_sums(pool: DataFrame, rounds: list[Round], weights: list[np.ndarray], class_weights: list[tuple[float, float]], sure: float | tuple[float, float]) -> list[np.ndarray]:
    """sums() of both views over the rows of the pool that have got a label."""
    sizes = [1 + len(w) + len(w) ** 2 for w in weights]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(sum(sizes))
        for at, order in _state(batches):
            labels, _ = taught(at, order, rounds, sure)
            have = [~np.isnan(y) for y in labels]
            if any(h.any() for h in have):
                out += np.concatenate([sums(at[k][h], y[h], np.where(y[h] > 0.5, *class_weights[k]), weights[k]) for k, (y, h) in enumerate(zip(labels, have, strict=True))])
        place = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(out[place])], ["place", "v"])

    # numbers are added up by their places, each place by itself, whatever the number of tasks
    rows = pool.mapInArrow(part, "place int, v double").groupBy("place").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(sum(sizes))
    out[rows["place"].to_numpy()] = rows["v"].to_numpy()
    return [out[: sizes[0]], out[sizes[0] :]]


def cotrain(known: tuple[np.ndarray, np.ndarray], pool: DataFrame, edges: np.ndarray, rounds: int = ROUNDS, take: float = TAKE, sure: float = SURE) -> Model:
    """Fit on known rows (codes, labels) in a fixed order and on all rows of pool (order, codes), which have no label.

    In each round both views are fitted on their labels and calibrated on known rows that they aren't fitted on; of the
    pool, each view passes up to `take` of it, those it is surest of and, calibrated, at least `sure`, as labels to the
    other one. A view that tells no more of the calibration rows than the classes' shares do teaches nothing. Labels keep the two classes' shares. Rows stay where
    they are: their labels follow from the weights and cut-offs of the rounds, and only sums come to the driver.
    """
    codes, y = known
    n_cal = int(len(y) * CALIBRATE)
    at, own = places(codes), slice(n_cal, None)
    weights = [np.zeros(n) for n in (len(TEXT) * (BINS + 1) + 1, len(META) * (BINS + 1) + (codes.shape[1] - len(TEXT) - len(META)) * SLOTS + 1)]
    share = y[own].mean() if len(y[own]) else 0.5
    past, got = [], np.zeros((2, 2), np.int64)
    # where most rows are good, to be right in `sure` of the cases is no news: errors must be rarer than guesses by LIFT
    sure = tuple(max(sure, 1 - (1 - of_class) / LIFT) for of_class in (share, 1 - share))

    def fit(starts: list[np.ndarray]) -> list[np.ndarray]:
        class_weights = []
        for k in (0, 1):
            good, bad = np.array([y[own].sum(), (1 - y[own]).sum()]) + got[k]
            part = np.clip(good / max(good + bad, 1), 0.01, 0.99)
            class_weights.append((0.5 / part / max(good + bad, 1), 0.5 / (1 - part) / max(good + bad, 1)))

        def total(w: list[np.ndarray]) -> list[np.ndarray]:
            known = [sums(at[k][own], y[own], np.where(y[own] > 0.5, *class_weights[k]), w[k]) for k in (0, 1)]
            return [a + b for a, b in zip(known, pool_sums(pool, past, w, class_weights, sure), strict=True)] if got.any() else known

        return fit_views(total, starts)

    def scales() -> list[np.ndarray]:
        return [_scale(w[-1] + w[at[k][:n_cal]].sum(1), y[:n_cal]) for k, w in enumerate(weights)]

    for _ in range(rounds if len(y[own]) else 0):
        weights = fit(weights)
        told = [np.append(w[:-1] * a, w[-1] * a + b) for w, (a, b) in zip(weights, scales(), strict=True)]
        if not np.any([t.any() for t in told]):
            break
        cuts, sizes = cut_offs(pool, past, told, share, take, sure)
        past.append(Round(told, cuts))
        got += np.array(sizes)[::-1]
        if not np.any(sizes):
            break
    weights = fit(weights)
    views = [View(edges[: len(TEXT)], weights[0]), View(edges[len(TEXT) :], weights[1])]
    logits = [w[-1] + w[at[k][:n_cal]].sum(1) for k, w in enumerate(weights)]
    found = scales()
    if not np.any(found):  # with next to no labels, what little the views tell is better than nothing
        found = [_calibrated(z[:, None], y[:n_cal]) for z in logits]
    both = _calibrated(np.column_stack([z * s[0] + s[1] for z, s in zip(logits, found, strict=True)]), y[:n_cal])
    return Model(*views, *found, both)


def view_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, numbers array<double> (TEXT and META), slots array<int> of the NAMES, one row per row of docs.

    Metadata columns that docs lacks count as null; nulls have a slot of their own.
    """

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            buf, offsets = text_bytes(batch.column("text"))
            parts = [measurements(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in chunks(offsets)]
            chars = np.log2(batch.column("chars").to_numpy(zero_copy_only=False) + 1.0)
            numbers = np.column_stack([np.concatenate(parts) if parts else np.zeros((0, len(TEXT))), chars])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(numbers) + 1, dtype=np.int32) * numbers.shape[1]), pa.array(numbers.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, batch.column("slots")], ["doc_id", "numbers", "slots"])

    name = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")), F.lit(SLOTS)).cast("int")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-")) if c in docs.columns else F.lit("-")
    chars = F.greatest(F.lit(0.0), F.coalesce((F.col("n_chars") if "n_chars" in docs.columns else F.lit(None).cast("double")).try_cast("double"), F.lit(0.0)))
    crossed = F.pmod(F.xxhash64(text("source"), text("lang"), F.floor(F.log2(chars + 1))), F.lit(SLOTS)).cast("int")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), chars.alias("chars"), F.array(name("source"), name("lang"), crossed).alias("slots"))
    return rows.mapInArrow(measured, "doc_id long, numbers array<double>, slots array<int>")


def _arrays(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    flat = lambda c: np.asarray((x.combine_chunks() if isinstance(x := table.column(c), pa.ChunkedArray) else x).flatten())
    return flat("numbers").reshape(-1, len(TEXT) + len(META)), flat("slots").reshape(-1, NAMES)


def range_edges(rows: DataFrame) -> np.ndarray:
    """BINS edges of each measurement, quantiles from counts over all rows; numbers count to 9 bits of their fraction."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4000):
            numbers, _ = _arrays(batch)
            for k in range(numbers.shape[1]):
                x, n = np.unique(numbers[:, k].astype(np.float32).view(np.int32) >> CELL, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), k, np.int32)), pa.array(x, pa.int64()), pa.array(n, pa.int64())], ["kind", "x", "n"])

    counts = _histograms(rows.mapInArrow(cells, "kind int, x long, n long"))
    edges = np.zeros((len(TEXT) + len(META), BINS))
    for k, (x, n) in counts.items():
        value = (x.astype(np.int32) << CELL).view(np.float32).astype(float)
        at = lambda v, n, q: v[np.minimum(np.searchsorted(np.cumsum(n), q * n.sum()), len(v) - 1)]
        edges[k] = at(value, n, np.linspace(0, 1, BINS + 2)[1:-1])
        # rare kinds of text differ in measurements that are 0 for most: half of the ranges lie among the larger values
        rest = value > edges[k, BINS // 2]
        if edges[k, 0] == edges[k, -1] and rest.any():
            edges[k] = np.sort(np.concatenate([edges[k, : BINS // 2], at(value[rest], n[rest], np.linspace(0, 1, BINS - BINS // 2))]))
    return edges


def train(docs: DataFrame, labels: DataFrame, where: str = "true", max_labelled: int = MAX_LABELLED) -> Model | None:
    """The model of labels.quality from a bounded sample of labelled rows and all other rows.

    None if no row has a label. Of repeated labels the larger counts, of repeated ids the row of the smallest codes; sure
    rows that tie are taken by a hash of their ids. where: SQL condition on doc_id of labels to learn from.
    """
    docs = docs.select(*(c for c in ("doc_id", "text", "source", "lang", "n_chars") if c in docs.columns)).where("doc_id IS NOT NULL")
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("double").alias("y"))
    order = F.xxhash64("doc_id")
    picked = known.where(where).orderBy(order, "doc_id").limit(max_labelled)
    if picked.isEmpty():
        return None
    # rows that have a label which isn't to be learned from stay unlabelled
    rows = cut(view_rows(docs).join(F.broadcast(picked), "doc_id", "left").withColumn("order", order))
    edges = range_edges(rows)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4000):
            numbers, slots = _arrays(batch)
            codes = np.column_stack([*(np.searchsorted(e, numbers[:, k], "right") for k, e in enumerate(edges)), slots]).astype(np.uint8)
            binary = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("y"), binary], ["order", "y", "codes"])

    # codes are some 25 bytes a row: fewer partitions, so that the rounds' sums come from fewer tasks
    rows = cut(rows.coalesce(4 * partitions(rows.sparkSession)).mapInArrow(coded, "order long, y double, codes binary"))
    own = rows.where("y IS NOT NULL").groupBy("order").agg(F.max("y").alias("y"), F.min("codes").alias("codes")).toArrow().sort_by("order")
    if not own.num_rows:
        return None
    codes = np.frombuffer(b"".join(own["codes"].to_pylist()), np.uint8).reshape(own.num_rows, -1)
    return cotrain((codes, own["y"].to_numpy()), rows.where("y IS NULL").select("order", "codes"), edges)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, score, text_score, meta_score (0 to 1, higher: better quality).

    A very long text is measured whole in one task, some 50 bytes of memory a byte; of names and ids any value goes, and
    other columns than text, source, lang, n_chars aren't looked at, whatever they are called. Nulls and empty texts have measurements of 0. Rows that repeat are scored each; an empty table gives an empty
    result; without a model every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model, n = shared.value, batch.num_rows
            out = model.scores(*_arrays(batch)) if model else (np.full(n, 0.5),) * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out)], ["doc_id", "score", "text_score", "meta_score"])

    return view_rows(docs, id_col, text_col).mapInArrow(scored, "doc_id long, score double, text_score double, meta_score double")


HELD_OUT = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, false)"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, train(docs, labels, f"NOT {HELD_OUT}"))
    return out.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= 0.5).alias("kept"), "text_score", "meta_score")
