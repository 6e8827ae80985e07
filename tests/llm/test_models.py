import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.llm import cotraining, packing, toxicity


@pytest.fixture(scope="module")
def labelled(spark, words):
    r = random.Random(5)
    docs, labels = [], []
    for i in range(900):
        text = words(r.randint(20, 120)).split()
        bad, junk = r.random() < 0.2, r.random() < 0.25
        if bad:
            for _ in range(4):
                text.insert(r.randrange(len(text)), r.choice(["idiotish", "moronic", "scumlike"]))
        if junk:
            text = [w + "***" for w in text]
        docs.append((i, " ".join(text), "en", f"s{i % 4}", 100))
        labels.append((i, int(not junk), int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held_out_accuracy(out, labels, column):
    rows = out.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 100
    return np.mean([r.predicted == r[column] for r in rows])


def test_toxicity_learns(labelled):
    docs, labels = labelled
    assert held_out_accuracy(toxicity.toxic_scores(docs, labels), labels, "toxic") > 0.95
    model = toxicity.train(docs, labels, max_train=300)
    assert len(model.keys) < 2000


def test_toxicity_rows_and_odd_tables(spark, labelled, make, corpus):
    docs, labels = labelled
    odd = make(corpus)
    out = toxicity.toxic_scores(odd, labels).collect()
    assert len(out) == len(corpus)
    assert all(0 <= r.score <= 1 for r in out)
    assert {r.held_out for r in out if r.doc_id is None} == {False}
    model = toxicity.train(docs, labels)
    kept = toxicity.keep_rows(docs, model)
    assert kept.columns == docs.columns
    assert kept.join(labels.where("toxic = 1"), "doc_id").count() < 20
    assert toxicity.toxic_scores(odd.where("false"), labels).count() == 0
    assert {r.score for r in toxicity.toxic_scores(odd, labels.where("false")).collect()} == {0.5}


def test_toxicity_learns_from_more_than_6000_rows(spark):
    rows = spark.range(7000).orderBy(F.xxhash64("id"), "id").collect()
    late = {r.id for r in rows[6000:]}
    docs = spark.createDataFrame([(i, f"plain words here {i % 50} " + ("latebad" if i in late and i % 2 else "")) for i in range(7000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in late and i % 2)) for i in range(7000)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert toxicity.keep_rows(docs, model).where("text LIKE '%latebad%'").count() == 0


def test_cotraining_learns(labelled):
    docs, labels = labelled
    model = cotraining.train(docs, labels.where("doc_id % 3 > 0"), f"NOT {cotraining.HELD_OUT}")
    out = cotraining.score(docs, model).withColumns({"held_out": F.expr(cotraining.HELD_OUT), "predicted": (F.col("score") >= 0.5).cast("int")})
    assert held_out_accuracy(out, labels, "quality") > 0.95


def test_cotraining_teaches_with_all_rows(spark, monkeypatch):
    r = random.Random(3)
    rows = [(i, ("*** " if i % 4 == 0 else "abc ") * r.randint(5, 9), "en", f"s{int(i % 4 == 0)}", 30) for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(400)], "doc_id long, quality int")
    seen = []
    cut_offs = cotraining.cut_offs

    def spy(*args):
        seen.append(cut_offs(*args)[1])
        return cut_offs(*args)

    monkeypatch.setattr(cotraining, "cut_offs", spy)
    model = cotraining.train(docs, labels)
    wanted = (int(0.05 * 0.75 * 11_600), int(0.05 * 0.25 * 11_600))  # of all rows without a label, at most
    assert all(0.8 * w <= n <= w * 1.05 for n, w in zip(seen[0][0], wanted, strict=True))
    out = cotraining.score(docs, model)
    assert out.where("(score >= 0.5) = (doc_id % 4 > 0)").count() == 12_000


def test_cotraining_sums_over_tasks(spark):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, cotraining.BINS + 1, (3000, len(cotraining.TEXT) + 3)).astype(np.uint8)
    order = rng.integers(-(2**62), 2**62, 3000)
    pool = spark.createDataFrame([(int(o), bytearray(c.tobytes())) for o, c in zip(order, codes, strict=True)], "order long, codes binary").repartition(7)
    weights = [rng.normal(size=len(cotraining.TEXT) * 13 + 1), rng.normal(size=142)]
    cuts, sizes = cotraining.cut_offs(pool, [], weights, 0.5, 0.2, 0.9)
    past = [cotraining.Round(weights, cuts)]
    at = cotraining.places(codes)
    labels, free = cotraining.taught(at, order, past, 0.9)
    assert 0 < free.sum() < 3000
    assert [(int((labels[1 - k] == 1).sum()), int((labels[1 - k] == 0).sum())) for k in (0, 1)] == sizes
    out = cotraining.pool_sums(pool, past, weights, [(1.0, 2.0)] * 2, 0.9)
    for k in (0, 1):
        have = ~np.isnan(labels[k])
        want = cotraining.sums(at[k][have], labels[k][have], np.where(labels[k][have] > 0.5, 1.0, 2.0), weights[k])
        assert have.sum() > 100 and np.allclose(out[k], want)


def test_cotraining_odd_tables(labelled, make, corpus):
    docs, labels = labelled
    odd = make(corpus)
    model = cotraining.train(docs, labels)
    out = cotraining.score(odd, model).collect()
    assert len(out) == len(corpus)
    assert all(0 <= r.score <= 1 for r in out)
    assert cotraining.score(odd.where("false"), model).count() == 0
    assert cotraining.score(odd.drop("source", "lang", "n_chars"), model).count() == len(corpus)
    assert cotraining.train(docs, labels.where("false")) is None
    assert {r.score for r in cotraining.score(odd, None).collect()} == {0.5}


def test_best_fit_fills_bins():
    r = random.Random(1)
    lengths = sorted((r.randint(1, 64) for _ in range(500)), reverse=True)
    out = packing.best_fit(lengths, (16, 32, 64), 2)
    bins = {}
    for n, (b, at, c) in zip(lengths, out, strict=True):
        bins.setdefault(b, []).append((at, n, c))
    for items in bins.values():
        items.sort()
        used = sum(n for _, n, _ in items)
        assert [at for at, *_ in items] == [sum(n for _, n, _ in items[:k]) for k in range(len(items))]
        assert {c for *_, c in items} == {min(c for c in (16, 32, 64) if c >= used)}
    total = sum(items[0][2] for items in bins.values())
    assert sum(lengths) / total > 0.97
    assert packing.best_fit([], (16,), 1) == []
    bins = packing.best_fit([16, 10, 6], (16, 32), 1)
    assert sum({b: c for b, _, c in bins}.values()) == 32


@pytest.mark.parametrize("shard", [5, 20_000])
def test_packing_keeps_every_word(make, corpus, shard):
    out = packing.pack(make(corpus), capacities=(64, 128, 256), shard=shard).collect()
    words = {}
    for r in out:
        words[r.doc_id] = words.get(r.doc_id, 0) + r.length
    want = {}
    for i, t in corpus:
        want[i] = want.get(i, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert words == want
    fill = {}
    for r in out:
        if r.bin is not None:
            fill.setdefault(r.bin, []).append((r.position, r.length, r.capacity, r.fill))
    for items in fill.values():
        items.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(items, items[1:], strict=False))
        assert items[-1][0] + items[-1][1] == items[0][3] <= items[0][2]
    assert all(r.bin is None for r in out if r.length == 0)
    assert packing.pack(make([])).count() == 0


@pytest.mark.parametrize(("shard", "shard_tokens", "end"), [(20_000, 1 << 23, None), (5, 1 << 23, 7), (20_000, 600, None)])
def test_sequences_of_ids_hold_every_token_once(spark, make, corpus, shard, shard_tokens, end):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from wayfold.llm import bpe

    path = public_tokenizers.path(bpe.VOCABULARY)
    encoded = bpe.encode(make(corpus), path)
    out = packing.pack_ids(encoded.selectExpr("*", "1 AS shard", "'x' AS piece", "2 AS _row", "3 AS n"), (64, 128, 256), shard=shard, shard_tokens=shard_tokens, end=end).collect()
    assert len({r.bin for r in out}) == len(out)
    assert len({r.bin >> 32 for r in out}) > 1 or (shard, shard_tokens) == (20_000, 1 << 23)
    found = {}
    for r in out:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.fill <= r.capacity and r.capacity == min(c for c in (64, 128, 256) if c >= r.fill)
        at = 0
        for p in r.pieces:
            assert p.position == at and p.start == p.piece * 256 and 0 < p.length <= 256
            found.setdefault((p.doc_id, p.start), []).append(tuple(ids[at : at + p.length]))
            at += p.length
        assert at == r.fill
    want = {}
    for r in encoded.collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        ids += [end] if ids and end is not None else []
        for s in range(0, len(ids), 256):
            want.setdefault((r.doc_id, s), []).append(tuple(ids[s : s + 256]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    if shard_tokens == 1 << 23 and shard == 20_000:
        assert sum(r.fill for r in out) / sum(r.capacity for r in out) > 0.95
    none = spark.createDataFrame([(1, None), (2, bytearray())], "doc_id long, ids binary")
    assert packing.pack_ids(none, end=7).count() == packing.pack_ids(none.limit(0)).count() == 0


def brute_cost(lengths, capacities, overhead, attention):
    """The least cost of all partitions of a few lengths into bins."""
    best = [float("inf")]

    def put(k, bins):
        if k == len(lengths):
            best[0] = min(best[0], sum(packing.cost(next(c for c in capacities if c >= b), overhead, attention) for b in bins))
            return
        for j in range(len(bins)):
            if bins[j] + lengths[k] <= capacities[-1]:
                put(k + 1, bins[:j] + [bins[j] + lengths[k]] + bins[j + 1 :])
        put(k + 1, [*bins, lengths[k]])

    put(0, [])
    return best[0]


def test_packing_is_near_the_optimum_and_opens_several_sizes():
    import random

    r = random.Random(11)
    ratios, opened = [], set()
    for _ in range(60):
        lengths = sorted((r.choice([r.randint(1, 8), r.randint(1, 32)]) for _ in range(r.randint(1, 8))), reverse=True)
        out = packing.best_fit(lengths, (8, 16, 32), 2, 128)
        total = sum(packing.cost(c, 2, 128) for c in {b: c for b, _, c in out}.values())
        opened |= {c for *_, c in out}
        ratios.append(total / brute_cost(lengths, (8, 16, 32), 2, 128))
    assert opened == {8, 16, 32}
    assert min(ratios) >= 1 - 1e-9 and max(ratios) < 1.5 and sum(ratios) / len(ratios) < 1.1
    many = [r.randint(1, 600) for _ in range(3000)] + [r.randint(600, 4096) for _ in range(200)]
    sizes = {b: c for b, _, c in packing.best_fit(sorted(many, reverse=True))}
    assert len(set(sizes.values())) >= 3 and sum(many) / sum(sizes.values()) > 0.9


def test_contents_of_bins_are_the_texts(make, corpus):
    docs = make(corpus)
    bins = packing.contents(packing.pack(docs, capacities=(64, 128), shard=10, with_text=True)).collect()
    assert all(len(b.text.split(" ")) == b.fill <= b.capacity for b in bins)
    want = sorted(w for _, t in corpus for w in re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(w for b in bins for w in b.text.split(" ")) == want


def test_ftrl_equals_a_plain_loop():
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 9))).encode() for _ in range(80)]
    labels = np.array([int(b"w1" in t.split()) for t in texts])
    alpha, beta, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2
    rows = [sorted({int(f) for f in toxicity.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[1]}) for t in texts]
    often = {f for f in {f for row in rows for f in row} if sum(f in row for row in rows) >= toxicity.MIN_DOCS}
    z, n = {f: 0.0 for f in often} | {None: 0.0}, {f: 0.0 for f in often} | {None: 0.0}

    def weight(f):
        if f is None:
            return -z[f] * alpha / (beta + n[f] ** 0.5)
        return 0.0 if abs(z[f]) <= l1 else -(z[f] - np.sign(z[f]) * l1) / ((beta + n[f] ** 0.5) / alpha + l2)

    for _ in range(toxicity.EPOCHS):
        for row, y in zip(rows, labels, strict=True):
            own = [f for f in row if f in often] + [None]
            w = {f: weight(f) for f in own}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for f in own:
                z[f] += g - ((n[f] + g * g) ** 0.5 - n[f] ** 0.5) / alpha * w[f]
                n[f] += g * g
    model = toxicity.fit(texts, labels)
    want = {f: weight(f) for f in often if weight(f)}
    assert dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True)) == pytest.approx(want)
    assert model.bias == pytest.approx(weight(None))


def test_parts_of_a_long_text_have_all_features(words):
    text = np.frombuffer(" ".join(f"{words(9)} z{i}" for i in range(90_000)).encode(), np.uint8)
    assert len(text) > 3 * toxicity.CHUNK
    whole = np.unique(toxicity.features(text, np.array([0, len(text)]))[1])
    parts = list(toxicity.feature_parts(text, np.array([0, len(text)])))
    assert len(parts) > 3
    assert np.array_equal(np.unique(np.concatenate([h for _, h in parts])), whole)


def test_rounds_help_where_both_views_tell_and_do_no_harm_where_one_does_not(spark, monkeypatch):
    r = random.Random(8)

    def page(good, told):
        # a few marks in bad texts, as many in some good ones; the source tells most of the time, or nothing
        marks = "".join(r.choice("#*$%") for _ in range(r.choice([0, 0, 1, 2] if good else [1, 2, 4, 6])))
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(r.randint(20, 60))]
        kind = good if not told or r.random() < 0.97 else not good
        return " ".join(words) + " " + marks, f"s{r.randrange(3) + 3 * kind if told else r.randrange(6)}"

    def ranked(told, rounds):
        monkeypatch.setattr(cotraining.cotrain, "__defaults__", (rounds, *cotraining.cotrain.__defaults__[1:]))
        docs = spark.createDataFrame([(i, *tables[told][i][:1], "en", tables[told][i][1], 100) for i in range(4000)], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
        model = cotraining.train(docs, spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(160)], "doc_id long, quality int"))
        out = cotraining.score(docs, model).where("doc_id >= 160").collect()
        good, bad = (np.array([x.text_score for x in out if (x.doc_id % 3 > 0) == k]) for k in (True, False))
        wins = np.searchsorted(np.sort(bad), good, "left") + np.searchsorted(np.sort(bad), good, "right")
        return wins.mean() / 2 / len(bad), np.mean([(x.score >= 0.5) == (x.doc_id % 3 > 0) for x in out])

    tables = {told: [page(i % 3 > 0, told) for i in range(4000)] for told in (True, False)}
    (plain, _), (taught, right) = ranked(True, 0), ranked(True, 4)
    assert taught > plain + 0.01 and right > 0.95  # the text view has learned from what the source tells
    (plain, before), (taught, after) = ranked(False, 0), ranked(False, 4)
    assert taught > plain - 0.01 and after > before - 0.01


def test_parts_keep_pairs_of_very_long_words(monkeypatch):
    r = random.Random(2)
    long = [("".join(r.choice("abcd") for _ in range(k)) + " ").encode() for k in [30_000, 3000, 1, 9000, 2, 5000, 12_000, 3, 4] * 12]
    text = np.frombuffer(b" .. ".join(long) + b" " * 9000 + b"end of it", np.uint8)
    whole = np.unique(toxicity.features(text, np.array([0, len(text)]))[1])
    for chunk in (1000, 4096, 20_000):
        monkeypatch.setattr(toxicity, "CHUNK", chunk)
        parts = list(toxicity.feature_parts(text, np.array([0, len(text)])))
        assert len(parts) > 10
        assert np.array_equal(np.unique(np.concatenate([h for _, h in parts])), whole)
