import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from wayfold.llm import language_id as L

SYLLABLES = {"aa": ["ka", "to", "ri", "mu"], "bb": ["schl", "ung", "ter", "ein"], "cc": ["é", "ção", "ñe", "que"]}


def plain_grams(word):
    b = b"\0" + word.encode() + b"\0"
    return {b[i : i + n] for n in L.SIZES for i in range(len(b) - n + 1)} | {b + b"whole"}


def text_of(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled():
    import random

    r = random.Random(3)
    rows = [(i, text_of(r, lang, r.randint(5, 60)), lang) for i, lang in enumerate(r.choice("abc") * 2 for _ in range(240))]
    return [(i, t.upper() if i % 7 == 0 else t + "\n12 %%", lang) for i, t, lang in rows]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", "y") for i, t, lang in rows], "doc_id long, text string, lang string, gram string, best string")


def test_grams_are_those_of_bytes():
    words = ["a", "ab", "étude", "ka" * 40, "ß"]
    owner, h = L.grams(pa.array([w.encode() for w in words], pa.large_binary()))
    for k, w in enumerate(words):
        assert len(set(h[owner == k].tolist())) == len(plain_grams(w))
    assert len(set(h.tolist())) == len(set().union(*map(plain_grams, words)))
    assert len(L.grams(pa.array([], pa.large_binary()))[0]) == 0


def test_filters_hold_what_documents_have(spark, labelled):
    rows = [*labelled, (None, "katori", "aa"), (900, "x" * 50, None)]
    f = L.train(frame(spark, rows))
    assert f.languages == ["aa", "bb", "cc"]
    docs = {lang: [set().union(*map(plain_grams, re.findall(r"[^\W\d_]+", t.lower()))) for i, t, x in rows if x == lang and i is not None] for lang in f.languages}
    counts = {lang: Counter(g for d in docs[lang] for g in d) for lang in f.languages}
    share = lambda lang, g: counts[lang][g] / len(docs[lang])
    have = lambda lang, g: counts[lang][g] >= L.MIN_DOCS and share(lang, g) >= max(L.MIN_SHARE, L.RATIO * max(share(x, g) for x in f.languages))
    words = sorted({w for _, t, _ in rows for w in re.findall(r"[^\W\d_]+", t.lower())})
    total, hits = f.hits(pa.array([w.encode() for w in words], pa.large_binary()))
    wrong = 0
    for w, n, own in zip(words, total, hits, strict=True):
        grams = [b"\0" + w.encode() + b"\0whole"] + [(b"\0" + w.encode() + b"\0")[i : i + k] for k in L.SIZES for i in range(len(w.encode()) + 3 - k)]
        assert n == len(grams)
        for k, lang in enumerate(f.languages):
            least = sum(have(lang, g) for g in grams)
            assert own[k] >= least  # a filter never misses
            wrong += own[k] - least
    assert wrong <= 0.01 * hits.sum() + 5
    assert (f.false_rates() < 0.01).all()
    assert abs(f.shares.sum() - 1) < 1e-9


def test_languages_are_told(spark, labelled):
    f = L.train(frame(spark, labelled), "doc_id % 4 <> 2")
    rows = [r for r in labelled if r[0] % 4 == 2]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 $ 34\n", "bb"), (None, "katorimu kato", "aa"), (1003, "日本語", "zz"), (1004, "ka" * 5, "aa"), (1004, "ka" * 5, "aa"), (1005, "einung ter " * 60_000 + "kato " * 10, "bb")]
    out = L.identify(frame(spark, rows), f).collect()
    assert sorted((r.doc_id or -1) for r in out) == sorted((i or -1) for i, _, _ in rows)
    got = {r.doc_id: r for r in out}
    assert all(got[i].lang_pred == lang for i, _, lang in rows if i is None or i < 1000 or i in (1004, 1005))
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    most = Counter(lang for i, _, lang in labelled if i % 4 != 2).most_common(1)[0][0]
    assert got[1003].lang_pred == most and 0 < got[1003].score < 1 and got[1003].runner_up == "und"
    assert all(0 <= r.score <= 1 for r in out)
    assert L.identify(frame(spark, []), f).count() == 0


def test_nothing_learned_means_undetermined(spark):
    f = L.train(frame(spark, [(1, "kato", None), (None, "kato", "aa")]))
    assert f.languages == []
    assert [(r.lang_pred, r.score) for r in L.identify(frame(spark, [(1, "kato", "aa"), (2, None, None)]), f).collect()] == [("und", 0.0)] * 2


def test_more_than_64_languages(spark):
    import random

    r = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{k:02d}": ["".join(r.choice(letters) for _ in range(5)) for _ in range(6)] for k in range(70)}
    rows = [(k * 10 + j, " ".join(r.choices(own[lang], k=12)), lang) for k, lang in enumerate(own) for j in range(5)]
    f = L.train(frame(spark, rows))
    assert f.rows.shape == (1 << (L.BITS - 1), 2)
    assert np.mean([r.lang_pred == rows[r.doc_id // 10 * 5][2] for r in L.identify(frame(spark, rows), f).collect()]) == 1


def test_held_out_accuracy(spark):
    folder = Path("/root/testdata/sf0.01")
    if not folder.exists():
        pytest.skip("no tables here")
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    out = L.query(spark, str(folder)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held_out and lang[r.doc_id]]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
