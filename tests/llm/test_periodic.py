import hashlib
import re
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfold.llm import periodic_runs as P


def smallest_period(w):
    fail = [0] * (len(w) + 1)
    k = 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k]
        k += w[i] == w[k]
        fail[i + 1] = k
    return len(w) - fail[len(w)]


def brute(w, least=24, times=3):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q) and smallest_period(w[i : j + q]) == q:
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def want(doc_id, text):
    w = words_of(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)),
    )


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 12)), max_size=5), st.integers(0, 30))
def test_runs_equal_brute_force(parts, tail):
    docs = [[x for word, times in parts for x in word * times], [0] * tail, [], [1, 0] * tail]
    flat = np.array([x for d in docs for x in d], np.int64)
    first = np.cumsum([0, *map(len, docs)])
    start, length, period = P.find_runs(flat, first, 6, 3)
    found = sorted(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    assert found == sorted((int(first[k]) + s, m, q) for k, d in enumerate(docs) for s, m, q in brute(d, 6))


def test_documents_equal_brute_force(spark, make, corpus, words):
    spell = words(7)
    rows = [*corpus, *((100 + i, words(40 + i)) for i in range(60))]
    rows += [(300, " ".join([spell] * 9)), (301, "x " * 30 + "y " + "x " * 40), (302, " \n".join([words(50)] * 4)), (303, "a b " * 12), (304, "a b " * 11 + "a"), (305, "  é  " * 30)]
    fib = ["a", "b"]
    while len(fib[-1]) < 2000:
        fib.append(fib[-1] + fib[-2])
    rows += [(306, " ".join(fib[-1])), (307, " ".join(fib[-1][:700]) + " " + words(30))]
    out = [tuple(r)[:8] for r in P.digests(P.periodic_runs(make(rows), order=P.echoed)).collect()]
    assert sorted(out, key=repr) == sorted((want(i, t) for i, t in rows), key=repr)
    assert any(r[1] > 1 for r in out) and any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None)


def test_a_very_long_text_and_none_at_all(spark, make, words):
    part = words(5000)
    n = len(words_of(part))
    head = words(100) + " <"
    text = " ".join([head, part, part, part, part, ">", words(100)])
    (r,) = P.periodic_runs(make([(1, text)])).collect()
    a = len(words_of(text))
    assert [tuple(x) for x in r.runs if x.period == n] == [(len(words_of(head)), 4 * n, n)]
    assert r.n_words == a and len(words_of(r.collapsed)) == a - 3 * n
    assert P.digests(P.periodic_runs(make([]))).count() == 0
    with pytest.raises(ValueError, match="three periods"):
        P.periodic_runs(make([]), min_repeats=2)
    plain = P.periodic_runs(make([(None, None)]), order=P.echoed).collect()
    assert [(x.doc_id, x.n_words, x.runs, x.collapsed) for x in plain] == [(None, 0, [], "")]


def test_query_has_its_columns(spark):
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no tables here")
    out = P.query(spark, str(folder))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(tuple(r)[:8] for r in out.collect()) == sorted(want(i, t) for i, t in docs)
