import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from wayfold.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, top=50):
    tf = [Counter(terms_of(t)) for _, t in docs]
    size = [sum(c.values()) for c in tf]
    n_docs, n_terms = sum(n > 0 for n in size), sum(size)
    df = Counter(t for c in tf for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms_of(t))
    out = []
    for i, terms in wanted.items():
        scores = []
        for (d, _), c, n in zip(docs, tf, size, strict=True):
            if n:
                m = 50 + 50 * n * n_docs // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
                if s > 0:
                    scores.append((-s, d is None, d or 0))
        out += [(i, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "item_id long, text string, rank int, block string")


@pytest.mark.parametrize(("block", "bundle", "rows", "top", "postings"), [(2048, 256, 250_000, 50, 1 << 20), (7, 3, 100, 4, 60)])
def test_results_equal_brute_force(spark, make, corpus, words, monkeypatch, block, bundle, rows, top, postings):
    for name, value in (("BLOCK", block), ("BUNDLE", bundle), ("BROADCAST_ROWS", rows), ("POSTINGS", postings), ("CHUNK", 500)):
        monkeypatch.setattr(R, name, value)
    docs = [*corpus, *((200 + i, words(5 + i % 40)) for i in range(150)), *((400 + i, "hot copy of one text") for i in range(60))]
    items = [(i, words(3 + i)) for i in range(9)] + [(20, "hot ONE"), (21, None), (22, "  .,"), (23, "unheard-of"), (24, "É ß日本 a1"), (25, corpus[12][1]), (None, "hot a"), (None, "b"), (26, words(4)), (26, words(5))]
    out = R.search(make(docs), items_of(spark, items), top)
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, out.collect()), key=repr) == brute(docs, items, top)


def test_empty_tables(spark, make):
    assert R.search(make([]), items_of(spark, [(1, "a")])).count() == 0
    assert R.search(make([(1, "a")]), items_of(spark, [])).count() == 0
    assert R.search(make([(1, None), (2, "..")]), items_of(spark, [(1, "a")])).count() == 0


def test_a_very_long_text(spark, make, words):
    docs = [(1, "needle " + words(400_000) + " needle"), (2, "needle " + words(50)), (3, words(30))]
    item = [(1, "Needle haystack"), (2, words(3))]
    assert sorted(map(tuple, R.search(make(docs), items_of(spark, item)).collect()), key=repr) == brute(docs, item)


def test_query_equals_its_sql(spark):
    duckdb, folder = pytest.importorskip("duckdb"), Path("/root/testdata/sf0.01")
    if not folder.exists():
        pytest.skip("no tables here")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    assert sorted(map(tuple, R.query(spark, str(folder)).collect())) == sorted(con.sql(R.SQL).fetchall())
