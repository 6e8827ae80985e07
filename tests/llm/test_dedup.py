import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wayfold.llm import exact_dedup, ngram_jaccard, substring_dedup, suffix_dedup
from wayfold.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
sha = lambda x: hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()
split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")


def with_ids(corpus):
    return [(i, t) for i, t in corpus if i is not None]


def once(corpus):
    """Rows in the order of ids, repeated ones once."""
    return sorted(set(with_ids(corpus)), key=lambda r: r[0])


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("parts", [1, 5, 40])
def test_exact_dedup(make, corpus, keep, parts):
    out = exact_dedup.exact_dedup(make(corpus).repartition(parts), keep=keep, fan_in=3).collect()
    groups = defaultdict(list)
    for i, t in corpus:
        groups[sha((t or "").translate(LOWER))].append(i)
    pick = max if keep == "max" else min
    want = {k: (pick((i for i in v if i is not None), default=None), len(v)) for k, v in groups.items()}
    assert len(out) == len(corpus)
    assert {r.digest.hex(): (r.keep_id, r.group_size) for r in out} == want
    assert Counter(r.digest.hex() for r in out if r.kept) == dict.fromkeys(groups, 1)
    assert all(r.doc_id == r.keep_id for r in out if r.kept)


def test_exact_dedup_keeps_all_columns(make, corpus):
    docs = make(corpus)
    kept = exact_dedup.keep_rows(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({(t or "").translate(LOWER) for _, t in corpus})
    assert exact_dedup.keep_rows(docs.where("false")).count() == 0


def brute_windows(texts, n):
    """Starts of windows of n items that start earlier, and of those that start elsewhere."""
    first, count = {}, Counter()
    for i, t in texts.items():
        for p in range(len(t) - n + 1):
            w = t[p : p + n] if isinstance(t, bytes) else tuple(t[p : p + n])
            first.setdefault(w, (i, p))
            count[w] += 1
    return first, count


def brute_cut(t, i, n, gone_at):
    gone = [False] * len(t)
    for p in range(len(t) - n + 1):
        if gone_at(t[p : p + n] if isinstance(t, bytes) else tuple(t[p : p + n]), (i, p)):
            gone[p : p + n] = [True] * n
    return gone


@pytest.mark.parametrize(("window", "anchor"), [(20, 6), (8, 3)])
def test_substring_dedup(make, corpus, window, anchor):
    texts = {i: split(t) for i, t in once(corpus)}
    first, _ = brute_windows(texts, window)
    out = substring_dedup.substring_dedup(make(with_ids(corpus)).repartition(6), window=window, anchor=anchor).collect()
    assert len(out) == len(with_ids(corpus))
    for r in out:
        gone = brute_cut(texts[r.doc_id], r.doc_id, window, lambda w, at: first[w] != at)
        assert (r.n_words, r.n_removed) == (len(gone), sum(gone)), r.doc_id
        assert r.kept_text == " ".join(w for w, g in zip(texts[r.doc_id], gone, strict=True) if not g)


def test_substring_rows_keep_layout_and_columns(make, corpus):
    docs = make(corpus)
    out = substring_dedup.cut_rows(docs, window=20)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert rows[48].text == "line one two\nline one two\n\nother"
    assert rows[46].text is None
    assert 22 not in rows  # nothing is left of it
    assert all(r.n_chars == len(r.text) for r in rows.values() if r.text is not None)
    assert substring_dedup.cut_rows(docs.where("false")).count() == 0


@pytest.mark.parametrize("stays", [True, False])
@pytest.mark.parametrize("length", [400, 100])
def test_suffix_dedup(make, corpus, stays, length):
    texts = {i: (t or "").encode() for i, t in once(corpus)}
    first, count = brute_windows(texts, length)
    out = suffix_dedup.suffix_dedup(make(with_ids(corpus)).repartition(6), length=length, first_stays=stays).collect()
    assert len(out) == len(with_ids(corpus))
    for r in out:
        t = texts[r.doc_id]
        # rows that repeat an id and its text are one document
        gone = brute_cut(t, r.doc_id, length, (lambda w, at: first[w] != at) if stays else (lambda w, at: count[w] > 1 or r.doc_id == 50 and count[w] > 1))
        if r.doc_id == 50 and not stays:
            continue
        assert (r.n_bytes, r.n_removed) == (len(t), sum(gone)), r.doc_id
        assert r.kept == bytes(b for b, g in zip(t, gone, strict=True) if not g)
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


@pytest.mark.parametrize("stays", [True, False])
@pytest.mark.parametrize("parts", [1, 3, 8])
def test_suffix_dedup_of_copies_and_their_trimmed_forms(spark, make, words, stays, parts):
    # documents are dealt to tasks by id; without merged partitions, copies meet in one task and the third is in another
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    rows = []
    for k in range(12):
        x = words(60)
        other = (x[5:], x[:-5], "#####" + x[5:], x[:-5] + "#####")[k % 4]
        rows += [(10 * k, x), (10 * k + 1, x), (10 * k + 2 + k % 3, other)]
    texts = {i: t.encode() for i, t in rows}
    first, count = brute_windows(texts, 100)
    try:
        out = suffix_dedup.suffix_dedup(make(rows), length=100, first_stays=stays).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(out) == len(rows)
    for r in out:
        gone = brute_cut(texts[r.doc_id], r.doc_id, 100, (lambda w, at: first[w] != at) if stays else (lambda w, at: count[w] > 1))
        assert r.n_removed == sum(gone), r.doc_id
        assert r.kept == bytes(b for b, g in zip(texts[r.doc_id], gone, strict=True) if not g)


def brute_links(corpus, n, num, den):
    sets = {}
    for i, t in once(corpus):
        w = split((t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    ids = list(sets)
    reach = {i: i for i in ids}
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    for _ in ids:
        for a, b in links:
            reach[a] = reach[b] = min(reach[a], reach[b])
    return sets, reach


@pytest.mark.parametrize(("n", "num"), [(4, 85), (5, 80), (2, 60)])
def test_near_duplicates(make, corpus, n, num):
    sets, reach = brute_links(corpus, n, num, 100)
    out = ngram_jaccard.near_duplicates(make(with_ids(corpus)), shingle=n, num=num).collect()
    assert len(out) == len(with_ids(corpus))
    assert {r.doc_id: (r.n_shingles, r.component) for r in out} == {i: (len(sets[i]), reach[i]) for i in sets}


def test_near_duplicates_of_a_large_group(spark, make, words):
    import random

    r = random.Random(3)
    base = words(150).split()
    rows = []
    for i in range(250):
        copy = list(base)
        for _ in range(r.randint(0, 6)):
            copy[r.randrange(len(copy))] = f"w{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(base[:60]) + " " + words(100)) for i in range(60)]
    sets, reach = brute_links(rows, 4, 85, 100)
    out = ngram_jaccard.near_duplicates(make(rows)).collect()
    assert {x.doc_id: x.component for x in out} == reach
    assert len({*reach.values()}) < 300


def test_near_duplicate_rows(make, corpus):
    docs = make(corpus)
    out = ngram_jaccard.keep_rows(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert 20 not in ids or ids.count(20) == 1
    assert {22, 23, 50}.isdisjoint(ids)
    assert ngram_jaccard.keep_rows(docs.where("false")).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 70), (80, 80)], "a long, b long")
    out = {r.node: r.component for r in components(links).collect()}
    assert out == {**dict.fromkeys(range(1, 41), 1), 50: 50, 60: 50, 70: 50, 80: 80}
    assert components(links.where("false")).count() == 0


def test_results_do_not_depend_on_partitions(make, corpus):
    docs = make(corpus)
    a, b = (sorted(substring_dedup.substring_dedup(d).select("doc_id", "kept_text").collect(), key=repr) for d in (docs.coalesce(1), docs.orderBy(F.rand(1)).repartition(9)))
    assert a == b


@pytest.fixture(scope="module")
def odd(words):
    """Ids that several rows have, with the same text or others; rows without an id; copies across all of them."""
    base, other, third = words(150), words(90), words(120)
    rows = [(1, "short text of its own"), (1, base), (1, other), (2, base + " tail"), (3, base), (3, base), (4, third), (4, third + " end")]
    return rows + [(None, other), (None, other), (None, base + " x"), (None, None), (5, None), (5, ""), (6, other.upper())]


def order_of(spark, make, rows):
    """The documents of rows (once each) in the operators' order, and which of them each row is."""
    from wayfold.llm.common import keyed, tagged

    keys = [(r._key, r._tag, r.text) for r in tagged(keyed(make(rows))).collect()]
    return sorted(set(keys)), Counter(keys)


def test_repeated_and_missing_ids(spark, make, odd):
    docs, count = order_of(spark, make, odd)
    assert sum(count.values()) == len(odd)
    assert len(docs) == len({(i, t or "") for i, t in odd})
    # windows of words, the first copy stays
    texts = {k[:2]: split(k[2]) for k in docs}
    first, _ = brute_windows(texts, 20)
    want = Counter()
    for k in docs:
        gone = brute_cut(texts[k[:2]], k[:2], 20, lambda w, at: first[w] != at)
        want[k[0], sum(gone), " ".join(w for w, g in zip(texts[k[:2]], gone, strict=True) if not g)] += count[k]
    out = substring_dedup.substring_dedup(make(odd).repartition(5)).collect()
    assert Counter((r._key, r.n_removed, r.kept_text) for r in out) == want
    # strings of bytes, either way
    data = {k[:2]: k[2].encode() for k in docs}
    first, times = brute_windows(data, 100)
    for stays in (True, False):
        want = Counter()
        for k in docs:
            gone = brute_cut(data[k[:2]], k[:2], 100, (lambda w, at: first[w] != at) if stays else (lambda w, at: times[w] > 1))
            want[k[0], sum(gone), bytes(b for b, g in zip(data[k[:2]], gone, strict=True) if not g)] += count[k]
        out = suffix_dedup.suffix_dedup(make(odd).repartition(5), length=100, first_stays=stays).collect()
        assert Counter((r._key, r.n_removed, bytes(r.kept)) for r in out) == want
    # near copies: every text is a node
    _, reach = brute_links([(n, k[2]) for n, k in enumerate(docs)], 4, 85, 100)
    label = {n: min(docs[m][0] for m in reach if reach[m] == reach[n]) for n in reach}
    out = ngram_jaccard.near_duplicates(make(odd).repartition(5)).collect()
    assert Counter((r._key, r.component) for r in out) == Counter({(docs[n][0], label[n]): 0 for n in reach}) + sum((Counter({(docs[n][0], label[n]): count[docs[n]]}) for n in reach), Counter())
    assert ngram_jaccard.keep_rows(make(odd)).count() == len({reach[n] for n in reach})


def test_empty_tables(make, corpus):
    none = make(corpus).where("false")
    for f in (substring_dedup.substring_dedup, suffix_dedup.suffix_dedup, ngram_jaccard.near_duplicates, exact_dedup.exact_dedup):
        assert f(none).count() == 0
    blank = make([(1, None), (2, ""), (2, " \n")])
    assert substring_dedup.substring_dedup(blank).agg(F.sum("n_words")).first()[0] == 0
    assert suffix_dedup.suffix_dedup(blank).agg(F.sum("n_bytes")).first()[0] == 2
    assert [r.component == r._key for r in ngram_jaccard.near_duplicates(blank).collect()] == [True] * 3


def test_very_long_texts_are_read_in_pieces(make):
    import random

    r = random.Random(2)
    long = " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(3, 12))) for _ in range(650_000))
    assert len(long) > 5 << 20
    step = 1 << 18
    spots = [step - 700, step - 10, 2 * step - 399, 4 * step - 200, 8 * step + 5, len(long) - 900]
    rows = [(0, long)] + [(n + 1, "#" * 7 + long[p : p + 900] + "!" * 7) for n, p in enumerate(spots)] + [(90, long[3:])]
    gone = [True] * 900
    out = {x.doc_id: x for x in suffix_dedup.suffix_dedup(make(rows)).select("doc_id", "n_removed", "kept").collect()}
    assert (out[0].n_removed, out[90].n_removed) == (0, len(long) - 3)
    assert all(bytes(out[n + 1].kept) == b"#" * 7 + b"!" * 7 for n in range(len(spots)))
    both = {x.doc_id: x.n_removed for x in suffix_dedup.suffix_dedup(make(rows), first_stays=False).select("doc_id", "n_removed").collect()}
    assert both == {0: len(long) - 3, 90: len(long) - 3, **{n + 1: len(gone) for n in range(len(spots))}}
    texts = {i: split(t) for i, t in rows}
    first, _ = brute_windows(texts, 20)
    found = {x.doc_id: x.n_removed for x in substring_dedup.substring_dedup(make(rows)).select("doc_id", "n_removed").collect()}
    assert found == {i: sum(brute_cut(t, i, 20, lambda w, at: first[w] != at)) for i, t in texts.items()}
    near = {x.doc_id: x.component for x in ngram_jaccard.near_duplicates(make([(0, long), (90, long[3:] + " more"), (91, "other words that are here")])).collect()}
    assert near == {0: 0, 90: 0, 91: 91}


def test_near_copies_and_a_passage_common_to_many(make, words):
    import random

    r = random.Random(9)
    base, passage = words(120).split(), words(80)
    rows = []
    for i in range(160):
        copy = list(base)
        for _ in range(r.randint(0, 9)):
            copy[r.randrange(len(copy))] = f"w{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(500 + i, passage + " " + words(r.choice([0, 3, 8, 60]))) for i in range(160)]
    sets, reach = brute_links(rows, 4, 85, 100)
    out = ngram_jaccard.near_duplicates(make(rows)).collect()
    assert {x.doc_id: (x.n_shingles, x.component) for x in out} == {i: (len(sets[i]), reach[i]) for i in sets}


def test_suffixes_and_factors_equal_brute_force():
    import random

    import numpy as np

    r = random.Random(4)
    for length in (3, 8, 13, 20):
        for _ in range(30):
            text = bytes(r.choice(b"ab") for _ in range(r.randint(length, 60)))
            starts = np.array(sorted(r.sample(range(len(text) - length + 1), r.randint(1, len(text) - length + 1))))
            s = suffix_dedup.Suffixes(np.frombuffer(text, np.uint8), starts, length)
            cut = [text[a : a + length] for a in starts]
            assert s.rank.tolist() == [sum(x < y for x in cut) for y in cut]
            common = lambda x, y: next((k for k in range(length) if x[k] != y[k]), length)
            assert s.factors(np.arange(len(starts))).tolist() == [max((common(cut[j], cut[k]) for j in range(k)), default=0) for k in range(len(cut))]
    x = np.array(r.sample(range(50), 50))
    assert suffix_dedup.previous_smaller(x).tolist() == [max((j for j in range(k) if x[j] < x[k]), default=-1) for k in range(50)]
    assert suffix_dedup.previous_smaller(x, back=True).tolist() == [min((j for j in range(k + 1, 50) if x[j] < x[k]), default=-1) for k in range(50)]


def test_a_passage_in_parts_of_several_large_groups(spark, make, words, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "GRID", 8)
    shared, rows = words(45), []
    for g in range(5):
        own = words(18).split()
        for m in range(14):
            body = [*own[:m], "new", *own[m + 1 :]] if m < len(own) else own
            rows.append((g * 100 + m, " ".join(body) + " " + (shared if m % 3 else words(45))))
    sets, reach = brute_links(rows, 4, 60, 100)
    out = ngram_jaccard.near_duplicates(make(rows), num=60).collect()
    assert {x.doc_id: x.component for x in out} == reach
    assert len(set(reach.values())) < len(rows) / 2


def test_rows_without_an_id_name_no_component(make, words):
    text = words(80)
    near = text + " end"
    rows = [(7, text), (5, near), (None, text + " more"), (None, words(50)), (None, None), (9, None), (11, "x y")]
    out = ngram_jaccard.near_duplicates(make(rows)).collect()
    assert sorted(((x.doc_id, x.component_id) for x in out), key=repr) == sorted([(7, 5), (5, 5), (None, 5), (None, None), (None, None), (9, 9), (11, 11)], key=repr)


def test_suffix_dedup_query_removes_strings_of_400_bytes_and_no_shorter_passages(make, corpus, words, spark, tmp_path):
    passages = {n: words(150).encode("ascii", "ignore").decode()[:n] for n in (399, 400, 410)}
    rows = once(corpus)
    for n, p in passages.items():
        assert len(p) == n and len(split(p)) > 50
        other = p.replace(" ", "\n") if n == 410 else p  # the same words, other bytes
        rows += [(n, f"{n}#{p}#{words(9)}"), (n + 1000, f"{n + 1000}!{other}!{words(9)}")]
    make(rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    texts = {i: (t or "").encode() for i, t in rows}
    _, count = brute_windows(texts, 400)
    out = {r.doc_id: r for r in suffix_dedup.query(spark, str(tmp_path)).collect()}
    assert out.keys() == texts.keys()
    for i, t in texts.items():
        gone = brute_cut(t, i, 400, lambda w, at: count[w] > 1)
        spans = sum(g and not before for g, before in zip(gone, [False, *gone], strict=False))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        assert (out[i].n_bytes, out[i].n_removed, out[i].n_spans, out[i].kept_sha256) == (len(t), sum(gone), spans, sha(kept)), i
    assert [out[n].n_removed for n in passages] == [out[n + 1000].n_removed for n in passages] == [0, 400, 0]
