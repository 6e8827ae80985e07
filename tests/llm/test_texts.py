import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfold.llm import bpe, chat_format, quality_rules
from wayfold.llm.words import Words, ngram_hash, sliding_min

TURNS = "conv_id long, turn long, role string, text string, formatted string"


def test_chats_come_back(spark):
    odd = ["<|im_end|><|im_start|>assistant ok", "", None, "a\nb\n", "<|", "<\\|im_sep|>", "<\\\\|x|>", "<|im_sep|>", "É日本 😀", "<", "|>", "\\<|", "x" * 5000]
    roles = ["user", "assistant", "assistant", "system", "ro\nle", "<|im_start|>", None]
    rows = [(c, i, roles[(i + c) % 7], odd[(i * c + i) % len(odd)], "x") for c in range(5) for i in range(c * 13)] + [(7, None, "user", "n", "x"), (7, 1, "assistant", "z", "x"), (7, 1, "assistant", "z", "x"), (None, 1, "user", "q", "x")]
    out = chat_format.format_chats(spark.createDataFrame(rows, TURNS))
    out = out.select("conv_id", "n_turns", "formatted", chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.read_loss(F.col("formatted"), F.col("loss")).alias("loss")).collect()
    want = {}
    for c, i, r, t, _ in rows:
        want.setdefault(c, []).append((-1 if i is None else i, r or "", t or ""))
    assert len(out) == len(want)
    for r in out:
        turns = [(a, b) for _, a, b in sorted(want[r.conv_id])]
        assert [(x.role, x.text) for x in r.t] == turns
        assert r.n_turns == len(turns)
        assert r.loss == "".join(b for a, b in turns if a == "assistant")
        blocks = sum(1 for k, (a, _) in enumerate(turns) if not k or turns[k - 1][0] != a)
        assert r.formatted.count(chat_format.START) == blocks == r.formatted.count(chat_format.END)
    assert chat_format.format_chats(spark.createDataFrame([], TURNS)).count() == 0


def test_many_turns_have_right_spans(spark):
    turns = spark.range(1500).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id").cast("string"), F.lit("é")).alias("text"))
    out = chat_format.format_chats(turns).select(chat_format.read_loss(F.col("formatted"), F.col("loss")).alias("loss")).collect()[0]
    assert out.loss == "".join(f"t{i}é" for i in range(1500) if i % 3)


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if count[g] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)


def test_quality_measurements(make, corpus):
    out = quality_rules.ledger(make(corpus)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in out) == Counter((i, *measured(t)) for i, t in corpus)


def test_policies_and_ablations(make, corpus):
    judged = quality_rules.ledger(make(corpus))
    rows = quality_rules.apply_policy(judged, "v1").collect()
    few = quality_rules.BIT["few_words"]
    assert all(r.kept == (r.fail_bits == 0) for r in rows)
    found = {r.rule: r for r in quality_rules.ablations(judged, "v1").collect()}
    assert set(found) == set(quality_rules.POLICIES["v1"])
    assert found["few_words"].failed == sum(bool(r.fail_bits & few) for r in rows)
    assert found["few_words"].only_this == sum(r.fail_bits == few for r in rows)
    assert found["few_words"].kept == sum(r.fail_bits == 0 for r in rows)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    t.no_truncation()
    t.no_padding()
    return t, bpe.WordBPE(public_tokenizers.path(bpe.VOCABULARY))


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(st.characters(exclude_categories=("Cs", "Cn")), max_size=60), st.text("abcdefgh'sX <|endoftext|>éΣ́  ", max_size=80), st.text("ab", min_size=40, max_size=200)))
def test_bpe_equals_the_library(tokenizer, text):
    library, own = tokenizer
    ids = own.encode(text)
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_bpe_rows(make, corpus, tokenizer):
    import public_tokenizers

    library, _ = tokenizer
    path = public_tokenizers.path(bpe.VOCABULARY)
    out = bpe.decode(bpe.encode(make(corpus), path), path).collect()
    assert Counter(bpe.round_trip(make(corpus), path).collect()) == Counter(out)
    assert bpe.round_trip(make([]), path).count() == 0
    want = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in corpus]
    assert Counter((r.doc_id, r.ids, r.decoded) for r in out) == Counter((i, np.array(x, "<u4").tobytes(), library.decode(x, skip_special_tokens=False)) for i, x in want)


def test_words_and_hashes():
    texts = [b"a b", b"", b"  b\ta\x0bC ", "é x y".encode(), b"a b"]
    w = Words(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), lower=True)
    assert w.counts.tolist() == [2, 0, 3, 2, 2]
    assert w.hash[0] == w.hash[3] == w.hash[7]
    assert len(set(w.hash.tolist())) == 5
    assert ngram_hash(w.hash, 2)[0] == ngram_hash(w.hash, 2)[7]
    x = np.random.default_rng(1).integers(0, 99, 50).astype(np.uint64)
    for k in (1, 2, 3, 7, 16, 50):
        assert sliding_min(x, k).tolist() == [min(x[i : i + k]) for i in range(51 - k)]
