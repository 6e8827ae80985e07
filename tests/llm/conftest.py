import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, digest string, kept string, row string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text), with columns whose names clash with those that operators use."""

    def docs(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", "z", "r") for i, t in rows], SCHEMA)

    return docs


@pytest.fixture(scope="session")
def words():
    """Texts of invented words, the same in each run."""
    import random

    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(300)] + ["É", "ß日本", "x y"]

    def text(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    return text


@pytest.fixture(scope="session")
def corpus(words):
    """Copies, near copies, shared passages, runs, odd white space, nulls, empty and long texts, repeated rows, no ids."""
    base, shared = words(120), words(60)
    cut = base.split()
    rows = [(i, words(n)) for i, n in enumerate([1, 2, 3, 4, 5, 19, 20, 21, 80, 200])]
    rows += [(20, base), (21, base.upper()), (22, base), (23, " ".join(cut[:60] + ["new"] + cut[61:])), (24, " ".join(cut[:-3])), (25, base + " " + words(80))]
    rows += [(30, words(30) + " " + shared + " " + words(30)), (31, shared + "\n" + words(40)), (32, words(50) + "\t\n " + shared), (33, shared + " " + shared)]
    rows += [(40, "a " * 100), (41, "a " * 90 + "b"), (42, "ab" * 900), (43, "b" + "ab" * 700), (44, "  \n\t "), (45, ""), (46, None), (47, words(4000)), (48, "line one two\nline one two\n\nother"), (49, "###*** %% && <x> $|")]
    rows += [(50, base), (50, base), (None, words(60)), (None, None), (None, base)]
    return rows
