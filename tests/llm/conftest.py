import random

import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, n long, hi long, part int, block long, sig string, "
        "node long, key string, selected boolean, lang_pred string, score double, range_no int")


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table with further columns whose names the operators use themselves."""
    def make(rows):
        extra = (1, 2, 3, 4, "x", 5, "y", True, "z", 0.5, 6)
        return spark.createDataFrame([(i, t, lang, "src", len(t or ""), *extra) for i, t, lang in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, one word, repeats, copies, a very long word, a very long text, odd white space."""
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "Eta", "theta", "iota", "kappa", "la", "mu"]
    prose = " ".join(rng.choice(words) for _ in range(300))
    near = prose.split()
    near[150] = "changed"
    rows = [
        (1, None, "en"), (2, "", "en"), (3, "  \t\n", None), (4, "word", "en"), (5, "word", "de"), (6, "WORD", None), (7, "two words", "en"),
        (8, prose, "en"), (9, prose, "en"), (10, " ".join(near), "en"), (11, prose.upper(), "de"), (12, "x" * 5000, "de"),
        (13, " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(6000)), "fr"), (14, "a\x1cb c\x85d\xa0e　f", None),
        (15, "ünï çödé 日本語 текст", "fr"), (16, "12 34 !?", "en"), (17, prose.replace(" ", "\n", 20), "en"), (18, "<|endoftext|> a", "en"),
        (19, "the the the the", "en"), (19, "the the the the", "en"), (None, "no id here", "en"), (None, None, None)]
    return rows + [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))), rng.choice(["en", "de", None])) for i in range(40)]
