import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, chunk string, key string, fp double"


def sentence(rng, n):
    syl = ["an", "er", "ti", "on", "the", "re", "ou", "st", "ing", "ha", "ble", "wh", "or", "né", "zü"]
    return " ".join("".join(rng.choice(syl) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, licence lines, junk, nulls and a long text."""
    rng = random.Random(5)
    docs = [sentence(rng, rng.randint(5, 160)) for _ in range(60)]
    passage = sentence(rng, 70)
    docs += [docs[3], docs[3], docs[7] + " tail", f"{sentence(rng, 30)} {passage} {sentence(rng, 20)}", f"{passage}. {sentence(rng, 40)}",
             docs[9].replace(" ", "  ", 1), "Released under the MIT License.\n" + docs[11], "GNU General Public License gnu GENERAL public license CC BY-NC 4.0",
             "", None, "   ", "12 34 !!", "a", "É È", sentence(rng, 6000), "x" * 5000, "z " * 3000, "ab" * 30 + "ab" * 30, None]
    return [(i, t) for i, t in enumerate(docs)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """With extra columns whose names the operators use inside."""
    langs = ["en", "fr", None]
    rows = [(i, t, langs[i % 3], "s", len(t or ""), "c", "k", 0.5) for i, t in corpus]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
