import random

import pytest

WORDS = "the of and to in that river stone light under garden winter slowly carried morning letter always between almost silver".split()


@pytest.fixture(scope="session")
def prose():
    """A maker of sentences of so many words, from a seed."""

    def make(words: int, seed: int) -> str:
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "er", "ing", "ly"]) for _ in range(words))

    return make


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, numbered from 0; extra columns by name with values."""

    def make(texts, **extra):
        rows = [(i, t, "en", "s", len(t or ""), *(v for v in extra.values())) for i, t in enumerate(texts)]
        schema = DOCS + "".join(f", `{c}` string" for c in extra)
        return spark.createDataFrame(rows, schema)

    return make


ODD = [None, "", " ", "\n\n\t", "a", "word", "Ünï cödé \U0001f642 \u4e2d\u6587", "tie tie tie", "tie tie tie", "x" * 5000]
