from __future__ import annotations

import random

import pytest

WORDS = "the of and to in a is that for it with as on be this by from at or an".split()


def sentence(rng, n, extra=()):
    """Words of a small invented language with function words, as a text."""
    parts = ["ba", "ko", "mi", "tu", "re", "sal", "ven", "dor", "lim", "pra"]
    made = ["".join(rng.choices(parts, k=rng.randint(2, 4))) for _ in range(n)]
    words = [rng.choice(WORDS) if rng.random() < 0.4 else w for w in made]
    for word in extra:
        words[rng.randrange(len(words))] = word
    return " ".join(words)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns whose names the operators use themselves."""
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, score double, "
        "words string, sig string, rep long, label string, found string"
    )

    def make(rows):
        full = [(i, t, lang, "s", len(t or ""), 0.5, "w", "s", 1, "l", "f") for i, t, lang in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def rng():
    return random.Random(5)
