import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def prose():
    """Deterministic running text of n words."""

    def make(seed, n):
        draw = random.Random(seed)
        return " ".join(draw.choice(WORDS) + draw.choice(["", "", "s", "n", "x"]) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def table(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those of helpers."""

    def make(rows):
        rows = [(i, t, "en", "kept", 1, 2, 3) for i, t in rows]
        schema = "doc_id long, text string, lang string, _words string, words int, _id int, score int"
        return spark.createDataFrame(rows, schema)

    return make
