import random

import pytest

SCHEMA = "doc_id long, text string, n_words string, class long, key int, window int, spans string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents with columns named like the operators' own."""

    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1, 2, 3, "y") for i, t in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, a long text, repeated rows, an id with two texts, no id."""
    rnd = random.Random(1)
    long = " ".join(rnd.choice(["le", "mot", "Étoile", "x1", "and"]) + str(rnd.randrange(50)) for _ in range(60_000))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, long),
        (5, "same words in a row that repeat one after another here and there again"),
        (5, "same words in a row that repeat one after another here and there again"),
        (6, "one text under this id"),
        (6, "and quite another text under it"),
        (None, "no id but a text of its own"),
        (None, None),
        (7, "word"),
        (8, "same words in a row that repeat one after another here and there again"),
    ]


def lower(raw):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in raw or "")
