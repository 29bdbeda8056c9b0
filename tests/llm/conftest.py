import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text[, source]) rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def prose():
    """Deterministic words: ``prose(n, seed)`` is a text of n words."""
    import random

    def make(n, seed, sep=" "):
        rng = random.Random(seed)
        return sep.join("".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))

    return make
