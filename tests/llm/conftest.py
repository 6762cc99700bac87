import pytest

WORDS = "alpha bravo carol delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango".split()


@pytest.fixture(scope="session")
def prose():
    """Deterministic text: words drawn by a small generator."""
    import random

    def make(seed: int, n: int, vocabulary: int = 400) -> str:
        r = random.Random(seed)
        return " ".join(f"{r.choice(WORDS)}{r.randrange(vocabulary)}" for _ in range(n))

    return make


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) rows, with columns whose names clash with results."""
    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), 7, "x", 0.5) for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string, score double")

    return make
