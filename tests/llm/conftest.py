import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASHING = ["score", "code", "root", "key", "text_hash", "part", "nth", "rank", "node", "at", "size", "marks", "edited",
            "kept_id", "kept_hash", "word", "n", "spans", "quality", "shard", "html", "ids", "start", "length"]


def prose(seed, n, words=400):
    rng = random.Random(seed)
    known = ["".join(rng.choices("abcdeéß", k=rng.randint(2, 8))) for _ in range(words)]
    return " ".join(rng.choice(known) + rng.choice(["", "", "", ",", ".", ".\n"]).rstrip() for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table with columns of every clashing name from (doc_id, text) pairs."""

    def make(pairs, clashing=True):
        rows = [(i, t, None if n % 5 == 0 else "en", None if n % 7 == 0 else f"s{n % 3}", None if t is None else len(t))
                for n, (i, t) in enumerate(pairs)]
        frame = spark.createDataFrame(rows, COLUMNS)
        if clashing:
            for name in CLASHING:
                frame = frame.selectExpr("*", f"'own' AS {name}")
        return frame

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and blank texts, repeats, ties in the id, short, and one very long text."""
    return [(5, prose(1, 300)), (1, None), (2, ""), (2, ""), (None, prose(2, 40)), (None, None), (7, "  \n\t "),
            (8, "one"), (9, "One two"), (10, prose(1, 300)), (10, prose(3, 120)), (11, prose(4, 60_000)), (12, "İß 日本語 á"),
            (13, prose(5, 16)), (14, "x " * 200)]
