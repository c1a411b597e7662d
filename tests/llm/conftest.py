"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns, no rows."""

import tempfile

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = "the old mill stands at the edge of the quiet village where the river bends twice before the sea"


def words(seed: int, count: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(count))


def document_rows() -> list[tuple]:
    base = words(1, 120)
    near = base.replace(base.split()[60], "changed")
    rows = [
        (1, base, "en", "a", len(base)),
        (2, near, "en", "a", len(near)),
        (3, base, None, "b", len(base)),
        (4, words(4, 50) + " " + PASSAGE + " " + words(5, 30), "en", "b", 1),
        (5, words(6, 40) + "\n" + PASSAGE + ". " + words(7, 60), "de", None, 1),
        (6, None, "en", "a", None),
        (7, "", "en", "a", 0),
        (8, "one two", "fr", "c", 7),
        (9, "ONE two", "fr", "c", 7),
        (10, words(8, 9000), "en", "c", 1),
        (11, "dé" * 200 + " ñandú " + PASSAGE[:60], "es", "\U0001f600", 1),
        (12, " \t\n ", "en", "b", 4),
        (12, " \t\n ", "en", "b", 4),
        (13, words(9, 30), "en", "b", 1),
        (13, words(9, 30), "en", "b", 1),
        (None, base, "en", "a", 1),
        (14, words(1, 119), "en", "a", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def shared(spark):
    """Every session of the tests shares a folder."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-tests-"))
    return spark


@pytest.fixture
def documents(shared):
    return shared.createDataFrame(document_rows(), DOCUMENTS)


@pytest.fixture
def no_documents(shared):
    return shared.createDataFrame([], DOCUMENTS)
