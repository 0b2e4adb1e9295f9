import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FOLDER = "/root/testdata/sf0.001"


def prose(rng, n, words=400, tag=""):
    return " ".join(f"{tag}w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns with clashing names."""
    rng = random.Random(3)
    passage = prose(rng, 70, tag="p")
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, prose(rng, 120), "en", "a"), (4, None, "de", "b"),
        (5, prose(rng, 80) + " " + passage, "en", "b"), (6, passage + " " + prose(rng, 90), None, "a"), (7, prose(rng, 30_000), "en", None),
        (None, "some text without an id", "en", "a"), (None, None, None, None), (8, "one", "de", "b"), (9, "one", "de", "b"),
        (10, "x" * 5000, "de", "b"), (11, "ÄÖ ü\U0001f600 日本語 é", "fr", "a"), (12, "idiot " * 60, "en", "a"), (12, "idiot " * 60, "en", "a"),
    ]
    full = [(i, t, la, s, None, "s", 1.0, 7, "k", 5) for i, t, la, s in rows]
    return spark.createDataFrame(full, DOCS + ", size string, score double, label int, start string, n bigint")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(1, 13)] + [(None, 1, 1), (4, None, None), (99, 1, 0)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
