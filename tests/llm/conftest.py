"""Fixtures of the operators' tests: a few hundred real documents, and a table of awkward rows."""

import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as further columns of the input.
CLASHES = (
    "row row_key fp component component_id fingerprint w h keys lines s llr kept copies copy size bucket share target keep word n "
    "id key line first digest marks rare text_ held_out score"
).split()


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


@pytest.fixture(scope="session")
def awkward_rows():
    """NULLs in every column, empty, blank and very long texts, ties, repeated rows, one id with two texts."""
    a, b = prose(1, 60), prose(2, 60)
    return [
        (1, a, "en", "a", len(a)),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, " \t\n\x0b \r\n", "en", "b", 7),
        (5, "\n".join(prose(k, 50) for k in range(100, 700)), "en", "b", None),
        (6, b, "en", "a", 1),
        (6, b, "en", "a", 1),
        (7, prose(3, 40), "de", None, 2),
        (7, prose(4, 40), "de", None, 2),
        (None, prose(5, 40), None, "ü", 3),
        (None, a, None, "ü", 3),
        (8, "Ünïcode WÖRTER ünd 漢字 \U0001f600 " + prose(6, 30), "xx", "𐀀", 4),
        (9, "one", "en", "a", 3),
    ]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    """The awkward rows with clashing further columns, NULL in half of the rows."""
    rows = [r + tuple(None if i % 2 else f"c{i}" for _ in CLASHES) for i, r in enumerate(awkward_rows)]
    return spark.createDataFrame(rows, SCHEMA + "".join(f", {c} string" for c in CLASHES))
