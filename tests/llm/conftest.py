import random

import pytest
from llm_helpers import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, shard string, sha string, id string"


def extend(rows):
    """Rows of (doc_id, text, lang, source) with columns whose names the operators use themselves."""
    return [(*r, None if r[1] is None else len(r[1]), "x", "x", "x", "x", "x") for r in rows]


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: spark.createDataFrame(extend(rows), SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    rng = random.Random(3)
    long = prose(rng, 30_000)
    base = prose(rng, 60)
    near = base.replace(base.split()[30], "other", 1)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, None, "b"), (4, None, None, None), (5, "", "fr", ""), (6, "one two", "en", "é"),
        (7, "one two", "en", "é"), (8, long, "en", "b"), (9, " \n ", "de", "c"), (None, "no id here", "en", None), (10, "é" * 40 + " ü 漢字 " + "x" * 70, "fr", "a"),
        (11, "a\n\n  b\tc " * 20, "de", "a"), (12, prose(rng, 500), "en", "z"), (12, prose(rng, 500), "en", "z"), (13, "x" * 300, "en", "a"),
    ]
    return rows + [rows[0], rows[0]]


@pytest.fixture(scope="session")
def odd(make, odd_rows):
    return make(odd_rows)


@pytest.fixture(scope="session")
def empty(make):
    return make([])
