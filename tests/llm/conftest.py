"""Documents with the cases that every operator has to bear."""

from __future__ import annotations

import random

import pytest

LONG = "a long text repeats itself " * 4000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, fp string, ids string, row string, t string"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows; extra columns of clashing names."""
    extra = ("s", "f", "i", "r", "t")
    return [
        (1, None, None, None, None, *extra),
        (2, "", "en", "a", 0, *extra),
        (3, " \n\t ", "en", "a", 4, *extra),
        (4, LONG, "en", "a", len(LONG), *extra),
        (5, "the same words here and there for all to see", "en", "a", 1, *extra),
        (5, "the same words here and there for all to see", "en", "a", 1, *extra),
        (6, "The SAME words here and there for all to see", "en", None, 1, *extra),
        (None, "a row that has no id but has a text", None, "b", 1, *extra),
        (7, "1234 5678 --- 90", None, "b", 1, *extra),
        (8, "éàü ñ 漢字 \U0001f600 token = 'abcdef123456'", "fr", "b", None, None, None, None, None, None),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
