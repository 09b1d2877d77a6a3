"""Runs of characters as keys: what holds a text holds all of its runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAM = 3


def grams(text: Column, q: int = GRAM) -> Column:
    """The distinct runs of ``q`` code points of a text, in linear time; none of null or a shorter text."""

    # Each code point with those behind it, looked at and not taken.
    runs = F.regexp_extract_all(text, F.lit(f"(?s)(?=({'.' * q}))."), F.lit(1))
    return F.coalesce(F.array_distinct(runs), F.array().cast("array<string>"))


def grams_or_whole(text: Column, q: int = GRAM) -> Column:
    """``grams``, or the text itself if it is shorter and not null."""
    return F.when(F.length(text) < q, F.array(text)).otherwise(grams(text, q))
