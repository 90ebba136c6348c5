"""Words of a text with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What separates words: ASCII characters that are neither digits nor letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-case words of a text; none for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def starts(n: Column, span: int) -> Column:
    """The places 0 .. n - span at which `span` consecutive words stand."""
    return F.when(n >= span, F.sequence(F.lit(0), n - span)).otherwise(F.array().cast("array<int>"))
