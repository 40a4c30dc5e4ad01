"""Column expressions for words and shingles. Everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = r"[\x20\x09-\x0D]+"
#: All characters that no item word holds, after A-Z are lower-cased.
NOT_ITEM_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def split_words(text: Column, between: str) -> Column:
    """Maximal runs of characters outside ``between``; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def positions(count: Column) -> Column:
    """0, 1, ... count - 1; empty for a count below 1."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def shingles(words: Column, size: int) -> Column:
    """64-bit hash of each ``size`` consecutive elements, in order."""
    return F.transform(
        positions(F.size(words) - (size - 1)), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)])
    )
