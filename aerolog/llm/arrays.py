"""Array expressions for operators that stay in built-in functions.

Each step is a column of its own, and every column that a lambda reads is also read outside of it: the
optimizer then keeps the step as a projection instead of putting its expression into the lambda, where
it would run once for each element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def indices(n: Column, least: int = 1) -> Column:
    """0 to n - 1; empty if n is below ``least``."""
    return F.when(n >= least, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def split_words(text: Column, breaks: str) -> Column:
    """The non-empty parts of a text between runs of ``breaks``; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), breaks)
    return F.filter(parts, lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
