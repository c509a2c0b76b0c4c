"""Column expressions shared by the operators that use no Python in tasks."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z. On a value of ASCII alone ``lower`` does the same, and does it on bytes."""
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(mapped)


def words(text: Column, separators: str) -> Column:
    """Words between runs of separators; none of a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that ``df`` has no column of, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
