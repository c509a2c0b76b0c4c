"""Row tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyloom import lexicons
from surveyloom.functions.text import contains_any


def is_on_topic(
    text: Column,
    markers: list[str] | None = None,
    keywords: list[str] | None = None,
    min_chars: int = 8,
    max_chars: int = 500,
) -> Column:
    """A question about the topic: right length, a question marker and a topic keyword."""
    lower = F.lower(text)
    return (
        F.coalesce(F.length(text).between(min_chars, max_chars), F.lit(False))
        & contains_any(lower, lexicons.QUESTION_MARKERS if markers is None else markers)
        & contains_any(lower, lexicons.TRAVEL_KEYWORDS if keywords is None else keywords)
    )


def longer_than(text: Column, chars: int = 2) -> Column:
    return F.length(text) > chars


def not_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def ends_with_question_mark(text: Column) -> Column:
    return text.rlike(r"(?U)[?？]\s*$")


def is_effective(effective: Column) -> Column:
    """A response counts as effective unless it says otherwise."""
    return F.coalesce(effective, F.lit(True))


def is_answered(answer: Column) -> Column:
    """Anything but the not-answered mark is an answer, NULL and empty text included."""
    return ~answer.eqNullSafe(lexicons.NOT_ANSWERED)


def is_category(category: Column, value: str) -> Column:
    return category == value


def not_default_category(category: Column) -> Column:
    return F.lower(category) != lexicons.DEFAULT_CATEGORY
