"""Question type, category, layout and id rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyloom import lexicons
from surveyloom.functions.text import any_of_pattern, contains_any


def type_from_option_text(options_text: Column, question_text: Column) -> Column:
    """Question type of a crawled question, from its joined options and its wording."""
    options = F.lower(F.coalesce(options_text, F.lit("")))
    yes_no = rf"(?U)\b({any_of_pattern(lexicons.YES_NO_WORDS)})\b"
    return (
        F.when(options == "", "open_ended")
        .when(contains_any(options, lexicons.RATING_MARKS), "rating")
        .when(options.rlike(yes_no), "yes_no")
        .when(contains_any(F.lower(question_text), lexicons.MULTIPLE_MARKS), "multiple_choice")
        .otherwise("single_choice")
    )


def type_from_option_count(options: Column, yes_no_words: list[str] | None = None) -> Column:
    """Question type of a cleaned question, from the number of its options."""
    words = lexicons.YES_NO_OPTIONS["en"] if yes_no_words is None else yes_no_words
    count = F.coalesce(F.size(options), F.lit(0))
    return (
        F.when(count == 0, "open_ended")
        .when((count == 2) & F.arrays_overlap(options, F.array(*map(F.lit, words))), "yes_no")
        .when(count <= 4, "single_choice")
        .otherwise("multiple_choice")
    )


def category_by_groups(
    text: Column,
    groups: list[tuple[str, list[str]]] | None = None,
    default: str = lexicons.DEFAULT_CATEGORY,
) -> Column:
    """First group, in order, of which any keyword occurs in the lower-cased text."""
    lower = F.lower(text)
    chain = None
    for name, words in lexicons.CRAWL_CATEGORIES if groups is None else groups:
        hit = contains_any(lower, words)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return F.lit(default) if chain is None else chain.otherwise(default)


def category_by_keyword(
    text: Column,
    keywords: list[tuple[str, str]] | None = None,
    default: str = lexicons.DEFAULT_CATEGORY,
) -> Column:
    """Category of the first keyword, in dictionary order, that occurs in the text (case counts)."""
    chain = None
    for word, category in lexicons.CLEANING_CATEGORIES if keywords is None else keywords:
        hit = text.contains(word)
        chain = F.when(hit, category) if chain is None else chain.when(hit, category)
    return F.lit(default) if chain is None else chain.otherwise(default)


def site_layout(url: Column, layouts: list[tuple[str, list[str]]] | None = None) -> Column:
    """Which page layout a url uses; ``generic`` when no site is known."""
    chain = None
    for name, hosts in lexicons.SITE_LAYOUTS if layouts is None else layouts:
        hit = contains_any(url, hosts)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return F.lit("generic") if chain is None else chain.otherwise("generic")


def padded_id(seq: Column) -> Column:
    """``Q`` and the position, padded to four digits."""
    return F.format_string("Q%04d", seq)
