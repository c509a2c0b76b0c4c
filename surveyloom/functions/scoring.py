"""Complexity and difficulty of a question, and how they are shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyloom import lexicons
from surveyloom.functions.options import option_count
from surveyloom.functions.text import contains_any, word_count


def _points(value: Column, *steps: tuple[int, int]) -> Column:
    """Points of the first step whose bound is exceeded, else 0. Steps go from high to low."""
    chain = None
    for bound, points in steps:
        chain = F.when(value > bound, points) if chain is None else chain.when(value > bound, points)
    return chain.otherwise(0)


def complexity(
    text: Column, options: Column, question_type: Column, hard_words: list[str] | None = None
) -> Column:
    """``easy``, ``medium`` or ``hard`` from length, options, type and hard words (case counts)."""
    hard = lexicons.COMPLEXITY_HARD_WORDS["en"] if hard_words is None else hard_words
    score = (
        _points(F.length(text), (60, 3), (40, 2), (20, 1))
        + _points(F.size(options), (6, 2), (4, 1))
        + F.when(question_type == "open_ended", 2).when(question_type == "multiple_choice", 1).otherwise(0)
        + F.when(contains_any(text, hard), 2).otherwise(0)
    )
    return F.when(score >= 6, "hard").when(score >= 3, "medium").otherwise("easy")


def difficulty_score(
    text: Column,
    question_type: Column,
    options_text: Column,
    lang: Column,
    hard_en: list[str] | None = None,
    hard_zh: list[str] | None = None,
) -> Column:
    """Difficulty 1 to 5 from type, length, number of options and wording."""
    hard_en = lexicons.DIFFICULTY_HARD_WORDS["en"] if hard_en is None else hard_en
    hard_zh = lexicons.DIFFICULTY_HARD_WORDS["zh"] if hard_zh is None else hard_zh
    text = F.coalesce(text, F.lit(""))
    lower = F.lower(text)
    kind = F.lower(F.coalesce(question_type, F.lit("")))
    english = lang == "en"
    score = (
        F.lit(1)
        + F.when(kind.contains("open_ended"), 2)
        .when(contains_any(kind, ["multiple_choice", "single_choice"]), 1)
        .otherwise(0)
        + F.when(english, _points(word_count(text), (30, 2), (15, 1))).otherwise(
            _points(F.length(text), (50, 2), (20, 1))
        )
        + F.when(F.coalesce(option_count(options_text), F.lit(0)) > 6, 1).otherwise(0)
        + F.when(
            (english & contains_any(lower, hard_en)) | (~english & contains_any(lower, hard_zh)), 1
        ).otherwise(0)
    )
    return F.least(F.lit(5), F.greatest(F.lit(1), score)).cast("int")


def stars(score: Column) -> Column:
    return F.concat(F.repeat(F.lit("★"), score), F.repeat(F.lit("☆"), F.lit(5) - score))


def match_percent(score: Column) -> Column:
    """Whole percent, cut off rather than rounded."""
    return F.floor(score * 100).cast("int")
