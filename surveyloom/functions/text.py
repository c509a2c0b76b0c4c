"""Text cleaning, language detection, tokens and normalised keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyloom import lexicons

CJK = "\\u4e00-\\u9fa5"


def any_of_pattern(words: list[str]) -> str:
    """One alternation that matches any of ``words`` literally."""
    return "|".join(re.escape(w) for w in words)


def contains_any(text: Column, words: list[str]) -> Column:
    """True where ``text`` contains at least one of ``words``; false for NULL text.

    One pattern, so that ``text``, which may be a long expression, is worked out once.
    """
    return F.coalesce(text.rlike(any_of_pattern(words)), F.lit(False))


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` knows only the blank)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse_blanks(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def clean_text(text: Column) -> Column:
    """Drop tags, blank out everything but letters, digits, ``_ . ? !``, collapse blanks."""
    no_tags = F.regexp_replace(F.coalesce(text, F.lit("")), r"<[^>]+>", "")
    return collapse_blanks(F.regexp_replace(no_tags, r"(?U)[^\p{L}\p{N}_\s.?!]", " "))


def clean_question_text(text: Column) -> Column:
    """Strip a leading ``Ask`` and numbering, then start at the first letter, if there is one."""
    no_ask = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?iU)^\s*ask\s+", "")
    no_number = F.regexp_replace(no_ask, r"(?iU)^\s*(?:Q\s*)?[0-9]+[.:\s]\s*", "")
    from_letter = F.regexp_extract(no_number, rf"[a-zA-Z{CJK}][\s\S]*$", 0)
    return strip(F.when(from_letter != "", from_letter).otherwise(no_number))


def strip_numbering(text: Column) -> Column:
    """Remove a leading ``12.``, ``12)`` or ``12、``."""
    return F.regexp_replace(text, r"(?U)^[0-9]+[.)、]\s*", "")


def detect_lang(text: Column) -> Column:
    """``zh`` if there is any Chinese character, else ``en``."""
    return F.when(text.rlike(f"[{CJK}]"), "zh").otherwise("en")


def word_count(text: Column) -> Column:
    trimmed = strip(text)
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"(?U)\s+")))


def words(text: Column, min_chars: int = 2) -> Column:
    """Lower-case runs of at least ``min_chars`` word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"([\p{{L}}\p{{N}}_]{{{min_chars},}})"), 1)


def without_words(tokens: Column, stop_words: list[str]) -> Column:
    """Drop stop words, keeping the order and number of the other tokens."""
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda w: ~w.isin(*stop_words))


def terms(text: Column, stop_words: list[str]) -> Column:
    """Tokens for term weighting."""
    return without_words(words(F.coalesce(text, F.lit(""))), stop_words)


def last_wins(pairs: list[tuple[str, str]]) -> dict[str, str]:
    """A synonym list as a mapping; of several entries for a word the last one counts."""
    return {word: target for word, target in pairs}


def _replace_words(tokens: Column, mapping: dict[str, str]) -> Column:
    if not mapping:
        return tokens
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.transform(tokens, lambda w: F.coalesce(F.try_element_at(table, w), w))


def _bigrams(run: Column) -> Column:
    """Overlapping two-character pieces of a run; a single character stays as it is."""
    return F.when(F.length(run) < 2, F.array(run)).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2)))
    )


def dedup_key(
    text: Column,
    lang: Column,
    stop_words: list[str] | None = None,
    lemmas: dict[str, str] | None = None,
    synonyms_en: list[tuple[str, str]] | None = None,
    synonyms_zh: list[tuple[str, str]] | None = None,
) -> Column:
    """Key under which two wordings of one question are equal.

    English: words minus stop words, lemma, then synonym. Chinese: symbols removed,
    synonyms folded, cut into overlapping pairs. Other languages: lower case only.
    """
    if stop_words is None:
        stop_words = lexicons.default_stop_words("en")
    en_map = last_wins(lexicons.SYNONYMS["en"] if synonyms_en is None else synonyms_en)
    zh_map = last_wins(lexicons.SYNONYMS["zh"] if synonyms_zh is None else synonyms_zh)
    lower = F.lower(F.coalesce(text, F.lit("")))

    en_tokens = without_words(words(lower, 1), stop_words)
    english = F.array_join(_replace_words(_replace_words(en_tokens, lemmas or {}), en_map), " ")

    folded = F.regexp_replace(lower, r"(?U)[^\p{L}\p{N}_\s]", "")
    for word, target in zh_map.items():
        folded = F.replace(folded, F.lit(word), F.lit(target))
    runs = F.regexp_extract_all(folded, F.lit(rf"(?U)([{CJK}]+|[^\s{CJK}]+)"), 1)
    pieces = F.flatten(
        F.transform(runs, lambda r: F.when(r.rlike(f"^[{CJK}]"), _bigrams(r)).otherwise(F.array(r)))
    )
    chinese = F.array_join(pieces, " ")
    return F.when(lang == "en", english).when(lang == "zh", chinese).otherwise(lower)


def digest(*cols: Column) -> Column:
    """Fixed-width stand-in for (long) text keys, so that shuffles carry 64 characters, not texts."""
    if len(cols) == 1:
        return F.sha2(cols[0], 256)
    return F.sha2(F.to_json(F.struct(*cols)), 256)
