"""Option lists: extraction, standard form, decoding, standard scales."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyloom import lexicons
from surveyloom.functions.text import collapse_blanks, contains_any, strip

SCALE_TYPE = "struct<min:int,max:int,labels:array<string>>"


def join_crawled_options(
    options: Column,
    prefix: str = lexicons.CRAWL_OPTION_PREFIX,
    dropped: list[str] | None = None,
    limit: int = lexicons.CRAWL_OPTION_LIMIT,
) -> Column:
    """First ``limit`` options, cleaned and joined; NULL when fewer than two remain."""
    dropped = lexicons.CRAWL_OPTION_DROPPED if dropped is None else dropped
    trimmed = F.transform(F.slice(options, 1, limit), strip)
    sized = F.filter(trimmed, lambda o: F.length(o).between(1, lexicons.CRAWL_OPTION_MAX_CHARS))
    bare = F.transform(sized, lambda o: F.regexp_replace(o, prefix, ""))
    kept = F.filter(bare, lambda o: (o != "") & ~o.isin(*dropped))
    return F.when(F.size(kept) >= 2, F.array_join(kept, lexicons.OPTION_SEPARATOR))


def standardize_options(
    options: Column,
    default: list[str] | None = lexicons.DEFAULT_OPTIONS["en"],
    prefix: str = lexicons.CLEANING_OPTION_PREFIX,
) -> Column:
    """Strip numbering and blanks, drop empty options; none left gives ``default`` (None: empty list)."""
    bare = F.transform(options, lambda o: collapse_blanks(F.regexp_replace(strip(o), prefix, "")))
    kept = F.filter(bare, lambda o: F.coalesce(o, F.lit("")) != "")
    fallback = F.array(*map(F.lit, default)) if default else F.array().cast("array<string>")
    return F.when(F.size(F.coalesce(kept, F.array().cast("array<string>"))) > 0, kept).otherwise(fallback)


def split_options(raw: Column) -> Column:
    """Split on ``/``, ``;`` or ``,``; strip; drop empty pieces."""
    return F.filter(F.transform(F.split(raw, "[/;,]"), strip), lambda o: o != "")


def option_count(joined: Column) -> Column:
    """Number of ``/``-separated options; NULL when there are none."""
    return F.when(
        joined != "", F.length(joined) - F.length(F.replace(joined, F.lit("/"), F.lit(""))) + 1
    )


def multi_answers(answer: Column) -> Column:
    """The single answers of a multiple-choice answer."""
    return F.split(answer, lexicons.OPTION_SEPARATOR)


def inline_options(text: Column) -> tuple[Column, Column]:
    """(text without the bracket, options in the bracket or NULL) for ``Pick one (bus/train/plane)``."""
    whole = F.regexp_extract(text, r"[(（]([^)）]{10,120})[)）]", 0)
    inside = F.regexp_extract(text, r"[(（]([^)）]{10,120})[)）]", 1)
    has = (inside != "") & inside.rlike("[/、]")
    return (
        F.when(has, strip(F.replace(text, whole, F.lit("")))).otherwise(text),
        F.when(has, F.split(inside, "[/、]")),
    )


def standard_scale(text: Column, options_text: Column, question_type: Column) -> tuple[Column, Column, Column]:
    """(options, type, changed): a question without options gets the scale its wording asks for."""
    lower = F.lower(text)
    empty = F.coalesce(options_text, F.lit("")) == ""
    options, kind, changed = None, None, F.lit(False)
    for zh_mark, en_marks, zh_scale, en_scale, scale_type in lexicons.STANDARD_SCALES:
        hit = empty & contains_any(lower, [zh_mark, *en_marks])
        scale = F.when(lower.contains(zh_mark), zh_scale).otherwise(en_scale)
        options = F.when(hit, scale) if options is None else options.when(hit, scale)
        kind = F.when(hit, scale_type) if kind is None else kind.when(hit, scale_type)
        changed = changed | hit
    return options.otherwise(options_text), kind.otherwise(question_type), changed


def decode_options(raw: Column) -> tuple[Column, Column]:
    """(option list, scale) from raw option text: a JSON array, a JSON object, joined text or NULL."""
    is_array, is_object = raw.rlike(r"^\s*\["), raw.rlike(r"^\s*\{")
    listed = F.when(is_array, F.from_json(raw, "array<string>")).when(
        ~is_object & (strip(raw) != ""), F.filter(F.transform(F.split(raw, "/"), strip), lambda o: o != "")
    )
    return listed, F.when(is_object, F.from_json(raw, SCALE_TYPE))
