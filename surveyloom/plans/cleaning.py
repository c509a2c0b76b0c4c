"""Cleaning compositions: raw questions to processed questions, and the report on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom import lexicons
from surveyloom.functions import options as opt
from surveyloom.functions import predicates as pred
from surveyloom.functions import rules, scoring
from surveyloom.functions import text as txt
from surveyloom.operators.counts import level_counts, topic_coverage_by_language
from surveyloom.operators.firstwins import drop_near_duplicates
from surveyloom.session import stored


def clean_questions(
    raw: DataFrame, lang: str = "en", default_options: list[str] | None = None,
    option_prefix: str = lexicons.CLEANING_OPTION_PREFIX,
    keywords: list[tuple[str, str]] | None = None, hard_words: list[str] | None = None,
) -> DataFrame:
    """Cleaned, classified and scored questions, one per cleaned text, with its frequency.

    ``raw`` has seq, question_id, text, options (list), source_platform, original_category.
    Cleaning runs on every row; equal texts are then folded in one aggregate, which both counts
    them and takes the first row; options, types and scores are worked out for the kept rows only.
    """
    defaults = lexicons.DEFAULT_OPTIONS[lang] if default_options is None else default_options
    fields = ["question_id", "options", "source_platform", "original_category", "cleaned_text"]
    cleaned = raw.filter(pred.not_empty(F.col("text"))).withColumn("cleaned_text", txt.clean_text(F.col("text")))
    folded = cleaned.groupBy(txt.digest(F.col("cleaned_text")).alias("_key")).agg(
        F.min_by(F.struct("seq", *fields), "seq").alias("first"), F.count("*").alias("frequency")
    )
    # Texts that became empty are one folded row by now; dropping them earlier would clean every text twice.
    rows = folded.select("first.*", "frequency").filter(F.col("cleaned_text") != "").withColumn(
        "options", opt.standardize_options(F.col("options"), defaults, option_prefix)
    )
    typed = rows.withColumn(
        "question_type", rules.type_from_option_count(F.col("options"), lexicons.YES_NO_OPTIONS[lang])
    )
    hard = lexicons.COMPLEXITY_HARD_WORDS[lang] if hard_words is None else hard_words
    text = F.col("cleaned_text")
    return typed.select(
        "seq",
        F.coalesce("question_id", rules.padded_id(F.col("seq"))).alias("question_id"),
        text.alias("text"),
        "options",
        "question_type",
        rules.category_by_keyword(text, keywords).alias("category"),
        scoring.complexity(text, F.col("options"), F.col("question_type"), hard).alias("complexity"),
        "frequency",
        F.coalesce("source_platform", F.lit("unknown")).alias("source_platform"),
        F.coalesce("original_category", F.lit("unknown")).alias("original_category"),
    )


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` for a costly value that later filters read.

    Spark moves such filters below a plain column and then works the value out twice; it does not
    move them below a generated column.
    """
    return df.withColumn("_value", value).select(
        *[c for c in df.columns if c != name], F.explode(F.array("_value")).alias(name)
    )


def split_failed(rows: DataFrame, casts: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose columns all convert, the others unchanged). A bad value never stops the job."""
    fits = F.lit(True)
    for column, kind in casts.items():
        fits = fits & (F.col(column).isNull() | F.col(column).try_cast(kind).isNotNull())
    good = rows.filter(fits).withColumns({c: F.col(c).try_cast(k) for c, k in casts.items()})
    return good, rows.filter(~fits)


def prepare_pool(
    raw: DataFrame, require_question_mark: bool = False, min_chars: int = 2, **key_options
) -> DataFrame:
    """Crawled questions made ready for retrieval: cleaned, language detected, near-duplicates
    dropped, difficulty scored. ``raw`` has seq, question_text, options_text, question_type."""
    cleaned = computed_once(raw, "question_text", txt.clean_question_text(F.col("question_text"))).filter(
        pred.longer_than(F.col("question_text"), min_chars)
    )
    if require_question_mark:
        cleaned = cleaned.filter(pred.ends_with_question_mark(F.col("question_text")))
    known = cleaned.withColumn("detected_lang", txt.detect_lang(F.col("question_text")))
    unique = drop_near_duplicates(known, **key_options)
    return unique.withColumn(
        "difficulty_score",
        scoring.difficulty_score(
            F.col("question_text"), F.col("question_type"), F.col("options_text"), F.col("detected_lang")
        ),
    )


def cleaning_report(raw: DataFrame, pool: DataFrame) -> DataFrame:
    """(stage, rows): raw rows, valid rows, English pool, Chinese pool."""
    loaded = raw.agg(F.count("*").alias("rows")).select(F.lit("raw").alias("stage"), "rows")
    counts = pool.agg(
        F.count("*").alias("valid"),
        F.count_if(F.col("detected_lang") == "en").alias("en"),
        F.count_if(F.col("detected_lang") == "zh").alias("zh"),
    )
    lines = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("rows")) for s in ("valid", "en", "zh")])
    return loaded.unionByName(counts.select(F.inline(lines)))


def content_report(pool: DataFrame, topics: dict[str, list[tuple[str, list[str]]]], lang: str = "detected_lang") -> DataFrame:
    """(lang, metric, key, count): types, topic coverage and difficulty levels per language.

    ``topics`` has a list per language; texts are matched with the list of their own language.
    """
    kinds = pool.groupBy(lang, F.coalesce("question_type", F.lit("Unknown")).alias("key")).agg(
        F.count("*").alias("count")
    ).select(lang, F.lit("question_type").alias("metric"), "key", "count")
    cover = topic_coverage_by_language(pool, topics, "question_text", lang).select(
        lang, F.lit("topic").alias("metric"), F.col("topic").alias("key"), "count"
    )
    levels = level_counts(pool, "difficulty_score", [1, 2, 3, 4, 5], [lang]).select(
        lang, F.lit("difficulty").alias("metric"), F.col("level").cast("string").alias("key"), "count"
    )
    return kinds.unionByName(cover).unionByName(levels)


def load_and_process(raw: DataFrame, topics: dict[str, list[tuple[str, list[str]]]], **options) -> dict[str, DataFrame]:
    """Pool, its two language parts, the cleaning report and the content report.

    The pool is written once; everything else reads the columns it needs from there.
    """
    pool = stored(prepare_pool(raw, **options), "pool")
    return {
        "pool": pool,
        "en": pool.filter(F.col("detected_lang") == "en"),
        "zh": pool.filter(F.col("detected_lang") == "zh"),
        "cleaning": cleaning_report(raw, pool),
        "content": content_report(pool, topics),
    }

