"""Counting reports. Reports that share a table share one scan, as grouping sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.predicates import is_answered, not_default_category, not_empty
from surveyloom.functions.text import contains_any, digest
from surveyloom.operators.firstwins import top_per_group
from surveyloom.session import stored


def count_by(df: DataFrame, value: Column, name: str, default: str | None = None) -> DataFrame:
    """Rows per value; NULL counts under ``default``, if given."""
    key = F.coalesce(value, F.lit(default)) if default is not None else value
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("count"))


def count_by_category(questions: DataFrame) -> DataFrame:
    return count_by(questions, F.col("category"), "category", "Uncategorized")


def count_by_type(questions: DataFrame) -> DataFrame:
    """Rows per type, most frequent first."""
    counted = count_by(questions, F.col("question_type"), "question_type", "Unknown")
    return counted.orderBy(F.desc("count"), "question_type")


def count_by_platform(questions: DataFrame, platform: str = "source_platform") -> DataFrame:
    return count_by(questions, F.col(platform), platform)


def grouped_counts(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """(metric, key, count) for several single-column groupings, and the total, in one pass."""
    names = list(keys)
    base = df.select(*[keys[n].cast("string").alias(n) for n in names])
    sets = [[F.col(n)] for n in names] + [[]]
    # grouping_id has one bit per column, 0 where the column is part of the set.
    full = (1 << len(names)) - 1
    counted = base.groupingSets(sets, *names).agg(
        F.grouping_id(*names).alias("_gid"), F.count("*").alias("count")
    )
    metric, key = F.when(F.col("_gid") == full, "total"), F.lit(None).cast("string")
    for i, n in enumerate(names):
        own = full ^ (1 << (len(names) - 1 - i))
        metric = metric.when(F.col("_gid") == own, n)
        key = F.when(F.col("_gid") == own, F.col(n)).otherwise(key)
    return counted.select(metric.alias("metric"), key.alias("key"), "count")


def bank_statistics(questions: DataFrame, questionnaires: DataFrame, users: DataFrame) -> DataFrame:
    """(metric, key, value): totals of the three collections, questions per category and per type."""
    per_question = grouped_counts(
        questions,
        {
            "categories_distribution": F.coalesce("category", F.lit("Uncategorized")),
            "question_types_distribution": F.coalesce("question_type", F.lit("Unknown")),
        },
    ).select(
        F.when(F.col("metric") == "total", "total_questions").otherwise(F.col("metric")).alias("metric"),
        F.coalesce("key", F.lit("")).alias("key"),
        F.col("count").alias("value"),
    )

    def total(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), F.lit("").alias("key"), "value")

    return per_question.unionByName(total(questionnaires, "total_questionnaires")).unionByName(
        total(users, "total_users")
    )


def count_checks(statistics: DataFrame) -> DataFrame:
    """(check, passed): category counts and type counts each add up to the number of questions."""
    sums = statistics.groupBy().agg(
        F.sum(F.when(F.col("metric") == "total_questions", F.col("value"))).alias("total"),
        F.sum(F.when(F.col("metric") == "categories_distribution", F.col("value"))).alias("by_category"),
        F.sum(F.when(F.col("metric") == "question_types_distribution", F.col("value"))).alias("by_type"),
    )
    checks = F.array(
        F.struct(F.lit("category counts").alias("check"), (F.col("by_category") == F.col("total")).alias("passed")),
        F.struct(F.lit("type counts").alias("check"), (F.col("by_type") == F.col("total")).alias("passed")),
    )
    return sums.select(F.inline(checks))


def top_by_count(df: DataFrame, value: str, k: int, order: str = "seq") -> DataFrame:
    """The ``k`` most frequent values; of equal ones the value that occurs first."""
    return (
        df.groupBy(value)
        .agg(F.count("*").alias("count"), F.min(order).alias("first_seq"))
        .orderBy(F.desc("count"), "first_seq")
        .limit(k)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The different values of a column, in order, without NULL."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def text_frequency(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of each text."""
    return df.groupBy(text).agg(F.count("*").alias("frequency"))


def frequency_report(frequencies: DataFrame, text: str, order: str = "seq", top: int = 10) -> DataFrame:
    """(metric, key, value) from one row per text with its frequency: total, distinct texts,
    the most frequent texts and how many texts occur once, twice and so on. No rows: no report."""
    frequencies = stored(frequencies.select(text, "frequency", order), "frequencies")
    totals = frequencies.agg(
        F.count("*").alias("total_questions"), F.count_distinct(digest(F.col(text))).alias("unique_questions")
    ).filter(F.col("total_questions") > 0)
    counted = totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.lit("").alias("key"), F.col(m).alias("value"))
                    for m in ("total_questions", "unique_questions")
                ]
            )
        )
    )
    best = (
        frequencies.orderBy(F.desc("frequency"), order)
        .limit(top)
        .select(F.lit("top_questions").alias("metric"), F.col(text).alias("key"), F.col("frequency").alias("value"))
    )
    spread = frequencies.groupBy("frequency").agg(F.count("*").alias("value")).select(
        F.lit("frequency_distribution").alias("metric"), F.col("frequency").cast("string").alias("key"), "value"
    )
    return counted.unionByName(best).unionByName(spread)


def crawl_statistics(questions: DataFrame, top_categories: int = 10, top_sources: int = 15) -> DataFrame:
    """(metric, key, value, percent) over crawled questions, all from one scan.

    Totals by kind, the most frequent categories, all types, the most frequent sources.
    """
    base = questions.select(
        F.coalesce("category", F.lit("")).alias("category"),
        F.coalesce("question_type", F.lit("")).alias("question_type"),
        F.coalesce("source_name", F.lit("")).alias("source_name"),
        "seq",
        not_empty(F.col("options_text")).alias("has_options"),
        (F.col("language") == "zh").alias("is_zh"),
        (F.coalesce("source_url", F.lit("")) != "generated").alias("is_real"),
    )
    names = ["category", "question_type", "source_name"]
    grouped = base.groupingSets([[F.col(n)] for n in names] + [[]], *names).agg(
        F.grouping_id(*names).alias("gid"),
        F.count("*").alias("n"),
        F.min("seq").alias("first_seq"),
        F.count_if("has_options").alias("with_options"),
        F.count_if("is_zh").alias("zh"),
        F.count_if("is_real").alias("real"),
    )
    # One row per category, type and source: written, so that the parts below do not scan again.
    sets = stored(grouped, "crawl-statistics")
    kinds = {0b011: "category", 0b101: "question_type", 0b110: "source_name"}
    metric, key = F.lit("total"), F.lit("")
    for gid, name in kinds.items():
        metric = F.when(F.col("gid") == gid, name).otherwise(metric)
        key = F.when(F.col("gid") == gid, F.col(name)).otherwise(key)
    lines = F.when(
        F.col("gid") == 0b111,
        F.array(
            *[
                F.struct(F.lit(m).alias("metric"), F.lit("").alias("key"), v.alias("value"))
                for m, v in [
                    ("total", F.col("n")), ("with_options", F.col("with_options")), ("zh", F.col("zh")),
                    ("en", F.col("n") - F.col("zh")), ("real", F.col("real")), ("generated", F.col("n") - F.col("real")),
                ]
            ]
        ),
    ).otherwise(F.array(F.struct(metric.alias("metric"), key.alias("key"), F.col("n").alias("value"))))
    total = sets.filter(F.col("gid") == 0b111).agg(F.max("n")).scalar()
    limits = {"category": top_categories, "source_name": top_sources}
    # Ranking is per metric over grouped rows; the group limit keeps the first few in each task.
    listed = sets.select("first_seq", F.inline(lines))
    parts = [listed.filter(~F.col("metric").isin(*limits)).drop("first_seq")]
    for name, k in limits.items():
        ranked = top_per_group(
            listed.filter(F.col("metric") == name), ["metric"], [F.desc("value"), "first_seq"], k
        )
        parts.append(ranked.drop("first_seq"))
    result = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return result.withColumn("percent", F.try_divide(F.col("value") * 100.0, total))


def topic_coverage(df: DataFrame, topics: list[tuple[str, list[str]]], text: str, by: list[str] | None = None) -> DataFrame:
    """Texts per topic; a text counts for every topic of which it contains a keyword. One scan."""
    lower = F.lower(F.col(text))
    counts = df.groupBy(*(by or [])).agg(
        *[F.count_if(contains_any(lower, words)).alias(f"_t{i}") for i, (_, words) in enumerate(topics)]
    )
    lines = F.array(
        *[F.struct(F.lit(name).alias("topic"), F.col(f"_t{i}").alias("count")) for i, (name, _) in enumerate(topics)]
    )
    return counts.select(*(by or []), F.inline(lines))


def topic_coverage_by_language(
    df: DataFrame, topics: dict[str, list[tuple[str, list[str]]]], text: str, lang: str
) -> DataFrame:
    """(lang, topic, count): texts per topic, each text against the topics of its own language. One scan.

    Languages without topics give no rows.
    """
    lower = F.lower(F.col(text))
    named = [(code, name, words) for code, listed in topics.items() for name, words in listed]
    counts = df.filter(F.col(lang).isin(*topics)).groupBy(lang).agg(
        *[F.count_if(F.when(F.col(lang) == code, contains_any(lower, words))).alias(f"_t{i}") for i, (code, _, words) in enumerate(named)]
    )
    lines = F.array(
        *[F.struct(F.lit(code).alias("of"), F.lit(name).alias("topic"), F.col(f"_t{i}").alias("count")) for i, (code, name, _) in enumerate(named)]
    )
    return counts.select(lang, F.inline(lines)).filter(F.col("of") == F.col(lang)).drop("of")


def level_counts(df: DataFrame, level: str, levels: list[int], by: list[str] | None = None) -> DataFrame:
    """Rows per level with absent levels as 0, in one aggregate."""
    counts = df.groupBy(*(by or [])).agg(*[F.count_if(F.col(level) == x).alias(f"_l{x}") for x in levels])
    lines = F.array(*[F.struct(F.lit(x).alias("level"), F.col(f"_l{x}").alias("count")) for x in levels])
    return counts.select(*(by or []), F.inline(lines))


def share_by(df: DataFrame, value: str) -> DataFrame:
    """Rows per value and their share of all rows."""
    counted = df.groupBy(value).agg(F.count("*").alias("count"))
    total = df.agg(F.count("*")).scalar()
    return counted.withColumn("share", F.try_divide(F.col("count").cast("double"), total))


def category_chart(questions: DataFrame) -> DataFrame:
    """Questions per category, without the catch-all category."""
    named = questions.filter(not_default_category(F.col("category")))
    return named.groupBy("category").agg(F.count("*").alias("count"))


def histogram(df: DataFrame, value: str, bins: int = 6) -> DataFrame:
    """Equal-width bins between the least and the greatest value; empty bins count 0.

    The last bin includes its upper edge. If all values are equal the range is widened by 0.5 to
    both sides. One scan finds the range, a second one counts; only bin counts are shuffled.
    """
    known = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("x"))
    ends = known.agg(F.min("x").alias("a"), F.max("x").alias("b")).filter(F.col("a").isNotNull())
    flat = F.col("a") == F.col("b")
    edges = stored(
        ends.select(
            F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
            F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
        ),
        "edges",
    )
    placed = known.withColumn("r", edges.select(F.struct("lo", "hi")).scalar())
    width = (F.col("r.hi") - F.col("r.lo")) / bins
    first = F.least(F.floor((F.col("x") - F.col("r.lo")) / width), F.lit(bins - 1))
    edge = lambda i: F.col("r.lo") + i * width
    # A value that rounding put on the wrong side of an edge moves to the bin that holds it.
    fixed = F.when(F.col("x") < edge(first), first - 1).when(
        (F.col("x") >= edge(first + 1)) & (first < bins - 1), first + 1
    ).otherwise(first)
    per_bin = placed.groupBy(fixed.cast("int").alias("bin")).agg(F.count("*").alias("count"))
    frame = edges.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    step = (F.col("hi") - F.col("lo")) / bins
    return frame.join(per_bin, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * step).alias("bin_from"),
        (F.col("lo") + (F.col("bin") + 1) * step).alias("bin_to"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def density_curve(df: DataFrame, value: str, points: int = 50, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density on ``points`` grid points between least and greatest value.

    Default bandwidth is n^(-1/5) times the sample standard deviation. Without spread: no curve.
    Each distinct value adds to the fixed grid inside its task; only the grid sums are shuffled.
    """
    base = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("x"))
    stats = base.agg(
        F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.stddev_samp("x").alias("sd")
    ).filter(F.col("hi") > F.col("lo"))
    h = F.lit(bandwidth) if bandwidth is not None else F.pow(F.col("n"), F.lit(-0.2)) * F.col("sd")
    span = stats.select(F.struct("n", "lo", "hi", h.alias("h"))).scalar()
    counted = base.groupBy("x").agg(F.count("*").alias("c")).withColumn("r", span).filter(F.col("r").isNotNull())
    grid = counted.select("x", "c", "r", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    at = F.col("r.lo") + F.col("point") * (F.col("r.hi") - F.col("r.lo")) / (points - 1)
    z = (at - F.col("x")) / F.col("r.h")
    return (
        grid.select("point", at.alias("grid_x"), "c", F.col("r.n").alias("n"), F.col("r.h").alias("h"), z.alias("z"))
        .groupBy("point")
        .agg(
            F.first("grid_x").alias("grid_x"),
            F.sum(
                F.col("c") * F.exp(-0.5 * F.col("z") * F.col("z"))
                / (F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
            ).alias("density"),
        )
    )


def platform_comparison(questions: DataFrame, source: str = "source_name") -> DataFrame:
    """Quantity and quality per source: rows, share with options, mean difficulty, distinct texts."""
    return questions.groupBy(source).agg(
        F.count("*").alias("questions"),
        F.avg(not_empty(F.col("options_text")).cast("double")).alias("options_share"),
        F.avg("difficulty").alias("mean_difficulty"),
        F.count_distinct(digest(F.col("question_text"))).alias("distinct_texts"),
    )


def user_progress(responses: DataFrame) -> DataFrame:
    """Per user: questions put, questions answered, and the state none, partial or complete."""
    per_user = responses.groupBy("user_id").agg(
        F.count("*").alias("assigned"), F.count_if(is_answered(F.col("answer"))).alias("answered")
    )
    state = (
        F.when(F.col("answered") == 0, "none").when(F.col("answered") < F.col("assigned"), "partial").otherwise("complete")
    )
    return per_user.withColumn("state", state)


def progress_summary(responses: DataFrame) -> DataFrame:
    """Users and responses per progress state."""
    return user_progress(responses).groupBy("state").agg(
        F.count("*").alias("users"), F.sum("answered").alias("answered"), F.sum("assigned").alias("assigned")
    )


def system_statistics(questions: DataFrame, questionnaires: DataFrame, users: DataFrame, responses: DataFrame) -> DataFrame:
    """(metric, value): sizes of the collections and the share of put questions that were answered."""
    sizes = bank_statistics(questions, questionnaires, users).filter(F.col("key") == "").select(
        "metric", F.col("value").cast("double").alias("value")
    )
    rate = responses.agg(F.avg(is_answered(F.col("answer")).cast("double")).alias("value")).select(
        F.lit("completion_rate").alias("metric"), "value"
    )
    return sizes.unionByName(rate)
