"""Batch changes of the bank: new questions, new questionnaires, question links, raw ingest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.operators.firstwins import new_rows
from surveyloom.session import stored
from surveyloom.sources.ids import next_ids, ordered_index, ranked_within


def append_questions(bank: DataFrame, new: DataFrame, order: str = "seq") -> DataFrame:
    """Bank plus new questions, which get the next ids and a usage count of 0."""
    added = next_ids(bank, new, "id", order).withColumn("usage_count", F.lit(0).cast("bigint"))
    return bank.unionByName(added, allowMissingColumns=True)


def create_questionnaires(questionnaires: DataFrame, new: DataFrame, order: str = "seq") -> DataFrame:
    """Questionnaires plus new ones with the next ids, no questions yet, in draft."""
    added = (
        next_ids(questionnaires, new, "id", order)
        .withColumn("question_ids", F.array().cast("array<bigint>"))
        .withColumn("status", F.lit("draft"))
    )
    return questionnaires.unionByName(added, allowMissingColumns=True)


@dataclass
class LinkResult:
    """``status`` (one row per request, with ``ok``), ``added`` (new links with their position),
    ``usage`` (question_id, added_count)."""

    status: DataFrame
    added: DataFrame
    usage: DataFrame


def check_links(requests: DataFrame, questionnaires: DataFrame, bank: DataFrame) -> DataFrame:
    """Requests with ``ok``: both the questionnaire and the question exist."""
    lists = questionnaires.select(F.col("id").alias("questionnaire_id"), F.lit(True).alias("_list")).distinct()
    ids = bank.select(F.col("id").alias("question_id"), F.lit(True).alias("_question")).distinct()
    return (
        requests.join(lists, "questionnaire_id", "left")
        .join(ids, "question_id", "left")
        .withColumn("ok", F.col("_list").isNotNull() & F.col("_question").isNotNull())
        .drop("_list", "_question")
    )


def link_questions(requests: DataFrame, questionnaires: DataFrame, bank: DataFrame) -> LinkResult:
    """Add questions to questionnaires, each at most once, in the order of the requests.

    A request for a link that exists already is ok but adds nothing and counts no usage.
    """
    status = check_links(requests, questionnaires, bank)
    existing = questionnaires.select(
        F.col("id").alias("questionnaire_id"), F.explode("question_ids").alias("question_id")
    )
    fresh = new_rows(status.filter("ok").drop("ok"), existing, ["questionnaire_id", "question_id"])
    sizes = questionnaires.select(F.col("id").alias("questionnaire_id"), F.size("question_ids").alias("_size"))
    ranked = ranked_within(fresh.select("questionnaire_id", "question_id", "seq"), ["questionnaire_id"], ["seq"])
    placed = ranked.join(sizes, "questionnaire_id").select(
        "questionnaire_id", "question_id", "seq", (F.greatest("_size", F.lit(0)) + F.col("rank") - 1).alias("position")
    )
    added = stored(placed, "added-links")
    usage = added.groupBy("question_id").agg(F.count("*").alias("added_count"))
    return LinkResult(status.select("seq", "questionnaire_id", "question_id", "ok"), added, usage)


def apply_links(questionnaires: DataFrame, bank: DataFrame, result: LinkResult) -> tuple[DataFrame, DataFrame]:
    """(all links as (questionnaire_id, position, question_id), bank with raised usage counts).

    Links stay rows, so a questionnaire may have any number of them.
    """
    existing = questionnaires.select(
        F.col("id").alias("questionnaire_id"), F.posexplode("question_ids").alias("position", "question_id")
    ).withColumn("position", F.col("position").cast("bigint"))
    links = existing.unionByName(result.added.select("questionnaire_id", "position", "question_id"))
    counts = result.usage.withColumnRenamed("question_id", "id")
    used = bank.join(counts, "id", "left").withColumn(
        "usage_count", F.coalesce("usage_count", F.lit(0)) + F.coalesce("added_count", F.lit(0))
    )
    return links, used.drop("added_count")


@dataclass
class IngestResult:
    accepted: DataFrame
    rejected: DataFrame
    summary: DataFrame


def ingest_raw(
    raw: DataFrame, known: DataFrame, valid: Column, text: str = "text", order: str = "seq", first_id: int = 0
) -> IngestResult:
    """Raw rows into (accepted with new ids from ``first_id`` on, rejected with a reason, counts).

    Rejected: rows that fail ``valid``, texts that stood earlier in the batch or are known.
    """
    passed = raw.withColumn("_valid", F.coalesce(valid, F.lit(False)))
    good = passed.filter("_valid").drop("_valid")
    fresh = new_rows(good, known, [text], order)
    accepted = ordered_index(fresh, [order], "_pos").withColumn(
        "question_id", F.format_string("Q%04d", F.col("_pos") + first_id)
    ).drop("_pos")
    invalid = passed.filter(~F.col("_valid")).select(order, F.lit("invalid").alias("reason"))
    repeated = good.join(accepted.select(order), order, "left_anti").select(order, F.lit("duplicate").alias("reason"))
    rejected = invalid.unionByName(repeated)
    summary = accepted.agg(F.count("*").alias("rows")).select(F.lit("added").alias("outcome"), "rows").unionByName(
        rejected.groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("rows"))
    )
    return IngestResult(accepted, rejected, summary)


def enlarge_bank(
    questions: DataFrame, target: int, seed: int, words: list[tuple[str, list[str]]],
    minimum: int = 100, order: str = "seq", text: str = "question_text",
) -> DataFrame:
    """Fill a bank up to ``target`` rows with variants of its own rows.

    Each variant copies a row picked by a hash of its number and replaces the first listed word that
    occurs in the text by one of its synonyms, everywhere. A bank that is large enough, or has fewer
    than ``minimum`` rows, stays as it is.
    """
    marked = questions.withColumn("variant", F.lit(None).cast("bigint"))
    have = questions.count()
    if have >= target or have < minimum:
        return marked
    spark = questions.sparkSession

    def pick(salt: str, n: Column) -> Column:
        hashed = F.md5(F.concat_ws("-", F.lit(salt), F.col("variant").cast("string"), F.lit(str(seed))))
        return F.pmod(F.conv(F.substring(hashed, 1, 15), 16, 10).cast("bigint"), n)

    variants = spark.range(target - have).select(F.col("id").alias("variant")).select(
        "variant", pick("row", F.lit(have)).alias("_base")
    )
    drawn = variants.join(ordered_index(questions, [order], "_base"), "_base").drop("_base")
    replaced = None
    for word, synonyms in words:
        options = F.array(*map(F.lit, synonyms))
        new = F.element_at(options, (pick(word, F.lit(len(synonyms))) + 1).cast("int"))
        hit, value = F.col(text).contains(word), F.replace(F.col(text), F.lit(word), new)
        replaced = F.when(hit, value) if replaced is None else replaced.when(hit, value)
    variant_rows = drawn.withColumn(text, replaced.otherwise(F.col(text)))
    if "source_name" in questions.columns:
        variant_rows = variant_rows.withColumn("source_name", F.concat(F.lit("Generated-"), F.col("source_name")))
    if "source_url" in questions.columns:
        variant_rows = variant_rows.withColumn("source_url", F.lit("generated"))
    return marked.unionByName(variant_rows)
