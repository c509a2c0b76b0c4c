"""Response analysis: answer rates, ineffective rates, user by category rates.

Responses are first added up per question (partly in each task, before any shuffle) and only then
joined with the question table. So a question with a third of all responses is one small row when
the join comes, and the join has as many rows as there are questions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.predicates import is_answered, is_effective
from surveyloom.operators.firstwins import top_per_group

COUNTERS = ["rows_all", "rows_ineffective", "rows_effective", "rows_answered"]


def question_lookup(questions: DataFrame, value: str, unique_ids: bool = False) -> DataFrame:
    """(question_id, value) table; of several questions with one id the last one counts."""
    if unique_ids:
        return questions.select(F.col("id").alias("question_id"), F.col(value).alias(f"bank_{value}"))
    last = top_per_group(questions.select("id", "seq", value), ["id"], [F.desc("seq")], 1)
    return last.select(F.col("id").alias("question_id"), F.col(value).alias(f"bank_{value}"))


def own_value(responses: DataFrame, column: str) -> Column:
    """The response's own value, NULL when it is missing or empty."""
    if column not in responses.columns:
        return F.lit(None).cast("string")
    return F.nullif(F.col(column), F.lit(""))


def response_counters(responses: DataFrame, own: list[str] | None = None) -> DataFrame:
    """Counters per question, kept apart by the response's own type and category, if it has them."""
    own = ["question_type", "category"] if own is None else own
    effective = is_effective(F.col("effective"))
    return responses.groupBy("question_id", *[own_value(responses, c).alias(f"own_{c}") for c in own]).agg(
        F.count("*").alias("rows_all"),
        F.count_if(F.coalesce(~F.col("effective"), F.lit(False))).alias("rows_ineffective"),
        F.count_if(effective).alias("rows_effective"),
        F.count_if(effective & is_answered(F.col("answer"))).alias("rows_answered"),
    )


def _by_value(counters: DataFrame, questions: DataFrame, value: str, unique_ids: bool) -> DataFrame:
    joined = counters.join(question_lookup(questions, value, unique_ids), "question_id", "left")
    return (
        joined.withColumn(value, F.coalesce(f"own_{value}", f"bank_{value}"))
        .filter(F.col(value).isNotNull())
        .groupBy(value)
        .agg(*[F.sum(c).alias(c) for c in COUNTERS])
    )


def answer_rate_from_counters(counters: DataFrame, questions: DataFrame, unique_ids: bool = False) -> DataFrame:
    return (
        _by_value(counters, questions, "question_type", unique_ids)
        .filter(F.col("rows_effective") > 0)
        .select(
            "question_type",
            F.col("rows_effective").alias("total"),
            F.col("rows_answered").alias("answered"),
            (F.col("rows_answered") / F.col("rows_effective")).alias("answer_rate"),
        )
    )


def answer_rate_by_type(responses: DataFrame, questions: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Share of answered rows among the effective rows, per question type."""
    effective = responses.filter(is_effective(F.col("effective")))
    return answer_rate_from_counters(response_counters(effective, ["question_type"]), questions, unique_ids)


def ineffective_from_counters(counters: DataFrame, questions: DataFrame, unique_ids: bool = False) -> DataFrame:
    return _by_value(counters, questions, "category", unique_ids).select(
        "category",
        F.col("rows_all").alias("total"),
        F.col("rows_ineffective").alias("ineffective"),
        (F.col("rows_ineffective") / F.col("rows_all")).alias("ineffective_rate"),
    )


def ineffective_rate_by_category(responses: DataFrame, questions: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Share of rows marked ineffective, per category."""
    return ineffective_from_counters(response_counters(responses, ["category"]), questions, unique_ids)


def with_question_values(
    responses: DataFrame, questions: DataFrame, values: list[str], unique_ids: bool = False
) -> DataFrame:
    """Responses with looked-up question columns; the response's own non-empty value goes first.

    Responses to unknown questions that bring no value of their own are dropped.
    """
    lookup = None
    for value in values:
        one = question_lookup(questions, value, unique_ids)
        lookup = one if lookup is None else lookup.join(one, "question_id")
    joined = responses.join(lookup, "question_id", "left")
    for value in values:
        joined = joined.withColumn(value, F.coalesce(own_value(responses, value), f"bank_{value}"))
    known = F.lit(True)
    for value in values:
        known = known & F.col(value).isNotNull()
    return joined.filter(known).drop(*[f"bank_{v}" for v in values])


def user_category_rates(responses: DataFrame, questions: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Answer rate per user and category over effective rows; the category comes from the bank only."""
    lookup = question_lookup(questions, "category", unique_ids)
    return (
        responses.filter(is_effective(F.col("effective")))
        .select("user_id", "question_id", is_answered(F.col("answer")).alias("hit"))
        .join(lookup, "question_id")
        .filter(F.col("bank_category").isNotNull())
        .groupBy("user_id", F.col("bank_category").alias("category"))
        .agg(F.count("*").alias("total"), F.count_if("hit").alias("answered"))
        .withColumn("rate", F.col("answered") / F.col("total"))
    )


def user_category_matrix(rates: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Users by categories; a cell without data is NULL. Only categories with data become columns.

    The list of columns is part of the schema, so it must be known when the query is built: either
    it is given or Spark looks up the distinct categories (``spark.sql.pivotMaxValues`` guards that).
    """
    grouped = rates.groupBy("user_id")
    pivoted = grouped.pivot("category", categories) if categories else grouped.pivot("category")
    return pivoted.agg(F.first("rate")).orderBy("user_id")


def answer_option_counts(responses: DataFrame) -> DataFrame:
    """How often each option was chosen per question; several choices in one answer count each."""
    from surveyloom.functions.options import multi_answers

    return (
        responses.filter(is_answered(F.col("answer")))
        .select("question_id", F.explode(multi_answers(F.col("answer"))).alias("option"))
        .groupBy("question_id", "option")
        .agg(F.count("*").alias("count"))
    )
