"""Reports over responses: all figures of an analysis, one report per user, one over all users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.predicates import is_answered
from surveyloom.operators import clusters, counts, hierarchy, responses
from surveyloom.operators.correlation import correlation_matrix
from surveyloom.session import stored


def analyze_results(answers: DataFrame, questions: DataFrame) -> dict[str, DataFrame]:
    """Answer rate, ineffective rate, user rates and category correlation.

    The counters per question are written once; both rate reports are then small joins on them.
    """
    counters = stored(responses.response_counters(answers), "counters")
    rates = stored(responses.user_category_rates(answers, questions), "rates")
    return {
        "answer_rate": responses.answer_rate_from_counters(counters, questions),
        "ineffective_rate": responses.ineffective_from_counters(counters, questions),
        "user_rates": rates,
        "correlation": correlation_matrix(rates, "user_id", "category", "rate"),
    }


def user_types(rates: DataFrame) -> DataFrame:
    """Per user: categories answered, overall rate, and the category with the highest rate as type.

    ``rates`` is the user by category table, so a user has at most one row per category.
    """
    # The least (-rate, name): the highest rate, and of equal rates the first name.
    best = F.min(F.struct((-F.col("rate")).alias("minus_rate"), "category"))
    return rates.groupBy("user_id").agg(
        F.count("*").alias("categories"),
        F.sum("answered").alias("answered"),
        F.sum("total").alias("total"),
        best["category"].alias("user_type"),
        F.max("rate").alias("best_rate"),
    )


def survey_report(answers: DataFrame, questions: DataFrame, recommended: DataFrame | None = None) -> dict[str, DataFrame]:
    """Per user: dimension scores, type, the answers in that dimension, and recommendations."""
    rates = responses.user_category_rates(answers, questions)
    types = user_types(rates)
    lookup = responses.question_lookup(questions, "category")
    key_answers = (
        answers.filter(is_answered(F.col("answer")))
        .join(lookup, "question_id")
        .join(types.select("user_id", F.col("user_type").alias("bank_category")), ["user_id", "bank_category"])
        .select("user_id", "question_id", "answer")
    )
    parts = {"dimensions": rates, "types": types, "key_answers": key_answers}
    if recommended is not None:
        parts["recommendations"] = recommended
    return parts


def all_users_report(types: DataFrame) -> DataFrame:
    """(metric, key, value): users, users per type, completion rate."""
    per_type = stored(
        types.groupBy("user_type").agg(
            F.count("*").alias("users"), F.sum("answered").alias("answered"), F.sum("total").alias("total")
        ),
        "per-type",
    )
    totals = per_type.agg(
        F.sum("users").cast("double").alias("total_users"),
        F.try_divide(F.sum("answered"), F.sum("total")).alias("completion_rate"),
    )
    lines = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.lit("").alias("key"), F.col(m).alias("value"))
            for m in ("total_users", "completion_rate")
        ]
    )
    return totals.select(F.inline(lines)).unionByName(
        per_type.select(
            F.lit("users_per_type").alias("metric"), F.col("user_type").alias("key"),
            F.col("users").cast("double").alias("value"),
        )
    )


def write_chart_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Chart tables as Parquet, one folder each."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")


def chart_tables(
    questions: DataFrame, answers: DataFrame, source: str = "source_name",
    assigned: DataFrame | None = None, tree: DataFrame | None = None, edges: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The tables behind all charts.

    ``assigned`` (questions with cluster and features) adds the scatter tables, ``tree`` the
    complexity shares, and ``tree`` with ``edges`` the relationship graph.
    """
    types = stored(user_types(responses.user_category_rates(answers, questions)), "user-types")
    tables = {
        "categories": counts.category_chart(questions),
        "difficulty": counts.histogram(questions, "difficulty"),
        "difficulty_curve": counts.density_curve(questions, "difficulty"),
        "sources": counts.platform_comparison(questions, source),
        "progress": counts.progress_summary(answers),
        "user_types": types,
        "all_users": all_users_report(types),
    }
    if assigned is not None:
        positions = stored(clusters.scatter_positions(assigned).drop("features"), "positions")
        tables |= {"cluster_positions": positions, "cluster_centres": clusters.scatter_centres(positions)}
    if tree is not None:
        tables["complexity"] = counts.share_by(tree, "complexity")
        if edges is not None:
            tables["graph_nodes"], tables["graph_edges"] = hierarchy.graph_data(tree, edges)
    return tables
