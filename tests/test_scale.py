"""Hot keys, join strategies and repeatability."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from checks import CHECKS
from surveyloom.operators import firstwins, responses, retrieval
from surveyloom.session import SETTINGS


@contextmanager
def settings(spark, **values):
    """Session settings for one test; ``__`` in a name stands for a dot."""
    names = {k: "spark.sql." + k.replace("__", ".") for k in values}
    before = {n: spark.conf.get(n, None) for n in names.values()}
    try:
        for key, value in values.items():
            spark.conf.set(names[key], value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def hot_responses(spark):
    """A third of all responses go to one question."""
    i = F.col("id")
    return spark.range(0, 300_000, numPartitions=6).select(
        (i % 1000).alias("user_id"), F.when(i % 3 == 0, 7).otherwise(i % 5000).alias("question_id"),
        F.when(i % 4 == 0, "not_answered").otherwise("a").alias("answer"), (i % 7 != 0).alias("effective"),
    )


def bank(spark):
    i = F.col("id")
    return spark.range(5000).select(
        "id", i.alias("seq"), F.concat(F.lit("t"), i % 4).alias("question_type"), F.concat(F.lit("c"), i % 9).alias("category")
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_question_is_split_when_the_bank_cannot_be_broadcast(spark, rows):
    broadcast = rows(responses.user_category_rates(hot_responses(spark), bank(spark)), "user_id", "category", "total", "answered")
    with settings(
        spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", shuffle__partitions="16",
        adaptive__advisoryPartitionSizeInBytes="20000", adaptive__skewJoin__skewedPartitionThresholdInBytes="40000",
        adaptive__skewJoin__skewedPartitionFactor="2.0", adaptive__coalescePartitions__enabled="false",
    ):
        df = responses.user_category_rates(hot_responses(spark), bank(spark), unique_ids=True)
        assert "skew=true" in final_plan(df)
        assert rows(df, "user_id", "category", "total", "answered") == broadcast


def test_hot_question_is_added_up_before_the_join(spark):
    """The join of the rate reports sees one row per question and task, not one per response."""
    plan = responses.answer_rate_by_type(hot_responses(spark), bank(spark))._jdf.queryExecution().executedPlan().toString()
    join = plan.index("Join")
    below = plan[join:]
    assert "partial_count" in below[below.index("question_id"):]


def test_hot_text_sends_few_rows(spark):
    """First-wins keeps one row per key and task before the shuffle."""
    texts = spark.range(0, 200_000, numPartitions=8).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    kept = firstwins.first_wins(texts, ["text"])
    assert kept.count() == 200_000 - 66_667 + 1
    assert kept.filter("text = 'hot'").first()["seq"] == 0


def test_hot_term(spark, rows):
    docs = spark.range(0, 3000, numPartitions=5).select(
        F.col("id").alias("seq"), F.concat(F.lit("hotel word"), F.col("id") % 50, F.lit(" item"), F.col("id")).alias("text"))
    asked = spark.createDataFrame([(1, "hotel word3"), (2, "item77")], "q int, text string")

    def answers():
        index = retrieval.build_index(docs, "seq", "text", [])
        wanted = retrieval.request_weights(asked, index.vocabulary, "q", "text", [])
        return rows(retrieval.ranked_matches(retrieval.cosine_scores(index, wanted), 5), "query", "rank", "doc", F.round("score", 6))

    plain = answers()
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1"):
        assert answers() == plain
    assert [r[2] for r in plain if r[0] == 1] == [3, 53, 103, 153, 203] and [r[2] for r in plain if r[0] == 2] == [77]


@pytest.mark.parametrize("name", [
    "answer_rate_by_type", "user_category_rates", "first_wins", "near_duplicates", "questions_for_requirements",
    "relationships", "next_questions", "first_questions", "page_outcomes", "term_weights",
])
def test_no_nested_loops(spark, name):
    plan = CHECKS[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = CHECKS["questions_by_category"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_brand,Brand#7)" in plan and "ReadSchema: struct<p_partkey:bigint,p_brand:string>" in plan


def test_adaptive_execution_is_part_of_the_settings():
    assert SETTINGS["spark.sql.adaptive.enabled"] == SETTINGS["spark.sql.adaptive.skewJoin.enabled"] == "true"
