"""Answers as they arrive: the last answer per session and question, and running answer rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from surveyloom.functions.predicates import is_answered, is_effective
from surveyloom.operators.responses import own_value, question_lookup
from surveyloom.streaming.versions import apply_batch, read_table


def last_answers(answers: DataFrame, watermark: str = "1 hour", window: str = "1 hour") -> DataFrame:
    """Last answer per (session, question) within each event-time window.

    The window is part of the key, so that state older than the watermark is dropped and rows that
    come later than it are ignored; without it the state would grow for ever. Equal times are
    settled by the larger ``event_id``.
    """
    spot = F.struct("ts", "event_id")
    return (
        answers.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window), "session_id", "question_id")
        .agg(F.max(spot).alias("spot"), F.max_by("answer", spot).alias("answer"))
        .select("session_id", "question_id", "spot.ts", "spot.event_id", "answer")
    )


ANSWERS = "session_id bigint, question_id bigint, ts timestamp, event_id bigint, answer string"


def _last(rows: DataFrame) -> DataFrame:
    spot = F.struct("ts", "event_id")
    found = rows.groupBy("session_id", "question_id").agg(F.max_by("answer", spot).alias("answer"), F.max(spot).alias("spot"))
    return found.select("session_id", "question_id", "spot.ts", "spot.event_id", "answer")


def write_answer_log(answers: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the last answer per (session, question) of each batch's changed answers. A repeated batch changes nothing."""
    def save(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, path, ANSWERS, ["session_id", "question_id"], _last)

    return (
        answers.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(save)
        .trigger(availableNow=True)
        .start()
    )


def current_answers(spark: SparkSession, path: str) -> DataFrame:
    """The last answer per (session, question), after the last whole batch."""
    return read_table(spark, path, ANSWERS).select("session_id", "question_id", "answer", "ts", "event_id")


def session_answers(current: DataFrame) -> DataFrame:
    """The answers of every session as rows, so that a session may have any number of them."""
    return current.select("session_id", "question_id", "answer")


def running_answer_rate(responses: DataFrame, questions: DataFrame) -> DataFrame:
    """Answered and total effective responses per question type so far (complete mode).

    ``questions`` is a static table; each arriving batch is joined with it. As in the batch report,
    a response's own type comes first, and of several questions with one id the last one counts.
    """
    kind = F.coalesce("own", "bank_question_type").alias("question_type")
    return (
        responses.filter(is_effective(F.col("effective")))
        .select("question_id", own_value(responses, "question_type").alias("own"), is_answered(F.col("answer")).alias("hit"))
        .join(question_lookup(questions, "question_type"), "question_id", "left")
        .select(kind, "hit")
        .filter(F.col("question_type").isNotNull())
        .groupBy("question_type")
        .agg(F.count("*").alias("total"), F.count_if("hit").alias("answered"))
    )


RATES = "question_type string, total bigint, answered bigint"


def write_running_table(table: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Put the small result table of each batch in the place of the one before, which readers use until then."""
    def save(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch.coalesce(1), batch_id, path, RATES, [], None)

    return (
        table.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(save)
        .trigger(availableNow=True)
        .start()
    )


def current_rates(spark: SparkSession, path: str) -> DataFrame:
    """The running table after the last whole batch."""
    return read_table(spark, path, RATES)
