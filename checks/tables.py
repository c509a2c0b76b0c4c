"""The given tables, and the survey entities seen through them, for Spark and as SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.sources import read_table

# Question wordings over all parts; both engines read this expression.
WORDING = """CASE p_partkey % 14
 WHEN 0 THEN 'How satisfied are you with the ' || p_name || '?'
 WHEN 1 THEN 'Which room or accommodation has a ' || p_name || '?'
 WHEN 2 THEN 'Would you rate the service of the ' || p_name || ' staff?'
 WHEN 3 THEN '您对酒店的房间满意吗？' || p_name
 WHEN 4 THEN 'What is the quality of the food near the ' || p_name || '?'
 WHEN 5 THEN 'Ask Q' || CAST(p_partkey AS VARCHAR(20)) || '. Why is the location of the ' || p_name || ' good?'
 WHEN 6 THEN CAST(p_partkey AS VARCHAR(20)) || ': Describe the flight to the ' || p_name
 WHEN 7 THEN p_name
 WHEN 8 THEN 'Do you recommend this trip (bus/train/plane to ' || p_name || ')?'
 WHEN 9 THEN '<b>Budget</b> & Planning: how   would you compare the price of a ' || p_name || '?'
 WHEN 10 THEN '签证 和 预算: 请描述 the tour of ' || p_name
 WHEN 11 THEN '...- what multiple hotels were booked by the guest with the ' || p_name || '?'
 WHEN 12 THEN '12) 景点推荐 ' || p_name || ' 如何?'
 ELSE 'Visa Policy: please evaluate and explain, from every perspective and in a comprehensive way, what the '
   || p_name || ' means for your travel, your stay, your food, your flight, your budget and for the trip of all others in your family or group'
END"""

KIND = """CASE p_size % 5 WHEN 0 THEN 'open_ended' WHEN 1 THEN 'yes_no' WHEN 2 THEN 'rating'
 WHEN 3 THEN 'single_choice' ELSE 'multiple_choice' END"""

SQL_VIEWS = {
    "questions": f"""SELECT p_partkey AS id, p_partkey AS seq, {WORDING} AS question_text, p_name AS short_text,
 p_type AS question_type, {KIND} AS kind, p_brand AS category, CAST(p_size AS DOUBLE) / 10 AS difficulty,
 list_transform(range(CAST(p_size % 9 AS BIGINT)),
   lambda i: CASE WHEN i = 5 THEN ' ' WHEN i = 3 THEN 'Please Select' WHEN i = 1 THEN 'Yes'
     ELSE chr(CAST(65 + i AS INTEGER)) || '. ' || p_name || ' ' || CAST(i AS VARCHAR) END) AS options,
 array_to_string(list_transform(range(CAST(p_size % 9 AS BIGINT)),
   lambda i: CASE WHEN p_size = 2 THEN '1-5 scale' WHEN i = 0 AND p_size % 4 = 1 THEN 'no' ELSE p_name || CAST(i AS VARCHAR) END), ' / ') AS options_text,
 CASE WHEN p_partkey % 3 = 0 THEN 'zh' ELSE 'en' END AS language,
 CASE WHEN p_partkey % 4 = 0 THEN 'generated' ELSE 'http://bank.example/' || p_brand END AS source_url,
 p_brand AS source_name FROM part""",
    "responses": """SELECT l_suppkey AS user_id, l_partkey AS question_id,
 CASE WHEN l_linestatus = 'O' THEN 'not_answered' ELSE l_returnflag END AS answer,
 l_returnflag <> 'R' AS effective FROM lineitem""",
    "questionnaires": """SELECT s_suppkey AS id, s_suppkey AS seq, s_name AS title, CAST(3 + s_suppkey % 8 AS INTEGER) AS question_count,
 ['Brand#' || CAST(1 + s_suppkey % 25 AS VARCHAR), 'Brand#' || CAST(1 + (s_suppkey * 7) % 25 AS VARCHAR)] AS categories,
 CAST(s_suppkey % 3 AS DOUBLE) / 2 AS low, CAST(s_suppkey % 3 AS DOUBLE) / 2 + 2.5 AS high,
 list_transform(range(1 + s_suppkey % 4), lambda i: s_suppkey * 5 + i * 11) AS question_ids FROM supplier""",
    "users": "SELECT c_custkey AS id, c_custkey AS seq, c_name AS username, c_mktsegment AS role FROM customer",
    "answer_log": """SELECT event_id, ts, user_id AS session_id,
 CAST(json_extract(props, '$.k') AS BIGINT) AS question_id, event_type AS answer FROM events""",
}


class Tables:
    """Given tables as attributes, entities as properties."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, f"{self.folder}/{name}.parquet", heavy=name in ("documents", "pages"))

    @cached_property
    def questions(self) -> DataFrame:
        n = F.expr("p_size % 9")
        steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        name, size = F.col("p_name"), F.col("p_size")
        options = F.transform(
            steps,
            lambda i: F.when(i == 5, " ").when(i == 3, "Please Select").when(i == 1, "Yes")
            .otherwise(F.concat(F.char(i + 65), F.lit(". "), name, F.lit(" "), i.cast("string"))),
        )
        joined = F.transform(
            steps,
            lambda i: F.when(size == 2, "1-5 scale").when((i == 0) & (size % 4 == 1), "no")
            .otherwise(F.concat(name, i.cast("string"))),
        )
        key = F.col("p_partkey")
        return self.part.select(
            key.alias("id"), key.alias("seq"), F.expr(WORDING).alias("question_text"), name.alias("short_text"),
            F.col("p_type").alias("question_type"), F.expr(KIND).alias("kind"), F.col("p_brand").alias("category"),
            (size.cast("double") / 10).alias("difficulty"), options.alias("options"),
            F.array_join(joined, " / ").alias("options_text"),
            F.when(key % 3 == 0, "zh").otherwise("en").alias("language"),
            F.when(key % 4 == 0, "generated").otherwise(F.concat(F.lit("http://bank.example/"), "p_brand")).alias("source_url"),
            F.col("p_brand").alias("source_name"),
        )

    @cached_property
    def responses(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("question_id"),
            F.when(F.col("l_linestatus") == "O", "not_answered").otherwise(F.col("l_returnflag")).alias("answer"),
            (F.col("l_returnflag") != "R").alias("effective"),
        )

    @cached_property
    def questionnaires(self) -> DataFrame:
        s = F.col("s_suppkey")
        low = (s % 3).cast("double") / 2
        return self.supplier.select(
            s.alias("id"), s.alias("seq"), F.col("s_name").alias("title"),
            (s % 8 + 3).cast("int").alias("question_count"),
            F.array(
                F.concat(F.lit("Brand#"), (s % 25 + 1).cast("string")),
                F.concat(F.lit("Brand#"), (s * 7 % 25 + 1).cast("string")),
            ).alias("categories"),
            F.array(low, low + 2.5).alias("difficulty_range"),
            F.transform(F.sequence(F.lit(0).cast("bigint"), s % 4), lambda i: s * 5 + i * 11).alias("question_ids"),
        )

    @cached_property
    def users(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.customer.select(
            c.alias("id"), c.alias("seq"), F.col("c_name").alias("username"), F.col("c_mktsegment").alias("role")
        )

    @cached_property
    def answer_log(self) -> DataFrame:
        return self.events.select(
            "event_id", "ts", F.col("user_id").alias("session_id"),
            F.get_json_object("props", "$.k").cast("bigint").alias("question_id"), F.col("event_type").alias("answer"),
        )
