"""Counting reports, response analysis and chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import big, check, r6
from surveyloom import lexicons as lex
from surveyloom.operators import counts, responses
from surveyloom.operators.correlation import correlated_pairs, correlation_matrix
from surveyloom.plans import cleaning, reports

CATEGORY = "CASE WHEN category IN ('Brand#1', 'Brand#2') THEN NULL ELSE category END"


def _with_gaps(t):
    """Questions some of which have no category and no type."""
    return t.questions.withColumn("category", F.expr(CATEGORY)).withColumn(
        "question_type", F.when(F.col("question_type") != "PROMO", F.col("question_type"))
    )


GAPS = f"""WITH g AS (SELECT * REPLACE ({CATEGORY} AS category,
 CASE WHEN question_type <> 'PROMO' THEN question_type END AS question_type) FROM questions)"""


@check("count_by_category", "A1", "questions", GAPS + """
SELECT coalesce(category, 'Uncategorized') AS category, count(*) AS count FROM g GROUP BY 1""")
def _(t):
    return counts.count_by_category(_with_gaps(t))


@check("count_by_type", "A2 L3", "questions", GAPS + """
SELECT coalesce(question_type, 'Unknown') AS question_type, count(*) AS count FROM g GROUP BY 1""")
def _(t):
    return counts.count_by_type(_with_gaps(t))


STATS = GAPS + """, s AS (SELECT 'total_questions' AS metric, '' AS key, count(*) AS value FROM g
 UNION ALL SELECT 'total_questionnaires', '', count(*) FROM questionnaires
 UNION ALL SELECT 'total_users', '', count(*) FROM users
 UNION ALL SELECT 'categories_distribution', coalesce(category, 'Uncategorized'), count(*) FROM g GROUP BY 2
 UNION ALL SELECT 'question_types_distribution', coalesce(question_type, 'Unknown'), count(*) FROM g GROUP BY 2)"""


@check("bank_statistics", "A3", "questions questionnaires users", STATS + " SELECT * FROM s")
def _(t):
    return counts.bank_statistics(_with_gaps(t), t.questionnaires, t.users)


@check("count_checks", "A20", "questions questionnaires users", STATS + """
SELECT 'category counts' AS check, (SELECT sum(value) FROM s WHERE metric = 'categories_distribution')
  = (SELECT value FROM s WHERE metric = 'total_questions') AS passed
UNION ALL SELECT 'type counts', (SELECT sum(value) FROM s WHERE metric = 'question_types_distribution')
  = (SELECT value FROM s WHERE metric = 'total_questions')""")
def _(t):
    return counts.count_checks(counts.bank_statistics(_with_gaps(t), t.questionnaires, t.users))


@check("answer_rate_by_type", "A4 J1 J2 F8 F9", "responses questions", """
SELECT q.question_type, count(*) AS total, CAST(sum(CASE WHEN answer <> 'not_answered' THEN 1 ELSE 0 END) AS BIGINT) AS answered,
 round(CAST(sum(CASE WHEN answer <> 'not_answered' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS answer_rate
FROM responses r JOIN questions q ON r.question_id = q.id WHERE effective GROUP BY 1""")
def _(t):
    rates = responses.answer_rate_by_type(t.responses, t.questions)
    return rates.withColumn("answer_rate", r6("answer_rate"))


@check("answer_rate_own_type", "A4 J2", "responses questions", """
WITH r AS (SELECT *, CASE question_id % 3 WHEN 0 THEN 'own' WHEN 1 THEN '' END AS own FROM responses)
SELECT coalesce(nullif(own, ''), nullif(q.kind, 'rating')) AS question_type, count(*) AS total,
 CAST(sum(CASE WHEN answer <> 'not_answered' THEN 1 ELSE 0 END) AS BIGINT) AS answered,
 round(CAST(sum(CASE WHEN answer <> 'not_answered' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS answer_rate
FROM r LEFT JOIN questions q ON r.question_id = q.id
WHERE effective AND coalesce(nullif(own, ''), nullif(q.kind, 'rating')) IS NOT NULL GROUP BY 1""")
def _(t):
    own = F.when(F.col("question_id") % 3 == 0, "own").when(F.col("question_id") % 3 == 1, "")
    bank = t.questions.withColumn("question_type", F.nullif("kind", F.lit("rating")))
    rates = responses.answer_rate_by_type(t.responses.withColumn("question_type", own), bank)
    return rates.withColumn("answer_rate", r6("answer_rate"))


@check("question_lookup_last_wins", "J1", "responses questions", """
WITH b AS (SELECT id, CASE WHEN id % 3 = 0 THEN kind ELSE category END AS category FROM questions)
SELECT b.category, count(*) AS n FROM responses r JOIN b ON r.question_id = b.id GROUP BY 1""")
def _(t):
    again = t.questions.filter(F.col("id") % 3 == 0).withColumns(
        {"seq": F.col("seq") + 10**12, "category": F.col("kind")}
    )
    bank = t.questions.unionByName(again)
    joined = responses.with_question_values(t.responses, bank, ["category"])
    return joined.groupBy("category").agg(F.count("*").alias("n"))


@check("ineffective_rate_by_category", "A5", "responses questions", """
SELECT q.category, count(*) AS total, CAST(sum(CASE WHEN NOT effective THEN 1 ELSE 0 END) AS BIGINT) AS ineffective,
 round(CAST(sum(CASE WHEN NOT effective THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS ineffective_rate
FROM responses r JOIN questions q ON r.question_id = q.id GROUP BY 1""")
def _(t):
    rates = responses.ineffective_rate_by_category(t.responses, t.questions)
    return rates.withColumn("ineffective_rate", r6("ineffective_rate"))


RATES = """WITH rates AS (SELECT user_id, category, count(*) AS total,
 CAST(sum(CASE WHEN answer <> 'not_answered' THEN 1 ELSE 0 END) AS BIGINT) AS answered,
 CAST(sum(CASE WHEN answer <> 'not_answered' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS rate
 FROM responses r JOIN questions q ON r.question_id = q.id WHERE effective GROUP BY 1, 2)"""


@check("user_category_rates", "A6", "responses questions", RATES + """
SELECT user_id, category, total, answered, round(rate, 6) AS rate FROM rates""")
def _(t):
    return responses.user_category_rates(t.responses, t.questions).withColumn("rate", r6("rate"))


@check("user_category_matrix", "A7 L2", "responses questions", RATES + "\nSELECT user_id, " + ", ".join(
    f"round(max(CASE WHEN category = 'Brand#{i}' THEN rate END), 6) AS \"Brand#{i}\"" for i in range(1, 26)
) + " FROM rates GROUP BY 1")
def _(t):
    matrix = responses.user_category_matrix(responses.user_category_rates(t.responses, t.questions))
    return matrix.select("user_id", *[r6(F.col(f"`{c}`")).alias(c) for c in matrix.columns if c != "user_id"])


@check("category_correlation", "A8 J7", "responses questions", RATES + """,
 pairs AS (SELECT a.category AS col_i, b.category AS col_j, count(*) AS n,
  CASE WHEN count(*) < 2 THEN 0.0 WHEN min(a.rate) = max(a.rate) OR min(b.rate) = max(b.rate) THEN NULL
   ELSE corr(a.rate, b.rate) END AS corr
  FROM rates a JOIN rates b ON a.user_id = b.user_id GROUP BY 1, 2),
 names AS (SELECT DISTINCT category FROM rates)
SELECT x.category AS col_i, y.category AS col_j, coalesce(n, 0) AS n,
 round(CASE WHEN n IS NULL THEN 0.0 ELSE corr END, 6) AS corr
FROM names x CROSS JOIN names y LEFT JOIN pairs p ON p.col_i = x.category AND p.col_j = y.category""")
def _(t):
    rates = responses.user_category_rates(t.responses, t.questions)
    return correlation_matrix(rates, "user_id", "category", "rate").withColumn("corr", r6("corr"))


@check("correlated_customers", "A8 J7", sql="""
WITH cells AS (SELECT o_custkey AS u, o_orderpriority AS c, avg(o_totalprice) AS v FROM orders GROUP BY 1, 2)
SELECT a.c AS col_i, b.c AS col_j, count(*) AS n,
 round(CASE WHEN count(*) < 2 THEN 0.0 WHEN min(a.v) = max(a.v) OR min(b.v) = max(b.v) THEN NULL ELSE corr(a.v, b.v) END, 6) AS corr
FROM cells a JOIN cells b ON a.u = b.u GROUP BY 1, 2""")
def _(t):
    cells = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.avg("o_totalprice").alias("v"))
    return correlated_pairs(cells, "o_custkey", "o_orderpriority", "v").withColumn("corr", r6("corr"))


@check("difficulty_levels", "A9", "questions", """
SELECT CAST(l AS BIGINT) AS level, count(id) AS count FROM range(1, 8) t(l) LEFT JOIN questions ON ceil(difficulty) = l GROUP BY 1""")
def _(t):
    leveled = t.questions.withColumn("level_of", F.ceil("difficulty"))
    return counts.level_counts(leveled, "level_of", [1, 2, 3, 4, 5, 6, 7]).withColumn("level", big("level"))


def _topic_sql(table: str, text: str, topics) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS topic, CAST(coalesce(sum(CASE WHEN "
        + " OR ".join(f"contains(lower({text}), '{w}')" for w in words)
        + f" THEN 1 ELSE 0 END), 0) AS BIGINT) AS count FROM {table}"
        for name, words in topics
    )


@check("topic_coverage", "A10 J10", "questions", _topic_sql("questions", "question_text", lex.TOPICS["en"]))
def _(t):
    return counts.topic_coverage(t.questions, lex.TOPICS["en"], "question_text")


DOC_TOPICS = [("the", ["the ", "thre"]), ("endings", ["ation", "heit", "eaux"]), ("rare", ["zebra"])]


@check("topic_coverage_documents", "A10", sql=_topic_sql("documents", "text", DOC_TOPICS))
def _(t):
    return counts.topic_coverage(t.documents, DOC_TOPICS, "text")


@check("count_by_platform", "A11", sql="SELECT source AS source_platform, count(*) AS count FROM documents GROUP BY 1")
def _(t):
    return counts.count_by_platform(t.documents.withColumnRenamed("source", "source_platform"))


FREQ = "WITH f AS (SELECT short_text, count(*) AS frequency, min(seq) AS seq FROM questions GROUP BY 1)"


@check("text_frequency", "A12", "questions", FREQ + " SELECT short_text, frequency FROM f")
def _(t):
    return counts.text_frequency(t.questions, "short_text")


@check("frequency_report", "A13 W3", "questions", FREQ + """
SELECT 'total_questions' AS metric, '' AS key, count(*) AS value FROM f
UNION ALL SELECT 'unique_questions', '', count(DISTINCT short_text) FROM f
UNION ALL (SELECT 'top_questions', short_text, frequency FROM f ORDER BY frequency DESC, seq LIMIT 10)
UNION ALL SELECT 'frequency_distribution', CAST(frequency AS VARCHAR), count(*) FROM f GROUP BY frequency""")
def _(t):
    frequencies = t.questions.groupBy("short_text").agg(F.count("*").alias("frequency"), F.min("seq").alias("seq"))
    return counts.frequency_report(frequencies, "short_text")


@check("crawl_statistics", "A14 W3", "questions", """
WITH n AS (SELECT count(*) AS n FROM questions),
 l AS (SELECT 'total' AS metric, '' AS key, count(*) AS value FROM questions
 UNION ALL SELECT 'with_options', '', count(*) FILTER (options_text <> '') FROM questions
 UNION ALL SELECT 'zh', '', count(*) FILTER (language = 'zh') FROM questions
 UNION ALL SELECT 'en', '', count(*) FILTER (language <> 'zh') FROM questions
 UNION ALL SELECT 'real', '', count(*) FILTER (source_url <> 'generated') FROM questions
 UNION ALL SELECT 'generated', '', count(*) FILTER (source_url = 'generated') FROM questions
 UNION ALL (SELECT 'category', category, count(*) FROM questions GROUP BY 2 ORDER BY count(*) DESC, min(seq) LIMIT 10)
 UNION ALL SELECT 'question_type', kind, count(*) FROM questions GROUP BY 2
 UNION ALL (SELECT 'source_name', source_name, count(*) FROM questions GROUP BY 2 ORDER BY count(*) DESC, min(seq) LIMIT 15))
SELECT metric, key, value, round(value * 100.0 / n, 6) AS percent FROM l, n""")
def _(t):
    stats = counts.crawl_statistics(t.questions.withColumn("question_type", F.col("kind")))
    return stats.withColumn("percent", r6("percent"))


@check("cleaning_counts", "A15 F5 F12", "questions", """
WITH n AS (SELECT *, regexp_matches(question_text, '[一-龥]') AS zh FROM questions WHERE length(short_text) > 8)
SELECT 'raw' AS stage, count(*) AS rows FROM questions UNION ALL SELECT 'valid', count(*) FROM n
UNION ALL SELECT 'en', count(*) FILTER (NOT zh) FROM n UNION ALL SELECT 'zh', count(*) FILTER (zh) FROM n""")
def _(t):
    from surveyloom.functions.text import detect_lang

    pool = t.questions.filter(F.length("short_text") > 8).withColumn("detected_lang", detect_lang(F.col("question_text")))
    return cleaning.cleaning_report(t.questions, pool)


@check("category_chart", "A17 F10", "questions", """
SELECT category, count(*) AS count FROM questions WHERE lower(category) <> 'general' GROUP BY 1""")
def _(t):
    return counts.category_chart(t.questions)


HISTOGRAM = """WITH b AS (SELECT min({v}) AS lo, (max({v}) - min({v})) / 6 AS w FROM {t}),
 e AS (SELECT i, lo + i * w AS a, lo + (i + 1) * w AS z FROM b, range(6) r(i))
SELECT CAST(i AS BIGINT) AS bin, round(any_value(a), 6) AS bin_from, round(any_value(z), 6) AS bin_to, count({v}) AS count
FROM e LEFT JOIN {t} ON {v} >= a AND ({v} < z OR i = 5) GROUP BY i"""


@check("difficulty_histogram", "A18", "questions", HISTOGRAM.format(v="difficulty", t="questions"))
def _(t):
    return counts.histogram(t.questions, "difficulty").select(
        big("bin").alias("bin"), r6("bin_from").alias("bin_from"), r6("bin_to").alias("bin_to"), "count"
    )


@check("value_histogram", "A18", sql=HISTOGRAM.format(v="value", t="events"))
def _(t):
    return counts.histogram(t.events, "value").select(
        big("bin").alias("bin"), r6("bin_from").alias("bin_from"), r6("bin_to").alias("bin_to"), "count"
    )


@check("difficulty_curve", "A19", "questions", """
WITH s AS (SELECT count(*) AS n, min(difficulty) AS lo, max(difficulty) AS hi, stddev_samp(difficulty) * pow(count(*), -0.2) AS h FROM questions),
 g AS (SELECT i, lo + i * (hi - lo) / 49 AS grid_x, n, h FROM s, range(50) r(i))
SELECT CAST(i AS BIGINT) AS point, round(any_value(grid_x), 6) AS grid_x,
 round(sum(exp(-0.5 * pow((grid_x - difficulty) / h, 2)) / (n * h * sqrt(2 * pi()))), 6) AS density
FROM g, questions GROUP BY i""")
def _(t):
    return counts.density_curve(t.questions, "difficulty").select(
        big("point").alias("point"), r6("grid_x").alias("grid_x"), r6("density").alias("density")
    )


@check("distinct_categories", "A21 L2", "questions", "SELECT DISTINCT category FROM questions")
def _(t):
    return counts.distinct_values(t.questions, "category")


@check("system_statistics", "A22", "questions questionnaires users responses", """
SELECT 'total_questions' AS metric, CAST(count(*) AS DOUBLE) AS value FROM questions
UNION ALL SELECT 'total_questionnaires', count(*) FROM questionnaires UNION ALL SELECT 'total_users', count(*) FROM users
UNION ALL SELECT 'completion_rate', round(avg(CASE WHEN answer <> 'not_answered' THEN 1.0 ELSE 0.0 END), 6) FROM responses""")
def _(t):
    stats = counts.system_statistics(t.questions, t.questionnaires, t.users, t.responses)
    return stats.withColumn("value", r6("value"))


@check("platform_comparison", "A23", "questions", """
SELECT source_name, count(*) AS questions, round(avg(CASE WHEN options_text <> '' THEN 1.0 ELSE 0.0 END), 6) AS options_share,
 round(avg(difficulty), 6) AS mean_difficulty, count(DISTINCT question_text) AS distinct_texts FROM questions GROUP BY 1""")
def _(t):
    compared = counts.platform_comparison(t.questions)
    return compared.withColumns({c: r6(c) for c in ("options_share", "mean_difficulty")})


@check("progress_summary", "A24", "answer_log", """
WITH u AS (SELECT session_id * 1000 + question_id AS user_id, count(*) AS assigned, count(*) FILTER (answer <> 'view') AS answered
  FROM answer_log GROUP BY 1)
SELECT CASE WHEN answered = 0 THEN 'none' WHEN answered < assigned THEN 'partial' ELSE 'complete' END AS state,
 count(*) AS users, CAST(sum(answered) AS BIGINT) AS answered, CAST(sum(assigned) AS BIGINT) AS assigned FROM u GROUP BY 1""")
def _(t):
    log = t.answer_log.select(
        (F.col("session_id") * 1000 + F.col("question_id")).alias("user_id"),
        F.when(F.col("answer") == "view", lex.NOT_ANSWERED).otherwise(F.col("answer")).alias("answer"),
    )
    return counts.progress_summary(log)


TYPES = RATES + """, types AS (SELECT user_id, count(*) AS categories, CAST(sum(answered) AS BIGINT) AS answered,
 CAST(sum(total) AS BIGINT) AS total, max(rate) AS best_rate FROM rates GROUP BY 1),
 typed AS (SELECT t.*, (SELECT min(category) FROM rates r WHERE r.user_id = t.user_id AND r.rate = t.best_rate) AS user_type FROM types t)"""


@check("user_types", "A25", "responses questions", TYPES + """
SELECT user_id, categories, answered, total, user_type, round(best_rate, 6) AS best_rate FROM typed""")
def _(t):
    types = reports.user_types(responses.user_category_rates(t.responses, t.questions))
    return types.withColumn("best_rate", r6("best_rate"))


@check("user_key_answers", "A25", "responses questions", TYPES + """
SELECT r.user_id, r.question_id, r.answer, count(*) AS n FROM responses r JOIN questions q ON r.question_id = q.id
 JOIN typed t ON t.user_id = r.user_id AND t.user_type = q.category WHERE r.answer <> 'not_answered' GROUP BY 1, 2, 3""")
def _(t):
    answers = reports.survey_report(t.responses, t.questions)["key_answers"]
    return answers.groupBy("user_id", "question_id", "answer").agg(F.count("*").alias("n"))


@check("all_users_report", "A26", "responses questions", TYPES + """
SELECT 'total_users' AS metric, '' AS key, CAST(count(*) AS DOUBLE) AS value FROM typed
UNION ALL SELECT 'completion_rate', '', round(CAST(sum(answered) AS DOUBLE) / sum(total), 6) FROM typed
UNION ALL SELECT 'users_per_type', user_type, count(*) FROM typed GROUP BY 2""")
def _(t):
    types = reports.user_types(responses.user_category_rates(t.responses, t.questions))
    return reports.all_users_report(types).withColumn("value", r6("value"))


@check("analyze_results", "A27", "responses questions", RATES + """
SELECT 'answer_rate' AS part, q.question_type AS key, round(CAST(count(*) FILTER (answer <> 'not_answered') AS DOUBLE) / count(*), 6) AS value
 FROM responses r JOIN questions q ON r.question_id = q.id WHERE effective GROUP BY 2
UNION ALL SELECT 'ineffective_rate', q.category, round(CAST(count(*) FILTER (NOT effective) AS DOUBLE) / count(*), 6)
 FROM responses r JOIN questions q ON r.question_id = q.id GROUP BY 2
UNION ALL SELECT 'user_rates', category, round(avg(rate), 6) FROM rates GROUP BY 2
UNION ALL SELECT 'correlation', key, round(coalesce(corr, 0.0), 6) FROM (
 SELECT x.category || ' / ' || y.category AS key, CASE WHEN n IS NULL THEN 0.0 ELSE corr END AS corr
 FROM (SELECT DISTINCT category FROM rates) x CROSS JOIN (SELECT DISTINCT category FROM rates) y
 LEFT JOIN (SELECT a.category AS i, b.category AS j, count(*) AS n, CASE WHEN count(*) < 2 THEN 0.0
   WHEN min(a.rate) = max(a.rate) OR min(b.rate) = max(b.rate) THEN NULL ELSE corr(a.rate, b.rate) END AS corr
  FROM rates a JOIN rates b ON a.user_id = b.user_id GROUP BY 1, 2) p ON p.i = x.category AND p.j = y.category)""")
def _(t):
    parts = reports.analyze_results(t.responses, t.questions)

    def line(part, key, value):
        return parts[part].select(F.lit(part).alias("part"), F.col(key).alias("key"), r6(value).alias("value"))

    rates, pairs = parts["user_rates"].groupBy("category").agg(F.avg("rate").alias("rate")), parts["correlation"]
    return (
        line("answer_rate", "question_type", "answer_rate")
        .unionByName(line("ineffective_rate", "category", "ineffective_rate"))
        .unionByName(rates.select(F.lit("user_rates").alias("part"), F.col("category").alias("key"), r6("rate").alias("value")))
        .unionByName(pairs.select(F.lit("correlation").alias("part"), F.concat_ws(" / ", "col_i", "col_j").alias("key"), r6(F.coalesce("corr", F.lit(0.0))).alias("value")))
    )


@check("complexity_shares", "A28", "questions", """
SELECT kind, count(*) AS count, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM questions), 6) AS share FROM questions GROUP BY 1""")
def _(t):
    return counts.share_by(t.questions, "kind").withColumn("share", r6("share"))
