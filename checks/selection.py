"""Sources, ids, sinks, selection, edits and enlargement over all questions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.registry import big, check
from surveyloom import lexicons as lex
from surveyloom import sources
from surveyloom.functions import predicates as pred
from surveyloom.operators import edits
from surveyloom.operators import selection as sel
from surveyloom.session import shared_folder


def _documents(rows, name: str, item):
    """Documents of up to seven elements each, in the order of ``seq``, over several files."""
    packed = rows.groupBy(F.expr("(seq - 1) div 7").alias("part")).agg(F.array_sort(F.collect_list(F.struct("seq", item.alias("item")))).alias("items"))
    ordered = packed.repartitionByRange("part").sortWithinPartitions("part")
    return ordered.select(F.transform("items", lambda x: x["item"]).alias(name))


def _scratch(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


@check("bank_scan", "S1 S2 S5", "questions", """
SELECT row_number() OVER (ORDER BY seq) - 1 AS seq, id, question_text, question_type, difficulty, category, category || '|' || language AS tags,
 array_to_string(list_transform(string_split(nullif(options_text, ''), '/'), lambda x: trim(x)), '|') AS options FROM questions""")
def _(t):
    path = _scratch(t, "bank")
    question = F.struct(
        "id", "question_text", "question_type", F.nullif("options_text", F.lit("")).alias("options"),
        "difficulty", "category", F.array("category", "language").alias("tags"), F.lit(0).alias("usage_count"),
    )
    _documents(t.questions, "questions", question).write.json(path)
    return sources.bank_questions(sources.read_bank(t.spark, path, multi_line=False)).select(
        "seq", "id", "question_text", "question_type", "difficulty", "category",
        F.array_join("tags", "|").alias("tags"), F.array_join("options", "|").alias("options"),
    )


@check("all_questionnaires", "S2", "questionnaires", "SELECT id, title, question_count FROM questionnaires")
def _(t):
    return t.questionnaires.select("id", "title", big("question_count").alias("question_count"))


@check("all_users", "S2", "users", "SELECT id, username, role FROM users")
def _(t):
    return t.users.select("id", "username", "role")


@check("question_list_scan", "S3", "questions", "SELECT row_number() OVER (ORDER BY seq) - 1 AS seq, question_text, options_text, category, language, source_url FROM questions")
def _(t):
    folder = _scratch(t, "list")
    item = F.struct("question_text", "options_text", F.col("kind").alias("question_type"), "category", "language", "source_url", "source_name")
    _documents(t.questions, "fullContent", item).write.json(folder)
    return sources.read_question_list(t.spark, folder, multi_line=False).select("seq", "question_text", "options_text", "category", "language", "source_url")


@check("responses_scan", "S4", "responses", """
SELECT user_id, question_id, answer, effective, row_number() OVER (ORDER BY user_id, question_id, answer, effective) - 1 AS seq FROM responses""")
def _(t):
    folder = _scratch(t, "responses")
    item = F.struct("user_id", "question_id", "answer", "effective")
    order = ["user_id", "question_id", "answer", "effective"]
    t.responses.repartitionByRange(*order).sortWithinPartitions(*order).select(F.array(item).alias("responses")).write.json(folder)
    return sources.read_responses(t.spark, folder, multi_line=False).select("seq", "user_id", "question_id", "answer", "effective")


@check("convert_rows", "S6 C20", "questions", """
SELECT seq + 1 AS id, question_text, CASE WHEN seq % 4 = 0 THEN 'text' ELSE kind END AS question_type, options_text AS options,
 2.0::DOUBLE AS difficulty, CASE WHEN seq % 5 = 0 THEN 'general' ELSE category END AS category,
 (CASE WHEN seq % 5 = 0 THEN 'general' ELSE category END) || '|' || (CASE WHEN seq % 7 = 0 THEN 'en' ELSE language END) AS tags,
 CAST(0 AS BIGINT) AS usage_count FROM questions""")
def _(t):
    rows = t.questions.select(
        "seq", "question_text", "options_text",
        F.when(F.col("seq") % 4 != 0, F.col("kind")).alias("question_type"),
        F.when(F.col("seq") % 5 != 0, F.col("category")).alias("category"),
        F.when(F.col("seq") % 7 != 0, F.col("language")).alias("language"),
    )
    return sources.convert_rows(rows).drop("seq").withColumn("tags", F.array_join("tags", "|"))


@check("json_sink", "S7", "questions", "SELECT seq, question_text, options_text, difficulty FROM questions")
def _(t):
    path = _scratch(t, "json")
    rows = t.questions.select("seq", "question_text", "options_text", "difficulty")
    sources.write_json(rows, path)
    return t.spark.read.schema(rows.schema).json(path)


@check("csv_sink", "S8", "questions", "SELECT seq, question_text, array_to_string(options, ' / ') AS options, difficulty FROM questions")
def _(t):
    path = _scratch(t, "csv")
    rows = t.questions.select("seq", "question_text", "options", "difficulty")
    sources.write_csv(rows, path)
    back = t.spark.read.option("header", True).option("escape", '"').option("emptyValue", "").schema(
        "seq bigint, question_text string, options string, difficulty double"
    ).csv(path)
    return back.withColumn("options", F.coalesce("options", F.lit("")))


@check("append_unique", "S9 D1", "questions", """
WITH a AS (SELECT short_text, min(seq) AS seq FROM questions WHERE seq % 2 = 0 GROUP BY 1),
 b AS (SELECT short_text, min(seq) AS seq FROM questions WHERE seq % 2 = 1 AND short_text NOT IN (SELECT short_text FROM a) GROUP BY 1),
 r AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT seq, short_text, (SELECT count(*) FROM a) AS first_added, (SELECT count(*) FROM b) AS then_added FROM r""")
def _(t):
    path = _scratch(t, "bank")
    rows = t.questions.select("seq", "short_text")
    first, second = sel.split_by(rows, F.col("seq") % 2 == 0)
    first.limit(0).write.parquet(path)
    added = [sources.append_unique(path, part, "short_text") for part in (first, second)]
    return t.spark.read.parquet(path).withColumns(
        {"first_added": F.lit(added[0]).cast("bigint"), "then_added": F.lit(added[1]).cast("bigint")}
    )


@check("seed_pages", "S10 U1", sql="""
SELECT 0 AS list, page_id AS seq, url, 'a' AS source_name FROM pages UNION ALL SELECT 1, page_id, url, 'b' FROM pages""")
def _(t):
    seeds = sources.seed_pages(*[t.pages.withColumn("source_name", F.lit(n)).withColumn("seq", F.col("page_id")) for n in ("a", "b")])
    return seeds


INGEST = """WITH good AS (SELECT * FROM questions WHERE length(short_text) > 8 AND options_text <> ''),
 known AS (SELECT DISTINCT short_text FROM questions WHERE options_text = ''),
 f AS (SELECT short_text, min(seq) AS seq FROM good WHERE short_text NOT IN (SELECT short_text FROM known) GROUP BY 1)"""


@check("ingest_raw", "S11 D1 S12", "questions", INGEST + """
SELECT seq, 'Q' || lpad(CAST(row_number() OVER (ORDER BY seq) - 1 AS VARCHAR), 4, '0') AS question_id, 'added' AS outcome FROM f
UNION ALL SELECT seq, NULL, 'invalid' FROM questions WHERE NOT (length(short_text) > 8 AND options_text <> '')
UNION ALL SELECT seq, NULL, 'duplicate' FROM good WHERE seq NOT IN (SELECT seq FROM f)""")
def _(t):
    raw = t.questions.withColumn("text", F.col("short_text"))
    known = raw.filter(F.col("options_text") == "").select("text")
    result = edits.ingest_raw(raw, known, pred.longer_than(F.col("text"), 8) & pred.not_empty(F.col("options_text")))
    return result.accepted.select("seq", "question_id", F.lit("added").alias("outcome")).unionByName(
        result.rejected.select("seq", F.lit(None).cast("string").alias("question_id"), F.col("reason").alias("outcome"))
    )


@check("ingest_summary", "S11", "questions", INGEST + """
SELECT 'added' AS outcome, count(*) AS rows FROM f
UNION ALL SELECT 'invalid', count(*) FROM questions WHERE NOT (length(short_text) > 8 AND options_text <> '')
UNION ALL SELECT 'duplicate', (SELECT count(*) FROM good) - (SELECT count(*) FROM f)""")
def _(t):
    raw = t.questions.withColumn("text", F.col("short_text"))
    known = raw.filter(F.col("options_text") == "").select("text")
    return edits.ingest_raw(
        raw, known, pred.longer_than(F.col("text"), 8) & pred.not_empty(F.col("options_text"))
    ).summary


@check("dense_positions", "S12", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS idx FROM lineitem""")
def _(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return sources.ordered_index(t.lineitem.select(*keys), keys).withColumn("l_linenumber", big("l_linenumber"))


@check("rank_within_groups", "S12 W1", sql="""
SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents""")
def _(t):
    return sources.ranked_within(t.documents.select("source", "doc_id"), ["source"], ["doc_id"])


@check("preview", "S13", "questions", "SELECT seq, substr(question_text, 1, 80) AS sample FROM questions ORDER BY seq LIMIT 3")
def _(t):
    return sel.preview(t.questions, "question_text")


@check("rows_by_ids", "F1", "questions responses", """
SELECT id, question_text FROM questions WHERE id IN (SELECT question_id FROM responses WHERE NOT effective)""")
def _(t):
    wanted = t.responses.filter(~F.col("effective")).select(F.col("question_id").alias("id"))
    return sel.rows_by_ids(t.questions, wanted).select("id", "question_text")


@check("question_by_id", "F1", "questions", "SELECT id, question_text FROM questions WHERE id = 17")
def _(t):
    return sel.by_id(t.questions, 17).select("id", "question_text")


@check("questions_by_category", "F2", "questions", "SELECT id FROM questions WHERE category = 'Brand#7'")
def _(t):
    return sel.by_value(t.questions, "category", "Brand#7").select("id")


@check("questions_by_platform", "F3", sql="SELECT doc_id FROM documents WHERE source = 'src3'")
def _(t):
    return sel.by_value(t.documents, "source", "src3").select("doc_id")


@check("select_by_difficulty", "F13", "questions", "SELECT id FROM questions WHERE difficulty BETWEEN 1.0 AND 2.5")
def _(t):
    return sel.by_difficulty(t.questions, 1.0, 2.5).select("id")


@check("select_by_categories", "F14", "questions", "SELECT id FROM questions WHERE category IN ('Brand#3', 'Brand#11')")
def _(t):
    return sel.by_categories(t.questions, ["Brand#3", "Brand#11"]).select("id")


@check("link_checks", "J3", "questionnaires questions", """
SELECT p_partkey AS seq, p_partkey % 150 AS questionnaire_id, p_partkey * 2 AS question_id,
 p_partkey % 150 IN (SELECT id FROM questionnaires) AND p_partkey * 2 IN (SELECT id FROM questions) AS ok FROM part""")
def _(t):
    key = F.col("p_partkey")
    requests = t.part.select(key.alias("seq"), (key % 150).alias("questionnaire_id"), (key * 2).alias("question_id"))
    return edits.check_links(requests, t.questionnaires, t.questions)


@check("expand_questionnaires", "J4", "questionnaires questions", """
WITH l AS (SELECT id AS questionnaire_id, unnest(question_ids) AS question_id, generate_subscripts(question_ids, 1) - 1 AS position FROM questionnaires)
SELECT l.questionnaire_id, CAST(l.position AS BIGINT) AS position, l.question_id, q.question_text FROM l JOIN questions q ON q.id = l.question_id""")
def _(t):
    rows = sel.expand_questionnaires(t.questionnaires, t.questions)
    return rows.select("questionnaire_id", big("position").alias("position"), "question_id", "question_text")


@check("questions_for_requirements", "J5 W2 F13 F14", "questionnaires questions", """
SELECT questionnaire_id, rank, question_id, category, difficulty FROM (
 SELECT n.id AS questionnaire_id, n.question_count, q.id AS question_id, q.category, q.difficulty,
  row_number() OVER (PARTITION BY n.id ORDER BY q.id) AS rank
 FROM questionnaires n JOIN questions q ON list_contains(n.categories, q.category) AND q.difficulty BETWEEN n.low AND n.high)
WHERE rank <= question_count""")
def _(t):
    chosen = sel.questions_for_requirements(t.questions, t.questionnaires)
    return chosen.withColumn("rank", big("rank"))


@check("random_questions", "L5", "questions", "SELECT id FROM questions ORDER BY md5(CAST(id AS VARCHAR) || '-11'), id LIMIT 25")
def _(t):
    return sel.random_questions(t.questions, 25, 11).select("id")


VARIANT_PICK = "CAST('0x' || substr(md5('{s}-' || CAST(v AS VARCHAR) || '-5'), 1, 15) AS BIGINT)"


def _variant_sql() -> str:
    arms = ""
    for word, synonyms in lex.VARIANT_WORDS:
        pick = f"{VARIANT_PICK.format(s=word)} % {len(synonyms)} + 1"
        options = ", ".join(f"'{x}'" for x in synonyms)
        arms += f" WHEN contains(question_text, '{word}') THEN replace(question_text, '{word}', list_extract([{options}], {pick}))"
    return f"CASE{arms} ELSE question_text END"


@check("enlarge_bank", "L6", "questions", f"""
WITH n AS (SELECT count(*) AS n FROM questions), base AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS b FROM questions),
 v AS (SELECT v, {VARIANT_PICK.format(s='row')} % n AS b FROM n, range(n // 2) r(v))
SELECT CAST(NULL AS BIGINT) AS variant, seq, question_text, source_name, source_url FROM questions
UNION ALL SELECT v, seq, {_variant_sql()}, 'Generated-' || source_name, 'generated' FROM v JOIN base ON v.b = base.b""")
def _(t):
    have = t.questions.count()
    rows = edits.enlarge_bank(t.questions, have + have // 2, 5, lex.VARIANT_WORDS)
    return rows.select("variant", "seq", "question_text", "source_name", "source_url")


@check("append_questions", "U2 S12", "questions", """
SELECT id, seq, usage_count FROM (SELECT id, seq, CAST(9 AS BIGINT) AS usage_count FROM questions
 UNION ALL SELECT (SELECT max(id) FROM questions) + row_number() OVER (ORDER BY doc_id), doc_id, 0 FROM documents)""")
def _(t):
    bank = t.questions.select("id", "seq", "question_text", F.lit(9).cast("bigint").alias("usage_count"))
    new = t.documents.select(F.col("doc_id").alias("seq"), F.col("text").alias("question_text"))
    return edits.append_questions(bank, new).select("id", "seq", "usage_count")


@check("create_questionnaires", "U3", "questionnaires", """
SELECT id, title, status, n FROM (SELECT id, title, 'open' AS status, CAST(len(question_ids) AS BIGINT) AS n FROM questionnaires
 UNION ALL SELECT (SELECT max(id) FROM questionnaires) + row_number() OVER (ORDER BY c_custkey), c_name, 'draft', 0 FROM customer)""")
def _(t):
    existing = t.questionnaires.select("id", "seq", "title", "question_ids", F.lit("open").alias("status"))
    new = t.customer.select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("title"))
    created = edits.create_questionnaires(existing, new)
    return created.select("id", "title", "status", big(F.size("question_ids")).alias("n"))


LINKS = """WITH req AS (SELECT p_partkey AS seq, p_partkey % 150 AS questionnaire_id, (p_partkey % 150) * 5 + p_partkey % 31 AS question_id FROM part),
 ok AS (SELECT *, questionnaire_id IN (SELECT id FROM questionnaires) AND question_id IN (SELECT id FROM questions) AS ok FROM req),
 old AS (SELECT id AS questionnaire_id, unnest(question_ids) AS question_id FROM questionnaires),
 fresh AS (SELECT questionnaire_id, question_id, min(seq) AS seq FROM ok WHERE ok AND (questionnaire_id, question_id) NOT IN (SELECT (questionnaire_id, question_id) FROM old) GROUP BY 1, 2),
 added AS (SELECT f.*, len(n.question_ids) + row_number() OVER (PARTITION BY questionnaire_id ORDER BY f.seq) - 1 AS position FROM fresh f JOIN questionnaires n ON n.id = f.questionnaire_id)"""


def _links(t):
    key = F.col("p_partkey")
    requests = t.part.select(
        key.alias("seq"), (key % 150).alias("questionnaire_id"), (key % 150 * 5 + key % 31).alias("question_id")
    )
    return edits.link_questions(requests, t.questionnaires, t.questions)


@check("link_questions", "U4 J3 J9 D1", "questionnaires questions", LINKS + """
SELECT questionnaire_id, question_id, seq, CAST(position AS BIGINT) AS position FROM added""")
def _(t):
    return _links(t).added.withColumn("position", big("position"))


@check("link_status", "U4 J3", "questionnaires questions", LINKS + " SELECT seq, questionnaire_id, question_id, ok FROM ok")
def _(t):
    return _links(t).status


@check("apply_links", "U4", "questionnaires questions", LINKS + """
SELECT 'link' AS kind, id, concat(pos - 1, ':', question_id) AS value FROM (
  SELECT id, unnest(question_ids) AS question_id, generate_subscripts(question_ids, 1) AS pos FROM questionnaires)
UNION ALL SELECT 'link', questionnaire_id, concat(position, ':', question_id) FROM added
UNION ALL SELECT 'usage', q.id, CAST((SELECT count(*) FROM added a WHERE a.question_id = q.id) AS VARCHAR) FROM questions q""")
def _(t):
    links, bank = edits.apply_links(
        t.questionnaires, t.questions.withColumn("usage_count", F.lit(0).cast("bigint")), _links(t)
    )
    rows = links.select(
        F.lit("link").alias("kind"), F.col("questionnaire_id").alias("id"), F.concat_ws(":", "position", "question_id").alias("value")
    )
    return rows.unionByName(
        bank.select(F.lit("usage").alias("kind"), "id", F.col("usage_count").cast("string").alias("value"))
    )


