"""Scalar rules and row tests over all questions, documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import big, check, r6
from surveyloom import lexicons as lex
from surveyloom.functions import options as opt
from surveyloom.functions import predicates as pred
from surveyloom.functions import rules, scoring
from surveyloom.functions import text as txt
from surveyloom.operators import responses as resp
from surveyloom.operators import selection as sel
from surveyloom.plans import cleaning


def _has(column: str, words: list[str]) -> str:
    """SQL: any of the words occurs."""
    return "(" + " OR ".join("contains(%s, '%s')" % (column, w.replace("'", "''")) for w in words) + ")"


def _groups(column: str, groups) -> str:
    arms = " ".join(f"WHEN {_has(column, words)} THEN '{name}'" for name, words in groups)
    return f"CASE {arms} ELSE 'general' END"


CLEAN_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace({0}, '<[^>]+>', '', 'g'),
 '[^\p{{L}}\p{{N}}_\s.?!]', ' ', 'g'), '\s+', ' ', 'g'))"""
STRIP_SQL = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
NUMBERED_SQL = r"regexp_replace(regexp_replace({0}, '(?i)^\s*ask\s+', ''), '(?i)^\s*(?:Q\s*)?[0-9]+[.:\s]\s*', '')"
CLEAN_QUESTION_SQL = (
    "CASE WHEN regexp_matches({n}, '[a-zA-Z一-龥]') THEN "
    + STRIP_SQL.format(r"regexp_extract({n}, '[a-zA-Z一-龥][\s\S]*$')")
    + " ELSE "
    + STRIP_SQL.format("{n}")
    + " END"
)
TYPE_SQL = (
    "CASE WHEN {o} = '' OR {o} IS NULL THEN 'open_ended' WHEN "
    + _has("lower({o})", lex.RATING_MARKS)
    + r" THEN 'rating' WHEN regexp_matches(lower({o}), '\b(yes|no|是|否)\b') THEN 'yes_no' WHEN "
    + _has("lower({t})", lex.MULTIPLE_MARKS)
    + " THEN 'multiple_choice' ELSE 'single_choice' END"
)
OPTIONS_SQL = r"""list_filter(list_transform(list_filter(list_transform({o}[1:10], lambda x: trim(x)),
 lambda x: length(x) BETWEEN 1 AND 99), lambda x: regexp_replace(x, '^[A-Z0-9①-⑩][.)、．]\s*', '')),
 lambda x: x <> '' AND x NOT IN ('请选择', 'Please Select', '其他'))"""
STANDARD_SQL = r"""list_filter(list_transform({o}, lambda x: trim(regexp_replace(regexp_replace(trim(x),
 '{p}', ''), '\s+', ' ', 'g'))), lambda x: x <> '')"""
STRICT = r"^[A-Za-z0-9][.、)）]\s*"
LENIENT = r"^[A-Za-z0-9][.、)）]?\s*"
COUNT_TYPE_SQL = """CASE WHEN len({o}) = 0 THEN 'open_ended'
 WHEN len({o}) = 2 AND list_has_any({o}, ['Yes', 'No', 'Have', 'Don''t have']) THEN 'yes_no'
 WHEN len({o}) <= 4 THEN 'single_choice' ELSE 'multiple_choice' END"""
SCORE_SQL = (
    "(CASE WHEN length({t}) > 60 THEN 3 WHEN length({t}) > 40 THEN 2 WHEN length({t}) > 20 THEN 1 ELSE 0 END"
    " + CASE WHEN len({o}) > 6 THEN 2 WHEN len({o}) > 4 THEN 1 ELSE 0 END"
    " + CASE WHEN {k} = 'open_ended' THEN 2 WHEN {k} = 'multiple_choice' THEN 1 ELSE 0 END"
    " + CASE WHEN " + _has("{t}", lex.COMPLEXITY_HARD_WORDS["en"]) + " THEN 2 ELSE 0 END)"
)
COMPLEXITY_SQL = f"CASE WHEN {SCORE_SQL} >= 6 THEN 'hard' WHEN {SCORE_SQL} >= 3 THEN 'medium' ELSE 'easy' END"
WORDS_SQL = r"len(list_filter(regexp_split_to_array({t}, '\s+'), lambda w: w <> ''))"
DIFFICULTY_SQL = (
    "least(5, greatest(1, 1 + CASE WHEN contains(lower({k}), 'open_ended') THEN 2"
    " WHEN contains(lower({k}), 'multiple_choice') OR contains(lower({k}), 'single_choice') THEN 1 ELSE 0 END"
    " + CASE WHEN {l} = 'en' THEN CASE WHEN " + WORDS_SQL + " > 30 THEN 2 WHEN " + WORDS_SQL + " > 15 THEN 1 ELSE 0 END"
    " ELSE CASE WHEN length({t}) > 50 THEN 2 WHEN length({t}) > 20 THEN 1 ELSE 0 END END"
    " + CASE WHEN {o} <> '' AND len(string_split({o}, '/')) > 6 THEN 1 ELSE 0 END"
    " + CASE WHEN ({l} = 'en' AND " + _has("lower({t})", lex.DIFFICULTY_HARD_WORDS["en"]) + ") OR ({l} <> 'en' AND "
    + _has("lower({t})", lex.DIFFICULTY_HARD_WORDS["zh"]) + ") THEN 1 ELSE 0 END))"
)
LANG_SQL = "CASE WHEN regexp_matches({t}, '[一-龥]') THEN 'zh' ELSE 'en' END"
TOPIC_SQL = (
    "(length({t}) BETWEEN 8 AND 500 AND " + _has("lower({t})", lex.QUESTION_MARKERS)
    + " AND " + _has("lower({t})", lex.TRAVEL_KEYWORDS) + ")"
)
KEYWORD_SQL = "CASE " + " ".join(
    "WHEN contains({t}, '%s') THEN '%s'" % pair for pair in lex.CLEANING_CATEGORIES
) + " ELSE 'general' END"


@check("clean_text", "C1", sql=f"""SELECT doc_id, md5({CLEAN_SQL.format('text')}) AS cleaned FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.md5(txt.clean_text(F.col("text"))).alias("cleaned"))


@check("clean_text_pages", "C1", sql=f"""SELECT page_id, md5({CLEAN_SQL.format('html')}) AS cleaned FROM pages""")
def _(t):
    return t.pages.select("page_id", F.md5(txt.clean_text(F.col("html"))).alias("cleaned"))


@check("clean_question_text", "C2", "questions", f"""
WITH n AS (SELECT seq, {NUMBERED_SQL.format('question_text')} AS x FROM questions)
SELECT seq, {CLEAN_QUESTION_SQL.format(n='x')} AS cleaned FROM n""")
def _(t):
    return t.questions.select("seq", txt.clean_question_text(F.col("question_text")).alias("cleaned"))


@check("strip_numbering", "C3", "questions", r"""
SELECT seq, regexp_replace(question_text, '^[0-9]+[.)、]\s*', '') AS bare FROM questions""")
def _(t):
    return t.questions.select("seq", txt.strip_numbering(F.col("question_text")).alias("bare"))


@check("strip_blanks", "C4", sql=f"""
SELECT doc_id, md5({STRIP_SQL.format("chr(10) || '  ' || text || chr(9) || chr(10)")}) AS stripped FROM documents""")
def _(t):
    padded = F.concat(F.lit("\n  "), "text", F.lit("\t\n"))
    return t.documents.select("doc_id", F.md5(txt.strip(padded)).alias("stripped"))


@check("crawled_options", "C5 W5", "questions", f"""
WITH o AS (SELECT seq, {OPTIONS_SQL.format(o='options')} AS kept FROM questions)
SELECT seq, CASE WHEN len(kept) >= 2 THEN array_to_string(kept, ' / ') END AS joined FROM o""")
def _(t):
    return t.questions.select("seq", opt.join_crawled_options(F.col("options")).alias("joined"))


@check("standard_options", "C6", "questions", f"""
WITH o AS (SELECT seq, {STANDARD_SQL.format(o='options', p=STRICT)} AS strict,
  {STANDARD_SQL.format(o='options', p=LENIENT)} AS lenient FROM questions)
SELECT seq, array_to_string(CASE WHEN len(strict) > 0 THEN strict ELSE ['Yes', 'No'] END, '|') AS strict,
 array_to_string(CASE WHEN len(lenient) > 0 THEN lenient ELSE ['Yes', 'No'] END, '|') AS lenient FROM o""")
def _(t):
    options = F.col("options")
    return t.questions.select(
        "seq",
        F.array_join(opt.standardize_options(options), "|").alias("strict"),
        F.array_join(
            opt.standardize_options(options, prefix=lex.CLEANING_OPTION_PREFIX_LENIENT), "|"
        ).alias("lenient"),
    )


@check("split_options", "C7", "questions", """
SELECT seq, coalesce(array_to_string(list_filter(list_transform(regexp_split_to_array(options_text, '[/;,]'),
 lambda x: trim(x)), lambda x: x <> ''), '|'), '') AS pieces FROM questions""")
def _(t):
    return t.questions.select("seq", F.array_join(opt.split_options(F.col("options_text")), "|").alias("pieces"))


@check("option_count", "C8", "questions", """
SELECT seq, CASE WHEN options_text <> '' THEN CAST(len(string_split(options_text, '/')) AS BIGINT) END AS n FROM questions""")
def _(t):
    return t.questions.select("seq", big(opt.option_count(F.col("options_text"))).alias("n"))


@check("type_from_option_text", "C9", "questions", f"""
SELECT seq, {TYPE_SQL.format(o='options_text', t='question_text')} AS question_type FROM questions""")
def _(t):
    return t.questions.select(
        "seq", rules.type_from_option_text(F.col("options_text"), F.col("question_text")).alias("question_type")
    )


@check("type_from_option_count", "C10", "questions", f"""
WITH o AS (SELECT seq, {STANDARD_SQL.format(o='options', p=STRICT)} AS s FROM questions)
SELECT seq, {COUNT_TYPE_SQL.format(o='s')} AS question_type FROM o""")
def _(t):
    kept = opt.standardize_options(F.col("options"), default=None)
    return t.questions.select("seq", rules.type_from_option_count(kept).alias("question_type"))


@check("category_by_groups", "C11 J10", "questions", f"""
SELECT seq, {_groups('lower(question_text)', lex.CRAWL_CATEGORIES)} AS category FROM questions""")
def _(t):
    return t.questions.select("seq", rules.category_by_groups(F.col("question_text")).alias("category"))


@check("category_by_groups_documents", "C11 J10", sql=f"""
SELECT doc_id, {_groups('lower(text)', [('first', ['erthwh', 'tionle']), ('second', ['eau']), ('third', ['the ', 'und'])])}
 AS category FROM documents""")
def _(t):
    groups = [("first", ["erthwh", "tionle"]), ("second", ["eau"]), ("third", ["the ", "und"])]
    return t.documents.select("doc_id", rules.category_by_groups(F.col("text"), groups).alias("category"))


@check("category_by_keyword", "C12", "questions", f"""
SELECT seq, {KEYWORD_SQL.format(t='question_text')} AS category FROM questions""")
def _(t):
    return t.questions.select("seq", rules.category_by_keyword(F.col("question_text")).alias("category"))


@check("complexity", "C13", "questions", f"""
WITH o AS (SELECT seq, question_text AS x, kind, {STANDARD_SQL.format(o='options', p=STRICT)} AS s FROM questions)
SELECT seq, {COMPLEXITY_SQL.format(t='x', o='s', k='kind')} AS complexity FROM o""")
def _(t):
    kept = opt.standardize_options(F.col("options"), default=None)
    return t.questions.select(
        "seq", scoring.complexity(F.col("question_text"), kept, F.col("kind")).alias("complexity")
    )


@check("difficulty_score", "C14", "questions", f"""
SELECT seq, CAST({DIFFICULTY_SQL.format(t='question_text', k='kind', o='options_text', l='language')} AS BIGINT) AS score
FROM questions""")
def _(t):
    score = scoring.difficulty_score(
        F.col("question_text"), F.col("kind"), F.col("options_text"), F.col("language")
    )
    return t.questions.select("seq", big(score).alias("score"))


@check("detect_lang", "C15", "questions", f"""
SELECT seq, {LANG_SQL.format(t='question_text')} AS lang FROM questions""")
def _(t):
    return t.questions.select("seq", txt.detect_lang(F.col("question_text")).alias("lang"))


def _scale_sql() -> tuple[str, str]:
    options, kind = "CASE WHEN options_text <> '' THEN options_text ", "CASE WHEN options_text <> '' THEN kind "
    for zh, en, zh_scale, en_scale, scale_type in lex.STANDARD_SCALES:
        hit = _has("lower(question_text)", [zh, *en])
        options += f"WHEN {hit} THEN CASE WHEN contains(question_text, '{zh}') THEN '{zh_scale}' ELSE '{en_scale}' END "
        kind += f"WHEN {hit} THEN '{scale_type}' "
    return options + "ELSE options_text END", kind + "ELSE kind END"


@check("standard_scale", "C16", "questions", f"""
SELECT seq, {_scale_sql()[0]} AS options_text, {_scale_sql()[1]} AS kind,
 options_text = '' AND {_has('lower(question_text)', [w for z, e, *_ in lex.STANDARD_SCALES for w in (z, *e)])} AS changed
FROM questions""")
def _(t):
    options, kind, changed = opt.standard_scale(F.col("question_text"), F.col("options_text"), F.col("kind"))
    return t.questions.select("seq", options.alias("options_text"), kind.alias("kind"), changed.alias("changed"))


@check("inline_options", "C17", "questions", r"""
WITH b AS (SELECT seq, question_text AS t, regexp_extract(question_text, '[(（]([^)）]{10,120})[)）]', 0) AS w,
  regexp_extract(question_text, '[(（]([^)）]{10,120})[)）]', 1) AS c FROM questions)
SELECT seq, CASE WHEN contains(c, '/') OR contains(c, '、') THEN trim(replace(t, w, '')) ELSE t END AS bare,
 CASE WHEN contains(c, '/') OR contains(c, '、') THEN array_to_string(regexp_split_to_array(c, '[/、]'), '|') END AS options
FROM b""")
def _(t):
    bare, inside = opt.inline_options(F.col("question_text"))
    return t.questions.select("seq", bare.alias("bare"), F.array_join(inside, "|").alias("options"))


@check("stars_and_percent", "C18 C19", "questions", """
SELECT seq, repeat('★', CAST(1 + seq % 5 AS BIGINT)) || repeat('☆', CAST(4 - seq % 5 AS BIGINT)) AS stars,
 CAST(floor(difficulty / 5.0 * 100) AS BIGINT) AS percent FROM questions""")
def _(t):
    return t.questions.select(
        "seq",
        scoring.stars((F.col("seq") % 5 + 1).cast("int")).alias("stars"),
        big(scoring.match_percent(F.col("difficulty") / 5.0)).alias("percent"),
    )


@check("answer_option_counts", "C21", "questions", """
WITH a AS (SELECT id AS question_id, unnest(string_split(options_text, ' / ')) AS o FROM questions WHERE options_text <> '')
SELECT question_id, o AS option, count(*) AS count FROM a GROUP BY 1, 2""")
def _(t):
    answers = t.questions.filter(F.col("options_text") != "").select(
        F.col("id").alias("question_id"), F.col("options_text").alias("answer")
    )
    return resp.answer_option_counts(answers)


@check("decode_options", "C22", "questions", """
SELECT seq, CASE seq % 4 WHEN 1 THEN array_to_string(options, '|') WHEN 2 THEN
  array_to_string(list_filter(list_transform(string_split(nullif(options_text, ''), '/'), lambda x: trim(x)), lambda x: x <> ''), '|') END AS options,
 CASE WHEN seq % 4 = 3 THEN seq % 7 END AS scale_max FROM questions""")
def _(t):
    q = t.questions
    kind = F.col("seq") % 4
    raw = (
        F.when(kind == 1, F.to_json("options")).when(kind == 2, F.col("options_text"))
        .when(kind == 3, F.to_json(F.struct(F.lit(1).alias("min"), (F.col("seq") % 7).alias("max"))))
    )
    listed, scale = opt.decode_options(F.col("raw"))
    return q.withColumn("raw", raw).select("seq", F.array_join(listed, "|").alias("options"), big(scale["max"]).alias("scale_max"))


@check("json_answer_field", "C22 C23", "answer_log", """
SELECT event_id, question_id FROM answer_log""")
def _(t):
    return t.answer_log.select("event_id", "question_id")


@check("field_fallback", "C20 C23", "questions", """
SELECT seq, CASE WHEN options_text <> '' THEN options_text WHEN seq % 3 = 0 THEN category ELSE '' END AS value FROM questions""")
def _(t):
    from surveyloom.sources import first_present

    value = first_present(F.nullif("options_text", F.lit("")), F.when(F.col("seq") % 3 == 0, F.col("category")))
    return t.questions.select("seq", value.alias("value"))


@check("padded_ids", "C24", "questions", """
SELECT seq, 'Q' || CASE WHEN seq < 10000 THEN lpad(CAST(seq AS VARCHAR), 4, '0') ELSE CAST(seq AS VARCHAR) END AS question_id FROM questions""")
def _(t):
    return t.questions.select("seq", rules.padded_id(F.col("seq")).alias("question_id"))


@check("topic_filter", "F4", "questions", f"""
SELECT seq FROM questions WHERE {TOPIC_SQL.format(t='question_text')}""")
def _(t):
    return t.questions.filter(pred.is_on_topic(F.col("question_text"))).select("seq")


@check("topic_filter_documents", "F4", sql=f"""
SELECT doc_id FROM documents WHERE length(text) BETWEEN 8 AND 500
 AND {_has('lower(text)', ['the', 'que'])} AND {_has('lower(text)', ['ion', 'heit'])}""")
def _(t):
    wanted = pred.is_on_topic(F.col("text"), ["the", "que"], ["ion", "heit"])
    return t.documents.filter(wanted).select("doc_id")


@check("short_text_filter", "F5", "questions", "SELECT seq FROM questions WHERE length(short_text) > 8")
def _(t):
    return t.questions.filter(pred.longer_than(F.col("short_text"), 8)).select("seq")


@check("empty_text_filter", "F6", "questions", "SELECT seq FROM questions WHERE options_text <> ''")
def _(t):
    return t.questions.filter(pred.not_empty(F.col("options_text"))).select("seq")


@check("question_mark_filter", "F7", "questions", r"""
SELECT seq FROM questions WHERE regexp_matches(question_text, '[?？]\s*$')""")
def _(t):
    return t.questions.filter(pred.ends_with_question_mark(F.col("question_text"))).select("seq")


@check("effective_answered", "F8 F9", "responses", """
SELECT question_id, count(*) AS effective, CAST(sum(CASE WHEN answer <> 'not_answered' THEN 1 ELSE 0 END) AS BIGINT) AS answered
FROM responses WHERE effective GROUP BY 1""")
def _(t):
    effective = t.responses.filter(pred.is_effective(F.col("effective")))
    return effective.groupBy("question_id").agg(
        F.count("*").alias("effective"), F.count_if(pred.is_answered(F.col("answer"))).alias("answered")
    )


@check("not_default_category", "F10", "questions", f"""
SELECT seq FROM questions WHERE {_groups('lower(question_text)', lex.CRAWL_CATEGORIES)} <> 'general'""")
def _(t):
    category = rules.category_by_groups(F.col("question_text"))
    return t.questions.filter(pred.not_default_category(category)).select("seq")


@check("open_split", "F11", "questions", """
SELECT seq, kind = 'open_ended' AS is_open FROM questions""")
def _(t):
    opened, closed = sel.split_by(t.questions, F.col("kind") == "open_ended")
    return opened.select("seq", F.lit(True).alias("is_open")).unionByName(closed.select("seq", F.lit(False).alias("is_open")))


@check("language_split", "F12", "questions", f"""
SELECT seq, {LANG_SQL.format(t='question_text')} AS lang FROM questions""")
def _(t):
    known = t.questions.withColumn("lang", txt.detect_lang(F.col("question_text")))
    english, chinese = sel.split_by(known, F.col("lang") == "en")
    return english.select("seq", "lang").unionByName(chinese.select("seq", "lang"))


@check("bad_rows_set_aside", "F15", "questions", r"""
SELECT seq, regexp_extract(source_name, '[0-9]+$') AS value, CAST(seq % 3 = 0 AS BOOLEAN) AS bad,
 CASE WHEN seq % 3 <> 0 THEN CAST(regexp_extract(source_name, '[0-9]+$') AS BIGINT) END AS number FROM questions""")
def _(t):
    value = F.regexp_extract("source_name", "[0-9]+$", 0)
    rows = t.questions.select("seq", value.alias("value"), F.when(F.col("seq") % 3 == 0, F.concat(value, F.lit("x"))).otherwise(value).alias("number"))
    good, bad = cleaning.split_failed(rows, {"number": "bigint"})
    return good.select("seq", "value", F.lit(False).alias("bad"), "number").unionByName(
        bad.select("seq", "value", F.lit(True).alias("bad"), F.lit(None).cast("bigint").alias("number"))
    )
