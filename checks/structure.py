"""Pages and links, hierarchy, compositions and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import rules as rule_sql
from checks.registry import big, check
from checks.texts import KEY_SQL, LANG, OPTIONS
from surveyloom import lexicons as lex
from surveyloom.functions import rules
from surveyloom.operators import hierarchy, webpages
from surveyloom.operators.firstwins import limit_links
from surveyloom.plans import cleaning, workflow
from surveyloom.session import shared_folder, stored
from surveyloom.streaming import answers as live

COMPLEXITY = "CASE id % 7 WHEN 0 THEN 'hard' WHEN 1 THEN 'medium' WHEN 2 THEN 'medium' ELSE 'easy' END"
NODES = f"""WITH nodes AS (SELECT id AS question_id, question_type AS cluster_id, {COMPLEXITY} AS complexity, category FROM questions),
 lv AS (SELECT *, CASE complexity WHEN 'easy' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END AS l FROM nodes),
 heads AS (SELECT cluster_id, l, min(question_id) AS head FROM lv GROUP BY 1, 2),
 par AS (SELECT lv.*, (SELECT arg_max(h.head, h.l) FROM heads h WHERE h.cluster_id = lv.cluster_id AND h.l < lv.l) AS parent_id FROM lv),
 tree AS (SELECT p.*, CAST((SELECT count(*) FROM heads h WHERE h.cluster_id = p.cluster_id AND h.l < p.l) AS BIGINT) AS depth,
  parent_id IS NULL AS is_root, question_id NOT IN (SELECT parent_id FROM par WHERE parent_id IS NOT NULL) AS is_leaf FROM par p)"""
ASSOCIATED = [("Brand#1", "Brand#2"), ("Brand#1", "Brand#3"), ("Brand#4", "Brand#1"), ("Brand#9", "Brand#9")]
ASSOCIATED_SQL = ", assoc AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in ASSOCIATED) + ") v(category, associated))"


def _tree(t):
    nodes = t.questions.select(
        F.col("id").alias("question_id"), F.col("question_type").alias("cluster_id"),
        F.expr(COMPLEXITY).alias("complexity"), "category",
    )
    return hierarchy.build_hierarchy(nodes)


def _associations(t):
    return t.spark.createDataFrame(ASSOCIATED, "category string, associated string")


@check("hierarchy", "H1", "questions", NODES + """
SELECT question_id, parent_id, depth, is_root, is_leaf FROM tree""")
def _(t):
    return _tree(t).select("question_id", "parent_id", big("depth").alias("depth"), "is_root", "is_leaf")


@check("hierarchy_summary", "H1", "questions", NODES + """
SELECT count(*) AS total_nodes, max(depth) AS max_depth, count(*) FILTER (is_root) AS root_nodes, count(*) FILTER (is_leaf) AS leaf_nodes FROM tree""")
def _(t):
    return hierarchy.hierarchy_summary(_tree(t)).withColumn("max_depth", big("max_depth"))


EDGES = NODES + ASSOCIATED_SQL + """,
 roots AS (SELECT question_id, category FROM tree WHERE is_root),
 edges AS (SELECT parent_id AS source_id, question_id AS target_id, 'parent' AS edge_type FROM tree WHERE parent_id IS NOT NULL
 UNION ALL SELECT * FROM (SELECT question_id, lead(question_id) OVER (PARTITION BY cluster_id ORDER BY question_id) AS n, 'cluster' FROM tree) WHERE n IS NOT NULL
 UNION ALL SELECT r.question_id, f.head, 'category' FROM roots r JOIN assoc a ON a.category = r.category
  JOIN (SELECT category, min(question_id) AS head FROM roots GROUP BY 1) f ON f.category = a.associated WHERE r.question_id <> f.head)"""


@check("relationships", "H2", "questions", EDGES + " SELECT source_id, target_id, edge_type FROM edges")
def _(t):
    return hierarchy.relationships(stored(_tree(t), "tree"), _associations(t))


@check("graph_nodes", "H9", "questions", EDGES + """
SELECT question_id, (SELECT count(*) FROM edges WHERE source_id = question_id) AS out_degree,
 (SELECT count(*) FROM edges WHERE target_id = question_id) AS in_degree FROM tree""")
def _(t):
    tree = stored(_tree(t), "tree")
    nodes, _edges = hierarchy.graph_data(tree, hierarchy.relationships(tree, _associations(t)))
    return nodes.select("question_id", "out_degree", "in_degree")


RULES = [("purchase", "Brand#5"), ("c", "Brand#6")]


@check("next_questions", "H3", "questions answer_log", NODES + ASSOCIATED_SQL + """,
 answered AS (SELECT session_id AS user_id, question_id, arg_max(answer, (ts, event_id)) AS answer, max((ts, event_id)) AS spot FROM answer_log GROUP BY 1, 2),
 cur AS (SELECT user_id, arg_max(question_id, spot) AS question_id, arg_max(answer, spot) AS answer FROM answered GROUP BY 1),
 at AS (SELECT c.user_id, c.question_id, c.answer, t.cluster_id, t.category FROM cur c JOIN tree t ON t.question_id = c.question_id),
 cand AS (SELECT a.user_id, t.question_id, 1 AS s FROM "at" a JOIN tree t ON t.parent_id = a.question_id
 UNION ALL SELECT a.user_id, t.question_id, 2 FROM "at" a JOIN tree t ON t.cluster_id = a.cluster_id
 UNION ALL SELECT a.user_id, t.question_id, 3 FROM "at" a JOIN (VALUES ('purchase', 'Brand#5'), ('c', 'Brand#6')) r(k, c) ON contains(a.answer, r.k) JOIN tree t ON t.category = r.c
 UNION ALL SELECT a.user_id, t.question_id, 4 FROM "at" a JOIN assoc s ON s.category = a.category JOIN tree t ON t.category = s.associated),
 best AS (SELECT user_id, question_id, min(s) AS strategy FROM cand GROUP BY 1, 2)
SELECT user_id, question_id, CAST(strategy AS BIGINT) AS strategy, rank FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY strategy, question_id) AS rank FROM best b
 WHERE NOT EXISTS (SELECT 1 FROM answered x WHERE x.user_id = b.user_id AND x.question_id = b.question_id)) WHERE rank <= 5""".replace(" at AS (", ' "at" AS ('))
def _(t):
    spot = F.struct("ts", "event_id")
    answered = t.answer_log.groupBy(F.col("session_id").alias("user_id"), "question_id").agg(
        F.max_by("answer", spot).alias("answer"), F.max(spot).alias("spot")
    )
    current = answered.groupBy("user_id").agg(F.max_by("question_id", "spot").alias("question_id"))
    tree = stored(_tree(t), "tree")
    found = hierarchy.next_questions(
        tree, hierarchy.ranked_groups(tree), current, answered.drop("spot"), _associations(t),
        RULES, 5,
    )
    return found.select("user_id", "question_id", big("strategy").alias("strategy"), big("rank").alias("rank"))


@check("first_questions", "H4 W2", "questions users", NODES + """,
 roots AS (SELECT question_id, category FROM tree WHERE is_root),
 interest AS (SELECT id AS user_id, 'Brand#' || CAST(1 + id % 40 AS VARCHAR) AS category FROM users
  UNION ALL SELECT id, 'Brand#' || CAST(26 + id % 7 AS VARCHAR) FROM users),
 own AS (SELECT DISTINCT user_id, question_id FROM interest JOIN roots ON roots.category = interest.category),
 everyone AS (SELECT * FROM own UNION ALL SELECT id, question_id FROM users, (SELECT question_id FROM roots ORDER BY 1 LIMIT 4) WHERE id NOT IN (SELECT user_id FROM own))
SELECT user_id, question_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY question_id) AS rank FROM everyone) WHERE rank <= 4""")
def _(t):
    users = t.users.select(F.col("id").alias("user_id"))
    name = lambda n: F.concat(F.lit("Brand#"), n.cast("string"))
    two = F.array(name(F.col("user_id") % 40 + 1), name(F.col("user_id") % 7 + 26))
    interests = users.select("user_id", F.explode(two).alias("category"))
    return hierarchy.first_questions(stored(_tree(t), "tree"), interests, users, 4).withColumn("rank", big("rank"))


# --- cleaning compositions -------------------------------------------------------------------

CLEANED = f"""WITH c AS (SELECT seq, {rule_sql.CLEAN_SQL.format('question_text')} AS text, options, source_name, kind FROM questions),
 f AS (SELECT text, count(*) AS frequency, min(seq) AS seq FROM c WHERE text <> '' GROUP BY 1),
 o AS (SELECT f.*, c.source_name, c.kind, {rule_sql.STANDARD_SQL.format(o='c.options', p=rule_sql.STRICT)} AS s FROM f JOIN c ON c.seq = f.seq),
 d AS (SELECT * REPLACE (CASE WHEN len(s) > 0 THEN s ELSE ['Yes', 'No'] END AS s) FROM o),
 k AS (SELECT *, {rule_sql.COUNT_TYPE_SQL.format(o='s')} AS question_type FROM d)"""


@check("clean_questions", "H6 F6 C1 A12 D1 C6 C10 C12 C13 C24", "questions", CLEANED + f"""
SELECT seq, 'Q' || lpad(CAST(seq AS VARCHAR), CAST(greatest(4, length(CAST(seq AS VARCHAR))) AS INTEGER), '0') AS question_id, text, array_to_string(s, '|') AS options, question_type,
 {rule_sql.KEYWORD_SQL.format(t='text')} AS category, {rule_sql.COMPLEXITY_SQL.format(t='text', o='s', k='question_type')} AS complexity,
 frequency, source_name AS source_platform, kind AS original_category FROM k""")
def _(t):
    raw = t.questions.select(
        "seq", F.lit(None).cast("string").alias("question_id"), F.col("question_text").alias("text"), "options",
        F.col("source_name").alias("source_platform"), F.col("kind").alias("original_category"),
    )
    return cleaning.clean_questions(raw).withColumn("options", F.array_join("options", "|"))


@check("clean_documents", "H6 A12", sql=f"""
WITH c AS (SELECT doc_id, {rule_sql.CLEAN_SQL.format('text')} AS text FROM documents)
SELECT min(doc_id) AS doc_id, count(*) AS frequency, md5(text) AS text FROM c WHERE text <> '' GROUP BY text""")
def _(t):
    raw = t.documents.select(
        F.col("doc_id").alias("seq"), F.lit(None).cast("string").alias("question_id"), "text",
        F.array().cast("array<string>").alias("options"), F.col("source").alias("source_platform"),
        F.col("lang").alias("original_category"),
    )
    return cleaning.clean_questions(raw).select(F.col("seq").alias("doc_id"), "frequency", F.md5("text").alias("text"))


POOL = rf"""WITH n AS (SELECT *, {rule_sql.NUMBERED_SQL.format('question_text')} AS x FROM questions),
 c AS (SELECT * REPLACE ({rule_sql.CLEAN_QUESTION_SQL.format(n='x')} AS question_text) FROM n),
 l AS (SELECT *, {rule_sql.LANG_SQL.format(t='question_text')} AS detected_lang FROM c WHERE length(question_text) > 2),
 key AS (SELECT *, {KEY_SQL} AS k FROM l WHERE detected_lang = 'en'),
 kept AS (SELECT min(seq) AS seq FROM key GROUP BY k UNION ALL SELECT min(seq) FROM l WHERE detected_lang = 'zh'
  GROUP BY list_sort([lower(question_text || ' ' || options_text)])),
 pool AS (SELECT l.*, CAST({rule_sql.DIFFICULTY_SQL.format(t='question_text', k='kind', o='options_text', l='detected_lang')} AS BIGINT) AS difficulty_score
  FROM l JOIN kept ON kept.seq = l.seq)"""


def _raw_pool(t):
    return t.questions.withColumn("question_type", F.col("kind"))


@check("prepare_pool", "H7 C2 F5 C15 D3 C14", "questions", POOL + """
SELECT seq, question_text, detected_lang, difficulty_score FROM pool""")
def _(t):
    pool = cleaning.prepare_pool(_raw_pool(t), **OPTIONS)
    return pool.select("seq", "question_text", "detected_lang", big("difficulty_score").alias("difficulty_score"))


@check("cleaning_report", "H7 A15", "questions", POOL + """
SELECT 'raw' AS stage, count(*) AS rows FROM questions UNION ALL SELECT 'valid', count(*) FROM pool
UNION ALL SELECT 'en', count(*) FILTER (detected_lang = 'en') FROM pool UNION ALL SELECT 'zh', count(*) FILTER (detected_lang = 'zh') FROM pool""")
def _(t):
    return cleaning.load_and_process(_raw_pool(t), lex.TOPICS, **OPTIONS)["cleaning"]


def _topic_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{lang}', 'topic', '{name}', count(*) FILTER ("
        + " OR ".join(f"contains(lower(question_text), '{w}')" for w in words) + f") FROM pool WHERE detected_lang = '{lang}' HAVING count(*) > 0"
        for lang, topics in lex.TOPICS.items() for name, words in topics
    )


@check("content_report", "H8 A2 A9 A10 F12", "questions", POOL + f"""
SELECT detected_lang, 'question_type' AS metric, kind AS key, count(*) AS count FROM pool GROUP BY 1, 3
UNION ALL {_topic_rows()}
UNION ALL SELECT d.detected_lang, 'difficulty', CAST(lvl AS VARCHAR), count(pool.seq) FROM (SELECT DISTINCT detected_lang FROM pool) d
 CROSS JOIN range(1, 6) r(lvl) LEFT JOIN pool ON pool.detected_lang = d.detected_lang AND difficulty_score = lvl GROUP BY 1, 3""")
def _(t):
    return cleaning.load_and_process(_raw_pool(t), lex.TOPICS, **OPTIONS)["content"]


@check("full_workflow", "H5")
def _(t):
    raw = t.documents.select(
        F.col("doc_id").alias("seq"), "text", F.array().cast("array<string>").alias("options"),
        F.col("source").alias("source_platform"), F.col("lang").alias("original_category"),
    )
    known = t.benchmark.select("text")
    return workflow.full_workflow(raw, known)["summary"]


# --- pages -----------------------------------------------------------------------------------

MARKERS, KEYWORDS = ["the", "que", "der", "la "], ["ion", "eau", "ich"]


@check("site_layout", "P5", sql="""
SELECT page_id, CASE WHEN contains(url, 'example.com') THEN 'wjx' WHEN contains(url, 'blog.') OR contains(url, '.org') THEN 'wenjuan' ELSE 'generic' END AS site FROM pages""")
def _(t):
    layouts = [("wjx", ["example.com"]), ("wenjuan", ["blog.", ".org"])]
    return t.pages.select("page_id", rules.site_layout(F.col("url"), layouts).alias("site"))


@check("page_blocks", "P4")
def _(t):
    return webpages.text_blocks(t.pages).groupBy("page_id").agg(
        F.count("*").alias("blocks"), F.sum(F.length("raw_text")).alias("chars")
    )


@check("page_questions", "P1 P2 P3 P4")
def _(t):
    return webpages.page_questions(webpages.text_blocks(t.pages), MARKERS, KEYWORDS)


HREF = r"""regexp_extract_all(html, '(?is)<a\s[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1)"""
LINK_SQL = f"""WITH h AS (SELECT page_id, url, unnest({HREF}) AS href, generate_subscripts({HREF}, 1) - 1 AS pos FROM pages),
 l AS (SELECT page_id AS page_seq, CAST(pos AS BIGINT) AS link_pos, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^[a-z]+://[^/]+') || href ELSE href END AS url FROM h),
 m AS (SELECT * FROM l WHERE regexp_matches(url, '(?:/t)|(?:/d[a-z]*)|(?:ion)'))"""
PATTERNS = [r"/t", r"/d[a-z]*", r"ion"]


@check("page_links", "P6", sql=LINK_SQL + " SELECT page_seq, link_pos, url FROM m")
def _(t):
    return webpages.page_links(t.pages, PATTERNS).withColumn("link_pos", big("link_pos"))


@check("sublinks", "P6 W4", sql=LINK_SQL + """,
 f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_seq, link_pos) AS o FROM m) WHERE o = 1)
SELECT page_seq, link_pos, url FROM (SELECT *, row_number() OVER (PARTITION BY page_seq ORDER BY link_pos) AS r FROM f) WHERE r <= 3""")
def _(t):
    return webpages.sublinks(t.pages, PATTERNS, 3).withColumn("link_pos", big("link_pos"))


@check("limit_links", "W4", sql="""
SELECT page_seq, link_pos, url FROM (SELECT *, row_number() OVER (PARTITION BY page_seq ORDER BY link_pos) AS r FROM (
 SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_seq, link_pos) AS o FROM (
  SELECT o_custkey AS page_seq, o_orderkey AS link_pos, CAST(floor(o_totalprice / 25) AS BIGINT) AS url FROM orders)) WHERE o = 1) WHERE r <= 4""")
def _(t):
    links = t.orders.select(
        F.col("o_custkey").alias("page_seq"), F.col("o_orderkey").alias("link_pos"),
        F.floor(F.col("o_totalprice") / 25).alias("url"),
    )
    return limit_links(links, 4)


def _site(t):
    """Orders as a site: a customer's page links to the pages of other customers."""
    page = F.col("c_custkey")
    seeds = t.customer.select(
        page.alias("page_id"), F.when(page % 11 != 0, F.lit("<html></html>")).alias("html"),
        F.concat(F.lit("u"), page.cast("string")).alias("url"),
    )
    found = t.customer.filter(F.col("c_acctbal") > 4000).select(
        page.alias("page_id"), F.explode(F.sequence(F.lit(1).cast("bigint"), page % 3 + 1)).alias("pos")
    )
    links = limit_links(
        t.orders.select(
            F.col("o_custkey").alias("page_seq"), F.col("o_orderkey").alias("link_pos"),
            F.concat(F.lit("u"), F.floor(F.col("o_totalprice") / 100).cast("string")).alias("url"),
        ), 3,
    )
    return seeds, found, links


SITE = """WITH seeds AS (SELECT c_custkey AS page_id, c_custkey % 11 = 0 AS missing, 'u' || CAST(c_custkey AS VARCHAR) AS url, c_acctbal > 4000 AS has FROM customer),
 lk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_seq ORDER BY link_pos) AS r FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_seq, link_pos) AS o FROM (
   SELECT o_custkey AS page_seq, o_orderkey AS link_pos, 'u' || CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR) AS url FROM orders)) WHERE o = 1) WHERE r <= 3),
 reach AS (SELECT lk.page_seq AS page_id, count(*) AS links_used, CAST(sum(t.page_id % 3 + 1) AS BIGINT) AS found FROM lk
  JOIN seeds t ON t.url = lk.url AND t.has JOIN seeds s ON s.page_id = lk.page_seq AND NOT s.has AND NOT s.missing GROUP BY 1),
 outc AS (SELECT s.page_id, CASE WHEN missing THEN 'failed' WHEN has THEN 'direct' WHEN found IS NOT NULL THEN 'sublinks' ELSE 'empty' END AS outcome,
  coalesce(links_used, 0) AS links_used, CASE WHEN has THEN s.page_id % 3 + 1 ELSE coalesce(found, 0) END AS questions FROM seeds s LEFT JOIN reach r ON r.page_id = s.page_id)"""


@check("page_outcomes", "P7 J8", sql=SITE + " SELECT page_id, outcome, links_used, questions FROM outc")
def _(t):
    seeds, found, links = _site(t)
    return webpages.page_outcomes(seeds, found, links, seeds)


@check("crawl_counters", "A16", sql=SITE + """
SELECT count(*) FILTER (outcome = 'direct') AS direct_success, count(*) FILTER (outcome IN ('sublinks', 'empty')) AS need_sublinks,
 CAST(sum(links_used) AS BIGINT) AS sublinks_success, count(*) FILTER (outcome = 'failed') AS total_failed, CAST(sum(questions) AS BIGINT) AS total_questions FROM outc""")
def _(t):
    seeds, found, links = _site(t)
    return webpages.crawl_counters(webpages.page_outcomes(seeds, found, links, seeds))


@check("crawl", "P7 P8 J8 U1")
def _(t):
    seeds = t.pages.select("url", F.lit("seed").alias("source_name"))
    return webpages.crawl(t.pages, seeds, PATTERNS, MARKERS, KEYWORDS)["questions"]


# Pages written out of the parts, in all four layouts; both engines read these expressions.
ASKED = "'How was the hotel ' || p_name || '?'"
PAGE_HTML = f"""CASE p_partkey % 4
 WHEN 0 THEN '<html><div class="top"><div class="x field"><div class="field-label">' || CAST(p_partkey AS VARCHAR(20)) || '. ' || {ASKED}
   || '</div><div class="ui-radio"> Good ' || p_name || '</div><div class="ui-checkbox on"><b>Bad</b> </div><select><option>Please Select</option><option>Fine</option></select></div>'
   || '<div class="field"><div class="field-label">Only words</div></div></div>'
 WHEN 1 THEN '<div class="question"><div class="question-title">' || {ASKED} || '</div><label>Good ' || p_name || '<label>Bad</label><script>"</label>"</script></div>'
 WHEN 2 THEN '<ul><li class="form-line"><label class="form-label">' || {ASKED} || '</label><label class="form-radio-item-label">Good ' || p_name
   || '</label><![foo[x]]><label class="form-checkbox-item-label">Bad</label><select><option>Fine</option></select></li></ul>'
 ELSE '<nav><p>How was the hotel menu?</p></nav><!-- <p>How was the hotel note?</p> --><p>' || {ASKED} || '</p><ul><li>Good ' || p_name || '</li><li>Bad</li></ul>'
   || '<p title="never closed>How was the hotel hall?</p>' END"""
PAGE_URL = """CASE p_partkey % 4 WHEN 0 THEN 'http://www.wjx.cn/' WHEN 1 THEN 'http://www.wenjuan.com/' WHEN 2 THEN 'http://form.jotform.com/'
 ELSE 'http://hotel.example/' END || CAST(p_partkey AS VARCHAR(20))"""


@check("layout_questions", "P1 P2 P3 P4", sql=f"""
SELECT p_partkey AS page_id, {ASKED} AS question_text, CASE p_partkey % 4 WHEN 1 THEN 'Good ' || p_name || 'Bad / Bad'
 WHEN 3 THEN 'Good ' || p_name || ' / Bad' ELSE 'Good ' || p_name || ' / Bad / Fine' END AS options_text,
 CASE p_partkey % 4 WHEN 1 THEN 'zh' ELSE 'en' END AS language,
 CASE p_partkey % 4 WHEN 0 THEN '问卷星' WHEN 1 THEN '问卷网' WHEN 2 THEN 'Jotform' ELSE {PAGE_URL} END AS source_name FROM part
UNION ALL SELECT p_partkey, 'How was the hotel hall?', '', 'en', {PAGE_URL} FROM part WHERE p_partkey % 4 = 3""")
def _(t):
    pages = t.part.select(F.col("p_partkey").alias("page_id"), F.expr(PAGE_URL).alias("url"), F.expr(PAGE_HTML).alias("html"))
    found = webpages.page_questions(webpages.text_blocks(pages))
    return found.select("page_id", "question_text", "options_text", "language", "source_name")


# A site of the customers: some pages ask questions, others only link to pages of other customers.
CUSTOMER_URL = "'http://hotel.example/t/' || CAST({} AS VARCHAR(20))"
CUSTOMER_ASKS = "'How was the hotel room ' || CAST(c_custkey % 50 AS VARCHAR(20)) || '?'"
CRAWL_SQL = f"""WITH site AS (SELECT c_custkey AS page_id, {CUSTOMER_URL.format('c_custkey')} AS url, c_custkey % 11 = 0 AS missing, c_acctbal > 4000 AND c_custkey % 11 > 0 AS has,
  c_custkey % 2 = 0 AS seed, {CUSTOMER_ASKS} AS question_text, c_mktsegment AS name FROM customer),
 lk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS r FROM (
  SELECT page_id, pos, target, row_number() OVER (PARTITION BY target ORDER BY page_id, pos) AS o FROM (
   SELECT o_custkey AS page_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos, CAST(floor(o_totalprice / 100) AS BIGINT) AS target
   FROM orders JOIN site ON site.page_id = o_custkey AND seed AND NOT has AND NOT missing)) WHERE o = 1) WHERE r <= 3),
 reach AS (SELECT lk.page_id, t.page_id AS target, t.seed AS known, t.question_text, s.name FROM lk JOIN site t ON t.page_id = lk.target AND t.has JOIN site s ON s.page_id = lk.page_id)"""


def _crawl(t):
    page = F.col("c_custkey")
    links = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", F.floor(F.col("o_totalprice") / 100).alias("to")))).alias("links"))
    anchors = F.expr("array_join(transform(links, x -> '<a class=\"l\" href=\"/t/' || cast(x.to as string) || '\">next</a>'), ' ')")
    asks = F.concat(F.lit("<div>page</div><p>"), F.expr(CUSTOMER_ASKS), F.lit("</p>"))
    html = F.when(page % 11 == 0, F.lit(None)).when(F.col("c_acctbal") > 4000, asks).otherwise(F.coalesce(anchors, F.lit("")))
    pages = t.customer.join(links, page == F.col("o_custkey"), "left").select(page.alias("page_id"), F.expr(CUSTOMER_URL.format("c_custkey")).alias("url"), html.alias("html"))
    seeds = t.customer.where(page % 2 == 0).select(F.expr(CUSTOMER_URL.format("c_custkey")).alias("url"), F.col("c_mktsegment").alias("source_name"))
    return webpages.crawl(pages, seeds, ["/t/"], per_page=3)


@check("crawl_site", "P7 P8 J8 U1 W4", sql=CRAWL_SQL + """,
 through AS (SELECT target AS page_id, question_text, min(name) AS source_name FROM reach WHERE NOT known GROUP BY 1, 2),
 whole AS (SELECT page_id, question_text, url AS source_name FROM site WHERE seed AND has UNION ALL SELECT * FROM through)
SELECT page_id, question_text, source_name FROM (SELECT *, row_number() OVER (PARTITION BY question_text ORDER BY page_id) AS o FROM whole) WHERE o = 1""")
def _(t):
    return _crawl(t)["questions"].select("page_id", "question_text", "source_name")


@check("crawl_site_outcomes", "P7 P8 J8 A16", sql=CRAWL_SQL + """,
 used AS (SELECT page_id, count(*) AS n FROM reach GROUP BY 1)
SELECT site.page_id, CASE WHEN missing THEN 'failed' WHEN has THEN 'direct' WHEN n IS NOT NULL THEN 'sublinks' ELSE 'empty' END AS outcome,
 coalesce(n, 0) AS links_used, CASE WHEN has THEN 1 ELSE coalesce(n, 0) END AS questions FROM site LEFT JOIN used ON used.page_id = site.page_id WHERE seed""")
def _(t):
    return _crawl(t)["outcomes"].select("page_id", "outcome", big("links_used").alias("links_used"), big("questions").alias("questions"))


# --- streams ---------------------------------------------------------------------------------


def _folders(t, name: str) -> tuple[str, str]:
    base = f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"
    return f"{base}/table", f"{base}/checkpoint"


@check("last_answers_stream", "ST1", "answer_log", """
SELECT session_id, question_id, arg_max(answer, (ts, event_id)) AS answer, arg_max(event_id, (ts, event_id)) AS event_id FROM answer_log GROUP BY 1, 2""")
def _(t):
    source = (
        t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
        .select(
            "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("session_id"),
            F.get_json_object("props", "$.k").cast("bigint").alias("question_id"), F.col("event_type").alias("answer"),
        )
    )
    path, checkpoint = _folders(t, "answers")
    live.write_answer_log(live.last_answers(source, "400 days", "1 day"), path, checkpoint).awaitTermination()
    return live.current_answers(t.spark, path).select("session_id", "question_id", "answer", "event_id")


@check("session_answers", "ST1", "answer_log", """
SELECT session_id, question_id, arg_max(answer, (ts, event_id)) AS answer FROM answer_log GROUP BY 1, 2""")
def _(t):
    spot = F.struct("ts", "event_id")
    current = t.answer_log.groupBy("session_id", "question_id").agg(F.max_by("answer", spot).alias("answer"))
    return live.session_answers(current)


@check("running_answer_rate_stream", "ST2", "responses questions", """
SELECT q.question_type, count(*) AS total, count(*) FILTER (answer <> 'not_answered') AS answered
FROM responses r JOIN questions q ON r.question_id = q.id WHERE effective GROUP BY 1""")
def _(t):
    arriving = (
        t.spark.readStream.schema(t.lineitem.schema).option("pathGlobFilter", "lineitem.parquet").parquet(t.folder)
        .select(
            F.col("l_partkey").alias("question_id"), (F.col("l_returnflag") != "R").alias("effective"),
            F.when(F.col("l_linestatus") == "O", lex.NOT_ANSWERED).otherwise(F.col("l_returnflag")).alias("answer"),
        )
    )
    path, checkpoint = _folders(t, "running")
    live.write_running_table(live.running_answer_rate(arriving, t.questions), path, checkpoint).awaitTermination()
    return live.current_rates(t.spark, path)
