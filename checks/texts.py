"""De-duplication, retrieval, keywords and clusters over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import big, check, r6
from surveyloom.functions import text as txt
from surveyloom.operators import clusters, firstwins, retrieval

STOP = ["the", "and", "of", "on", "is", "de", "la", "le", "et", "der", "die", "und", "el", "en"]
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
LEMMAS = {"widgets": "widget", "means": "mean"}
SYNONYMS = [("ring", "band"), ("gear", "cog"), ("bolt", "screw"), ("ring", "loop")]

TERMS_SQL = rf"list_filter(regexp_extract_all(lower({{x}}), '[\p{{{{L}}}}\p{{{{N}}}}_]{{{{2,}}}}'), lambda w: w NOT IN ({STOP_SQL}))".replace("{{", "{").replace("}}", "}")


def _terms(column: str) -> str:
    return TERMS_SQL.replace("{x}", column)


KEY_SQL = rf"""array_to_string(list_transform(list_transform(
 list_filter(regexp_extract_all(lower({{x}}), '[\p{{L}}\p{{N}}_]+'), lambda w: w NOT IN ({STOP_SQL})),
 lambda w: CASE w WHEN 'widgets' THEN 'widget' WHEN 'means' THEN 'mean' ELSE w END),
 lambda w: CASE w WHEN 'ring' THEN 'loop' WHEN 'gear' THEN 'cog' WHEN 'bolt' THEN 'screw' ELSE w END), ' ')""".replace(
    "{x}", "question_text || ' ' || coalesce(options_text, '')"
).replace("{{", "{").replace("}}", "}")
LANG = "CASE WHEN seq % 5 = 0 THEN 'fr' ELSE 'en' END"
OPTIONS = {"stop_words": STOP, "lemmas": LEMMAS, "synonyms_en": SYNONYMS}


@check("first_wins", "D1", sql="SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def _(t):
    return firstwins.first_wins(t.documents, ["text"], "doc_id").select("doc_id")


@check("first_wins_short_text", "D1", "questions", "SELECT short_text, min(seq) AS seq FROM questions GROUP BY 1")
def _(t):
    return firstwins.first_wins(t.questions, ["short_text"]).select("short_text", "seq")


@check("dedup_key", "D2", "questions", f"""
SELECT seq, CASE WHEN {LANG} = 'en' THEN {KEY_SQL} ELSE lower(question_text || ' ' || coalesce(options_text, '')) END AS dedup_key FROM questions""")
def _(t):
    wording = F.concat_ws(" ", "question_text", F.coalesce("options_text", F.lit("")))
    return t.questions.select("seq", txt.dedup_key(wording, F.expr(LANG), **OPTIONS).alias("dedup_key"))


@check("dedup_key_documents", "D2", sql=rf"""
SELECT doc_id, md5(array_to_string(list_transform(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'),
 lambda w: w NOT IN ({STOP_SQL})), lambda w: CASE w WHEN 'eau' THEN 'water' ELSE w END), ' ')) AS dedup_key FROM documents""")
def _(t):
    key = txt.dedup_key(F.col("text"), F.lit("en"), STOP, {}, [("eau", "water")])
    return t.documents.select("doc_id", F.md5(key).alias("dedup_key"))


# A dictionary made of the words of all documents: some go, others become their first letters, then a synonym.
@check("dictionary_keys", "D2", sql=r"""
SELECT doc_id, md5(array_to_string(list_transform(
  list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda w: length(w) <> 3),
  lambda w: CASE WHEN length(w) >= 6 AND length(w) % 2 = 0 THEN 'w' || substr(w, 1, 4) WHEN length(w) = 5 THEN 'five' ELSE w END), ' ')) AS dedup_key FROM documents""")
def _(t):
    from surveyloom.session import stored

    words = stored(t.documents.select(F.explode(txt.words(F.lower("text"), 1)).alias("word")).distinct(), "words")
    size = F.length("word")
    lemmas = words.where((size >= 6) & (size % 2 == 0)).select("word", F.substring("word", 1, 4).alias("target"))
    short = lemmas.select(F.col("target").alias("word")).distinct().select("word", F.concat(F.lit("w"), "word").alias("target"))
    synonyms = short.unionByName(words.where(size == 5).select("word", F.lit("five").alias("target")))
    stops = words.where(size == 3)
    # A word of four letters that is also the start of a longer one keeps its own form.
    lexicon = firstwins.composed_lexicon(stops, lemmas, synonyms).where((F.length("word") != 4))
    return firstwins.dictionary_keys(t.documents, "text", lexicon, "doc_id").select("doc_id", F.md5("dedup_key").alias("dedup_key"))


@check("near_duplicates", "D3", "questions", f"""
WITH k AS (SELECT seq, CASE WHEN {LANG} = 'en' THEN {KEY_SQL} ELSE lower(question_text || ' ' || coalesce(options_text, '')) END AS k FROM questions)
SELECT min(seq) AS seq FROM k GROUP BY k""")
def _(t):
    rows = t.questions.withColumn("detected_lang", F.expr(LANG))
    return firstwins.drop_near_duplicates(rows, **OPTIONS).select("seq")


@check("top_k_per_group", "W2 W1", sql="""
SELECT source, doc_id, n_chars, rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank
 FROM documents) WHERE rank <= 5""")
def _(t):
    top = firstwins.top_per_group(t.documents, ["source"], [F.desc("n_chars"), "doc_id"], 5, rank="rank")
    return top.select("source", "doc_id", "n_chars", big("rank").alias("rank"))


@check("global_top_k", "W3 L3", "questions", """
SELECT short_text, count(*) AS count, min(seq) AS first_seq FROM questions GROUP BY 1 ORDER BY 2 DESC, 3 LIMIT 10""")
def _(t):
    from surveyloom.operators.counts import top_by_count

    return top_by_count(t.questions, "short_text", 10)


@check("new_rows", "J9", sql="""
SELECT min(doc_id) AS doc_id FROM documents WHERE text NOT IN (SELECT text FROM benchmark) GROUP BY text""")
def _(t):
    return firstwins.new_rows(t.documents, t.benchmark, ["text"], "doc_id").select("doc_id")


def _tokens() -> str:
    return f"""WITH corpus AS (SELECT doc_id, text FROM documents),
 tok AS (SELECT doc_id AS doc, unnest({_terms('text')}) AS term FROM corpus),
 tf AS (SELECT doc, term, count(*) AS tf FROM tok GROUP BY 1, 2),
 voc AS (SELECT term, count(*) AS df, ln((1.0 + (SELECT count(*) FROM corpus)) / (1.0 + count(*))) + 1.0 AS idf FROM tf GROUP BY 1),
 w AS (SELECT doc, tf.term, tf * idf AS w FROM tf JOIN voc ON tf.term = voc.term),
 norm AS (SELECT doc, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1)"""


@check("tokens", "T1 T2", sql=f"""
SELECT doc_id, CAST(len({_terms('text')}) AS BIGINT) AS n, md5(array_to_string({_terms('text')}, ' ')) AS tokens FROM documents""")
def _(t):
    tokens = txt.terms(F.col("text"), STOP)
    return t.documents.select("doc_id", big(F.size(tokens)).alias("n"), F.md5(F.array_join(tokens, " ")).alias("tokens"))


def _index(t):
    return retrieval.build_index(t.documents, "doc_id", "text", STOP)


@check("vocabulary", "T3", sql=_tokens() + " SELECT term, df, round(idf, 6) AS idf FROM voc")
def _(t):
    return _index(t).vocabulary.withColumn("idf", r6("idf"))


@check("term_weights", "T3", sql=_tokens() + """
SELECT w.doc, w.term, round(w.w / norm.norm, 6) AS weight FROM w JOIN norm ON w.doc = norm.doc""")
def _(t):
    return retrieval.normalized_weights(_index(t)).withColumn("weight", r6("weight"))


REQUESTS = f""", rt AS (SELECT item_id AS query, unnest({_terms('text')}) AS term FROM benchmark),
 rtf AS (SELECT query, term, count(*) AS tf FROM rt GROUP BY 1, 2),
 rw AS (SELECT query, rtf.term, tf * idf AS w, idf FROM rtf JOIN voc ON rtf.term = voc.term),
 rn AS (SELECT query, sqrt(sum(w * w)) AS n FROM rw GROUP BY 1),
 q AS (SELECT rw.query, rw.term, rw.w / rn.n AS wq FROM rw JOIN rn ON rw.query = rn.query)"""
SCORES = REQUESTS + """, s AS (SELECT q.query, w.doc, sum(q.wq * w.w) / any_value(norm.norm) AS score
 FROM q JOIN w ON q.term = w.term JOIN norm ON norm.doc = w.doc GROUP BY 1, 2)"""


@check("request_weights", "T4", sql=_tokens() + REQUESTS + " SELECT query, term, round(wq, 6) AS wq FROM q")
def _(t):
    wanted = retrieval.request_weights(t.benchmark, _index(t).vocabulary, "item_id", "text", STOP)
    return wanted.select("query", "term", r6("wq").alias("wq"))


@check("analyze_requirements", "T8 T7 D2", sql=_tokens() + REQUESTS + """
SELECT query AS item_id, term, rank, round(wq, 6) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(wq, 9) DESC, term) AS rank FROM q) WHERE rank <= 8""")
def _(t):
    # With no lemmas and synonyms the normal form only drops stop words, which the SQL does as well.
    asked = retrieval.normalize_requests(
        t.benchmark.withColumn("lang", F.lit("en")), stop_words=STOP, lemmas={}, synonyms_en=[]
    )
    found = retrieval.analyze_requirements(asked, _index(t), 8, STOP, query="item_id")
    return found.select("item_id", "term", big("rank").alias("rank"), r6("weight").alias("weight"))


@check("cosine_scores", "T5 J6", sql=_tokens() + SCORES + " SELECT query, doc, round(score, 6) AS score FROM s")
def _(t):
    index = _index(t)
    wanted = retrieval.request_weights(t.benchmark, index.vocabulary, "item_id", "text", STOP)
    return retrieval.cosine_scores(index, wanted).select("query", "doc", r6("score").alias("score"))


@check("generate_survey", "T6 L1 L4 D4 W1 W2 C18 C19", sql=_tokens() + SCORES + """,
 c AS (SELECT query, doc, score, text, row_number() OVER (PARTITION BY query, text ORDER BY round(score, 9) DESC, doc) AS once
  FROM s JOIN corpus ON doc = doc_id WHERE score > 0.05),
 r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, doc) AS rank FROM c WHERE once = 1)
SELECT query AS item_id, rank, doc AS doc_id, round(score, 6) AS score, CAST(floor(round(score, 9) * 100) AS BIGINT) AS match_percent,
 CAST(1 + doc % 5 AS BIGINT) AS difficulty_score, repeat('★', CAST(1 + doc % 5 AS BIGINT)) || repeat('☆', CAST(4 - doc % 5 AS BIGINT)) AS stars,
 md5(text) AS question_text, CASE WHEN doc % 2 = 0 THEN 'a / b' END AS options_text FROM r WHERE rank <= 10""")
def _(t):
    corpus = t.documents.select(
        "doc_id", F.col("text").alias("question_text"), (F.col("doc_id") % 5 + 1).cast("int").alias("difficulty_score"),
        F.when(F.col("doc_id") % 2 == 0, "a / b").otherwise("").alias("options_text"),
    )
    index = retrieval.build_index(corpus, "doc_id", "question_text", STOP)
    found = retrieval.generate_survey(corpus, index, t.benchmark, 10, STOP, query="item_id", doc="doc_id")
    return found.select(
        "item_id", big("rank").alias("rank"), "doc_id", r6("score").alias("score"),
        big("match_percent").alias("match_percent"), big("difficulty_score").alias("difficulty_score"),
        "stars", F.md5("question_text").alias("question_text"), "options_text",
    )


#: Stop words of the two pools, and the language and number of results of a request.
POOL_STOP = {"en": ["the", "and", "of"], "fr": ["de", "la", "le", "et"]}
LANG_OF, K_OF = "CASE item_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' ELSE 'xx' END", "1 + item_id % 7"


def _pool_terms(column: str) -> str:
    found = rf"regexp_extract_all(lower({column}), '[\p{{L}}\p{{N}}_]{{2,}}')"
    cases = " ".join(f"WHEN '{lang}' THEN list_filter({found}, lambda w: w NOT IN ({', '.join(repr(w) for w in stop)}))" for lang, stop in POOL_STOP.items())
    return f"CASE lang {cases} END"


@check("generate_survey_by_language", "T6 T3 T4 T5 J6 C19", sql=f"""
WITH corpus AS (SELECT doc_id, text, lang FROM documents WHERE lang IN ('en', 'fr')),
 asked AS (SELECT item_id, text, {LANG_OF} AS lang, {K_OF} AS k FROM benchmark),
 sizes AS (SELECT lang, count(*) AS n FROM corpus GROUP BY 1),
 tf AS (SELECT lang, doc, term, count(*) AS tf FROM (SELECT lang, doc_id AS doc, unnest({_pool_terms('text')}) AS term FROM corpus) GROUP BY 1, 2, 3),
 voc AS (SELECT tf.lang, term, ln((1.0 + any_value(n)) / (1.0 + count(*))) + 1.0 AS idf FROM tf JOIN sizes ON sizes.lang = tf.lang GROUP BY 1, 2),
 w AS (SELECT tf.lang, doc, tf.term, tf * idf AS w FROM tf JOIN voc ON tf.term = voc.term AND tf.lang = voc.lang),
 norm AS (SELECT doc, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1),
 rtf AS (SELECT lang, query, term, count(*) AS tf FROM (SELECT lang, item_id AS query, unnest({_pool_terms('text')}) AS term FROM asked WHERE lang <> 'xx') GROUP BY 1, 2, 3),
 rw AS (SELECT rtf.lang, query, rtf.term, tf * idf AS w FROM rtf JOIN voc ON rtf.term = voc.term AND rtf.lang = voc.lang),
 rn AS (SELECT query, sqrt(sum(w * w)) AS n FROM rw GROUP BY 1),
 s AS (SELECT rw.query, w.doc, sum(rw.w * w.w) / any_value(rn.n * norm.norm) AS score FROM rw JOIN rn ON rn.query = rw.query
  JOIN w ON w.term = rw.term AND w.lang = rw.lang JOIN norm ON norm.doc = w.doc GROUP BY 1, 2),
 c AS (SELECT query, doc, score, text, row_number() OVER (PARTITION BY query, text ORDER BY round(score, 9) DESC, doc) AS once FROM s JOIN corpus ON doc = doc_id WHERE score > 0.05),
 r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, doc) AS rank FROM c WHERE once = 1)
SELECT query AS item_id, rank, doc AS doc_id, round(score, 6) AS score, CAST(floor(round(score, 9) * 100) AS BIGINT) AS match_percent FROM r JOIN asked ON item_id = query WHERE rank <= k""")
def _(t):
    corpus = t.documents.select("doc_id", F.col("text").alias("question_text"), "lang", F.lit(1).alias("difficulty_score"), F.lit("").alias("options_text"))
    pools = retrieval.language_pools(corpus, "doc_id", "question_text", POOL_STOP, "lang")
    asked = t.benchmark.withColumns({"lang": F.expr(LANG_OF), "k": F.expr(K_OF).cast("int")})
    found = retrieval.generate_survey_by_language(pools, asked, "k", query="item_id", doc="doc_id")
    return found.select("item_id", big("rank").alias("rank"), "doc_id", r6("score").alias("score"), big("match_percent").alias("match_percent"))


WEIGHTS = """, nw AS (SELECT w.doc, w.term, w.w / norm.norm AS weight FROM w JOIN norm ON w.doc = norm.doc)"""


@check("keywords", "T7", sql=_tokens() + WEIGHTS + """
SELECT doc, term, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY round(weight, 9) DESC, term) AS rank FROM nw) WHERE rank <= 5""")
def _(t):
    return retrieval.keywords(_index(t), 5).select("doc", "term", big("rank").alias("rank"))


@check("group_keywords", "K4", sql=_tokens() + WEIGHTS + """,
 sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY 1),
 m AS (SELECT d.source, term, sum(weight) / any_value(sizes.n) AS mean_weight FROM nw JOIN documents d ON d.doc_id = nw.doc
  JOIN sizes ON sizes.source = d.source GROUP BY 1, 2)
SELECT source, term, rank, round(mean_weight, 6) AS mean_weight FROM (SELECT *, row_number() OVER
 (PARTITION BY source ORDER BY round(mean_weight, 9) DESC, term) AS rank FROM m) WHERE rank <= 10""")
def _(t):
    best = retrieval.group_keywords(_index(t), t.documents, "doc_id", "source", 10)
    return best.select("source", "term", big("rank").alias("rank"), r6("mean_weight").alias("mean_weight"))


@check("nearest_centroid", "K5", sql="""
WITH p AS (SELECT vec_id, label, embedding FROM embeddings),
 e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM p),
 c AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM e GROUP BY 1, 2),
 d AS (SELECT e.vec_id, c.label, round(sum((e.x - c.m) * (e.x - c.m)), 9) AS d FROM e JOIN c ON e.i = c.i GROUP BY 1, 2)
SELECT vec_id, CAST(label AS BIGINT) AS cluster_id FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS rn FROM d) WHERE rn = 1""")
def _(t):
    points = t.embeddings.withColumn("embedding", F.col("embedding").cast("array<double>"))
    centres = clusters.centroids(points, "embedding", "label")
    return clusters.nearest_centroid(points, "embedding", centres, "label").select("vec_id", big("cluster_id").alias("cluster_id"))


@check("silhouettes", "K3", sql="""
WITH p AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
 u AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM p),
 d AS (SELECT a.vec_id, a.label AS own, b.label, sum(1 - list_dot_product(a.v, b.v)) AS s, count(*) AS n FROM u a JOIN u b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
 m AS (SELECT vec_id, own, max(CASE WHEN own = label THEN s / n END) AS a, min(CASE WHEN own <> label THEN s / n END) AS b FROM d GROUP BY 1, 2)
SELECT vec_id, own AS label, round(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM m""")
def _(t):
    return clusters.silhouettes(t.embeddings, "embedding", "label").select("vec_id", big("label").alias("label"), r6("silhouette").alias("silhouette"))


@check("cluster_fixpoint", "K2 K5", sql="SELECT count(*) AS documents, CAST(0 AS BIGINT) AS misplaced, true AS few FROM documents")
def _(t):
    """Every document is in the cluster whose centre is nearest, and there are at most as many clusters as asked for."""
    from surveyloom.session import stored

    model = clusters.fit_clusters(t.documents, "text", stop_words=STOP)
    centres = t.spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(model.centres)], "number int, centre array<double>")
    assigned = stored(clusters.assign_clusters(model, t.documents).select("doc_id", "features", "cluster_id"), "assigned")
    checked = clusters.nearest_centroid(assigned, "features", centres, "number", "nearest")
    return checked.agg(
        F.count("*").alias("documents"), F.count_if(F.col("nearest") != F.col("cluster_id")).alias("misplaced"),
        (F.countDistinct("cluster_id") <= 6).alias("few"),
    )


@check("cluster_documents", "K1 K2 K3")
def _(t):
    from surveyloom.session import stored

    model = clusters.fit_clusters(t.documents, "text", stop_words=STOP)
    assigned = stored(clusters.assign_clusters(model, t.documents).select("features", "cluster_id"), "assigned")
    return clusters.cluster_report(assigned).withColumn("silhouette", F.lit(clusters.silhouette(assigned)))


@check("cluster_scatter", "K6")
def _(t):
    model = clusters.fit_clusters(t.documents, "text", stop_words=STOP)
    placed = clusters.scatter_positions(clusters.assign_clusters(model, t.documents))
    return placed.select("doc_id", "cluster_id", r6("x").alias("x"), r6("y").alias("y"))
