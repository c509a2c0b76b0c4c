"""Operators on small literal tables, independent of how the rows are partitioned."""

import json

import pytest
from pyspark.sql import functions as F

from surveyloom import lexicons as lex
from surveyloom import sources
from surveyloom.operators import correlation, counts, edits, firstwins, hierarchy, responses, retrieval, selection
from surveyloom.plans import cleaning, reports, workflow

BANK = "id bigint, seq bigint, question_type string, category string"
RESPONSES = "user_id bigint, question_id bigint, answer string, effective boolean"
ANSWERS = [(1, 1, "Yes", True), (1, 2, "not_answered", True), (2, 1, "not_answered", None), (2, 2, "No", False), (3, 9, "Yes", True)]


@pytest.mark.parametrize("parts", [1, 7])
def test_first_wins(table, rows, parts):
    df = table("seq bigint, key string", (0, "a"), (1, "b"), (2, "a"), (3, None), (4, None), parts=parts)
    assert rows(firstwins.first_wins(df, ["key"]), "seq") == [(0,), (1,), (3,)]


def test_first_wins_limits_before_the_shuffle(table):
    df = table("seq bigint, key string", (0, "a"))
    plan = firstwins.first_wins(df, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_near_duplicates(table, rows):
    df = table("seq bigint, question_text string, options_text string, detected_lang string",
               (0, "The hotels?", None, "en"), (1, "hotel", "", "en"), (2, "room", None, "en"))
    out = firstwins.drop_near_duplicates(df, stop_words=["the"], lemmas={"hotels": "hotel"}, synonyms_en=[("hotel", "stay")])
    assert rows(out, "seq", "dedup_key") == [(0, "stay"), (2, "room")]


@pytest.mark.parametrize("limit,expected", [(30, [(0, "u1"), (0, "u2"), (1, "u3")]), (1, [(0, "u1"), (1, "u3")])])
def test_limit_links(table, rows, limit, expected):
    df = table("page_seq bigint, link_pos int, url string", (0, 0, "u1"), (0, 1, "u2"), (0, 2, "u1"), (1, 0, "u2"), (1, 1, "u3"))
    assert rows(firstwins.limit_links(df, limit), "page_seq", "url") == expected


@pytest.mark.parametrize("parts", [1, 5])
def test_rates(table, rows, parts):
    answers = table(RESPONSES, *ANSWERS, parts=parts)
    bank = table(BANK, (1, 0, "x", "c"), (2, 1, "y", "c"))
    assert rows(responses.answer_rate_by_type(answers, bank), "question_type", "answered", "total", "answer_rate") == [
        ("x", 1, 2, 0.5), ("y", 0, 1, 0.0)]
    assert rows(responses.ineffective_rate_by_category(answers, bank), "category", "ineffective", "total") == [("c", 1, 4)]
    again = table(BANK, (1, 0, "x", "c"), (2, 1, "y", "c"), (1, 2, "z", "d"))
    assert rows(responses.answer_rate_by_type(answers, again), "question_type", "total") == [("y", 1), ("z", 2)]


def test_own_value_goes_first(table, rows):
    answers = table(RESPONSES + ", question_type string", (1, 1, "a", True, "own"), (1, 1, "a", True, ""), (1, 9, "a", True, "own"), (1, 9, "a", True, None))
    bank = table(BANK, (1, 0, "x", "c"))
    assert rows(responses.answer_rate_by_type(answers, bank), "question_type", "total") == [("own", 2), ("x", 1)]


def test_user_matrix(table, rows):
    answers = table(RESPONSES, *ANSWERS)
    bank = table(BANK, (1, 0, "x", "c"), (2, 1, "y", "d"))
    rates = responses.user_category_rates(answers, bank)
    assert rows(rates, "user_id", "category", "rate") == [(1, "c", 1.0), (1, "d", 0.0), (2, "c", 0.0)]
    matrix = responses.user_category_matrix(rates)
    assert matrix.columns == ["user_id", "c", "d"] and rows(matrix, "*") == [(1, 1.0, 0.0), (2, 0.0, None)]


@pytest.mark.parametrize("parts", [1, 4])
def test_correlation(table, parts):
    cells = table("u bigint, c string, v double", (1, "a", 0.0), (2, "a", 1.0), (1, "b", 1.0), (2, "b", 0.0), (1, "k", 0.1), (2, "k", 0.1), (3, "z", 1.0), parts=parts)
    out = {(r.col_i, r.col_j): r.corr for r in correlation.correlation_matrix(cells, "u", "c", "v").collect()}
    assert len(out) == 16 and out[("a", "b")] == pytest.approx(-1.0) and out[("a", "a")] == pytest.approx(1.0)
    assert out[("a", "k")] is None and out[("k", "k")] is None and out[("z", "z")] == 0.0 and out[("a", "z")] == 0.0
    assert all(out[(i, j)] == out[(j, i)] for i, j in out)


def test_correlation_in_blocks(spark, monkeypatch):
    """Many columns are handled block by block and users may stretch over batches."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    dense = rng.random((40, 7))
    dense[rng.random((40, 7)) < 0.3] = np.nan
    long = [(u, f"c{c}", float(dense[u, c])) for u in range(40) for c in range(7) if not np.isnan(dense[u, c])]
    for name, value in (("BLOCK", 3), ("CHUNK", 60), ("CELLS", 50)):
        monkeypatch.setattr(correlation, name, value)
    pdf = pd.DataFrame(long, columns=["row_id", "col", "value"])
    parts = pd.concat(correlation._partition_moments(iter([pdf[:50], pdf[50:51], pdf[51:]])))
    assert len(parts) > 2 * 49  # several parts per pair, which are merged without loss
    merged = correlation.merged_moments(spark.createDataFrame(parts, correlation.SCHEMA)).toPandas().set_index(["col_i", "col_j"])
    for i in range(7):
        for j in range(7):
            both = ~np.isnan(dense[:, i]) & ~np.isnan(dense[:, j])
            x, y = dense[both, i], dense[both, j]
            want = [both.sum(), x.mean(), y.mean(), x.var() * len(x), y.var() * len(x), ((x - x.mean()) * (y - y.mean())).sum(), x.min(), x.max(), y.min(), y.max()]
            assert merged.loc[(f"c{i}", f"c{j}"), [*correlation.MOMENTS, *correlation.RANGES]].to_list() == pytest.approx(want)


@pytest.mark.parametrize("parts", [1, 5])
def test_correlation_of_columns_that_hardly_vary(table, parts, monkeypatch):
    """Values that differ in their ninth digit after the point, beside values far away that a pair does not share."""
    import random

    import duckdb

    rng = random.Random(4)
    cells = [(u, c, 5.0 + rng.randrange(9) * 1e-9) for u in range(300) for c in "abc" if rng.random() < 0.8]
    cells += [(u, "d", 5.0 + 1e-9 * u + 1e-10 * rng.randrange(50)) for u in range(0, 300, 2)]
    cells += [(u, c, 900.0) for u in range(300, 400) for c in "ad" if (u % 2 == 0) == (c == "a")] + [(500, "alone", 1.0), (501, "alone", 2.0)]
    monkeypatch.setattr(correlation, "CHUNK", 100)
    got = {(r.col_i, r.col_j): (r.n, r.corr) for r in correlation.correlated_pairs(table("u bigint, c string, v double", *cells, parts=parts), "u", "c", "v").collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE cells (u BIGINT, c VARCHAR, v DOUBLE)")
    con.executemany("INSERT INTO cells VALUES (?, ?, ?)", cells)
    want = con.execute("SELECT a.c, b.c, count(*), corr(a.v, b.v) FROM cells a JOIN cells b ON a.u = b.u GROUP BY 1, 2").fetchall()
    assert set(got) == {(i, j) for i, j, _, _ in want} and ("alone", "a") not in got
    for i, j, n, corr in want:
        assert got[(i, j)][0] == n and got[(i, j)][1] == pytest.approx(corr, abs=1e-6)


def test_counts(table, rows):
    df = table("s int, v double, t string, seq bigint", (1, 2.0, "a", 0), (1, 2.0, "a", 1), (5, 2.0, "b", 2))
    assert rows(counts.level_counts(df, "s", [1, 2, 3, 4, 5]), "level", "count") == [(1, 2), (2, 0), (3, 0), (4, 0), (5, 1)]
    bins = counts.histogram(df, "v")
    assert rows(bins, "bin", "count") == [(0, 0), (1, 0), (2, 0), (3, 3), (4, 0), (5, 0)]
    assert bins.agg(F.min("bin_from"), F.max("bin_to")).first()[:] == (1.5, 2.5)
    assert counts.density_curve(df, "v").count() == 0 and counts.histogram(df.limit(0), "v").count() == 0
    report = counts.frequency_report(df.groupBy("t").agg(F.count("*").alias("frequency"), F.min("seq").alias("seq")), "t")
    assert ("frequency_distribution", "1", 1) in rows(report, "metric", "key", "value")
    assert rows(counts.frequency_report(df.limit(0).groupBy("t").agg(F.count("*").alias("frequency"), F.min("seq").alias("seq")), "t"), "*") == []


def test_statistics_and_checks(table, rows):
    bank = table(BANK, (1, 0, None, None), (2, 1, "x", "c"))
    stats = counts.bank_statistics(bank, bank.limit(1), bank.limit(0))
    assert rows(stats, "metric", "key", "value") == [
        ("categories_distribution", "Uncategorized", 1), ("categories_distribution", "c", 1),
        ("question_types_distribution", "Unknown", 1), ("question_types_distribution", "x", 1),
        ("total_questionnaires", "", 1), ("total_questions", "", 2), ("total_users", "", 0)]
    assert rows(counts.count_checks(stats), "*") == [("category counts", True), ("type counts", True)]


def test_retrieval(spark, table):
    corpus = table("seq bigint, question_text string, difficulty_score int, options_text string",
                   (0, "good hotel", 3, "a / b"), (1, "good room", 1, ""), (2, "bad bus", 1, None))
    asked = table("query_id bigint, text string", (1, "hotel"), (2, "good"), (3, "good hotel"), (4, "unknown"))
    index = retrieval.build_index(corpus, "seq", "question_text", [])
    out = retrieval.generate_survey(corpus, index, asked, 10, []).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.seq, round(r.score, 6)) for r in out] == [
        (1, 0, 0.795961), (2, 0, 0.605349), (2, 1, 0.605349), (3, 0, 1.0), (3, 1, 0.366447)]
    assert out[0].stars == "★★★☆☆" and out[0].match_percent == 79 and out[0].options_text == "a / b" and out[2].options_text is None
    assert all(0.05 < r.score <= 1.0 + 1e-9 for r in out)


def test_retrieval_by_language(table, rows):
    corpus = table("seq bigint, question_text string, difficulty_score int, options_text string, lang string",
                   (0, "good hotel", 3, None, "en"), (1, "good room", 1, None, "en"), (2, "good hotel", 1, None, "fr"), (3, "bad hotel", 1, None, "fr"))
    pools = retrieval.language_pools(corpus, "seq", "question_text", {"en": [], "fr": ["bad"]}, "lang")
    asked = table("query_id bigint, text string, lang string, k int", (1, "good", "en", 1), (2, "good", "en", 5), (3, "good", "fr", 5), (4, "bad", "fr", 5), (5, "good", "xx", 5))
    out = retrieval.generate_survey_by_language(pools, asked, "k")
    assert rows(out, "query_id", "rank", "seq") == [(1, 1, 0), (2, 1, 0), (2, 2, 1), (3, 1, 2)]


def test_requests_in_normal_form(table, rows):
    """Pool keys and requests meet in one normal form: hotels and inn both become stay."""
    raw = table("seq bigint, question_text string, options_text string, question_type string",
                (0, "Which hotels are good?", "", "yes_no"), (1, "Is the bus late?", "", "yes_no"))
    options = {"stop_words": ["the", "is", "which", "are"], "lemmas": {"hotels": "hotel"}, "synonyms_en": [("hotel", "stay"), ("inn", "stay")]}
    pool = cleaning.prepare_pool(raw, **options)
    index = retrieval.build_index(pool, "seq", "dedup_key", [], shown="question_text")
    asked = retrieval.normalize_requests(table("query_id bigint, text string, lang string", (1, "An inn", "en"), (2, "late BUS", "en")), **options)
    out = retrieval.generate_survey(pool, index, asked, 5, [])
    assert rows(out, "query_id", "rank", "seq", "question_text") == [(1, 1, 0, "Which hotels are good?"), (2, 1, 1, "Is the bus late?")]
    assert rows(retrieval.analyze_requirements(asked, index, 1, []), "query_id", "rank", "term") == [(1, 1, "stay"), (2, 1, "bus")]


def test_retrieval_from_written_index(spark, table, tmp_path):
    corpus = table("seq bigint, text string", *[(i, f"word{i % 5} word{i % 3} common") for i in range(30)])
    index = retrieval.build_index(corpus, "seq", "text", [])
    retrieval.write_index(index, str(tmp_path / "index"))
    back = retrieval.read_index(spark, str(tmp_path / "index"))
    asked = table("q bigint, text string", (1, "word1 common"))

    def answer(idx):
        wanted = retrieval.request_weights(asked, idx.vocabulary, "q", "text", [])
        best = retrieval.ranked_matches(retrieval.cosine_scores(idx, wanted), 3)
        return [(r.doc, round(r.score, 9), r.rank) for r in best.orderBy("rank").collect()]

    texts = {r.seq: r.text for r in corpus.collect()}
    assert answer(index) == answer(back) and len({texts[d] for d, *_ in answer(index)}) == len(answer(index))


def test_ids(table, rows):
    df = table("seq bigint, g string", *[(i * 10, "a" if i % 3 else "b") for i in range(50)], parts=6)
    assert rows(sources.ordered_index(df, ["seq"]), "seq", "idx") == [(i * 10, i) for i in range(50)]
    ranked = rows(sources.ranked_within(df, ["g"], ["seq"]), "g", "rank")
    assert ranked == [("a", i + 1) for i in range(33)] + [("b", i + 1) for i in range(17)]
    empty = table("id bigint, seq bigint")
    new = table("seq bigint, t string", (5, "x"), (3, "y"))
    assert rows(sources.next_ids(empty, new), "id", "t") == [(1, "y"), (2, "x")]
    assert rows(sources.ordered_index(df.limit(0), ["seq"]), "*") == []


def test_edits(table, rows):
    bank = table("id bigint, question_text string, usage_count bigint", (1, "a", 4), (2, "b", None))
    grown = edits.append_questions(bank, table("seq bigint, question_text string", (0, "c")))
    assert rows(grown, "id", "question_text", "usage_count") == [(1, "a", 4), (2, "b", None), (3, "c", 0)]
    lists = table("id bigint, question_ids array<bigint>", (1, [1]))
    created = edits.create_questionnaires(lists.withColumn("status", F.lit("open")), table("seq bigint, title string", (0, "t")))
    assert rows(created, "id", "status", F.size("question_ids")) == [(1, "open", 1), (2, "draft", 0)]


def test_links_and_repeat(table, rows):
    lists = table("id bigint, question_ids array<bigint>", (1, [1]))
    bank = table("id bigint, usage_count bigint", (1, 0), (2, 0))
    asked = table("seq bigint, questionnaire_id bigint, question_id bigint", (0, 1, 1), (1, 1, 2), (2, 1, 2), (3, 1, 99), (4, 9, 1))
    result = edits.link_questions(asked, lists, bank)
    assert rows(result.status, "seq", "ok") == [(0, True), (1, True), (2, True), (3, False), (4, False)]
    links, bank2 = edits.apply_links(lists, bank, result)
    assert rows(links, "*") == [(1, 0, 1), (1, 1, 2)]
    assert rows(bank2, "id", "usage_count") == [(1, 0), (2, 1)]
    lists2 = table("id bigint, question_ids array<bigint>", (1, [1, 2]))
    links3, bank3 = edits.apply_links(lists2, bank2, edits.link_questions(asked, lists2, bank2))
    assert rows(links3, "*") == rows(links, "*") and rows(bank3, "*") == rows(bank2, "*")


def test_ingest(table, rows):
    raw = table("seq bigint, text string", (0, "a"), (1, ""), (2, "a"), (3, "k"), (4, "b"))
    out = edits.ingest_raw(raw, table("text string", ("k",)), F.col("text") != "", first_id=10)
    assert rows(out.accepted, "seq", "question_id") == [(0, "Q0010"), (4, "Q0011")]
    assert rows(out.rejected, "seq", "reason") == [(1, "invalid"), (2, "duplicate"), (3, "duplicate")]
    assert rows(out.summary, "*") == [("added", 2), ("duplicate", 2), ("invalid", 1)]


def test_requirements(table, rows):
    bank = table("id bigint, category string, difficulty double", (1, "p", 2.5), (2, "q", 1.0), (3, "p", 3.0), (4, "r", 2.0))
    need = table("id bigint, question_count int, categories array<string>, difficulty_range array<double>", (7, 1, ["p", "q"], [1.0, 2.5]), (8, 5, ["p", "p"], [1.0, 9.0]))
    assert rows(selection.questions_for_requirements(bank, need), "questionnaire_id", "rank", "question_id") == [(7, 1, 1), (8, 1, 1), (8, 2, 3)]


def test_requirements_by_bands(spark):
    """2,000 difficulties and a hot category: equal to plain code, and little more is joined than is taken."""
    import random

    rng = random.Random(6)
    bank = [(i, rng.choice(["hot", "hot", "b", "c"]), rng.randrange(2000) / 7) for i in range(6000)] + [(9000, "b", None), (9001, None, 3.0)]
    need = [(q, rng.randrange(1, 9), rng.sample(["hot", "b", "c", "none"], 2), sorted([rng.uniform(-20, 300), rng.uniform(-20, 300)])) for q in range(100)]
    need += [(200, 3, ["b"], [5.0, 4.0]), (201, 3, ["b"], [bank[4][2]] * 2), (202, 3, ["hot"], [400.0, 500.0]), (203, None, ["hot"], [0.0, 9.0]), (204, 2, ["hot"], [-5.0, 900.0])]
    banked = spark.createDataFrame(bank, "id bigint, category string, difficulty double").repartition(4)
    needed = spark.createDataFrame(need, "id bigint, question_count int, categories array<string>, difficulty_range array<double>")
    got = sorted((r.questionnaire_id, r["rank"], r.question_id) for r in selection.questions_for_requirements(banked, needed).collect())
    want = []
    for q, n, categories, (low, high) in need:
        fit = sorted(i for i, c, d in bank if c in categories and d is not None and low <= d <= high)
        want += [(q, k + 1, i) for k, i in enumerate(fit[: n or 0])]
    assert got == sorted(want)
    assert selection.matching_questions(banked, needed, 8).count() < 10 * len(got)
    one = spark.createDataFrame([(1, "b", 2.0)], "id bigint, category string, difficulty double")
    assert selection.questions_for_requirements(one, needed.limit(0)).count() == 0 and selection.questions_for_requirements(banked.limit(0), needed).count() == 0


def test_dictionary_keys_equal_the_column_rule(spark, table):
    """The join with a lexicon gives the keys of the rule with literal lists, and takes a lexicon of any size."""
    from surveyloom.functions.text import dedup_key

    stop, lemmas, synonyms = ["the", "is"], {"hotels": "hotel", "rooms": "room", "is": "be"}, [("hotel", "inn"), ("hotel", "stay"), ("room", "chamber"), ("the", "a")]
    df = table("seq bigint, text string, dedup_key string", (1, "The hotels, IS the Rooms is", "x"), (2, None, "x"), (3, "hotel hotel 12 b_c", "x"), (4, "the", "x"), (5, "...", "x"))
    lexicon = firstwins.composed_lexicon(
        spark.createDataFrame([(w,) for w in stop], "word string"), spark.createDataFrame(list(lemmas.items()), "word string, target string"),
        spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(synonyms)], "word string, target string, seq int"))
    plain = df.withColumn("want", dedup_key(F.col("text"), F.lit("en"), stop, lemmas, synonyms))
    got = firstwins.dictionary_keys(plain, "text", lexicon).collect()
    assert len(got) == 5 and all(r.dedup_key == r.want for r in got)
    large = lexicon.unionByName(spark.range(100_000).select(F.concat(F.lit("word"), "id").alias("word"), F.concat(F.lit("t"), "id").alias("target")))
    found = firstwins.dictionary_keys(plain.unionByName(table("seq bigint, text string, dedup_key string, want string", (9, "word77 hotels word99999 word100000", "x", "t77 stay t99999 word100000"))), "text", large)
    assert all(r.dedup_key == r.want for r in found.collect())
    assert "map(" not in firstwins.dictionary_keys(df, "text", large)._jdf.queryExecution().optimizedPlan().toString()


def test_top_of_a_hot_group_for_any_k(spark):
    """k = 5,000 of a group with two thirds of all rows: the parts of the group share the work."""
    df = spark.range(0, 60_000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).when(F.col("id") % 997 != 0, "hot").alias("g"), ((F.col("id") * 7919) % 60_000).alias("v"))
    got = firstwins.top_per_group(df, ["g"], [F.desc("v")], 5_000, rank="rank").cache()
    hot = sorted((r.v for r in df.where("g = 'hot'").collect()), reverse=True)[:5_000]
    assert [r.v for r in got.where("g = 'hot'").orderBy("rank").collect()] == hot
    assert got.where("g != 'hot'").agg(F.count("*"), F.max("rank")).first()[:] == (20_000, 1)
    assert got.where("g is null").agg(F.max("rank"), F.count("*")).first()[:] == (df.where("g is null").count(),) * 2
    parts = df.where("g = 'hot'").withColumn("p", F.pmod(F.monotonically_increasing_id(), F.lit(firstwins.PARTS))).groupBy("p").count().agg(F.max("count"), F.median("count")).first()
    assert parts[0] <= 2 * parts[1]
    assert [r.v for r in firstwins.top_per_group(df, ["g"], [F.desc("v")], 3).where("g = 'hot'").collect()] == hot[:3]


def test_requirements_plan_has_no_cross_join(table):
    bank = table("id bigint, category string, difficulty double", (1, "p", 2.5))
    need = table("id bigint, question_count int, categories array<string>, difficulty_range array<double>", (7, 1, ["p"], [1.0, 2.5]))
    plan = selection.questions_for_requirements(bank, need)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_random_questions_do_not_depend_on_partitions(table, rows):
    picked = [rows(selection.random_questions(table("id bigint", *[(i,) for i in range(100)], parts=p), 7, 3), "id") for p in (1, 7)]
    assert picked[0] == picked[1] and len(picked[0]) == 7


def test_enlarge(table, rows):
    bank = table("seq bigint, question_text string, source_name string, source_url string", *[(i, f"hotel {i} service", "s", "u") for i in range(100)])
    out = edits.enlarge_bank(bank, 130, 1, lex.VARIANT_WORDS)
    added = out.filter("variant is not null")
    assert out.count() == 130 and added.count() == 30
    assert added.filter(~F.col("question_text").rlike("property|accommodation") | F.col("question_text").contains("hotel")).count() == 0
    assert rows(added.select("source_name", "source_url").distinct(), "*") == [("Generated-s", "generated")]
    assert edits.enlarge_bank(bank.limit(99), 130, 1, lex.VARIANT_WORDS).count() == 99
    assert edits.enlarge_bank(bank, 100, 1, lex.VARIANT_WORDS).count() == 100


NODES = "question_id bigint, cluster_id int, complexity string, category string"


def test_hierarchy(table, rows):
    tree = hierarchy.build_hierarchy(table(NODES, (1, 0, "easy", "a"), (2, 0, "easy", "a"), (3, 0, "hard", "b"), (4, 0, "hard", "b")))
    assert rows(tree, "question_id", "parent_id", "depth", "is_root", "is_leaf") == [
        (1, None, 0, True, False), (2, None, 0, True, True), (3, 1, 1, False, True), (4, 1, 1, False, True)]
    assert rows(hierarchy.hierarchy_summary(tree), "*") == [(4, 1, 2, 3)]
    deep = hierarchy.build_hierarchy(table(NODES, (5, 0, "easy", "a"), (6, 0, "medium", "a"), (7, 0, "hard", "b"), (8, 1, "medium", "b"), (9, 1, "hard", "b")))
    assert rows(deep, "question_id", "parent_id", "depth") == [(5, None, 0), (6, 5, 1), (7, 6, 2), (8, None, 0), (9, 8, 1)]


def brute_force_next(nodes, parents, answers, current, assoc, answer_rules, k):
    cluster, category = {n[0]: n[1] for n in nodes}, {n[0]: n[3] for n in nodes}
    out = []
    for user, cur in current:
        answered = {q: a for u, q, a in answers if u == user}
        best = {}
        for q in cluster:
            strategies = [1] * (parents.get(q) == cur) + [2] * (cluster[q] == cluster[cur])
            strategies += [3 for word, c in answer_rules if word in (answered.get(cur) or "") and category[q] == c]
            strategies += [4 for a, b in assoc if a == category[cur] and category[q] == b]
            if strategies and q not in answered and q != cur:
                best[q] = min(strategies)
        out += [(user, q, s, i + 1) for i, (q, s) in enumerate(sorted(best.items(), key=lambda x: (x[1], x[0]))[:k])]
    return sorted(out)


def test_next_questions_against_brute_force(spark, table, rows):
    import random

    rng = random.Random(3)
    nodes = [(i, rng.choice([0, 0, 0, 1, 2]), rng.choice(["easy", "medium", "hard"]), rng.choice("abcd")) for i in range(60)]
    answers = sorted({(u, rng.randrange(60)): None for u in range(8) for _ in range(12)})
    answers = [(u, q, rng.choice(["low budget", "yes", "no"])) for u, q in answers]
    current = [(u, rng.choice([q for v, q, _ in answers if v == u] + [59])) for u in range(8)]
    assoc, answer_rules = [("a", "b"), ("b", "c"), ("c", "c")], [("budget", "d"), ("e", "a")]
    tree = hierarchy.build_hierarchy(table(NODES, *nodes))
    parents = {r.question_id: r.parent_id for r in tree.collect()}
    got = hierarchy.next_questions(
        tree, hierarchy.ranked_groups(tree), table("user_id bigint, question_id bigint", *current),
        table("user_id bigint, question_id bigint, answer string", *answers),
        table("category string, associated string", *assoc), answer_rules, 6)
    assert rows(got, "user_id", "question_id", "strategy", "rank") == brute_force_next(nodes, parents, answers, current, assoc, answer_rules, 6)


def test_clean_questions(table, rows):
    raw = table("seq bigint, question_id string, text string, options array<string>, source_platform string, original_category string",
                (0, None, "<b>Hi</b> there?", ["A. x", "B. y"], None, "o"), (1, "k", "Hi there?", None, "p", None), (2, "z", "", [], "p", "o"), (3, "w", "<p></p>", [], "p", "o"))
    out = cleaning.clean_questions(raw)
    assert rows(out, "seq", "question_id", "text", "question_type", "category", "complexity", "frequency", "source_platform") == [
        (0, "Q0000", "Hi there?", "single_choice", "general", "easy", 2, "unknown")]


def test_load_and_process(table, rows):
    raw = table("seq bigint, question_text string, options_text string, question_type string",
                (0, "Q1. The hotel room?", "", "open_ended"), (1, "hotel room", None, "yes_no"), (2, "您好吗？", "", None), (3, "x", "", "yes_no"))
    parts = cleaning.load_and_process(raw, lex.TOPICS, stop_words=["the"])
    assert rows(parts["cleaning"], "*") == [("en", 1), ("raw", 4), ("valid", 2), ("zh", 1)]
    assert ("en", "topic", "Hotel/Accommodation", 1) in rows(parts["content"], "*")
    assert ("zh", "topic", "Hotel/Accommodation", 0) in rows(parts["content"], "*")
    zh = cleaning.content_report(table("question_text string, question_type string, detected_lang string, difficulty_score int", ("酒店 hotel food", "x", "zh", 1)), lex.TOPICS)
    assert {r[2]: r[3] for r in rows(zh, "*") if r[1] == "topic" and r[3]} == {"Hotel/Accommodation": 1}
    assert rows(parts["en"], "seq") == [(0,)] and rows(parts["zh"], "seq") == [(2,)]
    strict = cleaning.prepare_pool(raw, require_question_mark=True, stop_words=["the"])
    assert rows(strict, "seq") == [(0,), (2,)]


def test_reports(table, rows):
    answers = table(RESPONSES, *ANSWERS)
    bank = table(BANK, (1, 0, "x", "c"), (2, 1, "y", "d"))
    parts = reports.analyze_results(answers, bank)
    assert rows(parts["answer_rate"], "question_type", "answer_rate") == [("x", 0.5), ("y", 0.0)]
    types = reports.user_types(parts["user_rates"])
    assert rows(types, "user_id", "user_type") == [(1, "c"), (2, "c")]
    assert ("total_users", "", 2.0) in rows(reports.all_users_report(types), "*")


def test_bank_document(spark, tmp_path, rows):
    path = tmp_path / "bank.json"
    path.write_text(json.dumps({"questions": [
        {"id": 4, "question_text": "a", "options": {"min": 1, "max": 5, "labels": ["l"]}, "difficulty": 2.0, "tags": ["t"]},
        {"id": 5, "question_text": "b", "options": ["x", "y"]}, {"id": 6, "question_text": "c", "options": None},
        {"id": 7, "question_text": "d", "options": "p / q"}],
        "questionnaires": [{"id": 1, "title": "t", "question_ids": [4, 6], "requirements": {"question_count": 2, "categories": ["c"], "difficulty_range": [1.0, 2.0]}}],
        "users": [{"id": 1, "username": "u"}]}, indent=1))
    bank = sources.read_bank(spark, str(path))
    questions = sources.bank_questions(bank)
    assert rows(questions, "id", "seq", F.array_join("options", "|"), "scale.max") == [(4, 0, None, 5), (5, 1, "x|y", None), (6, 2, None, None), (7, 3, "p|q", None)]
    lists = sources.bank_questionnaires(bank)
    assert rows(selection.expand_questionnaires(lists, questions.select("id", "question_text")), "position", "question_id") == [(0, 4), (1, 6)]
    assert sources.bank_users(bank).count() == 1
    missing = sources.read_bank(spark, str(tmp_path / "none.json"))
    assert [f(missing).count() for f in (sources.bank_questions, sources.bank_questionnaires, sources.bank_users)] == [0, 0, 0]


def test_question_lists_and_responses(spark, tmp_path, rows):
    items = [{"question_text": f"q{i}", "options_text": ""} for i in range(3)]
    (tmp_path / "bare.json").write_text(json.dumps(items, indent=1))
    (tmp_path / "wrapped.json").write_text(json.dumps({"fullContent": items}, indent=1))
    for name in ("bare.json", "wrapped.json"):
        got = sources.read_question_list(spark, str(tmp_path / name))
        assert rows(got, "seq", "question_text") == [(0, "q0"), (1, "q1"), (2, "q2")]
    folder = tmp_path / "many"
    folder.mkdir()
    lines = [json.dumps({"fullContent": items}), json.dumps({"question_text": "alone"}), json.dumps({"fullContent": items})]
    (folder / "a.json").write_text("\n".join(lines))
    (folder / "b.json").write_text(lines[0])
    got = sources.read_question_list(spark, str(folder), multi_line=False)
    assert rows(got, "seq", "question_text") == list(enumerate(["q0", "q1", "q2", "alone", *["q0", "q1", "q2"] * 2]))
    (tmp_path / "r.json").write_text(json.dumps({"responses": [{"user_id": 1, "question_id": 2, "answer": "a"}, {"user_id": 1, "question_id": 2, "answer": "b", "effective": None}]}))
    assert rows(sources.read_responses(spark, str(tmp_path / "r.json")), "seq", "answer", "effective") == [(0, "a", None), (1, "b", None)]


def test_convert_rows(table, rows):
    raw = table("seq bigint, question_text string, options_text string, category string", (0, "a", None, None), (1, None, "x", "c"))
    assert rows(sources.convert_rows(raw), "id", "question_text", "question_type", "options", "category", F.array_join("tags", "|")) == [
        (1, "a", "text", None, "general", "general|en"), (2, "", "text", "x", "c", "c|en")]
    told = sources.convert_rows(raw.withColumn("has", F.lit(True)), {"category": F.col("has")})
    assert rows(told, "id", "category") == [(1, None), (2, "c")]


def test_workflow(table, rows):
    words = ["hotel", "room", "bus", "train", "food", "meal"]
    raw = table("seq bigint, text string, options array<string>, source_platform string, original_category string",
                *[(i, f"{words[i % 6]} question number {'long ' * (i % 9)} {i}", [], "p", "o") for i in range(40)])
    parts = workflow.full_workflow(raw, table("text string", ("k",)), k=3)
    assert parts["summary"].first()["total_nodes"] == 40 and parts["summary"].first()["max_depth"] <= 2
    assert parts["clusters"].agg(F.sum("questions")).first()[0] == 40


def test_workflow_cuts_texts_into_terms_once(table, monkeypatch):
    """Frequencies, vectors and clusters each cut all texts into terms again."""
    from surveyloom.operators import clusters

    calls, plain = [], clusters.terms
    monkeypatch.setattr(clusters, "terms", lambda *a: calls.append(a) or plain(*a))
    raw = table("seq bigint, text string, options array<string>, source_platform string, original_category string",
                *[(i, f"{['hotel room', 'bus train'][i % 2]} and the question {i}", [], "p", "o") for i in range(30)])
    parts = workflow.full_workflow(raw, table("text string", ("k",)), k=2)
    assert len(calls) == 1 and not [c for part in parts.values() for c in part.columns if c.startswith("_")]
    model = clusters.fit_clusters(parts["processed"], "text", 2, 7)
    pick = lambda df: {r.question_id: (r.features, r.cluster_id) for r in df.collect()}
    assert pick(clusters.assign_clusters(model, parts["processed"])) == pick(parts["assigned"])


def test_upload(spark, tmp_path, rows):
    bank = str(tmp_path / "bank")
    (tmp_path / "a.json").write_text(json.dumps([{"question_text": t, "category": "c"} for t in ("x", "y", "x")]))
    (tmp_path / "b.json").write_text(json.dumps({"fullContent": [{"question_text": t} for t in ("y", "z")]}))
    empty = sources.convert_rows(sources.read_question_list(spark, str(tmp_path / "a.json"))).limit(0)
    empty.write.parquet(bank)
    assert workflow.upload_questions(spark, str(tmp_path / "a.json"), bank) == 2
    assert workflow.upload_questions(spark, str(tmp_path / "b.json"), bank) == 1
    assert rows(spark.read.parquet(bank), "id", "question_text", "category") == [(1, "x", "c"), (2, "y", "c"), (3, "z", "general")]


def test_chart_tables(spark, table, tmp_path, rows):
    from surveyloom.operators import clusters

    bank = table(BANK + ", question_text string, options_text string, difficulty double, source_name string",
                 *[(i, i, "x", "c" if i % 2 else "general", f"words about topic{i % 3} number{i}", "", float(i % 4), "s") for i in range(24)])
    answers = table(RESPONSES, *ANSWERS)
    model = clusters.fit_clusters(bank, "question_text", k=2, features=32)
    assigned = clusters.assign_clusters(model, bank, "question_text")
    assert -1.0 <= clusters.silhouette(assigned) <= 1.0
    assert clusters.assign_clusters(None, bank).select("cluster_id").distinct().collect() == [(0,)]
    tree = hierarchy.build_hierarchy(table(NODES, *[(i, i % 2, "easy" if i % 3 else "hard", "c") for i in range(24)]))
    edges = hierarchy.relationships(tree, spark.createDataFrame([("c", "c")], "category string, associated string"))
    tables = reports.chart_tables(bank, answers, assigned=assigned, tree=tree, edges=edges)
    reports.write_chart_tables(tables, str(tmp_path / "charts"))
    back = {name: spark.read.parquet(str(tmp_path / "charts" / name)) for name in tables}
    assert rows(back["categories"], "*") == [("c", 12)]
    assert back["difficulty"].agg(F.sum("count")).first()[0] == 24 and back["cluster_positions"].count() == 24
    assert rows(back["complexity"], "complexity", "count") == [("easy", 16), ("hard", 8)]
    assert back["graph_nodes"].agg(F.sum("in_degree"), F.sum("out_degree")).first()[:] == (back["graph_edges"].count(),) * 2


def test_projection_keeps_angles():
    import numpy as np

    from surveyloom.operators import clusters

    rng = np.random.default_rng(3)
    sets = [rng.choice(5000, 60, replace=False) for _ in range(30)]
    sets += [np.r_[s[:45], rng.choice(np.arange(5000, 9000), 15, replace=False)] for s in sets[:10]]  # 75 % alike
    row, code = np.repeat(np.arange(40), 60), np.concatenate(sets).astype(np.uint64)
    x = clusters.project(row, code, np.ones(len(code)), 41, 256, 7)
    assert np.allclose((x * x).sum(axis=1), [1.0] * 40 + [0.0])
    cosines = x @ x.T
    true = np.array([[len(set(a) & set(b)) / 60 for b in sets] for a in sets])
    assert np.abs(cosines[:40, :40] - true).max() < 0.35 and np.abs(cosines[:40, :40] - true).mean() < 0.07
    assert all(abs(cosines[i, 30 + i] - 0.75) < 0.2 for i in range(10))


def test_clusters_find_topics_and_silhouettes(table):
    import numpy as np

    from surveyloom.operators import clusters

    topics = [[f"{t}{i}" for i in range(30)] for t in ("hotel", "train", "menu")]
    rng = __import__("random").Random(2)
    rows_ = [(i, " ".join(rng.choices(topics[i % 3], k=12)), i % 3) for i in range(150)] + [(200, None, 0), (201, "", 1)]
    bank = table("seq bigint, text string, topic int", *rows_)
    model = clusters.fit_clusters(bank, "text", k=3, stop_words=[])
    assigned = clusters.assign_clusters(model, bank).collect()
    of = {}
    for r in assigned:
        if r.seq < 150:
            of.setdefault(r.topic, set()).add(r.cluster_id)
    assert all(len(c) == 1 for c in of.values()) and len(set.union(*of.values())) == 3
    assert len(model.centres) == 3 and model.centres.shape[1] == 256
    # Silhouettes against all pairs, with an all-zero vector, a group of one and a null group.
    points = [(i, [float(v) for v in np.random.default_rng(i).normal(size=3)], i % 3) for i in range(20)] + [(50, [0.0, 0.0, 0.0], 1), (51, [1.0, 2.0, 0.5], 9), (52, [1.0, 1.0, 1.0], None)]
    got = {r.seq: r.silhouette for r in clusters.silhouettes(table("seq bigint, v array<double>, g int", *points), "v", "g").collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, g in points if any(v) and g is not None}
    group = {i: g for i, _, g in points}
    for i, x in unit.items():
        far = {}
        for j, y in unit.items():
            if i != j:
                far.setdefault(group[j], []).append(1 - x @ y)
        mean = {g: np.mean(d) for g, d in far.items()}
        a, b = mean.pop(group[i], None), min(mean[g] for g in mean if g != group[i])
        assert got[i] == pytest.approx(0.0 if a is None else (b - a) / max(a, b))
    assert got[50] is None and got[52] is None


def test_scatter_is_principal_components(table):
    import numpy as np

    from surveyloom.operators import clusters

    x = np.random.default_rng(5).normal(size=(60, 4)) * [5, 2, 0.5, 0.1]
    placed = clusters.scatter_positions(table("seq bigint, cluster_id int, features array<float>", *[(i, 0, [float(v) for v in row]) for i, row in enumerate(x)])).collect()
    x = x.astype(np.float32).astype(float)
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :2]
    got, want = np.array([[r.x, r.y] for r in sorted(placed, key=lambda r: r.seq)]), x @ axes
    assert np.allclose(got * np.sign((got * want).sum(axis=0)), want, atol=1e-6)


def test_texts_stay_out_of_python_and_spans_are_bounded(spark):
    """Only codes of terms go to Python: the other columns of a row stay in Spark, and vectors are made span by span."""
    import numpy as np

    from surveyloom.operators import clusters

    rows = [(i, " ".join(f"w{(i * 7 + j) % 90}" for j in range(i % 40))) for i in range(120)] + [(500, None)]
    bank = spark.createDataFrame(rows, "seq bigint, text string").repartition(2)
    model = clusters.fit_clusters(bank, "text", k=3, stop_words=[])
    assigned = clusters.assign_clusters(model, bank)
    plan = assigned._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    assert assigned.columns == ["seq", "text", "features", "cluster_id"] and assigned.count() == len(rows)
    sizes = np.array([0, clusters.SPAN, 1, clusters.SPAN * 3, *[1] * (clusters.SPAN_ROWS + 5)])
    spans = list(clusters._spans(sizes))
    assert [s for start, n in spans for s in range(start, start + n)] == list(range(len(sizes)))
    assert all(n == 1 or (sizes[start:start + n].sum() <= clusters.SPAN and n <= clusters.SPAN_ROWS) for start, n in spans)
