"""What a task sorts, sends or reads does not grow where it need not."""

import random

from pyspark.sql import functions as F

from checks import CHECKS
from surveyloom import sources
from surveyloom.operators import retrieval
from surveyloom.operators import selection as sel
from surveyloom.sources import ids


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_products_are_added_up_where_the_weights_of_a_document_are(spark, tmp_path):
    corpus = spark.createDataFrame([(i, f"hotel w{i % 7} x{i % 3}") for i in range(60)], "seq bigint, text string")
    asked = spark.createDataFrame([(1, "hotel w3"), (2, "x1 x1 w5")], "q bigint, text string")
    index = retrieval.build_index(corpus, "seq", "text", [])
    wanted = retrieval.request_weights(asked, index.vocabulary, "q", "text", [])
    fresh = retrieval.cosine_scores(index, wanted)
    assert "hashpartitioning(query" not in _plan(fresh)
    retrieval.write_index(index, str(tmp_path / "index"))
    read = retrieval.cosine_scores(retrieval.read_index(spark, str(tmp_path / "index")), wanted)
    assert "hashpartitioning(query" not in _plan(read)
    got, again = [sorted((r.query, r.doc, round(r.score, 9)) for r in df.collect()) for df in (fresh, read)]
    assert got == again and {(q, d) for q, d, _ in got} == {(1, d) for d in range(60)} | {(2, d) for d in range(60) if d % 3 == 1 or d % 7 == 5}


def test_runs_of_bands_are_made_from_the_first_questions_of_bands(spark, monkeypatch):
    rng = random.Random(3)
    questions = [(i, f"c{i % 3}", rng.choice([None, rng.random()])) for i in range(400)]
    asked = [(q, rng.randint(1, 6), [f"c{q % 3}", "c1"], sorted([rng.random(), rng.random()])) for q in range(30)]
    bank = spark.createDataFrame(questions, "id bigint, category string, difficulty double")
    wanted = spark.createDataFrame(asked, "id bigint, question_count int, categories array<string>, difficulty_range array<double>")
    plans, stored = {}, sel.stored
    monkeypatch.setattr(sel, "stored", lambda df, label: (plans.setdefault(label, _plan(df)), stored(df, label))[1])
    got = sorted((r.questionnaire_id, r["rank"], r.question_id) for r in sel.questions_for_requirements(bank, wanted).collect())
    fits = {q: [i for i, c, d in questions if c in cs and d is not None and low <= d <= high][:n] for q, n, cs, (low, high) in asked}
    assert got == [(q, r + 1, i) for q in sorted(fits) for r, i in enumerate(fits[q])]
    assert plans["runs"].rindex("WindowGroupLimit") > plans["runs"].index("Generate")


def test_large_tables_are_numbered_in_more_ranges(spark, monkeypatch):
    monkeypatch.setattr(ids, "RANGE_ROWS", 50)
    seen, stored = [], ids.stored
    monkeypatch.setattr(ids, "stored", lambda df, label: (seen.append(df.rdd.getNumPartitions()), stored(df, label))[1])
    got = sources.ordered_index(spark.range(999, -1, -1).withColumn("text", F.lit("x")), ["id"])
    assert sorted((r.id, r.idx) for r in got.collect()) == [(i, i) for i in range(1000)] and seen[0] == 20


def test_words_of_a_dictionary_are_worked_out_once(spark):
    """The texts are read for their keys, and not for each list of the dictionary again."""
    assert _plan(CHECKS["dictionary_keys"](spark, "/root/testdata/sf0.001")).count("documents.parquet") <= 3
