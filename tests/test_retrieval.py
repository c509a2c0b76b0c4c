"""Bounded retrieval against all scores, and what its plans read."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import retrieval


def _corpus(spark, seed, n=300):
    """Texts of very different lengths; few words are in most of them, and some texts repeat."""
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 5, 20, 150])))) for i in range(n)]
    rows += [(n + i, rows[i * 3 % n][1]) for i in range(30)] + [(1000, None), (1001, "... !")]
    return rows, spark.createDataFrame(rows, "seq bigint, text string").repartition(4)


def _answers(df):
    return sorted((r.query, r["rank"], r.doc, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("k", [1, 4, 1000, "own"])
def test_best_matches_are_those_of_all_scores(spark, k):
    rows, corpus = _corpus(spark, 3)
    rng = random.Random(8)
    asked = spark.createDataFrame([(q, " ".join(rng.choices([w for _, t in rows if t for w in t.split()], k=rng.choice([1, 3, 12, 60]))), 1 + q % 9) for q in range(25)], "q bigint, text string, k int")
    index = retrieval.build_index(corpus, "seq", "text", ["w1"])
    wanted = retrieval.request_weights(asked, index.vocabulary, "q", "text", ["w1"])
    most = asked.select(F.col("q").alias("query"), "k") if k == "own" else k
    got = _answers(retrieval.best_matches(index, wanted, most))
    assert got == _answers(retrieval.ranked_matches(retrieval.cosine_scores(index, wanted), most)) and got
    if k == 4:  # fewer candidates are worked out than share a term with the request
        assert retrieval.candidate_scores(index, wanted, k).count() < 0.5 * retrieval.cosine_scores(index, wanted).count()


def test_vectors_are_counted_inside_rows(spark):
    rows, corpus = _corpus(spark, 5, 60)
    index = retrieval.build_index(corpus, "seq", "text", [])
    texts = {i: re.findall(r"\w{2,}", t or "") for i, t in rows}
    df = {w: sum(w in t for t in texts.values()) for t in texts.values() for w in t}
    idf = {w: math.log((1 + len(rows)) / (1 + n)) + 1 for w, n in df.items()}
    assert {r.term: (r.df, round(r.idf, 9)) for r in index.vocabulary.collect()} == {w: (df[w], round(idf[w], 9)) for w in df}
    got = {}
    for r in index.weights.collect():
        got.setdefault(r.doc, {})[r.term] = (r.tier, round(r.weight, 9))
    assert set(got) == {i for i, t in texts.items() if t}
    for i, own in got.items():
        raw = {w: texts[i].count(w) * idf[w] for w in set(texts[i])}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        assert own == {w: (int(math.log2(len(raw))), round(x / norm, 9)) for w, x in raw.items()}
    plan = retrieval.term_counts(corpus, "seq", "text", [])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("Exchange RoundRobinPartitioning", "")


def test_terms_that_cannot_lift_a_document_open_none(spark):
    tops = spark.createDataFrame([("common", 0, 0.1), ("usual", 0, 0.2), ("rare", 0, 0.9), ("common", 5, 0.01), ("usual", 5, 0.02), ("rare", 5, 0.03)], "term string, tier int, top double")
    wanted = spark.createDataFrame([(1, "common", 0.1), (1, "usual", 0.15), (1, "rare", 0.9), (1, "absent", 0.4)], "query int, term string, wq double")
    got = {(r.tier, r.term): round(r.slack, 9) for r in retrieval.opening_terms(wanted, tops).collect()}
    assert got == {(0, "rare"): 0.01, (0, "usual"): 0.01}  # 0.01 is closed; 0.01 + 0.03 are not; long documents cannot pass at all


def test_a_batch_reads_the_buckets_of_its_terms(spark, tmp_path):
    _, corpus = _corpus(spark, 7)
    retrieval.write_index(retrieval.build_index(corpus, "seq", "text", []), str(tmp_path / "index"))
    index = retrieval.read_index(spark, str(tmp_path / "index"))
    asked = spark.createDataFrame([(1, "w3 w7")], "q bigint, text string")
    wanted = retrieval.request_weights(asked, index.vocabulary, "q", "text", [])
    plan = retrieval.best_matches(index, wanted, 5)._jdf.queryExecution().executedPlan().toString()
    scans = [s for s in plan.split("\n") if "FileScan parquet" in s and "bucket#" in s]
    buckets = {r[0] for r in index.postings.where(F.col("term").isin("w3", "w7")).select("bucket").distinct().collect()}
    named = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scans[0]).group(1)
    assert len(scans) == 1 and {int(x) for x in re.findall(r"(?<![#\d])\d+(?=[,)])", named)} == buckets and len(buckets) < 3
    assert plan.count("FileScan parquet") - len(scans) >= 2 and "tier#" not in plan  # no weights by document are read


def test_terms_are_counted_without_python(spark):
    """No batch of whole texts waits in a Python task; runs of equal tokens count, in rows with equal or no ids too."""
    rows = [(1, "bb aa bb cc bb"), (1, "aa aa"), (None, "dd"), (2, ""), (3, None), (4, " ".join(f"w{i}" for i in range(8)))]
    counted = retrieval.term_counts(spark.createDataFrame(rows, "seq bigint, text string"), "seq", "text", ["cc"])
    assert "Arrow" not in counted._jdf.queryExecution().executedPlan().toString()
    assert counted.dtypes == [("doc", "bigint"), ("tier", "int"), ("term", "string"), ("tf", "int")]
    got = sorted((r.doc or 0, r.tier, r.term, r.tf) for r in counted.collect())
    assert got == [(0, 0, "dd", 1), (1, 0, "aa", 2), (1, 1, "aa", 1), (1, 1, "bb", 3)] + [(4, 3, f"w{i}", 1) for i in range(8)]


def test_a_new_index_makes_the_postings_of_a_batch_only(spark, monkeypatch):
    """No table of all postings is written for a batch of requests, and products of weights do not move between tasks."""
    _, corpus = _corpus(spark, 11)
    written, write = {}, retrieval.stored

    def spied(df, label, **options):
        out = write(df, label, **options)
        written[label] = (out.count(), df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(retrieval, "stored", spied)
    index = retrieval.build_index(corpus, "seq", "text", [])
    asked = spark.createDataFrame([(1, "w3 w7 w20"), (2, "w50 w7")], "q bigint, text string")
    wanted = retrieval.request_weights(asked, index.vocabulary, "q", "text", [])
    assert _answers(retrieval.best_matches(index, wanted, 5)) == _answers(retrieval.ranked_matches(retrieval.cosine_scores(index, wanted), 5))
    assert written["norms"][0] == index.counts.select("doc").distinct().count()  # every document's length, over all its terms
    assert sum(n for label, (n, _) in written.items() if label not in ("term-counts", "texts", "norms")) < 0.5 * index.counts.count()
    assert "Exchange hashpartitioning(doc#" in written["candidates"][1] and "Exchange hashpartitioning(query#" in written["finalists"][1]
    assert not re.search(r"hashpartitioning\(query#\w+, doc#", written["candidates"][1])


@pytest.mark.parametrize("few", [50_000, 0])
def test_large_batches_and_vocabularies_give_the_same(spark, monkeypatch, few):
    """Few terms are sent to the tasks, the others and all requests meet in shuffles, and documents are dealt over many tasks."""
    rows, corpus = _corpus(spark, 13, 120)
    rows, corpus = rows + [(5, "w2 w3 w3"), (None, "w2 w4")], corpus.union(spark.createDataFrame([(5, "w2 w3 w3"), (None, "w2 w4")], "seq bigint, text string"))
    for name, value in (("FEW", few), ("FREQUENT", 9), ("TASK_PRODUCTS", 50)):
        monkeypatch.setattr(retrieval, name, value)
    index = retrieval.build_index(corpus, "seq", "text", [])
    terms, df = {}, {}
    for i, text in rows:
        found = re.findall(r"\w{2,}", text or "")
        terms.setdefault(i, []).extend((w, found.count(w)) for w in set(found))
        for w in set(found):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log((1 + len(rows)) / (1 + n)) + 1 for w, n in df.items()}
    least = retrieval._least_frequent(index.vocabulary)
    assert 1 < least and sum(n >= least for n in df.values()) <= 9 < sum(2 * n >= least for n in df.values())
    got = {r.doc: round(r.norm, 9) for r in index.norms().collect()}
    assert got == {i: round(math.sqrt(sum((n * idf[w]) ** 2 for w, n in own)), 9) for i, own in terms.items() if own}
    asked = spark.createDataFrame([(q, f"w{2 + q} w{3 + q} w2 w{40 + q}") for q in range(6)], "q bigint, text string")
    wanted = retrieval.request_weights(asked, index.vocabulary, "q", "text", [])
    batch = retrieval.request_batch(index, wanted)
    assert batch.few == (few > 0) and batch.tasks > 3
    got = _answers(retrieval.best_matches(index, wanted, 4))
    assert got == _answers(retrieval.ranked_matches(retrieval.cosine_scores(index, wanted), 4)) and got
