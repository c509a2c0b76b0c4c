"""Term weights and ranked retrieval over an inverted index.

The corpus is indexed once (``build_index``) and can be written (``write_index``) and reused. A document's terms are
counted inside its row and weighted once. In a written index, postings lie in buckets of terms with their final
weights, so a batch of requests reads the buckets of its own terms and joins nothing else. A new index has the counts by
document and the lengths of all documents, from which the postings of a batch's terms are made; they are dealt by
document, so that products are added up where they are made and do not move. The index also knows the largest weight of
each term among documents of like length: terms that together cannot lift a document over the least score open no
candidates, and of the candidates only those that can still reach a request's best ``k`` are worked out in full.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyloom.functions.scoring import match_percent, stars
from surveyloom.functions.text import dedup_key, digest, terms
from surveyloom.operators.firstwins import top_per_group
from surveyloom.sources.ids import ranked_within
from surveyloom.session import stored

MIN_SCORE = 0.05
RANK_DIGITS = 9  # scores are compared at this many digits, so that summation order cannot swap ties
MARGIN = 1e-8  # bounds give way by this much, more than summation order and rounding can move a score
BUCKETS = 64  # folders of postings; a bucket of any size is split into files
CLOSED_SHARE = 0.2  # part of the least score that terms which open no candidates may add up to
FREQUENT = 1 << 18  # most terms whose idf is sent to every task
FEW = 50_000  # terms of requests, or documents found for them, that are sent to every task; Spark chooses if there are more
TASK_PRODUCTS = 4_000_000  # products of weights that one task adds up


@dataclass
class TermIndex:
    """``weights`` (doc, tier, term, weight), ``vocabulary`` (term, df, idf), ``texts`` (doc, text_key).

    ``postings`` (term, doc, tier, weight, bucket) and ``tops`` (term, tier, top: largest weight) are those of a written
    index. A new one has ``counts`` (doc, tier, term, tf) instead. A tier holds documents with like numbers of terms.
    """

    weights: DataFrame
    vocabulary: DataFrame
    texts: DataFrame
    postings: DataFrame | None = None
    tops: DataFrame | None = None
    counts: DataFrame | None = None
    _norms: DataFrame | None = field(default=None, repr=False)

    def norms(self) -> DataFrame:
        """(doc, norm) of a new index, made when a request first asks for them."""
        if self._norms is None:
            self._norms = stored(document_norms(self.counts, self.vocabulary), "norms")
        return self._norms

    def inverted(self) -> tuple[DataFrame, DataFrame]:
        if self.postings is None:
            rows = self.weights.select("term", "doc", "tier", "weight").withColumn("bucket", _bucket(F.col("term")))
            self.postings = stored(_dealt(rows), "postings", by=["bucket"])
            self.tops = stored(self.postings.groupBy("term", "tier").agg(F.max("weight").alias("top")), "tops")
        return self.postings, self.tops


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _dealt(postings: DataFrame) -> DataFrame:
    """Postings by bucket; a bucket with frequent terms is rebalanced to as many tasks, and files, as it needs."""
    return postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "tier")


def term_counts(docs: DataFrame, doc: str, text: str, stop_words: list[str]) -> DataFrame:
    """(doc, tier, term, tf). A document is a row, so its terms are counted where it is; nothing is moved.

    Its tokens are sorted, and equal ones then stand in runs: a run gives a term, and its length the count. Each step is
    generated, since Spark would else work a plain column out again for every element that reads it.
    """
    tokens = docs.select(F.col(doc).alias("doc"), F.explode(F.array(F.sort_array(terms(F.col(text), stop_words)))).alias("tokens"))
    size = F.size("tokens")
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: (i == 0) | (F.get("tokens", i) != F.get("tokens", i - 1)))
    runs = tokens.withColumn("starts", F.explode(F.array(starts)))
    each = F.transform("starts", lambda at, i: F.struct(F.get("tokens", at).alias("term"), (F.coalesce(F.get("starts", i + 1), size) - at).alias("tf")))
    tier = F.length(F.bin(F.size("starts"))) - 1  # the whole part of the binary logarithm
    return runs.select("doc", tier.alias("tier"), F.inline(each))


def vocabulary_of(counted: DataFrame, docs: DataFrame) -> DataFrame:
    """(term, df, idf) with the smoothed idf ln((1+n)/(1+df))+1, n being all documents."""
    total = docs.agg(F.count("*")).scalar()
    idf = F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0
    return (
        counted.groupBy("term")
        .agg(F.count("*").alias("df"))
        .withColumn("n", total)
        .select("term", "df", idf.alias("idf"))
    )


def term_weights(counted: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc, tier, term, weight): tf times idf, the weights of a document scaled to length 1.

    A term in very many documents makes a large join partition, which adaptive execution splits; the vocabulary side
    has one row per term. A document's terms fit a window, since it is a row of the corpus.
    """
    raw = counted.join(vocabulary.select("term", "idf"), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc")))
    return raw.select("doc", "tier", "term", (F.col("w") / norm).alias("weight"))


def _least_frequent(vocabulary: DataFrame) -> int:
    """The least power of two that at most ``FREQUENT`` terms have as their document frequency or exceed."""
    powers = dict(vocabulary.groupBy(F.length(F.bin("df")) - 1).agg(F.count("*")).collect())
    terms_above, power = 0, max(powers, default=0) + 1
    while power > 0 and terms_above + powers.get(power - 1, 0) <= FREQUENT:
        power -= 1
        terms_above += powers.get(power, 0)
    return 1 << power


def document_norms(counted: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc, norm): the length of a document's vector of tf times idf, over all of its terms.

    The most frequent terms make most of the rows; their idf is sent to the tasks, which add up the squares of a document
    where its terms are. Only the rows of the other terms meet the vocabulary in a shuffle.
    """
    least = _least_frequent(vocabulary)
    weighted = vocabulary.select("term", "idf", (F.col("df") >= least).alias("often"))
    often, seldom = (weighted.where(kind).drop("often") for kind in (F.col("often"), ~F.col("often")))
    met = counted.select("doc", "term", "tf").join(F.broadcast(often), "term").select("doc", "tf", "idf")
    if least > 1:
        others = counted.select("doc", "term", "tf").join(F.broadcast(often.select("term")), "term", "left_anti")
        met = met.unionAll(others.join(seldom, "term").select("doc", "tf", "idf"))
    w = F.col("tf") * F.col("idf")
    return met.groupBy("doc").agg(F.sqrt(F.sum(w * w)).alias("norm"))


def build_index(corpus: DataFrame, doc: str, text: str, stop_words: list[str], shown: str | None = None) -> TermIndex:
    """Index ``text``; ``shown`` is the text a result is recognised by (default: the same).

    The counts, the vocabulary and the digests of the texts are written once, as what follows reads them several times.
    """
    counted = stored(term_counts(corpus, doc, text, stop_words), "term-counts", compression="zstd")
    vocabulary = stored(vocabulary_of(counted, corpus), "vocabulary")
    texts = stored(corpus.select(F.col(doc).alias("doc"), digest(F.col(shown or text)).alias("text_key")), "texts")
    return TermIndex(term_weights(counted, vocabulary), vocabulary, texts, counts=counted)


def write_index(index: TermIndex, path: str) -> None:
    """Postings in buckets of terms, the vocabulary and the largest weights by term, weights and texts by document."""
    postings, tops = index.inverted()
    _dealt(postings).write.partitionBy("bucket").parquet(f"{path}/postings")
    for name, part, key in (("vocabulary", index.vocabulary, "term"), ("tops", tops, "term"), ("weights", index.weights, "doc"), ("texts", index.texts, "doc")):
        part.hint("rebalance", key).sortWithinPartitions(key).write.parquet(f"{path}/{name}")


def read_index(spark: SparkSession, path: str) -> TermIndex:
    return TermIndex(*[spark.read.parquet(f"{path}/{name}") for name in ("weights", "vocabulary", "texts", "postings", "tops")])


def normalized_weights(index: TermIndex) -> DataFrame:
    """(doc, term, weight) with rows of length 1."""
    return index.weights.select("doc", "term", "weight")


def request_weights(
    requests: DataFrame, vocabulary: DataFrame, query: str, text: str, stop_words: list[str]
) -> DataFrame:
    """(query, term, wq): requests weighted with the fitted idf; unknown terms drop out; length 1."""
    counts = (
        requests.select(F.col(query).alias("query"), F.explode(terms(F.col(text), stop_words)).alias("term"))
        .groupBy("query", "term")
        .agg(F.count("*").alias("tf"))
    )
    raw = counts.join(vocabulary.select("term", "idf"), "term").withColumn("w", F.col("tf") * F.col("idf"))
    # A request is one text, so its terms fit a window.
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("query")))
    return raw.select("query", "term", (F.col("w") / length).alias("wq"), "idf")


def normalize_requests(requests: DataFrame, text: str = "text", lang: str = "lang", **key_options) -> DataFrame:
    """Requests with their text in the same normal form as the keys of an indexed pool."""
    return requests.withColumn(text, dedup_key(F.col(text), F.col(lang), **key_options))


def analyze_requirements(
    requests: DataFrame, index: TermIndex, k: int, stop_words: list[str], query: str = "query_id", text: str = "text"
) -> DataFrame:
    """The ``k`` search terms that carry most weight in each request; ties in order of the term."""
    weights = request_weights(requests, index.vocabulary, query, text, stop_words)
    order = [F.desc(F.round("wq", RANK_DIGITS)), F.asc("term")]
    return top_per_group(weights, ["query"], order, k, rank="rank").select(
        F.col("query").alias(query), "rank", "term", F.col("wq").alias("weight")
    )


def _buckets(wanted: DataFrame) -> list[int]:
    """Buckets of the terms of ``wanted``: ``BUCKETS`` numbers at most, so that the scan can be told them."""
    return [r[0] for r in wanted.select(_bucket(F.col("term")).alias("bucket")).distinct().collect()]


def _in(postings: DataFrame, buckets: list[int]) -> DataFrame:
    return postings.where(F.col("bucket").isin(buckets)).drop("bucket")


def cosine_scores(index: TermIndex, request_terms: DataFrame) -> DataFrame:
    """(query, doc, score, text_key) for every request and document that share a term.

    Weights come by document, those of a new index as it made them and those of a written one from the buckets of the
    requests' terms. So the products of a document are added up where its weights are, and do not move.
    """
    wanted = stored(request_terms.select("query", "term", "wq"), "request-terms")
    if index.postings is None:
        weights = index.weights.select("doc", "term", "weight")
    else:
        met = _in(index.postings, _buckets(wanted)).join(wanted.select("term").distinct(), "term", "left_semi")
        weights = met.select("doc", "term", "weight").repartition("doc")
    products = weights.join(wanted, "term").groupBy("query", "doc").agg(F.sum(F.col("weight") * F.col("wq")).alias("score"))
    return products.join(index.texts, "doc").select("query", "doc", "score", "text_key")


def opening_terms(wanted: DataFrame, tops: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(query, tier, term, wq, slack): the terms of a request that open candidates among the documents of a tier.

    The others, those with the least products of weight and largest weight, together add ``slack``, which is a small
    part of ``min_score``; a document that has only such terms cannot pass. Where all terms of a request together
    cannot pass it, a tier has no opening terms.
    """
    each = Window.partitionBy("query", "tier")
    bounds = wanted.join(tops, "term").withColumn("most", F.col("wq") * F.col("top"))
    upto = bounds.withColumn("upto", F.sum("most").over(each.orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0)))
    closed = F.col("upto") <= CLOSED_SHARE * min_score
    slack = upto.withColumns({"slack": F.coalesce(F.max(F.when(closed, F.col("upto"))).over(each), F.lit(0.0)), "whole": F.max("upto").over(each)})
    return slack.where(~closed & (F.col("whole") > min_score - MARGIN)).select("query", "tier", "term", "wq", "slack")


@dataclass
class Batch:
    """``wanted`` (query, term, wq) of a batch of requests and their ``terms`` (term, idf).

    ``few`` says whether they are sent to every task, ``tasks`` over how many tasks the documents are dealt.
    """

    wanted: DataFrame
    terms: DataFrame
    few: bool
    tasks: int


def _sent(rows: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(rows) if few else rows


def request_batch(index: TermIndex, wanted: DataFrame) -> Batch:
    """The requests' terms are written once. There are as many tasks as their products need, known by the frequencies."""
    wanted = stored(wanted.select("query", "term", "wq"), "request-terms")
    few = wanted.count() <= FEW
    asked = wanted.groupBy("term").agg(F.count("*").alias("requests"))
    met = stored(index.vocabulary.join(_sent(asked, few), "term").select("term", "df", "idf", "requests"), "request-vocabulary")
    products = met.agg(F.sum(F.col("df") * F.col("requests"))).first()[0] or 0
    least = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return Batch(wanted, met.select("term", "idf"), few, max(least, -(-products // TASK_PRODUCTS)))


def request_postings(index: TermIndex, batch: Batch, docs: DataFrame | None = None) -> DataFrame:
    """(doc, tier, term, weight) of the batch's terms, of ``docs`` (doc) only if given, dealt by document.

    A written index is read in the buckets of the terms. Those of a new one are its counts of the terms, which meet the
    lengths of their documents after they are dealt.
    """
    new = index.postings is None and index.counts is not None
    rows = index.counts if new else _in(index.inverted()[0], _buckets(batch.terms))
    met = rows.join(_sent(batch.terms.select("term"), batch.few), "term", "left_semi")
    dealt = (met if docs is None else met.join(docs, "doc", "left_semi")).repartition(batch.tasks, "doc")
    if new:
        weight = F.col("tf") * F.col("idf") / F.col("norm")
        dealt = dealt.join(_sent(batch.terms, batch.few), "term").join(index.norms(), "doc").withColumn("weight", weight)
    return dealt.select("doc", "tier", "term", "weight")


def request_tops(index: TermIndex, batch: Batch) -> DataFrame:
    """(term, tier, top): the largest weight of the batch's terms in each tier."""
    if index.postings is None and index.counts is not None:
        return request_postings(index, batch).groupBy("term", "tier").agg(F.max("weight").alias("top"))
    return index.inverted()[1]


def candidate_scores(index: TermIndex, wanted: DataFrame, k: int | DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(query, doc): documents that may be among the best ``k`` of a request and above ``min_score``; none is missing."""
    return _candidates(index, request_batch(index, wanted), k, min_score)


def _candidates(index: TermIndex, batch: Batch, k: int | DataFrame, min_score: float) -> DataFrame:
    opening = opening_terms(batch.wanted, request_tops(index, batch), min_score)
    opened = request_postings(index, batch).join(_sent(opening, batch.few), ["term", "tier"]).groupBy("query", "doc").agg(
        F.sum(F.col("weight") * F.col("wq")).alias("least"), F.max("slack").alias("slack")
    )
    # Texts are told apart by a short hash: were two equal, a floor would only be lower. They meet where documents are.
    texts = index.texts.select("doc", F.xxhash64("text_key").alias("text_hash"))
    opened = stored(opened.where(F.col("least") + F.col("slack") > min_score - MARGIN).join(texts, "doc"), "candidates")
    # The k-th best of different texts, by what is certain.
    best = opened.groupBy("query", "text_hash").agg(F.max("least").alias("least"))
    if isinstance(k, int):
        last = top_per_group(best, ["query"], [F.desc("least"), "text_hash"], k, rank="place").where(F.col("place") == k)
    else:
        falling = best.withColumn("falling", -F.col("least"))
        last = ranked_within(falling, ["query"], ["falling", "text_hash"], "place").join(k, "query").where(F.col("place") == F.col("k"))
    floors = last.select("query", F.col("least").alias("floor"))
    kept = opened.join(_sent(floors, batch.few), "query", "left").where(F.col("floor").isNull() | (F.col("least") + F.col("slack") >= F.col("floor") - MARGIN))
    return kept.select("query", "doc").distinct()


def best_matches(index: TermIndex, wanted: DataFrame, k: int | DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The best ``k`` documents per request of ``wanted`` (query, term, wq), as ``ranked_matches`` of all scores gives them.

    ``k`` may be a table (query, k). Postings are those of the requests' terms only, and beyond the opening terms only
    those of candidates.
    """
    batch = request_batch(index, wanted)
    kept = stored(_candidates(index, batch, k, min_score), "finalists")
    few = kept.count() <= FEW
    postings = request_postings(index, batch, _sent(kept.select("doc").distinct(), few))
    finalists = postings.join(_sent(kept, few), "doc").join(_sent(batch.wanted, batch.few), ["query", "term"])
    scores = finalists.groupBy("query", "doc").agg(F.sum(F.col("weight") * F.col("wq")).alias("score"))
    return ranked_matches(scores.where(F.col("score") > min_score).join(index.texts, "doc"), k, min_score)


def ranked_matches(scores: DataFrame, k: int | DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Best ``k`` documents per request above ``min_score``; each text once; ties by document order.

    ``k`` may be a table (query, k). Then all matches of a request are ranked, spread over many tasks.
    """
    order = [F.desc(F.round("score", RANK_DIGITS)), F.asc("doc")]
    above = scores.filter(F.col("score") > min_score)
    once = top_per_group(above, ["query", "text_key"], order, 1)
    if isinstance(k, int):
        return top_per_group(once, ["query"], order, k, rank="rank")
    falling = once.withColumn("_falling", -F.round("score", RANK_DIGITS))
    ranked = ranked_within(falling, ["query"], ["_falling", "doc"]).drop("_falling")
    return ranked.join(k, "query").filter(F.col("rank") <= F.col("k")).drop("k")


def generate_survey(
    corpus: DataFrame, index: TermIndex, requests: DataFrame, k: int | str, stop_words: list[str],
    query: str = "query_id", text: str = "text", doc: str = "seq", min_score: float = MIN_SCORE,
) -> DataFrame:
    """Ranked questions for every request. Texts and options are fetched for the winners only.

    ``k`` is a number, or the column of ``requests`` that has each request's own number.
    """
    wanted = request_weights(requests, index.vocabulary, query, text, stop_words)
    most = requests.groupBy(F.col(query).alias("query")).agg(F.max(k).alias("k")) if isinstance(k, str) else k
    best = stored(best_matches(index, wanted, most, min_score), "matches")
    details = corpus.select(
        F.col(doc).alias("doc"), "question_text", "difficulty_score",
        F.nullif(F.coalesce("options_text", F.lit("")), F.lit("")).alias("options_text"),
    )
    return details.join(_sent(best, best.count() <= FEW), "doc").select(
        F.col("query").alias(query), "rank", F.col("doc").alias(doc), "score",
        match_percent(F.round("score", RANK_DIGITS)).alias("match_percent"),
        "difficulty_score", stars(F.col("difficulty_score")).alias("stars"), "question_text", "options_text",
    )


@dataclass
class Pool:
    """The questions of one language, their index and the stop words it was built with."""

    corpus: DataFrame
    index: TermIndex
    stop_words: list[str]


def language_pools(corpus: DataFrame, doc: str, text: str, stop_words: dict[str, list[str]], lang: str, **options) -> dict[str, Pool]:
    """A pool for each language of ``stop_words``; document frequencies count within the language."""
    parts = {code: corpus.filter(F.col(lang) == code) for code in stop_words}
    return {code: Pool(part, build_index(part, doc, text, stop_words[code], **options), stop_words[code]) for code, part in parts.items()}


def generate_survey_by_language(pools: dict[str, Pool], requests: DataFrame, k: int | str, lang: str = "lang", **options) -> DataFrame:
    """Ranked questions for every request, from the pool of its own language only.

    A request in a language without a pool gives no rows.
    """
    parts = [
        generate_survey(pool.corpus, pool.index, requests.filter(F.col(lang) == code), k, pool.stop_words, **options)
        for code, pool in pools.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def keywords(index: TermIndex, k: int) -> DataFrame:
    """The ``k`` heaviest terms per document; ties in order of the term."""
    order = [F.desc(F.round("weight", RANK_DIGITS)), F.asc("term")]
    return top_per_group(normalized_weights(index), ["doc"], order, k, rank="rank")


def group_keywords(index: TermIndex, groups: DataFrame, doc: str, group: str, k: int) -> DataFrame:
    """The ``k`` terms with the highest mean weight per group of documents.

    Weights are added per (group, term) in each task first, so a large group is no large task.
    """
    members = groups.select(F.col(doc).alias("doc"), F.col(group).alias("grp"))
    sizes = members.groupBy("grp").agg(F.count("*").alias("size"))
    sums = normalized_weights(index).join(members, "doc").groupBy("grp", "term").agg(F.sum("weight").alias("s"))
    means = sums.join(sizes, "grp").withColumn("mean_weight", F.col("s") / F.col("size"))
    order = [F.desc(F.round("mean_weight", RANK_DIGITS)), F.asc("term")]
    return top_per_group(means, ["grp"], order, k, rank="rank").select(
        F.col("grp").alias(group), "rank", "term", "mean_weight"
    )
