"""Classifier chain for toxicity categories.

The categories are label columns in a fixed order. Each has a linear (logistic) model over hashed words, word starts
and the probabilities of the categories before it. Later models are trained with out-of-fold probabilities of the
earlier ones, so they see the errors that the earlier models make on new texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from surveyloom.llm.tokens import NON_ALNUM, mix, slices

BITS = 18
START_BYTES = 5
#: Unless the caller names others: labelled texts that the models are fitted on, at most (the first by the digest of
#: their id), and features of a model, at most (those that separate its classes best).
MOST_LABELLED, MOST_FEATURES = 8_000, 4_000
FOLDS = 3
#: Features of the texts that are scored at a time, and such texts, at most (a text with more features is scored alone).
SPAN, SPAN_ROWS = 1 << 18, 2_000


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct feature numbers of each text: its words and their first five bytes, hashed."""
    shift = np.uint64(64 - BITS)
    for part in slices(column):
        start, end, bounds = part.spans(NON_ALNUM)
        words = part.hashes(start, end) >> shift
        heads = mix(part.hashes(start, np.minimum(end, start + START_BYTES))) >> shift
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield np.unique(np.concatenate([words[a:b], heads[a:b]])).astype(np.int32)


@dataclass
class Link:
    """One model of a chain. ``weights``: by feature number; ``earlier``: of the log odds of the categories before."""

    weights: np.ndarray
    earlier: np.ndarray
    bias: float


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate(rows) if rows else np.zeros(0, np.int32)), np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])


def predict(link: Link, columns: np.ndarray, row: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
    z = np.bincount(row, weights=link.weights[columns], minlength=n) + earlier @ link.earlier + link.bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_link(
    rows: list[np.ndarray], earlier: np.ndarray, y: np.ndarray, most: int = MOST_FEATURES, steps: int = 150, penalty: float = 2.0,
) -> Link:
    """Logistic regression with a ridge penalty, by accelerated gradient steps over selected features."""
    columns, row = _flat(rows)
    n, positive = len(rows), max(1.0, y.sum())
    seen = np.bincount(columns, minlength=1 << BITS)
    seen_positive = np.bincount(columns, weights=y[row], minlength=1 << BITS)
    rate = positive / max(1, n)
    gap = np.abs(seen_positive - seen * rate) / np.sqrt(seen * rate * (1 - rate) + 1)
    gap[seen < 3] = 0
    chosen = np.sort(np.argsort(-gap, kind="stable")[:most])
    chosen = chosen[gap[chosen] > 2.0]
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))
    inside = place[columns] >= 0
    c, r = place[columns[inside]], row[inside]
    weights, extra, bias = np.zeros(len(chosen)), np.zeros(earlier.shape[1]), float(_odds(np.array(rate)))
    # Step sizes by coordinate: half the largest curvature, summed over the features of a row.
    width = max(1.0, np.sqrt(np.mean(np.bincount(r, minlength=n) + 1.0)))
    scale = 1.0 / (0.25 * np.bincount(c, minlength=len(chosen)) * width + penalty)
    m_w, m_e, m_b = np.zeros_like(weights), np.zeros_like(extra), 0.0
    for _ in range(steps):
        z = np.bincount(r, weights=weights[c], minlength=n) + earlier @ extra + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g_w = np.bincount(c, weights=error[r], minlength=len(chosen)) + penalty * weights
        m_w = 0.8 * m_w + scale * g_w * 0.5
        m_e = 0.8 * m_e + 0.2 * (earlier.T @ error + penalty * extra) / (0.25 * n * 10 + penalty)
        m_b = 0.8 * m_b + 0.2 * error.sum() / (0.25 * n)
        weights, extra, bias = weights - m_w, extra - m_e, bias - m_b
    full = np.zeros(1 << BITS)
    full[chosen] = weights
    return Link(full, extra, bias)


def fit_chain(rows: list[np.ndarray], fold: np.ndarray, labels: np.ndarray, most: int = MOST_FEATURES) -> list[Link]:
    """Links of all categories (columns of ``labels``), later ones fitted with out-of-fold probabilities."""
    chain: list[Link] = []
    earlier = np.zeros((len(rows), 0))
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(float)
        outside = np.full(len(rows), y.mean() if len(y) else 0.0)
        for f in range(FOLDS if k + 1 < labels.shape[1] else 0):
            inner, test = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if len(inner) and len(test):
                link = fit_link([rows[i] for i in inner], earlier[inner], y[inner], most)
                outside[test] = predict(link, *_flat([rows[i] for i in test]), len(test), earlier[test])
        chain.append(fit_link(rows, earlier, y, most))
        earlier = np.column_stack([earlier, _odds(outside)])
    return chain


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array(list(features(batch.column(batch.schema.get_field_index("text")))), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "labels")), found], ["id", "labels", "features"])


def _fit(most: int):
    """The chain of the sampled texts, which are one group: a row per link, with the features that have a weight."""
    def fit(known: pa.Table) -> pa.Table:
        known = known.take(np.argsort(known["id"].to_numpy(), kind="stable"))
        found = known["features"].combine_chunks()
        flat, cuts = found.flatten().to_numpy(), np.append(0, np.cumsum(found.value_lengths()))
        labels = np.array(known["labels"].to_pylist(), float)
        chain = fit_chain([flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], known["fold"].to_numpy(), labels, most)
        places = [np.flatnonzero(link.weights) for link in chain]
        return pa.table({
            "link": pa.array(range(len(chain)), pa.int32()), "places": pa.array([p.tolist() for p in places], pa.list_(pa.int32())),
            "weights": pa.array([link.weights[p].tolist() for link, p in zip(chain, places, strict=True)], pa.list_(pa.float64())),
            "earlier": pa.array([link.earlier.tolist() for link in chain], pa.list_(pa.float64())), "bias": pa.array([link.bias for link in chain], pa.float64()),
        })

    return fit


def _spans(rows: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Runs of rows that have at most ``SPAN`` features in all, or one row of more, and are at most ``SPAN_ROWS``."""
    own, total = [], 0
    for found in rows:
        if own and (total + len(found) > SPAN or len(own) >= SPAN_ROWS):
            yield own
            own, total = [], 0
        own.append(found)
        total += len(found)
    if own:
        yield own


def _chances(links: list[Link], rows: list[np.ndarray]) -> np.ndarray:
    """Probabilities of all categories (columns) for the features of each row."""
    columns, row = _flat(rows)
    earlier, result = np.zeros((len(rows), 0)), np.zeros((len(rows), len(links)))
    for k, link in enumerate(links):
        result[:, k] = predict(link, columns, row, len(rows), earlier)
        earlier = np.column_stack([earlier, _odds(result[:, k])])
    return result


def _apply(model, place: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = model.value
        for batch in batches:
            # A batch has 10,000 texts; only the features of a few are held at a time.
            found = [_chances(links, rows) for rows in _spans(features(batch.column(place)))]
            lists = pa.array([p for part in found for p in part.tolist()], pa.list_(pa.float64()))
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*kept, lists], [*batch.schema.names, "probabilities"])

    return score


def toxicity(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text",
    most_labelled: int = MOST_LABELLED, most_features: int = MOST_FEATURES,
) -> DataFrame:
    """Columns of ``docs`` and ``probabilities``: one per category, in the order of ``categories`` (name to SQL of a 0/1 label).

    The chain is fitted, in one task, on at most ``most_labelled`` labelled texts, one per id (of rows that repeat an id
    the smallest text); each of its models has at most ``most_features`` features. Labels with a null category or id
    are left out; of repeated labels the smallest counts. A null text is empty. Without labelled texts all
    probabilities are 0. Every row of ``docs`` gives a row, repeated ones too; a column ``probabilities`` of ``docs``
    is replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("probabilities")
    marks = labels.select(F.col("doc_id").alias("id"), F.array(*[F.expr(sql).cast("int") for sql in categories.values()]).alias("labels"))
    marks = marks.where(F.col("id").isNotNull() & ~F.exists("labels", lambda x: x.isNull())).groupBy("id").agg(F.min("labels").alias("labels"))
    sample = marks.orderBy(F.md5(F.col("id").cast("string")), "id").limit(most_labelled)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    once = texts.join(F.broadcast(sample), "id").groupBy("id").agg(F.first("labels").alias("labels"), F.min("text").alias("text"))
    known = once.mapInArrow(_featurise, f"id {texts.schema['id'].dataType.simpleString()}, labels array<int>, features array<int>")
    known = known.withColumn("fold", F.pmod(F.crc32(F.col("id").cast("string")), F.lit(FOLDS))).withColumn("all", F.lit(0))
    links = known.groupBy("all").applyInArrow(_fit(most_features), "link int, places array<int>, weights array<double>, earlier array<double>, bias double").collect()
    chain = [Link(np.zeros(1 << BITS), np.zeros(k), -30.0) for k in range(len(categories))]
    for r in links:
        chain[r.link].weights[r.places] = r.weights
        chain[r.link].earlier, chain[r.link].bias = np.array(r.earlier, float), r.bias
    model = spark.sparkContext.broadcast(chain)
    schema = StructType([*docs.schema.fields, StructField("probabilities", ArrayType(DoubleType()))])
    return docs.mapInArrow(_apply(model, docs.columns.index(text_col)), schema)
