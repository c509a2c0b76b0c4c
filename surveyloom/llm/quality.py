"""Quality classifier: a regularised quadratic discriminant over document statistics.

A text becomes a short vector of transformed counts (words, lines, kinds of characters, repetition). Each class has a
mean and a covariance, shrunk towards that of both classes and towards its diagonal. The moments are sums over all
labelled rows, merged in Spark. The inverses of the Cholesky factors are worked out once; a text's score is the
difference of the two log densities (Mahalanobis distances and log determinants), mapped to a probability by a logistic
curve that is fitted on the differences of all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.tokens import NEWLINE, SPACES, Slice, byte_table, chain, mix, slices
from surveyloom.session import stored

#: Share of the common covariance in that of a class, and of the diagonal in the result.
TO_POOLED, TO_DIAGONAL = 0.1, 0.05
#: Bins of the density difference (of its arcsinh) for the logistic curve.
BINS, WIDEST = 4_000, 20.0
UPPER, DIGITS = byte_table((0x41, 0x5A)), byte_table((0x30, 0x39))
LETTERS = byte_table((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xFF))
STOPS = byte_table((0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B))
SHOUTS = byte_table((0x21, 0x21), (0x3F, 0x3F))
QUOTES = byte_table((0x22, 0x22), (0x27, 0x29), (0x2D, 0x2D))
SIGNS = byte_table((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)) & ~(STOPS | SHOUTS | QUOTES)
CHARS = ~byte_table((0x80, 0xBF))


def _row_of(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def _again(keys: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Per text, how many of its keys are equal to an earlier one."""
    own = mix(keys + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = np.unique(own, return_index=True)[1]
    return np.bincount(row, minlength=n) - np.bincount(row[first], minlength=n)


def statistics(part: Slice) -> np.ndarray:
    """Transformed statistics, a row per text; every byte, word and line counts."""
    n = len(part)
    start, end, bounds = part.spans(SPACES)
    words, row = np.diff(bounds), _row_of(bounds)
    line_start, line_end, line_bounds = part.spans(NEWLINE)
    lines, line_row = np.diff(line_bounds), _row_of(line_bounds)
    hashes = part.hashes(start, end)
    runs = chain(hashes, 3)
    inside = row[: len(runs)] == row[2:] if len(runs) else np.zeros(0, bool)
    chars, letters = part.counts(CHARS), part.counts(LETTERS)
    first = part.data[start] if len(start) else np.zeros(0, np.uint8)
    last = part.data[end - 1] if len(end) else np.zeros(0, np.uint8)
    per = lambda flags: np.bincount(row, weights=flags, minlength=n)
    share = lambda k, of: np.arcsin(np.sqrt(np.minimum(1, k / np.maximum(1, of))))
    return np.column_stack([
        np.log1p(words),
        np.log1p(part.counts(~SPACES) / np.maximum(1, words)),
        np.log1p(chars / np.maximum(1, lines)),
        share(part.counts(UPPER), letters),
        share(part.counts(DIGITS), chars),
        share(part.counts(STOPS), words),
        share(part.counts(SHOUTS), words),
        share(part.counts(SIGNS), words),
        share(part.counts(QUOTES), words),
        share(per(UPPER[first]), words),
        share(per(SIGNS[last] | SHOUTS[last]), words),
        share(per(end - start <= 2), words),
        share(_again(hashes, row, n), words),
        share(_again(part.hashes(line_start, line_end), line_row, n), lines),
        share(_again(runs[inside], row[: len(runs)][inside], n), words),
    ]).astype(float)


FEATURES = 15


@dataclass
class Quadratic:
    """Means, inverse Cholesky factors and log determinants of the classes 0 and 1, and the logistic curve."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray
    slope: float
    offset: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0."""
        density = [-0.5 * (((x - m) @ w.T) ** 2).sum(axis=1) - c for m, w, c in zip(self.means, self.factors, self.constants, strict=True)]
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.arcsinh(self.difference(x)) + self.offset, -40, 40)))


def _flat(x: np.ndarray) -> np.ndarray:
    """Number, sum and products of rows, as one array."""
    return np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])


def discriminant(sums: dict[int, np.ndarray], centre: np.ndarray) -> Quadratic | None:
    """The classes' densities from their sums about ``centre``; none unless both have rows."""
    if not all(k in sums and sums[k][0] > 0 for k in (0, 1)):
        return None
    d, means, scatters, counts = len(centre), [], [], []
    for k in (0, 1):
        n, total, products = sums[k][0], sums[k][1 : d + 1], sums[k][d + 1 :].reshape(d, d)
        means.append(total / n)
        scatters.append(products - np.outer(total, total) / n)
        counts.append(n)
    # A figure that does not vary at all keeps a small variance.
    pooled = sum(scatters) / sum(counts) + 1e-4 * np.eye(d)
    factors, constants = [], []
    for s, n in zip(scatters, counts, strict=True):
        weight = TO_POOLED + (1 - TO_POOLED) * d / (d + n)
        shrunk = (1 - weight) * s / n + weight * pooled
        shrunk = (1 - TO_DIAGONAL) * shrunk + TO_DIAGONAL * np.diag(np.diag(shrunk))
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(np.diag(lower)).sum())
    return Quadratic(np.array(means) + centre, np.array(factors), np.array(constants), 1.0, 0.0)


def fit_curve(middle: np.ndarray, zeros: np.ndarray, ones: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve over bins with these numbers of rows of the two classes, by Newton's method."""
    x, n, theta = np.column_stack([middle, np.ones(len(middle))]), zeros + ones, np.zeros(2)
    penalty = np.diag([1e-2, 1e-2])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (ones - n * p) - penalty @ theta)
        theta = theta + step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
    return float(theta[0]), float(theta[1])


def _describe(place: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = np.concatenate([statistics(part) for part in slices(batch.column(place), lower=False)])
                kept = [batch.column(i) for i in range(batch.num_columns) if i != place]
                names = [n for i, n in enumerate(batch.schema.names) if i != place]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * FEATURES, pa.int32()), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*kept, lists], [*names, "features"])

    return work


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)


def _moments(centre: np.ndarray):
    """Per task and class, the sums about ``centre``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x, y = _rows(batch.column(1)) - centre, batch.column(0).to_numpy()
            for k in np.unique(y).tolist():
                sums[k] = sums.get(k, 0) + _flat(x[y == k])
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["label", "sums"])

    return work


def _bins(model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.arcsinh(model.value.difference(_rows(batch.column(1))))
            bins = np.clip((at + WIDEST) * BINS / (2 * WIDEST), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bins)], ["label", "bin"])

    return work


def _score(model, place: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(i) for i in range(batch.num_columns) if i != place]
            names = [n for i, n in enumerate(batch.schema.names) if i != place]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(model.value.score(_rows(batch.column(place))))], [*names, "score"])

    return work


def fit(labelled: DataFrame) -> Quadratic | None:
    """The model from ``labelled``: label (0 or 1) and features. All rows count; only sums come to the driver."""
    averages = labelled.agg(*[F.avg(F.col("features")[i]).alias(f"a{i}") for i in range(FEATURES)]).first()
    if averages[0] is None:
        return None
    centre = np.array(averages, float)
    parts = labelled.select("label", "features").mapInArrow(_moments(centre), "label int, sums array<double>")
    totals = parts.select("label", F.posexplode("sums").alias("pos", "x")).groupBy("label", "pos").agg(F.sum("x").alias("x")).collect()
    sums = {k: np.zeros(1 + FEATURES + FEATURES**2) for k in {r.label for r in totals}}
    for r in totals:
        sums[r.label][r.pos] = r.x
    found = discriminant(sums, centre)
    if found is None:
        return None
    shared = labelled.sparkSession.sparkContext.broadcast(found)
    binned = labelled.select("label", "features").mapInArrow(_bins(shared), "label int, bin int").groupBy("label", "bin").count().collect()
    times = np.zeros((2, BINS))
    for r in binned:
        times[r.label, r.bin] = r["count"]
    middle = (np.arange(BINS) + 0.5) * 2 * WIDEST / BINS - WIDEST
    found.slope, found.offset = fit_curve(middle, *times)
    return found


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier).

    The model learns from labelled rows that are not held out; a null ``held_out`` is not. Labels that are not 0 or 1,
    or whose id is null, are left out; of repeated labels the smallest counts; rows that repeat an id count each for
    itself. A null text is an empty one and is scored like any other. Unless both labels occur, all rows get the share
    of ones among the labels, (ones + 1) / (all + 2). Other columns of ``docs`` are ignored.
    """
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    kinds = given.schema["id"].dataType.simpleString()
    described = stored(given.mapInArrow(_describe(2), f"id {kinds}, held_out boolean, features array<double>"), "quality-statistics")
    marks = labels.select(F.col("doc_id").alias("marked"), F.col(label_col).cast("int").alias("label")).where("marked is not null and label in (0, 1)")
    marks = marks.groupBy("marked").agg(F.min("label").alias("label"))
    training = described.where(~F.col("held_out")).join(marks, F.col("id") == F.col("marked")).select("label", "features")
    labelled = stored(training, "quality-labelled")
    model = fit(labelled)
    if model is None:
        share = labelled.agg(((F.sum("label") + 1) / (F.count("*") + 2)).alias("share")).first().share
        return described.select(F.col("id").alias(id_col), "held_out", F.lit(0.5 if share is None else float(share)).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return described.mapInArrow(_score(shared, 2), f"id {kinds}, held_out boolean, score double").withColumnRenamed("id", id_col)
