"""Grouping questions by wording: term vectors, k-means, quality, assignment, scatter positions.

A text's weighted terms are projected on a few hundred columns by seeded signs, inside its row: every term adds its
weight, with a sign, to a few columns that its hash names. Lengths and angles are kept closely, no two terms share a
column set, and a centre is a few hundred numbers whatever the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from surveyloom import lexicons
from surveyloom.functions.text import terms
from surveyloom.session import stored

#: Columns that a term adds to.
SPREAD = 4
#: Document frequencies are counted in two rows of counters by two hashes of the term; the smaller count holds. They
#: bound what the driver holds, and are exact until terms collide in both rows.
COUNTERS, COUNTER_BITS = 2, 20
#: Codes and rows that are projected at a time.
SPAN, SPAN_ROWS = 1 << 18, 2_000


@dataclass
class ClusterModel:
    """``idf``: weight by counter row and counter. ``centres``: a row per cluster."""

    stop_words: list[str]
    seed: int
    features: int
    idf: np.ndarray
    centres: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """64 well-mixed bits of 64-bit codes."""
    x = x + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _term_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code and number of each different code of each row."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    row, code = np.repeat(np.arange(len(column)), sizes), column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (code[1:] != code[:-1])]) if len(row) else np.zeros(0, int)
    return row[first], code[first], np.diff(np.r_[first, len(row)])


def _counters(code: np.ndarray) -> list[np.ndarray]:
    return [(_mix(code, 101 + r) >> np.uint64(64 - COUNTER_BITS)).astype(np.int64) for r in range(COUNTERS)]


def project(row: np.ndarray, code: np.ndarray, weight: np.ndarray, n: int, features: int, seed: int) -> np.ndarray:
    """``n`` vectors of ``features`` columns, of length 1 or 0, from weighted codes."""
    out = np.zeros(n * features)
    for r in range(SPREAD):
        h = _mix(code, seed * SPREAD + r + 1)
        sign = 1.0 - 2.0 * (h >> np.uint64(63)).astype(float)
        out += np.bincount(row * features + (h % np.uint64(features)).astype(np.int64), weights=sign * weight, minlength=n * features)
    out = out.reshape(n, features)
    length = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(length > 0, length, 1.0)


def term_codes(text: Column, stop_words: list[str]) -> Column:
    """A code for each term of a text, in order."""
    return F.transform(terms(text, stop_words), lambda t: F.xxhash64(t))


def term_idf(questions: DataFrame, codes: Column) -> np.ndarray:
    """Smoothed idf ln((1+n)/(1+df))+1 by counter row and counter."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((COUNTERS, 1 << COUNTER_BITS), np.int64)
        for batch in batches:
            for r, at in enumerate(_counters(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))):
                np.add.at(totals[r], at, 1)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(totals.ravel()[at])], ["at", "df"])

    # A code is a row, so a batch of them is small however long the texts are.
    found = questions.select(F.explode(F.array_distinct(codes)).alias("code")).mapInArrow(count, "at long, df long").groupBy("at").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(COUNTERS << COUNTER_BITS)
    df[found["at"].to_numpy()] = found["df"].to_numpy()
    return (np.log((1.0 + questions.count()) / (1.0 + df)) + 1.0).reshape(COUNTERS, -1).astype(np.float32)


def _spans(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows (from, number) that have ``SPAN`` codes in all, or one row of more, and at most ``SPAN_ROWS`` rows."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (total + size > SPAN or i - start >= SPAN_ROWS):
            yield start, i - start
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes) - start


def _vectors(questions: DataFrame, codes: Column, model: ClusterModel, keep: bool) -> DataFrame:
    """``features`` of each row (and its columns, if ``keep``), and ``cluster_id`` where the model has centres.

    Only the codes of a text go to Python; the other columns stay in Spark. A batch is worked out span by span.
    """
    shared = questions.sparkSession.sparkContext.broadcast(model)
    given = questions.drop("features", "cluster_id") if keep else questions.select()
    placed = len(model.centres) > 0
    fields = [StructField("features", ArrayType(FloatType())), *[StructField("cluster_id", IntegerType())] * placed]

    @F.arrow_udf(StructType(fields))
    def work(codes: pa.Array) -> pa.Array:
        own, found, numbers = shared.value, [], []
        for start, rows in _spans(codes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)):
            row, code, tf = _term_rows(codes.slice(start, rows))
            idf = np.max([own.idf[r][at] for r, at in enumerate(_counters(code))], axis=0)
            x = project(row, code, tf * idf, rows, own.features, own.seed).astype(np.float32)
            found.append(x)
            if placed:
                numbers.append(nearest(x.astype(float), own.centres).astype(np.int32))
        x = np.concatenate(found) if found else np.zeros((0, own.features), np.float32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * own.features, pa.int32()), pa.array(x.ravel()))
        more = [pa.array(np.concatenate(numbers) if numbers else np.zeros(0, np.int32))] if placed else []
        return pa.StructArray.from_arrays([lists, *more], [f.name for f in fields])

    made = work(codes).alias("_made")
    return questions.select(*[F.col(f"`{c}`") for c in given.columns], made).select(*[F.col(f"`{c}`") for c in given.columns], "_made.*")


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre of each row, the first of equal ones (at nine digits)."""
    distance = (x * x).sum(axis=1, keepdims=True) - 2.0 * x @ centres.T + (centres * centres).sum(axis=1)
    return np.argmin(np.round(distance, 9), axis=1)


def fit_clusters(
    questions: DataFrame, text: str, k: int = 6, seed: int = 7, features: int = 256,
    stop_words: list[str] | None = None, max_iter: int = 20, codes: str | None = None,
) -> ClusterModel:
    """Vectorise and cluster. The model's size does not depend on the data. The vectors are written once; the k-means
    rounds read only them. ``codes``: a column that has the ``term_codes`` of the text already."""
    stop_words = lexicons.default_stop_words("en") if stop_words is None else stop_words
    own = term_codes(F.col(text), stop_words) if codes is None else F.col(codes)
    model = ClusterModel(stop_words, seed, features, term_idf(questions, own))
    vectors = stored(_vectors(questions, own, model, keep=False), "text-vectors")
    kmeans = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster_id", maxIter=max_iter)
    fitted = kmeans.fit(vectors.select(array_to_vector("features").alias("features")))
    model.centres = np.array(fitted.clusterCenters())
    return model


def assign_clusters(model: ClusterModel | None, questions: DataFrame, text: str = "text", codes: str | None = None) -> DataFrame:
    """Questions with ``features`` and ``cluster_id``; cluster 0 for all while there is no model. ``codes``: as in ``fit_clusters``."""
    if model is None:
        return questions.withColumn("cluster_id", F.lit(0))
    return _vectors(questions, term_codes(F.col(text), model.stop_words) if codes is None else F.col(codes), model, keep=True)


def _dense(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Lists as rows, filled with zeros up to ``width`` or the longest; a null list is all zeros."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), max(width, int(sizes.max(initial=0)))))
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1, and which rows are not all zeros."""
    length = np.sqrt((x * x).sum(axis=1))
    return x / np.where(length > 0, length, 1.0)[:, None], length > 0


def group_sums(points: DataFrame, vector: str, group: str) -> DataFrame:
    """(group, dim, s, n): sums of the unit vectors of each group, and the number of its vectors that are not all zeros.

    Every task adds up its own rows, and sends a row per group and dimension.
    """
    given = points.select(F.col(group).alias("g"), F.col(vector).alias("v")).where("g is not null")
    kind = given.schema["g"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            x, known = _unit(_dense(batch.column(1)))
            named = batch.column(0).dictionary_encode()
            code = named.indices.to_numpy(zero_copy_only=False)
            for i, g in enumerate(named.dictionary.to_pylist()):
                own = known & (code == i)
                n, s = totals.get(g, (0, np.zeros(0)))
                grown = np.zeros(max(len(s), x.shape[1]))
                grown[: len(s)] += s
                grown[: x.shape[1]] += x[own].sum(axis=0)
                totals[g] = (n + int(own.sum()), grown)
        names, rows = list(totals), list(totals.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, to_arrow_type(kind)), pa.array([n for n, _ in rows], pa.int64()), pa.array([s.tolist() for _, s in rows], pa.list_(pa.float64()))], ["g", "n", "sums"]
        )

    parts = given.mapInArrow(work, StructType([StructField("g", kind), StructField("n", LongType()), StructField("sums", ArrayType(DoubleType()))]))
    return parts.select("g", "n", F.posexplode("sums").alias("dim", "s")).groupBy("g", "dim").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def silhouettes(points: DataFrame, vector: str = "features", group: str = "cluster_id") -> DataFrame:
    """``points`` with ``silhouette`` by cosine distance: null for an all-zero vector, 0 alone in a group.

    A point's mean distance to a group comes from the sum of the group's unit vectors, so no two points meet. The sums
    are one row per group; they reach the tasks as one broadcast.
    """
    names = points.columns
    sums = group_sums(points, vector, group).groupBy("g").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("dim", "s"))).alias("sums"))
    listed = sums.where("n > 0").collect()
    width = max((len(r.sums) for r in listed), default=0)
    totals, sizes, place = np.zeros((len(listed), width)), np.array([r.n for r in listed], float), {r.g: i for i, r in enumerate(listed)}
    for i, r in enumerate(listed):
        totals[i, : len(r.sums)] = [d.s for d in r.sums]
    shared = points.sparkSession.sparkContext.broadcast((totals, sizes, place))
    at_vector, at_group = names.index(vector), names.index(group)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, sizes, place = shared.value
        for batch in batches:
            own = np.array([place.get(g, -1) for g in batch.column(at_group).to_pylist()], np.int64)
            x, known = _unit(_dense(batch.column(at_vector), totals.shape[1]))
            known &= own >= 0
            value = np.zeros(len(x))
            if known.any():
                x, own = x[known], own[known]
                near, each, n = x @ totals.T, np.arange(len(x)), sizes[own]
                inside = 1 - (near[each, own] - 1) / np.maximum(n - 1, 1)
                outside = 1 - near / sizes
                outside[each, own] = np.inf
                between = outside.min(axis=1)
                apart = (n > 1) & np.isfinite(between)
                between = np.where(apart, between, 1.0)
                value[known] = np.where(apart, (between - inside) / np.maximum(between, inside), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value, mask=~known)], [*batch.schema.names, "silhouette"])

    return points.mapInArrow(work, StructType([*points.schema.fields, StructField("silhouette", DoubleType())]))


def silhouette(assigned: DataFrame) -> float:
    """Mean silhouette by cosine distance."""
    return silhouettes(assigned.select("features", "cluster_id")).agg(F.avg("silhouette")).first()[0]


def cluster_report(assigned: DataFrame) -> DataFrame:
    """Questions per cluster."""
    return assigned.groupBy("cluster_id").agg(F.count("*").alias("questions"))


def centroids(points: DataFrame, vector: str, group: str) -> DataFrame:
    """(group, centre): mean vector per group, added up element by element."""
    parts = points.select(F.col(group), F.posexplode(vector).alias("dim", "x"))
    means = parts.groupBy(group, "dim").agg(F.avg("x").alias("m"))
    return means.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda s: s["m"]).alias("centre")
    )


def nearest_centroid(points: DataFrame, vector: str, centres: DataFrame, group: str, name: str = "cluster_id") -> DataFrame:
    """Points with the group of the nearest centre by Euclidean distance; the lower group on a tie (at nine digits).

    The centres are one vector per group; they reach the tasks as one broadcast, for matrix products.
    """
    listed = centres.select(group, "centre").orderBy(group).collect()
    shared = points.sparkSession.sparkContext.broadcast(([r[0] for r in listed], np.array([r[1] for r in listed], float)))
    points = points.drop(name)
    place, added = points.columns.index(vector), StructField(name, centres.schema[group].dataType)
    kind = to_arrow_type(added.dataType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, own = shared.value
        for batch in batches:
            x = batch.column(place).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
            found = nearest(x, own) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([groups[i] for i in found], kind)], [*batch.schema.names, name])

    return points.mapInArrow(work, StructType([*points.schema.fields, added]))


def scatter_positions(assigned: DataFrame) -> DataFrame:
    """Every question with its place on the two main axes of the vectors.

    The axes come from the matrix of columns by columns, which is as small as the vectors are short. A question without
    terms stands where a vector of zeros does.
    """
    vectors = assigned.withColumn("_vector", array_to_vector("features"))
    placed = PCA(k=2, inputCol="_vector", outputCol="_xy").fit(vectors).transform(vectors)
    xy = vector_to_array("_xy")
    return placed.withColumns({"x": xy[0], "y": xy[1]}).drop("_xy", "_vector")


def scatter_centres(positions: DataFrame) -> DataFrame:
    return positions.groupBy("cluster_id").agg(
        F.avg("x").alias("x"), F.avg("y").alias("y"), F.count("*").alias("questions")
    )
