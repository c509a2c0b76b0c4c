"""Pairwise-complete Pearson correlation between the columns of a long (row, column, value) table.

Spark puts the rows of one user next to each other; each task turns its users into small matrices and works out, for
every pair of columns with a common user, the number of common users, both means and the sums of products about those
means. Such moments merge without loss: two parts add up, plus what their means are apart. No large sums are
subtracted from each other, so columns that vary in their last digits only keep their correlation. One row per pair
and chunk is shuffled; pairs are never listed per user.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.session import stored

#: Per pair: common rows, means, sums of squares and products about the means.
MOMENTS = ["n", "mean_x", "mean_y", "xx", "yy", "xy"]
RANGES = ["min_x", "max_x", "min_y", "max_y"]
SCHEMA = "col_i string, col_j string, " + ", ".join(f"{name} double" for name in [*MOMENTS, *RANGES])
BLOCK = 256  # columns handled against each other at once
CHUNK = 200_000  # input rows gathered before moments are worked out, so that few of them leave a task
CELLS = 2_000_000  # largest matrix (users times columns) held at once; more users are halved


def _block_moments(xi: np.ndarray, xj: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of every pair of a column of ``xi`` with a column of ``xj`` over rows that have both."""
    out = {name: np.zeros((xi.shape[1], xj.shape[1])) for name in [*MOMENTS, *RANGES]}
    known = ~np.isnan(xi)
    for j in range(xj.shape[1]):
        rows = ~np.isnan(xj[:, j])
        if not rows.any():
            continue
        both, x, y = known[rows], xi[rows], xj[rows, j][:, None]
        n = both.sum(axis=0)
        some = np.maximum(n, 1)
        mean_x = np.where(both, x, 0.0).sum(axis=0) / some
        mean_y = np.where(both, y, 0.0).sum(axis=0) / some
        # A mean is rounded; the means of what is left make up for it.
        dx, dy = np.where(both, x - mean_x, 0.0), np.where(both, y - mean_y, 0.0)
        rest_x, rest_y = dx.sum(axis=0) / some, dy.sum(axis=0) / some
        dx, dy = np.where(both, dx - rest_x, 0.0), np.where(both, dy - rest_y, 0.0)
        found = {
            "n": n, "mean_x": mean_x + rest_x, "mean_y": mean_y + rest_y,
            "xx": (dx * dx).sum(axis=0), "yy": (dy * dy).sum(axis=0), "xy": (dx * dy).sum(axis=0),
            "min_x": np.where(both, x, np.inf).min(axis=0), "max_x": np.where(both, x, -np.inf).max(axis=0),
            "min_y": np.where(both, y, np.inf).min(axis=0), "max_y": np.where(both, y, -np.inf).max(axis=0),
        }
        for name, values in found.items():
            out[name][:, j] = values
    return out


def _matrix_moments(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    users, ids = pd.factorize(rows["row_id"])
    codes, names = pd.factorize(rows["col"], sort=True)
    if len(ids) > 1 and len(ids) * len(names) > CELLS:
        first = users < len(ids) // 2
        yield from _matrix_moments(rows[first])
        yield from _matrix_moments(rows[~first])
        return
    values, names = rows["value"].to_numpy(float), np.asarray(names)
    blocks = {}
    for start in range(0, len(names), BLOCK):
        inside = (codes >= start) & (codes < start + BLOCK)
        block = np.full((len(ids), min(BLOCK, len(names) - start)), np.nan)
        block[users[inside], codes[inside] - start] = values[inside]
        blocks[start] = block
    for a, xi in blocks.items():
        for b, xj in blocks.items():
            sums = _block_moments(xi, xj)
            i, j = np.nonzero(sums["n"])
            yield pd.DataFrame(
                {"col_i": names[i + a], "col_j": names[j + b], **{name: sums[name][i, j] for name in sums}}
            )


def _partition_moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Moments chunk by chunk; the last user of a chunk waits for the next one."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= CHUNK:
            rows = pd.concat(held)
            last = rows["row_id"] == rows["row_id"].iloc[-1]
            held, size = [rows[last]], int(last.sum())
            if size < len(rows):
                yield from _matrix_moments(rows[~last])
    if size:
        yield from _matrix_moments(pd.concat(held))


def merged_moments(parts: DataFrame) -> DataFrame:
    """One row of moments per pair from those of its parts.

    The mean of a pair is taken relative to that of its first part, since the parts' means may be equal in all but
    their last digits.
    """
    pair = Window.partitionBy("col_i", "col_j")
    out = parts
    for v in "xy":
        base = F.first(f"mean_{v}").over(pair.orderBy(f"mean_{v}").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        out = out.withColumn(f"base_{v}", base).withColumn(f"gap_{v}", F.col(f"mean_{v}") - F.col(f"base_{v}"))
        out = out.withColumn(f"off_{v}", F.col(f"gap_{v}") - F.sum(F.col("n") * F.col(f"gap_{v}")).over(pair) / F.sum("n").over(pair))
    n = F.col("n")
    return out.groupBy("col_i", "col_j").agg(
        F.sum("n").alias("n"),
        *[(F.first(f"base_{v}") + F.sum(n * F.col(f"gap_{v}")) / F.sum("n")).alias(f"mean_{v}") for v in "xy"],
        *[F.sum(F.col(a + b) + n * F.col(f"off_{a}") * F.col(f"off_{b}")).alias(a + b) for a, b in ("xx", "yy", "xy")],
        *[(F.min if name.startswith("min") else F.max)(name).alias(name) for name in RANGES],
    )


def pair_moments(cells: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """Moments per ordered pair of columns that occur together in at least one row."""
    long = cells.select(
        F.col(row).alias("row_id"), F.col(col).cast("string").alias("col"), F.col(value).cast("double").alias("value")
    ).filter(F.col("value").isNotNull())
    together = long.repartition("row_id").sortWithinPartitions("row_id")
    return merged_moments(together.mapInPandas(_partition_moments, SCHEMA))


def correlated_pairs(cells: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """(col_i, col_j, n, corr) of the pairs of columns with a common row, the diagonal included.

    Fewer than two common rows give 0.0; a column that is constant on the common rows gives NULL.
    """
    flat = (F.col("min_x") == F.col("max_x")) | (F.col("min_y") == F.col("max_y"))
    r = F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy"))
    return pair_moments(cells, row, col, value).select(
        "col_i", "col_j", F.col("n").cast("bigint").alias("n"),
        F.when(F.col("n") < 2, F.lit(0.0)).when(~flat, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("corr"),
    )


def correlation_matrix(cells: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """The whole matrix: ``correlated_pairs``, and 0.0 for every pair of columns without a common row.

    It has a row for every two columns; where they are many, ``correlated_pairs`` lists those that occur.
    """
    # One row per pair of columns: small, and read three times below.
    known = stored(correlated_pairs(cells, row, col, value), "moments")
    # Every column with data is paired with itself.
    names = known.filter(F.col("col_i") == F.col("col_j")).select("col_i")
    every = names.agg(F.collect_set("col_i")).scalar()
    pairs = names.select("col_i", F.explode(every).alias("col_j"))
    return pairs.join(known, ["col_i", "col_j"], "left").select(
        "col_i", "col_j", F.coalesce("n", F.lit(0)).alias("n"),
        F.when(F.col("n").isNull(), F.lit(0.0)).otherwise(F.col("corr")).alias("corr"),
    )
