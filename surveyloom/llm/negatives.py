"""Hard negatives by slot-decomposed selection.

Every anchor has a few positives, and every positive asks for the best negatives in a window of scores that ends at the
positive's own score. The upper ends cut the scores of an anchor into disjoint slots. Tasks score blocks of rows
against blocks of anchors and keep the first few rows per slot, as do the merges after them; a suffix merge from the
lowest slot upwards then answers the windows of all positives, however they overlap. No task sees all rows of a label,
and what is shuffled is a few rows per anchor, slot and block.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.session import stored

#: Rows and anchors scored by one task at a time, at most; and entries of a matrix of scores.
BLOCK_ROWS, LEAST_ROWS = 65_536, 2_048
BLOCK_ANCHORS = 4_096
ENTRIES = 1 << 21
#: Sums of products are exact in doubles below this.
EXACT = 2.0**53


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, filled with zeros up to ``width``."""
    lists = vectors.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width))
    ends = np.cumsum(sizes)
    at = np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes)
    out[np.repeat(np.arange(len(lists)), sizes), at] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    return (a @ b.T if most < EXACT else a.astype(np.int64) @ b.astype(np.int64).T).astype(np.int64)


def first_of_rows(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` largest allowed scores of each row; of equal ones those in the first columns."""
    least = np.iinfo(np.int64).min
    held = np.where(allowed, scores, least)
    if held.shape[1] > k:
        limit = np.partition(held, -k, axis=1)[:, -k][:, None]
        above, equal = held > limit, held == limit
        allowed = allowed & (above | equal & (np.cumsum(equal, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    return np.nonzero(allowed)


def _scored(choose: Callable[[np.ndarray, np.ndarray, np.ndarray, list], list], entries: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Task over a block of rows and a block of anchors.

    ``choose`` gets scores, whether labels are the same, whether ids are, and the anchors' limits; it names the entries
    to keep, by slot.
    """

    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and anchors.num_rows:
            rows = rows.sort_by("id")
            width = max(int(t["vector"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max()) for t in (rows, anchors))
            (a, own, own_label), (b, ids, labels) = ((_matrix(t["vector"], width), t["id"].to_numpy(), t["label"].to_numpy()) for t in (anchors, rows))
            limits = anchors["limits"].to_pylist() if "limits" in anchors.column_names else [[]] * len(own)
            step = max(1, entries // len(ids))
            for at in range(0, len(own), step):
                cut = slice(at, at + step)
                scores = _products(a[cut], b)
                for slot, (r, c) in choose(scores, own_label[cut, None] == labels, own[cut, None] == ids, limits[cut]):
                    found.append((own[cut][r], np.full(len(r), slot, np.int32), scores[r, c], ids[c]))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int64)]
        return pa.table(dict(zip(("anchor_id", "slot", "score", "id"), columns, strict=True)))

    return work


def _first_positives(k: int):
    return lambda scores, same, itself, _: [(0, first_of_rows(scores, same & ~itself, k))]


def _first_negatives(k: int, low: int, high: int):
    def choose(scores, same, _, limits):
        # Upper ends, highest first. A shorter list goes on with ends below all scores, whose slots stay empty.
        least, width = np.iinfo(np.int64).min, max(map(len, limits))
        upper = np.array([[*x, *[least] * (width + 1 - len(x))] for x in limits], np.int64)
        # No window reaches below that of the smallest positive from zero up; the others are empty.
        floor = np.array([low * min((u for u in x if u >= 0), default=np.iinfo(np.int64).max // low) for x in limits], np.int64)
        open_ = ~same & (high * scores >= floor[:, None])
        return [(j, first_of_rows(scores, open_ & (scores <= upper[:, j, None]) & (scores > upper[:, j + 1, None]), k)) for j in range(width)]

    return choose


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows per key by score and id; Spark limits the groups before and after the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for all anchors.

    A score is the inner product of vectors whose components are ``floor(scale * x)``. An anchor's positives are its
    first rows of its own label, its negatives rows of another label with ``low * positive <= high * negative <=
    high * positive``. Higher scores come first, equal ones by the smaller id. Rows with a null id, label or vector, or
    with a component that is null or not finite, take no part. Rows that repeat an id are one row, the one with the
    smallest label and vector. Components that the shorter of two vectors lacks count as 0; scores must fit 64 bits. An
    anchor without positives, and a positive without negatives (as all below zero), give no row. Other columns are ignored.
    """
    given = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).cast("long").alias("label"), is_anchor.alias("anchor"))
    given = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    given = given.where(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * scale))
    given = given.groupBy("id").agg(F.min(F.struct("label", whole.alias("vector"))).alias("row"), F.bool_or("anchor").alias("anchor"))
    given = stored(given.select("id", "row.label", "row.vector", F.coalesce("anchor", F.lit(False)).alias("anchor")), "negative-vectors")
    anchors = stored(given.where("anchor").drop("anchor"), "negative-anchors")

    sizes = given.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    parts = max(-(-sizes.rows // BLOCK_ROWS), min(4 * rows.sparkSession.sparkContext.defaultParallelism, -(-sizes.rows // LEAST_ROWS)), 1)
    groups = max(-(-sizes.anchors // BLOCK_ANCHORS), 1)

    def dealt(side: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        """Each row in a block of its own side, for every block of the other."""
        block = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
        return side.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).repartition(parts * groups, "part", "of").groupBy("part", "of")

    def search(asked: DataFrame, choose) -> DataFrame:
        blocks = dealt(given.drop("anchor"), "part", parts, "of", groups).cogroup(dealt(asked, "of", groups, "part", parts))
        return blocks.applyInArrow(_scored(choose, ENTRIES), "anchor_id long, slot int, score long, id long")

    best = stored(_first(search(anchors, _first_positives(positives)), ["anchor_id"], positives).select("anchor_id", "score", "id"), "positives")
    per_anchor = best.groupBy("anchor_id").agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
    asked = anchors.join(per_anchor.withColumnRenamed("anchor_id", "id"), "id")
    slots = _first(search(asked, _first_negatives(negatives, low, high)), ["anchor_id", "slot"], negatives)
    kept = slots.groupBy("anchor_id").agg(F.collect_list(F.struct((-F.col("score")).alias("below"), "id", "slot")).alias("kept"))
    # From the lowest slot upwards: a slot's own rows, then those of the slots below it.
    merged = f"""aggregate(sequence(size(limits) - 1, 0, -1), cast(array() as array<array<struct<below: bigint, id: bigint, slot: int>>>),
        (all, j) -> concat(array(slice(concat(array_sort(filter(kept, x -> x.slot = j)), if(size(all) > 0, all[0], filter(kept, x -> false))), 1, {negatives})), all))"""
    answers = per_anchor.join(kept, "anchor_id").select("anchor_id", "limits", F.expr(merged).alias("merged"))
    window = F.expr(f"filter(merged[cast(array_position(limits, score) - 1 as int)], x -> {low} * score <= -{high} * x.below)")
    paired = best.join(answers, "anchor_id").select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode(window).alias("pos", "x"))
    return paired.select("anchor_id", "positive_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.id").alias("negative_id"), "positive_score", (-F.col("x.below")).alias("negative_score"))
