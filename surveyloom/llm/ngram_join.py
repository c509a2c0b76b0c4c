"""Jaccard join of documents on word n-grams, by a blocked sparse product of the document by n-gram incidence.

Two documents link when their sets of distinct n-grams have a Jaccard similarity of at least ``num / den``.

1. Documents with equal sets form one class; its smallest id stands for it.
2. Of a set of n n-grams only the n - ceil(num * n / den) + 1 rarest enter the incidence: linked sets share one of
   them. Rarity comes from a counting table over all documents (2^20 counters); any fixed order gives the same links.
3. Classes that share a frequent n-gram of the incidence are multiplied in dense blocks of bounded size, over all
   their n-grams. These links are final and join most copies of a group.
4. The rest of the product runs over blocks of n-grams, for pairs that are not joined yet. Each block gives partial
   overlap counts; they are added up per pair, and pairs whose largest possible overlap is below the bound that
   follows from both sizes are discarded. What is left is compared over whole sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.components import components
from surveyloom.llm.tokens import SPACES, chain, shingle_sets, slices
from surveyloom.session import stored

COUNTER_BITS = 20
#: Most classes of a dense block, and of a block of the incidence, on average.
DENSE_ROWS, SPARSE_ROWS = 256, 4096


def _counters(words: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                hashes, _ = part.words(SPACES)
                slots = (chain(hashes, words) >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)
                total += np.bincount(slots, minlength=len(total))
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    return count


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << COUNTER_BITS, np.int64)
    for batch in batches:
        for item in batch.column(0):
            total += np.frombuffer(item.as_buffer(), np.int64)
    if total.any():
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])


def ngram_counters(texts: DataFrame, words: int) -> np.ndarray:
    """Occurrences of n-grams in 2^20 counters. Tasks send one table each; two levels of tasks add them up."""
    parts = texts.mapInArrow(_counters(words), "counts binary")
    fan_in = max(1, math.isqrt(texts.rdd.getNumPartitions()))
    found = parts.repartition(fan_in).mapInArrow(_add, "counts binary").repartition(1).mapInArrow(_add, "counts binary").collect()
    return np.frombuffer(found[0].counts, np.int64) if found else np.zeros(1 << COUNTER_BITS, np.int64)


def _prefixes(words: int, num: int, den: int, counters):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = counters.value
        for batch in batches:
            sizes, keys, rare = [], [], []
            for own in shingle_sets(batch.column(1), words):
                n = len(own)
                sizes.append(n)
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                first = np.lexsort((own, order[(own >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]))
                rare.append(own[first[: n + (num * n) // -den + 1]] if n else own)
            lengths = np.zeros(len(rare) + 1, np.int32)
            np.cumsum([len(x) for x in rare], out=lengths[1:])
            flat = np.concatenate(rare).view(np.int64) if rare else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat))],
                ["id", "n", "set_key", "rare"],
            )

    return cut


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches sorted by ``keys``, cut only between groups, and where the groups start. Holds a batch and a group."""
    held: list[pa.RecordBatch] = []

    def cut(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(parts)
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for key in keys:
            values = table[key].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return table, np.flatnonzero(new)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        table, starts = cut([*held[-1:], batch])
        last = int(starts[-1]) - (table.num_rows - batch.num_rows)
        if last < 0:
            held.append(batch)
            continue
        parts = [*held, batch.slice(0, last)]
        if sum(x.num_rows for x in parts):
            yield cut(parts)
        held = [batch.slice(last)]
    if held:
        yield cut(held)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    for table, starts in whole_groups(batches, keys):
        for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
            yield table.slice(a, b - a)


def overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of different sets, as a product of the incidence matrix with its transpose, by blocks of columns."""
    out = np.zeros((len(sets), len(sets)), np.float32)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = seen[column] > 1
    number = np.cumsum(seen > 1) - 1
    column, row = number[column[shared]], row[shared]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (first, first + width))
        block = np.zeros((len(sets), width), np.float32)
        block[row[a:b], column[a:b] - first] = 1
        out += block @ block.T
    return out.astype(np.int64)


class Union:
    def __init__(self, n: int):
        self.of = list(range(n))

    def find(self, x: int) -> int:
        while self.of[x] != x:
            self.of[x] = self.of[self.of[x]]
            x = self.of[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.of[max(a, b)] = min(a, b)


def _dense(words: int, num: int, den: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["gram", "seed", "salt"]):
            if table.num_rows < 2:
                continue
            ids = table["rep"].to_numpy()
            sets = list(shingle_sets(table["text"], words))
            sizes = np.array([len(s) for s in sets])
            both = overlaps(sets)
            linked = np.triu(den * both >= num * (sizes[:, None] + sizes[None, :] - both), 1)
            union = Union(len(ids))
            for a, b in np.argwhere(linked).tolist():
                union.join(a, b)
            root = np.array([union.find(i) for i in range(len(ids))])
            away = np.flatnonzero(ids[root] != ids)
            if len(away):
                yield pa.RecordBatch.from_arrays([pa.array(ids[away]), pa.array(ids[root[away]])], ["u", "v"])

    return link


def bound(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Smallest overlap of linked sets of these sizes."""
    return -(-num * (a + b) // (num + den))


#: Bytes of packed partial products that a task holds before it sends them on.
PACKED = np.dtype([("a", "<i8"), ("b", "<i8"), ("na", "<i4"), ("nb", "<i4"), ("pa", "<i4"), ("pb", "<i4")])


def _sparse(num: int, den: int, buckets: int):
    """Partial products of blocks of n-grams, packed by bucket of the first document."""

    def flush(found: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(found)
        bucket = (rows["a"].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        rows, bucket = rows[order], bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[cuts[1:], len(rows)]
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[cuts]), pa.array([rows[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary())], ["bucket", "rows"]
        )

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for table, starts in whole_groups(batches, ["gram", "low", "high"]):
            rep, n, pos = (table[c].to_numpy() for c in ("rep", "n", "pos"))
            for i, j in _candidates(table, starts, num, den):
                swap = rep[j] < rep[i]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                out = np.empty(len(i), PACKED)
                for side, at in (("a", i), ("b", j)):
                    out[side], out["n" + side], out["p" + side] = rep[at], n[at], pos[at]
                found.append(out)
                size += len(out)
                if size > 200_000:
                    yield flush(found)
                    found, size = [], 0
        if size:
            yield flush(found)

    return product


#: Groups up to this size are multiplied together, larger ones each for itself.
SMALL_GROUP = 32


def _candidates(table: pa.Table, starts: np.ndarray, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group, of different components, that both can have the overlap that their sizes ask for."""
    comp, n, left, block, low, high = (table[c].to_numpy() for c in ("comp", "n", "left", "block", "low", "high"))
    sizes = np.diff(np.r_[starts, len(comp)])
    group = np.repeat(np.arange(len(sizes)), sizes)

    def fits(i, j):
        ok = (comp[i] != comp[j]) & (np.minimum(left[i], left[j]) >= bound(n[i], n[j], num, den))
        return ok & ((low[i] == high[i]) | (block[i] != block[j]))

    near = np.flatnonzero(sizes[group] <= SMALL_GROUP)
    for step in range(1, SMALL_GROUP):
        near = near[near + step < len(group)]
        near = near[group[near] == group[near + step]]
        if not len(near):
            break
        chosen = near[fits(near, near + step)]
        yield chosen, chosen + step
    for g in np.flatnonzero(sizes > SMALL_GROUP):
        rows = np.arange(starts[g], starts[g] + sizes[g])
        values, index, counts = np.unique(comp[rows], return_inverse=True, return_counts=True)
        # Every pair of two components has a side outside the largest one.
        largest = index == counts.argmax()
        for k in np.flatnonzero(~largest):
            other = rows[largest | (rows > rows[k])]
            other = other[fits(rows[k], other)]
            yield np.full(len(other), rows[k]), other


def _viable(num: int, den: int):
    """Classes that have a possible partner in the block; all of a large group."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["gram"]):
            rep = table["rep"].to_numpy()
            sizes = np.diff(np.r_[starts, len(rep)])
            large = np.repeat(sizes > SMALL_GROUP, sizes)
            found = [rep[large]]
            small = table.filter(pa.array(~large))
            cuts = np.cumsum(np.r_[0, sizes[sizes <= SMALL_GROUP]])[:-1]
            own = small["rep"].to_numpy()
            for i, j in _candidates(small, cuts, num, den):
                found += [own[i], own[j]]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)))], ["rep"])

    return keep


def _accumulate(num: int, den: int):
    """Add the partial products up; keep pairs that can still reach the bound."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["bucket"]):
            rows = np.concatenate([np.frombuffer(x.as_buffer(), PACKED) for x in table["rows"]])
            rows = rows[np.lexsort((rows["b"], rows["a"]))]
            cuts = np.flatnonzero(np.r_[True, (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])])
            shared = np.diff(np.r_[cuts, len(rows)])
            last_a, last_b = np.maximum.reduceat(rows["pa"], cuts), np.maximum.reduceat(rows["pb"], cuts)
            one = rows[cuts]
            most = shared + np.minimum(one["na"] - last_a - 1, one["nb"] - last_b - 1)
            one = one[most >= bound(one["na"].astype(np.int64), one["nb"].astype(np.int64), num, den)]
            if len(one):
                yield pa.RecordBatch.from_arrays([pa.array(one["a"]), pa.array(one["b"])], ["u", "v"])

    return add


def _verify(words: int, num: int, den: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (a, b) in enumerate(zip(shingle_sets(batch.column(2), words), shingle_sets(batch.column(3), words), strict=True)):
                both = len(np.intersect1d(a, b, assume_unique=True))
                if den * both >= num * (len(a) + len(b) - both):
                    kept.append(i)
            yield batch.select(["u", "v"]).take(pa.array(kept, pa.int64()))

    return check


def jaccard_components(docs: DataFrame, words: int = 3, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: (id, n_shingles, component_id), linking sets with similarity of at least ``num / den``.

    ``component_id`` is the smallest id that a document reaches by links, its own included. Null and blank texts have
    no shingles and no links; a text of fewer words than ``words`` is one shingle. Rows that repeat an id are one
    document: their texts count as linked. A null id is never linked and has a null component. Other columns of
    ``docs`` are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counters = spark.sparkContext.broadcast(ngram_counters(texts.select("text"), words))
    sets = stored(texts.mapInArrow(_prefixes(words, num, den, counters), "id long, n long, set_key binary, rare array<long>"), "ngram-sets")
    usable = sets.where("n > 0 and id is not null")
    classes = usable.groupBy("set_key").agg(F.min("id").alias("rep"))
    one = usable.join(classes, (usable.id == classes.rep) & (usable.set_key == classes.set_key)).select("rep", "n", "rare")
    incidence = one.select("rep", "n", F.posexplode("rare").alias("pos", "gram"))
    shared = incidence.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1")
    cells = stored(incidence.join(shared, "gram"), "ngram-cells")
    # left: n-grams of the set that another set can have, as far as the incidence tells
    sums = cells.groupBy("rep").agg(F.first("n").alias("size"), F.count("*").alias("found"), F.max(F.struct("m", "gram")).alias("hot"))
    left = sums.withColumn("left", F.expr(f"size - (size - ({num} * size + {den} - 1) div {den} + 1) + found")).where(F.expr(f"{den} * left >= {num} * size"))
    left = stored(left.select("rep", "left", "hot"), "ngram-left")
    open_cells = cells.join(left.select("rep", "left"), "rep").select("gram", "rep", "n", "pos", "left")
    one_block = open_cells.withColumns({"comp": F.col("rep"), "block": F.lit(0), "low": F.lit(0), "high": F.lit(0)})
    viable = one_block.repartition("gram").sortWithinPartitions("gram").mapInArrow(_viable(num, den), "rep long").distinct()
    viable = stored(left.join(viable, "rep", "left_semi"), "ngram-viable")
    text_of = texts.join(viable.select(F.col("rep").alias("id")), "id", "left_semi").dropDuplicates(["id", "text"])
    text_of = stored(text_of.select(F.col("id").alias("rep"), "text"), "ngram-texts")

    seeds = F.when(F.col("hot.m") > DENSE_ROWS, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    placed = viable.select("rep", "hot", F.explode(seeds).alias("seed")).select(
        "rep", F.col("hot.gram").alias("gram"), "seed",
        F.pmod(F.xxhash64("rep", "seed"), F.ceil(F.col("hot.m") / DENSE_ROWS)).alias("salt"),
    )
    blocks = text_of.join(placed, "rep").select("gram", "seed", "salt", "rep", "text")
    blocks = blocks.repartition("gram", "seed", "salt").sortWithinPartitions("gram", "seed", "salt")
    same_id = usable.select("id", "set_key").join(classes, "set_key").where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    found = stored(blocks.mapInArrow(_dense(words, num, den), "u long, v long"), "ngram-found")
    joined = stored(components(found), "ngram-joined")

    labelled = open_cells.join(viable.select("rep"), "rep", "left_semi").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    labelled = labelled.select("gram", "rep", "n", "pos", "left", F.coalesce("component", "rep").alias("comp"))
    labelled = stored(labelled, "ngram-labelled")
    mixed = labelled.groupBy("gram").agg(F.count("*").alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1")
    split = F.ceil(F.col("m") / SPARSE_ROWS).cast("int")
    rows = labelled.join(mixed.select("gram", split.alias("parts")), "gram").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other", "parts")
    rows = rows.repartition("gram", "low", "high").sortWithinPartitions("gram", "low", "high")
    partial = rows.mapInArrow(_sparse(num, den, 4096), "bucket int, rows binary")
    pairs = partial.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_accumulate(num, den), "u long, v long")
    pairs = stored(pairs, "ngram-pairs")
    compared = pairs.join(text_of.select(F.col("rep").alias("u"), F.col("text").alias("left_text")), "u")
    compared = compared.join(text_of.select(F.col("rep").alias("v"), F.col("text").alias("right_text")), "v").select("u", "v", "left_text", "right_text")
    more = compared.mapInArrow(_verify(words, num, den), "u long, v long")
    linked = joined.select(F.col("node").alias("u"), F.col("component").alias("v")).unionAll(more)
    # An id that stands in several rows belongs to several classes.
    repeated = usable.groupBy("id").agg(F.min("set_key").alias("k0"), F.max("set_key").alias("k1")).where("k0 <> k1")
    again = same_id.join(repeated.select(F.col("id").alias("u")), "u", "left_semi")
    final = components(linked.unionAll(again))
    rep_of = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component_id"))
    own = sets.join(rep_of, "set_key", "left")
    return own.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("component_id"))).otherwise(F.col("id")).alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that stand for their component: the one with the smallest id. Documents without words stay.

    Of rows that repeat an id all stay if the id stands for its component, except exact repeats of id and text.
    """
    kept = jaccard_components(docs, **options).where("component_id = doc_id or component_id is null").select("doc_id").distinct()
    nulls = docs.where(F.col("doc_id").isNull())
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionAll(nulls)
