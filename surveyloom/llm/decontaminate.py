"""Benchmark decontamination: windows of words that documents share with test items.

A window is ``WINDOW`` consecutive words of an item, or a shorter item as a whole. The hashes of all windows are a
broadcast hash set, as long as their texts stay under ``MOST_BROADCAST`` characters; beyond that the same join
shuffles. Every window of a document looks its hash up; hits are verified by their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.columns import NOT_WORD, lower_ascii, unused, words
from surveyloom.session import stored

WINDOW = 13
MOST_BROADCAST = 32_000_000


def _windows(lengths: list[int]) -> Column:
    """All windows (size, pos, hash) of these lengths, of the word hashes ``codes``."""
    kind = "array<struct<size:int,pos:int,hash:bigint>>"
    each = [
        f"if(size(codes) >= {n}, transform(sequence(0, size(codes) - {n}), i -> struct({n} as size, i as pos, xxhash64(slice(codes, i + 1, {n})) as hash)), cast(array() as {kind}))"
        for n in lengths
    ]
    return F.expr(f"concat({', '.join([*each, f'cast(array() as {kind})'])})")


def _text(size: str, pos: str) -> Column:
    return F.expr(f"array_join(slice(tokens, {pos} + 1, {size}), ' ')")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: (item_id, size, hash, words). Null and wordless items have none."""
    items = benchmark.select("item_id", words(lower_ascii(F.col("text")), NOT_WORD).alias("tokens")).where("size(tokens) > 0")
    items = items.withColumn("n", F.least(F.size("tokens"), F.lit(window)))
    items = items.withColumn("pos", F.explode(F.sequence(F.lit(0), F.size("tokens") - F.col("n"))))
    coded = F.expr("xxhash64(slice(transform(tokens, w -> xxhash64(w)), pos + 1, n))")
    return items.select("item_id", F.col("n").alias("size"), coded.alias("hash"), _text("n", "pos").alias("words")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_words, n_hit, n_items, items_sha256, spans, contaminated.

    ``n_hit`` counts words inside any occurrence of a window, ``spans`` lists them (start, length in words, in order).
    Contaminated: a hit, and ``share * n_hit >= n_words``. Null texts have no words. Items without an id are not
    counted as items, but their windows hit. Rows that repeat doc_id and text give equal rows; a null doc_id is kept.
    Without items nothing is hit. Other columns are ignored.
    """
    found = stored(benchmark_windows(benchmark, window), "benchmark-windows")
    sizes = found.groupBy("size").agg(F.sum(F.length("words")).alias("chars")).collect()
    per_window = found.groupBy("hash", "size", "words").agg(F.collect_set("item_id").alias("items"))
    if sum(s.chars for s in sizes) <= MOST_BROADCAST:
        per_window = F.broadcast(per_window)
    tokens = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(lower_ascii(F.col("text")), NOT_WORD).alias("tokens"))
    tokens = tokens.withColumn("codes", F.expr("transform(tokens, w -> xxhash64(w))"))
    # One more element without a hash stands for the document itself, so that one pass finds documents without a hit too.
    each = F.concat(_windows(sorted(s["size"] for s in sizes)), F.expr("array(struct(0 as size, 0 as pos, cast(null as bigint) as hash))"))
    scanned = tokens.withColumn("w", F.explode(each)).select("doc_id", "text_key", "tokens", F.col("w.size").alias("size"), F.col("w.pos").alias("pos"), F.col("w.hash").alias("hash"))
    hits = scanned.join(per_window.withColumnRenamed("size", "item_size"), "hash", "left")
    hits = hits.where(F.col("hash").isNull() | (F.col("words") == _text("size", "pos")) & (F.col("size") == F.col("item_size")))
    hits = hits.select("doc_id", "text_key", F.size("tokens").alias("n"), "pos", "size", "hash", "items")
    span = F.when(F.col("hash").isNotNull(), F.struct("pos", "size"))
    per_doc = hits.groupBy("doc_id", "text_key").agg(
        F.max("n").cast("long").alias("n_words"), F.sort_array(F.collect_set(span)).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"), F.count(F.when(F.col("hash").isNull(), 1)).alias("copies"),
    )
    covered = "aggregate(spans, struct(0 as upto, 0L as n), (a, s) -> struct(greatest(a.upto, s.pos + s.size) as upto, a.n + greatest(0, s.pos + s.size - greatest(a.upto, s.pos)) as n), a -> a.n)"
    listed = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    out = per_doc.select(
        "doc_id", "text_key", "n_words", F.expr(covered).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), "spans", F.explode(F.expr("sequence(1L, copies)")).alias("copy"),
    ).drop("copy")
    return out.withColumn("contaminated", F.expr(f"n_hit > 0 and {share} * n_hit >= n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with their columns as they are."""
    key, gone_id, gone_key = unused(docs, "text_key", "gone_id", "gone_key")
    bad = contamination(docs, benchmark, **options).where("contaminated").select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key)).distinct()
    keyed = docs.withColumn(key, F.xxhash64("text"))
    return keyed.join(bad, keyed["doc_id"].eqNullSafe(bad[gone_id]) & (keyed[key] == bad[gone_key]), "left_anti").select(*docs.columns)
