"""First-wins de-duplication and top-k per group.

All of these are a ``row_number`` with a small upper bound, which Spark plans as a group limit on
both sides of the shuffle: each task first keeps only its own first rows per key, so a key that
holds a third of all rows sends a handful of rows per task, not a third of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.text import dedup_key, digest, words

#: Largest ``k`` for which Spark limits groups on both sides of the shuffle, and parts of a group beyond it.
GROUP_LIMIT, PARTS = 1_000, 64


def _narrow(df: DataFrame, keys: list[str]) -> list[Column]:
    """Group keys; text keys are replaced by their digest so that long texts are not compared."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [digest(F.col(k)) if isinstance(kinds[k], T.StringType) else F.col(k) for k in keys]


def top_per_group(df: DataFrame, keys: list[str], order: list, k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group, optionally with their 1-based rank.

    Up to ``GROUP_LIMIT`` rows a group, Spark keeps a few rows per task. Beyond it a group is ranked in two phases: its
    rows are dealt over ``PARTS`` parts of which each keeps its own first ``k``, and what they keep is ranked by ranges
    over many tasks. Rows that are equal in ``order`` may then come in any order.
    """
    name = rank or "_rn"
    if k > GROUP_LIMIT:
        from surveyloom.sources.ids import ranked_within  # which itself uses this module

        part = F.pmod(F.monotonically_increasing_id(), F.lit(PARTS))
        window = Window.partitionBy(*_narrow(df, keys), "_part").orderBy(*order)
        heads = df.withColumn("_part", part).withColumn("_first", F.row_number().over(window)).filter(F.col("_first") <= k).drop("_part", "_first")
        kept = ranked_within(heads, keys, order, name).filter(F.col(name) <= k)
    else:
        window = Window.partitionBy(*_narrow(df, keys)).orderBy(*order)
        kept = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def first_wins(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """The first row, by ``order``, of each key."""
    return top_per_group(df, keys, [order], 1)


def new_rows(batch: DataFrame, history: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """First row per key of ``batch``, without the keys already in ``history``."""
    names = [f"_k{i}" for i in range(len(keys))]
    known = history.select(*[c.alias(n) for c, n in zip(_narrow(history, keys), names)])
    fresh = first_wins(batch, keys, order).withColumns(dict(zip(names, _narrow(batch, keys))))
    return fresh.join(known, names, "left_anti").drop(*names)


def composed_lexicon(stop_words: DataFrame, lemmas: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(word, target): what a word becomes after lemma and synonym; NULL for a stop word (word).

    ``lemmas`` and ``synonyms`` have (word, target); of several entries for a word, that with the largest ``seq``
    counts, if there is such a column.
    """
    def once(table: DataFrame) -> DataFrame:
        return top_per_group(table, ["word"], [F.desc("seq")], 1).drop("seq") if "seq" in table.columns else table.dropDuplicates(["word"])

    lemma, synonym = once(lemmas).toDF("word", "lemma"), once(synonyms).toDF("from", "to")
    known = lemma.select("word").unionByName(synonym.select(F.col("from").alias("word"))).distinct()
    found = known.join(lemma, "word", "left").withColumn("lemma", F.coalesce("lemma", "word"))
    found = found.join(synonym, F.col("lemma") == F.col("from"), "left").select("word", F.coalesce("to", "lemma").alias("target"))
    stops = stop_words.select("word").distinct()
    return found.join(stops, "word", "left_anti").unionByName(stops.withColumn("target", F.lit(None).cast("string")))


def dictionary_keys(df: DataFrame, text: str, lexicon: DataFrame, order: str = "seq") -> DataFrame:
    """``df`` with ``dedup_key``: its lower-case words, looked up in ``lexicon`` (word, target), joined by blanks.

    For dictionaries of any size: the different words of all texts meet the lexicon once, in a join, and what they
    become is joined back to the places where they stand. Words that are not in the lexicon stay, those with a NULL
    target go. ``order`` names the rows. Equal to ``dedup_key`` for English, whose lists are part of the plan.
    """
    placed = df.select(F.col(order).alias("_row"), F.posexplode(words(F.lower(F.coalesce(F.col(text), F.lit(""))), 1)).alias("_pos", "word"))
    met = placed.select("word").distinct().join(lexicon.select("word", "target", F.lit(True).alias("listed")), "word")
    found = placed.join(met, "word", "left").select("_row", "_pos", F.when(F.col("listed"), F.col("target")).otherwise(F.col("word")).alias("target"))
    kept = F.array_sort(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("_pos", "target"))))
    keys = found.groupBy("_row").agg(F.array_join(F.transform(kept, lambda x: x["target"]), " ").alias("dedup_key"))
    joined = df.drop("dedup_key").join(keys, F.col(order) == F.col("_row"), "left")
    return joined.drop("_row").withColumn("dedup_key", F.coalesce("dedup_key", F.lit("")))


def drop_near_duplicates(
    df: DataFrame, text: str = "question_text", options: str = "options_text",
    lang: str = "detected_lang", order: str = "seq", **key_options,
) -> DataFrame:
    """One row per normalised key of text and options; adds ``dedup_key``."""
    wording = F.concat_ws(" ", F.col(text), F.coalesce(F.col(options), F.lit("")))
    keyed = df.withColumn("dedup_key", dedup_key(wording, F.col(lang), **key_options))
    return first_wins(keyed, ["dedup_key"], order)


def limit_links(links: DataFrame, per_page: int) -> DataFrame:
    """First occurrence of each link over all pages, then at most ``per_page`` per page.

    A link counts as taken by the page where it stands first even if the limit then cuts it there.
    """
    spot = F.struct("page_seq", "link_pos")
    firsts = first_wins(links.withColumn("_spot", spot), ["url"], "_spot").drop("_spot")
    return top_per_group(firsts, ["page_seq"], ["link_pos"], per_page)
