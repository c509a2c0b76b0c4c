"""Removal of lines that stand on many sites, such as menus, notices and licence lines.

Lines are compared by the hash of their words (A-Z as a-z, white space as one space). A HyperLogLog sketch per line
gathers its sites, merged by aggregation, so that a line that stands everywhere is a few sketches per task. Lines
whose estimate is near the threshold are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.columns import SPACE, lower_ascii, unused
from surveyloom.session import stored

SITES = 10
#: log2 of the registers of a sketch; its relative error is about 1.04 / sqrt(2^12), and the band is ten times that.
REGISTERS = 12
BAND = 10 * 1.04 / 2 ** (REGISTERS / 2)


def lines(docs: DataFrame) -> DataFrame:
    """Lines with a word: doc_id, text_key, source, pos, line (hash)."""
    split = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "source", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    plain = F.trim(F.regexp_replace(lower_ascii(F.col("raw")), SPACE, " "))
    split = split.withColumn("plain", plain).where("plain <> ''")
    return split.select("doc_id", "text_key", "source", "pos", F.xxhash64("plain").alias("line"))


def widespread(found: DataFrame, sites: int = SITES) -> DataFrame:
    """Hashes of lines that stand on at least ``sites`` sites (``source``; null is none)."""
    spread = found.where("source is not null").groupBy("line").agg(F.hll_sketch_agg("source", REGISTERS).alias("sketch"))
    spread = stored(spread.select("line", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= sites * (1 - BAND) - 1), "line-spread")
    surely = F.col("sites") > sites * (1 + BAND) + 1
    near = spread.where(~surely).select("line")
    exact = found.where("source is not null").join(near, "line", "left_semi").select("line", "source").distinct()
    exact = exact.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= sites).select("line")
    return spread.where(surely).select("line").unionAll(exact)


def remove_widespread(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """``docs`` with ``text`` cut, and with n_lines, n_spread (lines with a word, widespread ones) and n_removed.

    Widespread lines go from every document, however many it has. Only a text that has no other lines with a word, and
    that stands in several rows as a whole, is left as it is: it is a copy, for the removal of copies to thin out. Where
    such a text stands once, nothing but its blank lines is left. A null text stays null with zeros. Rows that repeat
    doc_id and text are cut alike and count once for their site. A null source counts as no site; a null doc_id is an
    id like others. Columns of these names in ``docs`` are replaced.
    """
    docs = docs.drop("n_lines", "n_spread", "n_removed")
    found = stored(lines(docs), "line-hashes")  # read three times below
    spread = stored(widespread(found, sites), "line-widespread")
    repeated = docs.groupBy(F.xxhash64("text").alias("text_key")).count().where("count > 1").select("text_key", F.lit(True).alias("copy"))
    hits = found.join(spread, "line", "left_semi").groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("pos")).alias("hit"))
    key, hit, copy, hit_id, hit_key = unused(docs, "text_key", "hit", "copy", "hit_id", "hit_key")
    hits = hits.join(repeated, "text_key", "left").select(F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key), F.col("hit").alias(hit), F.col("copy").alias(copy))
    keyed = docs.withColumn(key, F.xxhash64("text"))
    joined = keyed.join(hits, keyed["doc_id"].eqNullSafe(hits[hit_id]) & (keyed[key] == hits[hit_key]), "left")
    q = lambda name: f"`{name}`"
    n_lines = F.coalesce(F.size(F.filter(F.split("text", "\n"), lambda l: F.btrim(l, F.lit(" \t\x0b\x0c\r")) != "")), F.lit(0)).cast("long")
    cut = F.col(q(hit)).isNotNull() & ~(F.coalesce(F.col(q(copy)), F.lit(False)) & (F.size(q(hit)) == n_lines))
    # What lies between the hits, in one pass: each line is copied once.
    kept = f"""transform(array(split(text, '\\n')), l -> array_join(flatten(transform(sequence(0, size({q(hit)})), j ->
        slice(l, coalesce(get({q(hit)}, j - 1) + 2, 1), coalesce(get({q(hit)}, j), size(l)) - coalesce(get({q(hit)}, j - 1) + 1, 0)))), '\\n'))[0]"""
    return joined.select(
        *[F.when(cut, F.expr(kept)).otherwise(F.col("text")).alias("text") if c == "text" else F.col(q(c)) for c in docs.columns],
        n_lines.alias("n_lines"),
        F.coalesce(F.size(q(hit)), F.lit(0)).cast("long").alias("n_spread"),
        F.when(cut, F.size(q(hit))).otherwise(0).cast("long").alias("n_removed"),
    )
