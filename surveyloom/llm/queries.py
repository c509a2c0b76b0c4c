"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import blocks, columns, decontaminate, fertility, language, line_spread, manifest, negatives, ngram_join, pfair, ppm, quality, toxicity, transcripts

GOOD = 0.7
#: Toxicity categories of the label table, in the order of the chain: a name, and SQL of its 0/1 label.
CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}
TOXIC = 0.5


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _fold(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % modulus == 2


def op1_tokeniser_fertility(spark: SparkSession, folder: str) -> DataFrame:
    return fertility.quality(_table(spark, folder, "documents"))


def op2_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, _table(spark, folder, "labels"), CATEGORIES)
    chances = [F.col("probabilities")[i].alias(f"p_{name}") for i, name in enumerate(CATEGORIES)]
    return scored.select("doc_id", *chances).withColumn("toxic", F.col("p_toxic") >= TOXIC)


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"), _fold(4))


def op4_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """The turns of all conversations, once from their rows, and once from texts that hold several turns with markers."""
    turns = _table(spark, folder, "conversations")
    model = transcripts.fit(turns.where(F.crc32(F.col("conv_id").cast("string")) % 4 != 2))
    texts = transcripts.rendered_transcripts(turns, {"user": "User", "assistant": "Assistant", "system": "System"})
    given = [turns.select("conv_id", "turn", "text").withColumn("form", F.lit("rows")), texts.withColumn("form", F.lit("texts"))]
    both = given[0].unionByName(given[1].withColumn("turn", F.col("turn").cast(turns.schema["turn"].dataType)))
    named = both.withColumn("conv_id", F.concat_ws("/", "form", F.col("conv_id").cast("string")))
    found = transcripts.parse(named, model)
    return found.select(F.substring_index("conv_id", "/", 1).alias("form"), F.substring_index("conv_id", "/", -1).try_cast("long").alias("conv_id"), "place", "turn", "at", "role", "n_lines", "rendered")


def op5_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    return pfair.mix(_table(spark, folder, "documents"))


def op6_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    return line_spread.remove_widespread(docs).select("doc_id", "text", "n_lines", "n_spread", "n_removed")


def op7_block_labels(spark: SparkSession, folder: str) -> DataFrame:
    return blocks.main_text(_table(spark, folder, "pages"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, folder, "documents"))


def op10_ppm(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.score_documents(_table(spark, folder, "documents"), _fold(7))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, folder, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    leaf = lambda text: manifest.leaf_digest([F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [text])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf(columns.lower_ascii(F.col("text"))))
    found = manifest.manifest(_table(spark, folder, "documents"), leaf(F.col("text")), tampered)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def op13_quadratic_quality(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"), _fold(4))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_tokeniser_fertility, op2_toxicity_chain, op3_language, op4_transcripts, op5_pfair_mix, op6_line_spread, op7_block_labels,
        op8_decontamination, op9_ngram_join, op10_ppm, op11_hard_negatives, op12_merkle_manifest, op13_quadratic_quality,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(string_split_regex(" + _LOWER.format("coalesce(text, '')") + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


def _manifest_sql(levels: int = 7) -> str:
    """Trees of at most ``8 ** levels`` leaves; a level that has one node of a tree stays as it is."""
    head = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    bits = "list_concat([ascii(c)], [-1, -1, -1, -1, -1, -1, -1, -1])"
    crc = f"""xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: {bits}))),
        lambda a, b: case when b >= 0 then xor(a, b) when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end), 4294967295)"""
    tampered = f"case when {crc} % 3 = 0 then {_LOWER.format('text')} else text end"
    steps = [f"""
leaves as (select doc_id, lang, sha256({head} || {_field('text')}) as leaf, sha256({head} || {_field(tampered)}) as shown from documents),
up0 as (
  select row_number() over () as n, doc_id, leaf, shown as cur, '' as proof, dense_rank() over (order by lang nulls first) - 1 as tree,
         row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i
  from leaves
), nodes0 as (select tree, i, leaf as h from up0)"""]

    def climb(k: int, up: str, nodes: str, more: str = "") -> str:
        return f"""
{nodes}{k}_counted as (select *, count(*) over (partition by tree) > 1 as many from {nodes}{k}),
{nodes}{k + 1} as (
  select tree, i // 8 as i, case when many then sha256(string_agg(h, '' order by i)) else max(h) end as h from {nodes}{k}_counted group by tree, i // 8, many
), {up}{k + 1} as (
  select u.n, doc_id, leaf, {more}u.tree, u.i // 8 as i, proof || coalesce(string_agg(r.h, '' order by r.i) filter (where r.i <> u.i), '') as proof,
         case when bool_or(many) then sha256(string_agg(case when r.i = u.i then cur else r.h end, '' order by r.i)) else cur end as cur
  from {up}{k} u join {nodes}{k}_counted r on r.tree = u.tree and r.i // 8 = u.i // 8 group by all
)""".replace("group by all", f"group by u.n, doc_id, leaf, {more}u.tree, u.i, cur, proof")

    steps += [climb(k, "up", "nodes") for k in range(levels)]
    steps.append(f"""
tops0 as (select 0 as tree, tree as i, h from nodes{levels}),
last0 as (select n, doc_id, leaf, h as subroot, 0 as tree, u.tree as i, cur, proof from up{levels} u join nodes{levels} t on t.tree = u.tree)""")
    steps += [climb(k, "last", "tops", "subroot, ") for k in range(2)]
    return f"""with {",".join(steps)}
select doc_id, leaf, subroot, h as root, sha256(proof) as proof_sha256, cur as folded_root, cur = h as verified from last2, tops2"""


SQL: dict[str, str] = {
    "op12_merkle_manifest": _manifest_sql(),
    "op6_line_spread": rf"""
with lines as (
  select doc_id, source, raw, pos,
         trim(regexp_replace({_LOWER.format('raw')}, '[\x20\x09-\x0D]+', ' ', 'g')) as plain
  from (select doc_id, source, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)
), spread as (select plain from lines where plain <> '' group by plain having count(distinct source) >= {line_spread.SITES}),
marked as (select l.*, l.plain <> '' and s.plain is not null as hit from lines l left join spread s on l.plain = s.plain),
judged as (
  select doc_id, count(*) filter (where plain <> '') as n_lines, count(*) filter (where hit) as n_spread,
         coalesce(string_agg(raw, chr(10) order by pos) filter (where not hit), '') as rest
  from marked group by doc_id
), copies as (select text from documents group by text having count(*) > 1),
cuts as (
  select d.doc_id, d.text, coalesce(n_lines, 0) as n_lines, coalesce(n_spread, 0) as n_spread, rest,
         coalesce(n_spread, 0) > 0 and not (n_spread = n_lines and c.text is not null) as cut
  from documents d left join judged j on d.doc_id = j.doc_id left join copies c on d.text = c.text
)
select doc_id, case when cut then rest else text end as text, n_lines, n_spread, case when cut then n_spread else 0 end as n_removed from cuts
""",
    "op8_decontamination": f"""
with items as (select item_id, {_WORDS} as w from benchmark),
sized as (select item_id, w, least(len(w), {decontaminate.WINDOW}) as n from items where len(w) > 0),
windows as (
  select distinct item_id, n, array_to_string(list_slice(w, p + 1, p + n), ' ') as g
  from (select item_id, w, n, unnest(range(0, len(w) - n + 1)) as p from sized)
), docs as (select doc_id, {_WORDS} as w from documents),
starts as (
  select doc_id, n, p, array_to_string(list_slice(w, p + 1, p + n), ' ') as g
  from (select doc_id, w, n, unnest(range(0, len(w) - n + 1)) as p from docs, (select distinct n from windows) where len(w) >= n)
), hits as (select distinct doc_id, item_id, s.n, p from starts s join windows using (n, g)),
words as (select doc_id, count(distinct i) as n_hit from (select doc_id, unnest(range(p, p + n)) as i from hits) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item_id from hits) group by doc_id
)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs d left join words h on d.doc_id = h.doc_id left join found f on d.doc_id = f.doc_id
""",
    "op11_hard_negatives": """
with rows as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.id as anchor_id, r.id, r.label = a.label as same, cast(list_dot_product(a.v, r.v) as bigint) as score
  from rows a join rows r on r.id <> a.id where a.id % 100 = 0
), positives as (
  select anchor_id, id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select anchor_id, positive_id, cast(row_number() over w as int) as rank, id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, id)
qualify row_number() over w <= 5
""",
}
