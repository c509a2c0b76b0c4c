"""From raw questions to a hierarchy in one go, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveyloom import lexicons
from surveyloom.functions.predicates import not_empty
from surveyloom.operators import clusters, hierarchy
from surveyloom.operators.edits import ingest_raw
from surveyloom.plans.cleaning import clean_questions
from surveyloom.session import stored
from surveyloom.sources import convert_rows, next_ids, read_question_list, unseen_rows


def upload_questions(spark: SparkSession, path: str, bank_path: str) -> int:
    """Add the questions of a JSON list to the Parquet bank; return how many were new.

    A text that is in the bank already, or stood earlier in the list, is left out; the others get
    the next ids.
    """
    rows = convert_rows(read_question_list(spark, path))
    bank = spark.read.schema(rows.schema).parquet(bank_path)
    fresh = next_ids(bank, unseen_rows(bank, rows.drop("id"), "question_text")).select(*rows.columns)
    seen = Observation()
    fresh.observe(seen, F.count(F.lit(1)).alias("added")).write.mode("append").parquet(bank_path)
    return seen.get["added"]


def full_workflow(raw: DataFrame, known: DataFrame, k: int = 6, lang: str = "en", seed: int = 7) -> dict[str, DataFrame]:
    """Ingest, clean, cluster and arrange. ``raw`` has seq, text, options, source_platform,
    original_category; ``known`` the texts already in the bank."""
    ingest = ingest_raw(raw, known, not_empty(F.col("text")))
    # Three passes need the terms of a text; they are cut and coded once, with the cleaning.
    codes = clusters.term_codes(F.col("text"), lexicons.default_stop_words("en"))
    coded = stored(clean_questions(ingest.accepted, lang).withColumn("_codes", codes), "processed")
    processed = coded.drop("_codes")
    model = clusters.fit_clusters(coded, "text", k, seed, codes="_codes")
    assigned = stored(clusters.assign_clusters(model, coded, codes="_codes").drop("_codes"), "assigned")
    tree = hierarchy.build_hierarchy(assigned.select("question_id", "cluster_id", "complexity", "category"))
    return {
        "ingest": ingest.summary,
        "rejected": ingest.rejected,
        "processed": processed,
        "assigned": assigned,
        "clusters": clusters.cluster_report(assigned),
        "tree": tree,
        "summary": hierarchy.hierarchy_summary(tree),
    }
