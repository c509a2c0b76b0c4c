"""A corpus pipeline of five stages over the documents, each written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import decontaminate, line_spread, ngram_join, pfair, queries, toxicity
from surveyloom.session import stored


def _same_columns(result: DataFrame, docs: DataFrame) -> DataFrame:
    return result.select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.toxicity(docs, labels, queries.CATEGORIES)
    toxic = list(queries.CATEGORIES).index("toxic")
    return _same_columns(scored.where(F.col("probabilities")[toxic] < queries.TOXIC), docs)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on many sites; n_chars follows the text."""
    cut = line_spread.remove_widespread(docs)
    return _same_columns(cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)), docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return _same_columns(ngram_join.drop_near_copies(docs, words=5, num=4, den=5), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return _same_columns(decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every document in the mix of the sources."""
    return pfair.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_lines),
    ("ngram_jaccard_join", drop_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The first stage has a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
