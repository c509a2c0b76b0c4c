"""Reading JSON documents into tables.

A document that spans several lines cannot be split, so it is read by one task. Convert it once
(``convert_rows`` and a Parquet write) and query the table; everything downstream splits. With
``multi_line=False`` a file holds one document per line instead, and is split like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom import lexicons, schemas
from surveyloom.functions.options import decode_options
from surveyloom.sources.ids import ordered_index

__all__ = [
    "read_bank", "bank_questions", "bank_questionnaires", "bank_users", "read_responses",
    "read_question_list", "read_question_lines", "convert_rows", "seed_pages", "first_present",
]


def _path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def _place() -> Column:
    """Where a document stands: its file, the split of the file, and its position among the rows of that split."""
    return F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))


PLACE = "_place"


def _read_document(spark: SparkSession, path: str, schema: str, multi_line: bool) -> DataFrame:
    if not _path_exists(spark, path):
        place = "struct<file_path: string, file_block_start: bigint, row: bigint>"
        return spark.createDataFrame([], f"{schema}, {PLACE} {place}")
    rows = spark.read.option("multiLine", multi_line).schema(schema).json(path)
    return rows.select("*", _place().alias(PLACE))


def _numbered(elements: DataFrame) -> DataFrame:
    """Elements with ``seq``, their 0-based position over all documents and files."""
    return ordered_index(elements, [PLACE, "_pos"], "seq").drop(PLACE, "_pos")


def read_bank(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per bank document, with its collections as arrays, and its place among the documents.

    No row when the file is missing.
    """
    return _read_document(spark, path, schemas.BANK_DOCUMENT, multi_line)


def _collection(bank: DataFrame, name: str) -> DataFrame:
    elements = bank.select(PLACE, F.posexplode(name).alias("_pos", "_item"))
    return _numbered(elements).select("seq", "_item.*")


def bank_questions(bank: DataFrame) -> DataFrame:
    """All questions, with the polymorphic options decoded into a list or a scale."""
    listed, scale = decode_options(F.col("options_raw"))
    return (
        _collection(bank, "questions")
        .withColumnRenamed("options", "options_raw")
        .select(
            "id", "seq", "question_text", "question_type", "options_raw",
            listed.alias("options"), scale.alias("scale"),
            "difficulty", "category", "tags", "usage_count",
        )
    )


def bank_questionnaires(bank: DataFrame) -> DataFrame:
    return _collection(bank, "questionnaires")


def bank_users(bank: DataFrame) -> DataFrame:
    return _collection(bank, "users")


def read_responses(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return _collection(_read_document(spark, path, schemas.RESPONSE_DOCUMENT, multi_line), "responses")


def read_question_list(
    spark: SparkSession, path: str, fields: str = schemas.CRAWLED_QUESTION, multi_line: bool = True
) -> DataFrame:
    """Questions of a JSON array, or of an object that holds the array under ``fullContent``.

    Both are read with one schema: a row of a bare array has the fields at the top, a wrapping
    object has them inside ``fullContent``.
    """
    wrapped = f"{fields}, fullContent array<{schemas._struct(fields)}>"
    names = [f.strip().split(" ")[0] for f in schemas._split_top(fields)]
    rows = spark.read.option("multiLine", multi_line).schema(wrapped).json(path)
    # One row per document element; an element is either a question or the wrapper.
    items = F.coalesce("fullContent", F.array(F.struct(*names)))
    elements = rows.select(_place().alias(PLACE), F.posexplode(items).alias("_pos", "_item"))
    return _numbered(elements).select("seq", "_item.*")


def read_question_lines(
    spark: SparkSession, path: str, seq: str, fields: str = schemas.CRAWLED_QUESTION
) -> DataFrame:
    """Questions of splittable JSON lines that carry their own order column ``seq``."""
    return spark.read.schema(f"{seq} bigint, {fields}").json(path).withColumnRenamed(seq, "seq")


def convert_rows(rows: DataFrame, present: dict[str, Column] | None = None) -> DataFrame:
    """Bank rows from raw question rows.

    A default applies where the column is NULL, or, if ``present`` names a boolean column for a
    field, where that is false: so an explicit null can be told from a missing key.
    """
    present = present or {}

    def field(name: str, default: str | None) -> Column:
        if name not in rows.columns:
            return F.lit(default).cast("string")
        if name in present:
            return F.when(present[name], F.col(name)).otherwise(F.lit(default))
        return F.coalesce(F.col(name), F.lit(default)) if default is not None else F.col(name)

    category = field("category", lexicons.DEFAULT_CATEGORY)
    return rows.select(
        (F.col("seq") + 1).alias("id"),
        "seq",
        field("question_text", "").alias("question_text"),
        field("question_type", "text").alias("question_type"),
        field("options_text", None).alias("options"),
        F.lit(2.0).alias("difficulty"),
        category.alias("category"),
        F.array(category, field("language", "en")).alias("tags"),
        F.lit(0).cast("bigint").alias("usage_count"),
    )


def seed_pages(*sources: DataFrame) -> DataFrame:
    """All (seq, url, source_name) seed lists as one table; duplicates stay.

    ``list`` is the number of the list and ``seq`` the position in it, so (list, seq) orders all seeds.
    """
    parts = [s.select(F.lit(i).alias("list"), "seq", "url", "source_name") for i, s in enumerate(sources)]
    return reduce(DataFrame.unionByName, parts)


def first_present(*candidates: Column, default: str = "") -> Column:
    """First candidate that is not NULL, else ``default``."""
    return F.coalesce(*candidates, F.lit(default))
