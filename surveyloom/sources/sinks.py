"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom import lexicons
from surveyloom.functions.text import digest
from surveyloom.operators.firstwins import first_wins

__all__ = ["write_json", "write_csv", "unseen_rows", "append_unique"]


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, one file per task."""
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header; arrays become joined text and structs JSON, since CSV has no nesting."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), lexicons.OPTION_SEPARATOR)
        elif isinstance(field.dataType, (T.StructType, T.MapType)):
            column = F.to_json(column)
        columns.append(column.alias(field.name))
    writer = df.select(*columns).write.mode(mode).option("header", True).option("escape", '"')
    # By default the writer would cut blanks off the ends of the values.
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def unseen_rows(target: DataFrame, batch: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """First row per key of ``batch`` whose key is not in ``target``.

    The target's keys are first cut down to those that occur in the batch (Spark broadcasts the
    batch keys when they are small), so a large target is scanned but not shuffled.
    """
    fresh = first_wins(batch, [key], order).withColumn("_digest", digest(F.col(key)))
    known = (
        target.select(digest(F.col(key)).alias("_digest"))
        .join(fresh.select("_digest"), "_digest", "left_semi")
        .distinct()
    )
    return fresh.join(known, "_digest", "left_anti").drop("_digest")


def append_unique(target_path: str, batch: DataFrame, key: str, order: str = "seq") -> int:
    """Append the rows of ``batch`` with new keys to the Parquet table; return how many were added."""
    spark = batch.sparkSession
    target = spark.read.schema(batch.schema).parquet(target_path)
    seen = Observation()
    unseen_rows(target, batch, key, order).observe(seen, F.count(F.lit(1)).alias("added")).write.mode(
        "append"
    ).parquet(target_path)
    return seen.get["added"]
