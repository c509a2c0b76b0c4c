"""Reading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

__all__ = ["read_table"]


def read_table(spark: SparkSession, path: str, heavy: bool = False) -> DataFrame:
    """A Parquet table. ``heavy``: much work per row (text rules, HTML) will follow.

    A table in a few row groups is read by as many tasks, however many cores there are. For heavy
    work its rows are then spread over all cores first. A large table has more splits than the
    cluster has cores and is left as it is, so no shuffle is added there.
    """
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if heavy and table.rdd.getNumPartitions() < cores:
        return table.repartition(cores)
    return table
