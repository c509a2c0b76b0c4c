"""Dense positions and ids without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.session import stored

__all__ = ["ordered_index", "ranked_within", "next_ids"]

#: Rows of a range that one task sorts; more rows make more ranges.
RANGE_ROWS = 1_000_000
LOCAL_BITS = 33  # monotonically_increasing_id keeps the position inside a partition in the low 33 bits


def ordered_index(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """Add the 0-based position of each row in the order of ``order`` (a unique key).

    The rows are range-partitioned and sorted once, numbered inside each partition, and written
    to the shared folder. The sizes of the partitions (one number each) give the offsets. No task
    sees more than its own range, and no key can be hot because the order key is unique. There are as many
    ranges as the session has shuffle partitions, and more where a range would else grow with the table.
    """
    spark = df.sparkSession
    ranges = -(-df.count() // RANGE_ROWS)
    more = [ranges] if ranges > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    ranged = (
        df.repartitionByRange(*more, *order)
        .sortWithinPartitions(*order)
        .withColumn("_local", F.monotonically_increasing_id())
    )
    rows = stored(ranged, "ordered").withColumn("_part", F.shiftright("_local", LOCAL_BITS))
    sizes = sorted((r["_part"], r["n"]) for r in rows.groupBy("_part").agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for part, size in sizes:
        offsets.append((part, total))
        total += size
    starts = spark.createDataFrame(offsets, "_part bigint, _start bigint")
    within = F.col("_local").bitwiseAND((1 << LOCAL_BITS) - 1)
    # One row per partition, so the number of partitions bounds what is broadcast.
    return (
        rows.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + within)
        .drop("_part", "_local", "_start")
    )


def ranked_within(df: DataFrame, group: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Add the 1-based rank inside each group; a group of any size is spread over many tasks.

    Equal to ``row_number`` over the group, which would put a whole group into one task.
    """
    indexed = ordered_index(df, [*group, *order], "_idx")
    firsts = indexed.groupBy(*group).agg(F.min("_idx").alias("_first"))
    same = [F.col(f"r.{g}").eqNullSafe(F.col(f"f.{g}")) for g in group]
    return (
        indexed.alias("r")
        .join(firsts.alias("f"), same)
        .select(*[F.col(f"r.{c}") for c in df.columns], (F.col("_idx") - F.col("_first") + 1).alias(name))
    )


def next_ids(existing: DataFrame, new_rows: DataFrame, id_col: str = "id", order: str = "seq") -> DataFrame:
    """Give ``new_rows`` the ids that follow the highest id of ``existing`` (1 when that is empty)."""
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).scalar()
    plain = new_rows.drop(id_col) if id_col in new_rows.columns else new_rows
    return ordered_index(plain, [order], "_pos").withColumn(id_col, top + F.col("_pos") + 1).drop("_pos")
