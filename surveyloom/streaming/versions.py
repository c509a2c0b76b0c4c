"""A keyed table that a stream changes batch by batch, and that readers can use at any time.

Rows lie in buckets of a hash of their keys. A batch writes the buckets it touches anew, in a folder of its own, and
at last, as one file, which folder each bucket is in. Readers follow the last such file. Until it is there they see the
table as it was, so a batch that fails leaves the old rows readable, and its repetition writes the same folder again.
What neither the last nor the one before it names is removed, so the table's size follows its keys, not its batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 32
VERSIONS = "bucket int, version bigint, batch_id bigint"


def bucket_of(keys: list[str], buckets: int = BUCKETS) -> Column:
    """Bucket of a row; without keys there is one."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int") if keys else F.lit(0)


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _written(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that have said where the buckets are, in order."""
    system, where = _folder(spark, f"{path}/where")
    if not system.exists(where):
        return []
    names = [s.getPath() for s in system.listStatus(where)]
    done = [p for p in names if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in done)


def _versions(spark: SparkSession, path: str, batch_id: int) -> dict[int, int]:
    """The folder of each bucket, ``BUCKETS`` numbers at most."""
    rows = spark.read.schema("bucket int, version bigint").parquet(f"{path}/where/batch_id={batch_id}").collect()
    return {r.bucket: r.version for r in rows}


def _read(spark: SparkSession, path: str, schema: str, versions: dict[int, int]) -> DataFrame:
    folders = [f"{path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table after the last batch that was written as a whole."""
    written = _written(spark, path)
    return _read(spark, path, schema, _versions(spark, path, written[-1]) if written else {})


def apply_batch(batch: DataFrame, batch_id: int, path: str, schema: str, keys: list[str], merge: Callable[[DataFrame], DataFrame] | None) -> None:
    """Merge a batch into the table: ``merge`` gets old and new rows of the touched buckets. Without it a batch is the whole table."""
    spark = batch.sparkSession
    earlier = [n for n in _written(spark, path) if n < batch_id]
    before = _versions(spark, path, earlier[-1]) if earlier and merge else {}
    named = [c.split()[0] for c in schema.split(",")]
    rows = batch.select(*named)
    if merge is not None:
        touched = {r[0] for r in rows.select(bucket_of(keys).alias("bucket")).distinct().collect()}
        old = _read(spark, path, schema, {b: v for b, v in before.items() if b in touched})
        rows = merge(old.unionByName(rows))
    else:
        touched = {0}
    dealt = rows.withColumn("bucket", bucket_of(keys if merge else []))
    dealt.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/version={batch_id}")
    system, made = _folder(spark, f"{path}/data/version={batch_id}")
    full = {int(s.getPath().getName().split("=")[1]) for s in system.listStatus(made) if s.getPath().getName().startswith("bucket=")}
    after = {b: v for b, v in before.items() if b not in touched} | {b: batch_id for b in full}
    pointer = spark.createDataFrame(sorted(after.items()), "bucket int, version bigint")
    pointer.coalesce(1).write.mode("overwrite").parquet(f"{path}/where/batch_id={batch_id}")
    used = set(after.values()) | set(before.values())
    for kind, kept in (("data", {f"version={v}" for v in used}), ("where", {f"batch_id={n}" for n in [*earlier[-1:], batch_id]})):
        system, where = _folder(spark, f"{path}/{kind}")
        for status in system.listStatus(where):
            if status.getPath().getName() not in kept:
                system.delete(status.getPath(), True)
