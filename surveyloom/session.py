"""Session settings the library is tested with, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages are large: a batch for a Python task is cut by size, not only by its number of rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def local_session(cores: int = 8, memory: str = "8g", name: str = "surveyloom", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass your own session instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **SETTINGS,
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's checkpoint folder.

    Only a local session may go without; it gets a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
    if chosen.isDefined():
        return chosen.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="surveyloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return shared_folder(spark)


def stored(df: DataFrame, label: str, by: list[str] | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result is read several times and must be the same rows each time, also after
    executors were lost. Being Parquet, each reader loads only the columns it needs. ``by`` names columns that make
    folders, so that a filter on them reads only its own. ``compression``: of the files, if not the session's.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=by, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
