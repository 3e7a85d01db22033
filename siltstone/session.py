"""Session factory with the settings the engine expects."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that results or plans depend on: UTC everywhere, runtime re-planning with skew handling.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(master: str | None = None, partitions: int | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; ``master`` and ``partitions`` (of shuffles) only where the caller wants to choose them."""
    builder = SparkSession.builder.appName("siltstone")
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a session on this one machine that names
    none gets a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="siltstone-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so that later steps don't repeat it and survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many tasks as there are cores, where it comes in fewer (a small table in one file); else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet below the shared folder, read again. For loops of joins: a checkpoint keeps the optimizer's guess of
    a result's size, which each join multiplies; a file has the size that it has. Most of what is written is names and hashes, which Zstandard halves."""
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
