"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``. Only a session on this one machine that
    names none (as in tests) gets a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="siltstone-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder that driver and executors share."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def rewritten(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of a few numbers that one task takes.
ROWS_A_TASK = 50_000


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df``, at most ``rows`` rows of a few numbers, in as many tasks as they need (one per core at least) instead of
    all partitions of a shuffle; larger tables stay as they are."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK)))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` doesn't have yet (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def col(name: str):
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` (already materialised) has at most ``max_rows`` rows; reads no more than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for mapInArrow; when a task ends, the worker gives the memory it has freed back to the machine, as it
    stays alive for other tasks beside the JVM."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return whole


def texts_of(column: pa.Array) -> Iterator[str]:
    """The texts of a column one by one, null as the empty text."""
    for x in column:
        yield x.as_py() or ""
