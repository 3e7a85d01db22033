"""A record store that is written once: batches of Parquet under their own digest, and a manifest that makes them visible.

A batch is first written whole, then its manifest; readers look at manifests only. So a write that fails leaves nothing
that anybody sees, the same batch again writes nothing, and a file that no manifest lists is never read. One writer at a
time: two at once could both write a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.functions.canonical import path_safe
from siltstone.operators.ordered import tree_digest
from siltstone.session import cut

MANIFEST = "file string, rows bigint, event_class string, producer_id string"
#: Files that one read may name; a store with more is compacted, or read by class and producer.
MOST_FILES = 1_000_000


def committed(spark: SparkSession, folder: str) -> bool:
    """Whether a write to ``folder`` ended well, by Spark's own file system, so any store will do."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, event_class, producer_id) of all visible files; empty for a store without any."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [str(s.getPath()) for s in files.listStatus(folder)] if files.exists(folder) else []
    visible = [f for f in found if committed(spark, f)]
    return spark.read.schema(MANIFEST).parquet(*visible) if visible else spark.createDataFrame([], MANIFEST)


def view(spark: SparkSession, path: str, schema, where: Column | str = "true") -> DataFrame:
    """The store's rows from the files whose manifest line meets ``where`` (of event_class and producer_id), by the
    declared schema: columns that a file lacks are null, others are left out. Other files aren't opened."""
    files = [r.file for r in manifest(spark, path).where(where).select("file").distinct().limit(MOST_FILES + 1).collect()]
    if len(files) > MOST_FILES:
        raise ValueError(f"more than {MOST_FILES} files")
    empty = spark.createDataFrame([], schema)
    return spark.read.schema(empty.schema).parquet(*files) if files else empty


def write_once(rows: DataFrame, path: str, key: str = "record_id") -> DataFrame:
    """(key, body_hash, status) of ``rows``, of which new records are written: written, unchanged (there with the same
    body), conflict (there, or earlier in this batch, with another), or refused (no key).

    Rows need event_class and producer_id, by which files are laid out. Of several bodies for a new key the one with the
    smallest hash is written; of repeated rows one is.
    """
    spark, inner = rows.sparkSession, sorted(c for c in rows.columns if c != key)
    batch = cut(rows.withColumn("body_hash", F.sha2(F.to_json(F.struct(*inner), {"ignoreNullFields": "false"}), 256)))
    stored = view(spark, path, f"{key} {rows.schema[key].dataType.simpleString()}, body_hash string").select(key, F.col("body_hash").alias("old"))
    least = batch.groupBy(key).agg(F.min("body_hash").alias("least"))  # combined before the shuffle
    judged = batch.join(stored, key, "left").join(least, key, "left")
    judged = judged.withColumn("again", F.row_number().over(Window.partitionBy(key, "body_hash").orderBy("body_hash")))
    there = F.coalesce("old", "least")
    status = F.when(F.col(key).isNull(), "refused").when(F.col("body_hash") != there, "conflict").when(F.col("old").isNotNull() | (F.col("again") > 1), "unchanged").otherwise("written")
    judged = cut(judged.withColumn("status", status))
    new = judged.where("status = 'written'").drop("old", "least", "again", "status")
    count, digest = tree_digest(new.select(F.concat_ws("\0", F.col(key).cast("string"), "body_hash").alias("row")), "row").first()
    if count and not committed(spark, f"{path}/manifest/batch={digest}"):
        data = f"{path}/data/batch={digest}"
        placed = new.withColumns({"p_class": path_safe(F.coalesce("event_class", F.lit(""))), "p_producer": path_safe(F.coalesce("producer_id", F.lit("")))})
        placed.write.mode("overwrite").partitionBy("p_class", "p_producer").parquet(data)
        listed = spark.read.schema(new.schema).option("recursiveFileLookup", "true").parquet(data).select(F.input_file_name().alias("file"), "event_class", "producer_id")
        listed.groupBy("file", "event_class", "producer_id").agg(F.count(F.lit(1)).alias("rows")).select("file", "rows", "event_class", "producer_id").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/batch={digest}")
    return judged.select(key, "body_hash", "status")
