"""Snapshots: rows, partition plan, digests, and checks that return what is wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.canonical import path_safe
from siltstone.operators.ordered import tree_digest
from siltstone.schemas import EXCLUDED_LIFECYCLE, LEARNING_COLUMNS


def snapshot_rows(records: DataFrame, observations: DataFrame, overlay: DataFrame | None = None) -> DataFrame:
    """Records that are in force, with their observations; a record without any has one row of nulls. The derived
    overlay of corrections wins over what a record has stored."""
    kept = records.where(~F.col("lifecycle_state").isin(*EXCLUDED_LIFECYCLE))
    if overlay is not None:
        derived = overlay.withColumnRenamed("superseded_by", "derived")
        kept = kept.join(derived, "record_id", "left").withColumn("superseded_by", F.coalesce("derived", "superseded_by")).drop("derived")
    return kept.join(observations, "record_id", "left")


def partition_plan(rows: DataFrame) -> DataFrame:
    """Records and rows per (event class, producer), with a directory name that two raw keys never share."""
    plan = rows.groupBy("event_class", "producer_id").agg(F.count_distinct("record_id").alias("record_count"), F.count(F.lit(1)).alias("row_count"))
    return plan.withColumn("directory", F.concat(F.lit("class="), path_safe(F.col("event_class")), F.lit("/producer="), path_safe(F.col("producer_id"))))


def collisions(rows: DataFrame, key: str, digest: str) -> DataFrame:
    """Identities that stand for more than one digest."""
    return rows.groupBy(key).agg(F.count_distinct(digest).alias("digests"), F.count(F.lit(1)).alias("rows")).where("digests > 1")


def snapshot_digest(rows: DataFrame, *columns: str) -> DataFrame:
    """One row: the number of rows and the digest of the given columns, by a hash tree that no order changes."""
    return tree_digest(rows.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("row")), "row")


def unsorted_rows(rows: DataFrame, partition: list[str], position: str, key: str) -> DataFrame:
    """Rows that stand after one with a greater key in their partition; empty if each is sorted."""
    before = F.lag(key).over(Window.partitionBy(*partition).orderBy(position))
    return rows.withColumn("before", before).where(F.col("before") > F.col(key)).drop("before")


def changed_hashes(manifest: DataFrame, actual: DataFrame) -> DataFrame:
    """(name, expected, actual) of members that are missing, unlisted or of another hash; empty if all agree."""
    both = manifest.select("name", F.col("hash").alias("expected")).join(actual.select("name", F.col("hash").alias("actual")), "name", "full_outer")
    return both.where(~F.col("expected").eqNullSafe(F.col("actual")))


def write_snapshot(rows: DataFrame, path: str) -> None:
    """Partitioned Parquet. Partition columns have names of their own, so directory names never replace data."""
    placed = rows.withColumn("p_event_class", path_safe(F.col("event_class"))).withColumn("p_producer", path_safe(F.col("producer_id")))
    order = ["record_id", *(c for c in LEARNING_COLUMNS if c in rows.columns)]
    placed.repartition("p_event_class", "p_producer").sortWithinPartitions("p_event_class", "p_producer", *order).write.option("compression", "zstd").partitionBy("p_event_class", "p_producer").parquet(path)


def read_snapshot(spark, path: str, schema) -> DataFrame:
    """The rows as they were written, with the declared schema; directory columns are not read."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def report_document(rows: DataFrame, snapshot_id: str, *order: str) -> DataFrame:
    """One row: a report as canonical JSON (rows in the given order, nulls kept) and its sha256. For reports, whose
    rows are groups, not for data."""
    named = rows.select(F.struct(*order).alias("o"), F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("j"))
    whole = named.agg(F.array_sort(F.collect_list(F.struct("o", "j"))).alias("rows"))
    text = F.concat(F.lit('{"rows":['), F.array_join(F.transform("rows", lambda r: r["j"]), ","), F.lit(f'],"source_snapshot_id":"{snapshot_id}"}}'))
    return whole.select(text.alias("document")).withColumn("report_hash", F.sha2("document", 256))
