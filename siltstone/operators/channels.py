"""Channel indexes: what each channel offers, as versions of a bucketed table; a commit copies the buckets that it changes.

A version is a small file that names the folder of every bucket. It is written aside and renamed, which a file system
such as HDFS refuses if the name is there: of two writers from one version one wins, and the other is told so. Readers see
whole versions only; a lost writer leaves folders that no version names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.canonical import identity
from siltstone.operators.ordered import numbered
from siltstone.operators.store import write_once
from siltstone.session import cut

ENTRY = "channel string, archive_hash string, pack_version string, sequence bigint, previous_version string"
PUBLICATION = ("channel", "sequence", "archive_hash", "pack_version")


def file_system(spark: SparkSession, path: str):
    """Spark's own file system for a path, and the path in its terms."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def head(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[str, str]]:
    """The latest version (or the given one) and the folder of each bucket; version 0 has none."""
    files, folder = file_system(spark, f"{path}/versions")
    names = sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []
    there = [int(n) for n in names if n.isdigit() and (version is None or int(n) <= version)]
    if not there or version == 0:
        return 0, {}
    return there[-1], json.loads(spark.read.text(f"{path}/versions/{there[-1]:012d}").first()[0])


def commit(spark: SparkSession, path: str, version: int, places: dict[str, str]) -> bool:
    """Make a version visible; False if there is one of that number."""
    files, aside = file_system(spark, f"{path}/aside/{uuid.uuid4().hex}")
    _, target = file_system(spark, f"{path}/versions/{version:012d}")
    files.mkdirs(target.getParent())
    out = files.create(aside, False)
    out.write(bytearray(json.dumps(places, sort_keys=True).encode()))
    out.close()
    return not files.exists(target) and files.rename(aside, target)


def buckets_of(spark: SparkSession, places: dict[str, str], wanted: set[str] | None = None) -> DataFrame:
    folders = [f for b, f in places.items() if wanted is None or b in wanted]
    return spark.read.schema(ENTRY).parquet(*folders) if folders else spark.createDataFrame([], ENTRY)


def entries(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version's entries: per channel and archive the last publication, the version that was active before it, and
    whether it is the channel's active one."""
    rows = buckets_of(spark, head(spark, path, version)[1])
    active = rows.groupBy("channel").agg(F.max("sequence").alias("active"))
    return rows.join(active, "channel").withColumn("is_active", F.col("sequence") == F.col("active")).drop("active")


def publish(publications: DataFrame, path: str, expected: int, buckets: int = 64) -> DataFrame:
    """(channel, sequence, archive_hash, pack_version, status) of each different publication, of which new ones become
    visible together as version ``expected`` + 1.

    published; unchanged (the channel's entry for the archive is this one); late (not after the channel's active one);
    refused (no channel, sequence or archive, or another archive at the same place, of which the smallest is taken);
    conflict, all of them, if the index isn't at ``expected`` any more: read it again and publish anew. Nothing new makes no
    version. ``buckets`` must stay what it was when the index was begun; what a commit copies is about as many of them
    as channels are named.
    """
    spark = publications.sparkSession
    bucket = F.pmod(F.xxhash64("channel"), F.lit(buckets)).cast("string")
    batch = cut(publications.select(*PUBLICATION).distinct().withColumn("bucket", bucket))
    lost = batch.select(*PUBLICATION, F.lit("conflict").alias("status"))
    version, places = head(spark, path)
    if version != expected:
        return lost
    touched = {r.bucket for r in batch.where("channel is not null").select("bucket").distinct().collect()}  # at most ``buckets``
    old = buckets_of(spark, places, touched)
    top = old.groupBy("channel").agg(F.max_by(F.struct("sequence", "pack_version"), "sequence").alias("top"))
    same = old.select("channel", "archive_hash", F.col("sequence").alias("stored"))
    least = batch.groupBy("channel", "sequence").agg(F.min(F.struct("archive_hash", "pack_version")).alias("least"))
    judged = batch.join(least, ["channel", "sequence"], "left").join(top, "channel", "left").join(same, ["channel", "archive_hash"], "left")
    c = F.col
    lacking = c("channel").isNull() | c("sequence").isNull() | c("archive_hash").isNull()
    status = (
        F.when(lacking, "refused")
        .when(c("stored") == c("sequence"), "unchanged")
        .when(c("sequence") <= c("top.sequence"), "late")
        .when(~F.struct("archive_hash", "pack_version").eqNullSafe(c("least")), "refused")
        .otherwise("published")
    )
    judged = cut(judged.select(*PUBLICATION, "bucket", status.alias("status"), c("top.pack_version").alias("active_version")))
    new = judged.where("status = 'published'")
    if new.isEmpty():
        return judged.select(*PUBLICATION, "status")
    # The version before is that of the place before in one order over all channels, so a hot channel is not one task.
    placed = cut(numbered(new.select(*PUBLICATION, "active_version", "bucket").withColumnRenamed("sequence", "at"), ["channel", "at"]))
    before = placed.select(c("channel"), (c("sequence") + 1).alias("sequence"), c("pack_version").alias("before"), F.lit(True).alias("follows"))
    placed = placed.join(before, ["channel", "sequence"], "left").withColumn("previous_version", F.when(c("follows"), c("before")).otherwise(c("active_version")))
    placed = placed.drop("sequence").withColumnRenamed("at", "sequence")
    value = ("pack_version", "sequence", "previous_version")
    both = old.unionByName(placed.select(*old.columns)).groupBy("channel", "archive_hash").agg(F.max_by(F.struct(*value), "sequence").alias("x"))
    folder = f"{path}/data/{uuid.uuid4().hex}"
    both.select("channel", "archive_hash", "x.*", bucket.alias("bucket")).write.partitionBy("bucket").parquet(folder)
    won = commit(spark, path, version + 1, places | {b: f"{folder}/bucket={b}" for b in touched & written_buckets(spark, folder)})
    return judged.select(*PUBLICATION, "status") if won else lost


def written_buckets(spark: SparkSession, folder: str) -> set[str]:
    files, found = file_system(spark, folder)
    return {s.getPath().getName().removeprefix("bucket=") for s in files.listStatus(found) if s.isDirectory()}


RETIREMENT = ("pack_id", "pack_version", "pack_sha256", "reason", "replacement_version", "retired_at", "issuer")


def retirement_id() -> Column:
    return identity("retire_", {c: F.col(c) for c in RETIREMENT})


def retire(rows: DataFrame, path: str) -> DataFrame:
    """(retirement_id, status) of retirements, of which new ones are added to the ledger at ``path``: written, unchanged
    (there already, or repeated here), or refused (no reason or no issuer but white space)."""
    stated = (F.trim("reason") != "") & (F.trim("issuer") != "")
    named = rows.select(*RETIREMENT).withColumn("retirement_id", F.when(stated, retirement_id()))
    named = named.withColumns({"event_class": F.lit("retirement"), "producer_id": F.coalesce("pack_id", F.lit(""))})
    return write_once(named, path, "retirement_id").select("retirement_id", "status")


def in_force(offered: DataFrame, retired: DataFrame) -> DataFrame:
    """Active entries, each with whether its archive is retired and by which version it is to be replaced (of several
    retirements the last)."""
    last = retired.groupBy(F.col("pack_sha256").alias("archive_hash")).agg(F.max_by("replacement_version", F.struct("retired_at", "replacement_version")).alias("replacement_version"), F.lit(True).alias("gone"))
    return offered.where("is_active").join(last, "archive_hash", "left").withColumn("retired", F.coalesce("gone", F.lit(False))).drop("gone", "is_active")
