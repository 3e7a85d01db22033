"""A global order without a global sort in one task: dense numbers, and digests that no arrival order changes."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import cut

IN_PART = 33  #: Bits of a row's place in its partition, in Spark's increasing ids.


def numbered(rows: DataFrame, order: list[str], start: int = 0) -> DataFrame:
    """``rows`` with a dense ``sequence`` from ``start`` + 1 in the given order (nulls first), ties by a hash of the row; an
    order over all columns has no ties but between equal rows.

    Ranges of all order columns and the hash are sorted by themselves, so one hot value is split; each is shifted by the
    sizes of those before it, a number per partition. Rows are written once, so that a lost task finds the same places.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = set(order) == set(rows.columns)
    keys = order if whole else [*order, "__tie"]
    placed = rows if whole else rows.withColumn("__tie", F.xxhash64(*rows.columns))
    placed = placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = cut(placed.withColumn("__at", F.monotonically_increasing_id())).withColumn("__part", F.shiftright("__at", IN_PART))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))  # a row per partition
    shifts = F.broadcast(sizes.select("__part", (F.coalesce(before, F.lit(0)) + start + 1).alias("__shift")))
    return placed.join(shifts, "__part").withColumn("sequence", F.col("__at").bitwiseAND(2**IN_PART - 1) + F.col("__shift")).drop("__tie", "__at", "__part", "__shift")


def leaf(text) -> Column:
    """A text's SHA-256 as 32 bytes, which sort as its digits do and are half as long where rows are moved."""
    return F.unhex(F.sha2(text, 256))


def node(below: Column) -> Column:
    """The hash, as bytes, of the digits of the hashes ``h`` of an array, in its order."""
    return leaf(F.array_join(F.transform(F.array_sort(below), lambda x: digits(x["h"])), ""))


def digits(h: Column | str) -> Column:
    return F.lower(F.hex(h))


def tree_digest(rows: DataFrame, column: str, fan_out: int = 4096) -> DataFrame:
    """(row_count, digest) of the texts in a column, repeats included, whatever their order or partitioning.

    Hashes in their order are the leaves of a tree whose every node hashes up to ``fan_out`` below it, so no group is
    larger; levels grow with the logarithm of the rows. No rows have the digest of the empty text.
    """
    level = numbered(rows.select(leaf(column).alias("h")), ["h"])
    count = left = level.count()
    if not count:
        return rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("row_count"), F.sha2(F.lit(""), 256).alias("digest"))
    while True:
        level = level.groupBy(F.floor((F.col("sequence") - 1) / fan_out).alias("group")).agg(node(F.collect_list(F.struct("sequence", "h"))).alias("h"))
        level, left = level.select((F.col("group") + 1).alias("sequence"), "h"), -(-left // fan_out)
        if left == 1:
            return level.select(F.lit(count).cast("long").alias("row_count"), digits("h").alias("digest"))


def grouped_digest(rows: DataFrame, by: list[str], column: str, fan_out: int = 4096) -> DataFrame:
    """(``by``, row_count, digest): ``tree_digest`` of every group. Null is a group like others, a null text an empty one.

    Hashes are numbered over all groups at once and then from each group's first, so neither many small groups nor one
    huge group is a single task; levels grow with the logarithm of the largest group.
    """
    level = numbered(rows.select(*by, leaf(F.coalesce(column, F.lit(""))).alias("h")), [*by, "h"])
    sizes = level.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), F.min("sequence").alias("first"))
    sizes = cut(sizes.select(*(F.col(b).alias(f"__{b}") for b in by), "row_count", "first"))
    same = reduce(and_, (F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by))
    level = level.join(sizes, same).select(*by, "row_count", (F.col("sequence") - F.col("first")).alias("place"), "h")
    left, reach = sizes.agg(F.max("row_count")).first()[0] or 1, 1
    while True:
        above = node(F.collect_list(F.struct("place", "h")))
        if reach > 1:  # a group that has its root already keeps it, however large others are
            above = F.when(F.col("row_count") <= reach, F.min("h")).otherwise(above)
        level = level.groupBy(*by, "row_count", F.floor(F.col("place") / fan_out).alias("above")).agg(above.alias("h"))
        level, left, reach = level.withColumnRenamed("above", "place"), -(-left // fan_out), reach * fan_out
        if left == 1:
            return level.select(*by, "row_count", digits("h").alias("digest"))
