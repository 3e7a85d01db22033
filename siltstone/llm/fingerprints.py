"""Canonical exact digests of documents, on DataFrame and SQL functions alone.

A text is brought to a canonical form (compatibility normalisation, case folding, white space folded to
single spaces and trimmed); four 64-bit hashes of it, each from a seed of its own, make a digest of 256
bits. Documents are grouped by digest, and inside a bucket that holds several rows the canonical texts
themselves are compared, so that a collision can't merge two texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import col, cut, small_enough

#: One seed for each 64-bit part of the digest.
SEEDS = (11, 23, 47, 91)


def java(owner: str, method: str, text: Column, flag: bool) -> Column:
    return F.reflect(F.lit(owner), F.lit(method), text, F.lit(flag))


def canonical(text: Column) -> Column:
    """The canonical form; null counts as the empty text. ASCII texts take a shorter way to the same form."""
    text = F.coalesce(text, F.lit(""))
    normal, fold = ("com.ibm.icu.text.Normalizer", "compose"), ("com.ibm.icu.lang.UCharacter", "foldCase")
    wide = java(*normal, java(*fold, java(*normal, text, True), True), True)
    folded = F.when(text.rlike(r"[^\x00-\x7F]"), wide).otherwise(F.lower(text))
    return F.trim(F.regexp_replace(folded, r"(?U)\s+", " "))


def digest(canon: Column) -> Column:
    """64 lowercase hex digits for a canonical text."""
    return F.lower(F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(s), canon)), 16, "0") for s in SEEDS)))


def likeness(a: Column, b: Column) -> Column:
    """Of two exact digests: 1 if they are equal, else 0."""
    return F.when(a == b, 1.0).otherwise(0.0)


def copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", most_broadcast: int = 500_000) -> DataFrame:
    """One row per digest that several rows share: fingerprint, texts (distinct canonical texts under it),
    group_id (the smallest id, null before others only if all are null) and copies (rows).

    Only rows of shared digests are shuffled with their text, and equal texts of a task are combined before.
    Up to ``most_broadcast`` shared digests (64 bytes each) are broadcast to find those rows; beyond that
    the rows are joined with them by shuffle.
    """
    rows = df.select(col(doc_id).alias("doc_id"), canonical(col(text)).alias("canon")).withColumn("fingerprint", digest(F.col("canon")))
    shared = cut(rows.groupBy("fingerprint").count().where("count > 1").select("fingerprint"))
    shared = F.broadcast(shared) if small_enough(shared, most_broadcast) else shared.hint("shuffle_hash")
    same = rows.join(shared, "fingerprint", "left_semi").groupBy("fingerprint", "canon").agg(F.min("doc_id").alias("group_id"), F.count("*").alias("copies"))
    return same.groupBy("fingerprint").agg(F.count("*").alias("texts"), F.min("group_id").alias("group_id"), F.sum("copies").alias("copies"))


def fingerprint(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, fingerprint, group_id (the smallest id with the same canonical
    text) and copies (rows that have it).

    Null and empty texts, and texts of white space alone, are equal. Repeated rows are copies of each
    other; a null id counts as a copy but never as a group's smallest id while another is known; an empty
    table has no rows; further columns are not kept.
    """
    return with_groups(df.select(col(doc_id).alias("doc_id"), digest(canonical(col(text))).alias("fingerprint")), df, doc_id, text)


def with_groups(rows: DataFrame, df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``rows`` (with doc_id and fingerprint) and the group of each, as found in ``df``."""
    buckets = cut(copies(df, doc_id, text))
    alone = (F.coalesce("g.group_id", "doc_id").alias("group_id"), F.coalesce("g.copies", F.lit(1)).cast("long").alias("copies"))
    out = rows.join(buckets.where("texts = 1").alias("g"), "fingerprint", "left").select(*rows.columns, *alone)
    if buckets.where("texts > 1").isEmpty():
        return out
    # Different texts under one digest: their rows are told apart by the canonical text itself.
    split = buckets.where("texts > 1").select("fingerprint")
    apart = df.select(col(doc_id).alias("doc_id"), canonical(col(text)).alias("canon")).withColumn("fingerprint", digest(F.col("canon"))).join(split, "fingerprint", "left_semi")
    named = apart.groupBy("fingerprint", "canon").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    named = apart.join(named, ["fingerprint", "canon"]).select("fingerprint", "doc_id", "least", "n").distinct()
    return out.join(named, ["fingerprint", "doc_id"], "left").select(*rows.columns, F.coalesce("least", "group_id").alias("group_id"), F.coalesce("n", "copies").alias("copies"))


def with_next(df: DataFrame, key: str, values: list[str], rows_per_bucket: int = 64, most: int = 128) -> DataFrame:
    """``df`` with ``next_<v>`` for each of ``values``: its value in the next row by ``key`` (after the last: the first).

    Rows are dealt into ranges of the key that begin at keys which exist (quantiles, so even where keys
    are not); a range's first row is dealt to the range before it as well, so no task needs more than its
    range. At most ``most`` squared ranges, found by two short lists, are the size of the plan's literals.
    Rows of equal key are ordered by the values; a null key is before all others.
    """
    rank = F.coalesce(col(key), F.lit(-(2**63)))
    n, least = df.select(F.count("*"), F.min(rank)).first()
    if not n:
        return df.select("*", *(col(v).alias(f"next_{v}") for v in values))
    ranges = max(1, min(most * most, n // rows_per_bucket))
    wanted = [k / ranges for k in range(1, ranges)]
    found = df.select(F.percentile_approx(rank, wanted, 20_000)).first()[0] if wanted else []
    heads = sorted({least, *found})
    step = max(1, math.isqrt(len(heads)))
    outer = heads[::step]
    below = lambda values, x: F.size(F.filter(values, lambda v: v <= x))
    lists = F.array(*(F.array(*map(F.lit, heads[k : k + step])) for k in range(0, len(heads), step)))
    top, place, ghost, bucket = (f"__{x}" for x in ("top", "place", "ghost", "bucket"))
    dealt = df.withColumn(top, below(F.array(*map(F.lit, outer)), rank) - 1)
    inner = F.element_at(lists, F.col(top) + 1)
    dealt = dealt.withColumn(place, F.col(top) * step + below(inner, rank) - 1).withColumn(top, F.array_contains(inner, rank))
    before = F.struct(F.when(F.col(place) == 0, len(heads) - 1).otherwise(F.col(place) - 1).alias("b"), F.lit(True).alias("g"))
    own = F.struct(F.col(place).alias("b"), F.lit(False).alias("g"))
    dealt = dealt.withColumn(top, F.explode(F.when(F.col(top), F.array(own, before)).otherwise(F.array(own)))).withColumn(bucket, F.col(f"{top}.b")).withColumn(ghost, F.col(f"{top}.g"))
    order = Window.partitionBy(bucket).orderBy(F.col(ghost), rank, *(col(v) for v in values))
    out = dealt.select(*map(col, df.columns), ghost, *(F.lead(col(v)).over(order).alias(f"next_{v}") for v in values))
    return out.where(~F.col(ghost)).drop(ghost)


def edited(text: Column, following: Column) -> Column:
    """The text whose last floor(n/2) code points are replaced by the first as many of the following one (or all)."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(text, F.length(text) - half), F.left(following, half))
