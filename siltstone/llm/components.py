"""Connected components of a graph given as a table of links."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import cut, gathered


def checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, most_broadcast: int = 500_000) -> DataFrame:
    """(u, v) with v the smallest node that u reaches, for every node u that isn't its component's smallest.

    Alternates two star steps until nothing changes, which takes a number of rounds logarithmic in the
    length of the chains: every larger neighbour of a node is linked to the node's smallest neighbour, then
    every smaller one is. Minima are combined before the shuffle, and the joins that bring them back to the
    links can be split by Spark where a node has many. Up to ``most_broadcast`` links the minima are broadcast, as the steps never
    add links. Every step goes to as many tasks as the links need, not to all partitions of a shuffle.
    """
    links = cut(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before, now = None, checksum(links)
    few = F.broadcast if now[0] <= most_broadcast else lambda df: df
    narrow = functools.partial(gathered, rows=now[0])
    links = narrow(links)
    ends = lambda n, m: F.struct(F.col(n).alias("n"), F.col(m).alias("m"))
    while now != before:
        both = links.select(F.explode(F.array(ends("u", "v"), ends("v", "u"))).alias("e")).select("e.*")
        least = narrow(both.groupBy("n").agg(F.min("m").alias("least"))).select("n", F.least("n", "least").alias("least"))
        large = narrow(both.where("m > n").join(few(least), "n").select(F.col("m").alias("u"), F.col("least").alias("v")).distinct())
        # A node's smallest neighbour among the smaller ones, itself kept as a link.
        least = narrow(large.groupBy("u").agg(F.min("v").alias("least")))
        small = large.join(few(least), "u").where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        links = cut(narrow(small.unionByName(least.select("u", F.col("least").alias("v"))).distinct()))
        before, now = now, checksum(links)
    return links
