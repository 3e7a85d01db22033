"""Near-duplicate documents by SimHash and a self-join of binary tries.

A fingerprint's bits are the majorities of the bits of its shingles' hashes. Distinct fingerprints are joined
with themselves by walking pairs of trie nodes together, most significant bit first: equal bits keep a pair's
count of differing bits, different ones add one, and a pair is pruned as soon as the count exceeds the budget.

To spread the tries over a cluster the 64 bits are cut into one block more than the budget; two fingerprints
within the budget agree in one block at least, so the tries are dealt by block and value, and in a dealt trie
the walk goes straight through the agreed block. Groups that are too large for a task are dealt again by
blocks of their other bits, and at last by pairs of chunks, so that no link is lost. A task emits a spanning
forest of the links that it has found; components of the whole are found in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from siltstone.llm.common import col, cut, free_name, lean, partitions, small_enough
from siltstone.llm.components import components

SEED = 42
SHINGLE = 3
BUDGET = 3
FULL = 2**64 - 1


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def shingle_hashes(text: bytes, words: int = SHINGLE) -> np.ndarray:
    """Of a text in UTF-8: A-Z lower-cased, words cut at ASCII white space; a shorter text is one shingle."""
    w = text.lower().split()
    if not w:
        return np.zeros(0, "<u8")
    if len(w) < words:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[k:] for k in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in shingles], dtype="<u8")


def fingerprint(hashes: np.ndarray) -> int:
    """Majorities of the hashes' bits; without hashes 0."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def simhash(text: bytes, words: int = SHINGLE) -> int:
    """The fingerprint of a text's shingles; without words 0."""
    return fingerprint(shingle_hashes(text, words))


def with_simhash(df: DataFrame, text: str = "text", to: str = "simhash") -> DataFrame:
    """``df`` without ``text``, with its fingerprint as a signed long; null counts as the empty text."""
    kept = [c for c in df.columns if c not in (text, to)]
    rows = df.select(*map(col, kept), col(text).cast("binary").alias(free_name(df, "__raw")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signed(simhash(t)) if t else 0 for t in (x.as_py() for x in batch.column(len(kept)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], [*kept, to])

    return rows.mapInArrow(lean(run), StructType([*(f for f in df.schema.fields if f.name in kept), StructField(to, LongType())]))


def blocks_of(mask: int, parts: int) -> list[int]:
    """``mask`` with, in turn, each of ``parts`` blocks of its unset bits added."""
    unset = [b for b in range(63, -1, -1) if not mask >> b & 1]
    size, more = divmod(len(unset), parts)
    out, at = [], 0
    for k in range(parts):
        n = size + (k < more)
        if n:
            out.append(mask | sum(1 << b for b in unset[at : at + n]))
        at += n
    return out


class Forest:
    """Disjoint sets of indices, joined many at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def leaf_pairs(la, ha, lb, hb) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs of the ranges [la, ha) and [lb, hb); of equal ranges each pair once."""
    na, nb = ha - la, hb - lb
    n = na * nb
    which = np.repeat(np.arange(len(n)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i, j = la[which] + k // nb[which], lb[which] + k % nb[which]
    keep = (la[which] != lb[which]) | (i < j)
    return i[keep], j[keep]


def trie_links(values: np.ndarray, groups: list[tuple[int, int]], budget: int, most: int = 1 << 18, leaf: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of values (sorted within each group) that differ in at most ``budget`` bits, from walks of node pairs.

    Pairs of small nodes are compared leaf by leaf. At most about ``most`` node pairs, or twice ``most`` times
    ``leaf`` leaves, are looked at at once.
    """
    ones_before: dict[int, np.ndarray] = {}

    def ones(bit: int) -> np.ndarray:
        if bit not in ones_before:
            ones_before[bit] = np.concatenate([[0], np.cumsum((values >> np.uint64(bit) & np.uint64(1)).astype(np.int64))])
        return ones_before[bit]

    first = np.array(groups, np.int64).reshape(-1, 2)
    lo, hi = first[:, 0], first[:, 1]
    stack = [(63, lo, hi, lo, hi, np.zeros(len(lo), np.int64))]
    while stack:
        bit, la, ha, lb, hb, err = stack.pop()
        if len(la) > most:
            half = len(la) // 2
            stack += [(bit, *(x[half:] for x in (la, ha, lb, hb, err))), (bit, *(x[:half] for x in (la, ha, lb, hb, err)))]
            continue
        small = ((ha - la) * (hb - lb) <= leaf) if bit >= 0 else np.ones(len(la), bool)
        if small.any():
            sizes = (ha - la)[small] * (hb - lb)[small]
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // (most * 4))) + 1
            for part in np.split(np.flatnonzero(small), cuts):
                i, j = leaf_pairs(la[part], ha[part], lb[part], hb[part])
                near = np.bitwise_count(values[i] ^ values[j]) <= budget
                yield i[near], j[near]
        big = ~small
        if not big.any():
            continue
        la, ha, lb, hb, err = (x[big] for x in (la, ha, lb, hb, err))
        c = ones(bit)
        ma, mb = ha - (c[ha] - c[la]), hb - (c[hb] - c[lb])
        same = la == lb
        apart = ~same
        children = [(la, ma, lb, mb, err), (ma, ha, mb, hb, err), (la, ma, mb, hb, err + 1), (ma[apart], ha[apart], lb[apart], mb[apart], err[apart] + 1)]
        nodes = tuple(np.concatenate(x) for x in zip(*children, strict=True))
        alive = (nodes[0] < nodes[1]) & (nodes[2] < nodes[3]) & (nodes[4] <= budget)
        if alive.any():
            stack.append((bit - 1, *(x[alive] for x in nodes)))


def forest_links(rows: DataFrame, budget: int) -> DataFrame:
    """Spanning links (u, v) of each partition's groups; ``rows``: group (long, long), value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [[b.column(k).to_numpy(zero_copy_only=False) for k in range(3)] for b in batches if b.num_rows]
        if not found:
            return
        a, b, v = (np.concatenate(x) for x in zip(*found, strict=True))
        v = v.view(np.uint64)
        order = np.lexsort((v, b, a))
        a, b, v = a[order], b[order], v[order]
        edge = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(v)]])
        several = ends - starts > 1
        names, place = np.unique(v, return_inverse=True)
        forest = Forest(len(names))
        for i, j in trie_links(v, list(zip(starts[several].tolist(), ends[several].tolist(), strict=True)), budget):
            forest.join(place[i], place[j])
        child = np.flatnonzero(forest.root != np.arange(len(names)))
        yield pa.RecordBatch.from_arrays([pa.array(names[child].view(np.int64)), pa.array(names[forest.root[child]].view(np.int64))], ["u", "v"])

    return rows.mapInArrow(lean(run), "u long, v long")


def links(values: DataFrame, budget: int = BUDGET, least_hot: int = 1000) -> DataFrame:
    """Links (u, v) that connect all values (column simhash, distinct) within ``budget`` differing bits."""
    spark = values.sparkSession
    deal = partitions(spark)
    masks = blocks_of(0, budget + 1)
    rows = values.select(F.explode(F.array(*(F.lit(signed(m)) for m in masks))).alias("mask"), "simhash")
    done = None
    for depth in range(4):
        rows = rows.select("mask", F.col("mask").bitwiseAND(F.col("simhash")).alias("key"), "simhash")
        sizes = cut(rows.groupBy("mask", "key").count())
        limit = max(least_hot, (sizes.agg(F.sum("count")).first()[0] or 0) // (2 * deal))
        hot = sizes.where(F.col("count") > limit).drop("count")  # at most 2 * deal rows
        if hot.isEmpty():
            return finish(rows, done, budget, deal)
        hot = hot.withColumn("hot", F.lit(True))
        marked = rows.join(F.broadcast(hot), ["mask", "key"], "left")
        cold = marked.where("hot is null").select("mask", "key", "simhash")
        done = cold if done is None else done.unionByName(cold)
        if depth == 3:
            break
        finer = {signed(m): [signed(x) for x in blocks_of(m, budget + 1)] for m in masks}
        masks = [m for ms in finer.values() for m in (x % 2**64 for x in ms)]
        table = F.create_map(*(x for m, ms in finer.items() for x in (F.lit(m), F.array(*map(F.lit, ms)))))
        children = F.element_at(table, F.col("mask"))
        rows = marked.where("hot").select(F.explode(children).alias("mask"), "simhash")
    # What is still too large: every pair of chunks of the group is a task of its own.
    chunks = F.greatest(F.lit(2), F.ceil(F.col("count") / limit)).cast("int")
    big = sizes.where(F.col("count") > limit).select("mask", "key", chunks.alias("chunks"))
    own = F.pmod(F.xxhash64("simhash"), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.least(o, own) * F.col("chunks") + F.greatest(o, own))
    paired = rows.join(F.broadcast(big), ["mask", "key"]).select("mask", "key", F.explode(pairs).alias("pair"), "simhash")
    return finish(paired.select(F.xxhash64("mask", "pair").alias("mask"), "key", "simhash"), done, budget, deal)


def finish(rows: DataFrame, done: DataFrame | None, budget: int, deal: int) -> DataFrame:
    rows = rows if done is None else done.unionByName(rows)
    return forest_links(rows.repartition(deal, "mask", "key"), budget)


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """One row per row of ``df``: doc_id, simhash (signed long), component_id (the smallest id reachable over
    links of at most ``budget`` differing bits, the row itself included).

    Equal texts have equal fingerprints and so one component; null and empty texts have fingerprint 0 and are
    linked like all others. A null id is no component's id unless all its ids are null. Repeated rows give
    repeated rows; further columns are not kept; an empty table gives none.
    """
    prints = cut(with_simhash(df.select(col(doc_id).alias("doc_id"), col(text).alias("text"))))
    nodes = cut(prints.groupBy("simhash").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes.select("simhash"), budget)).withColumnsRenamed({"u": "simhash", "v": "root"})
    named = nodes.join(roots, "simhash", "left").select("simhash", F.coalesce("root", "simhash").alias("root"), "least")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("simhash", "component_id")
    return prints.join(named, "simhash").select("doc_id", "simhash", "component_id")


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = BUDGET, most_broadcast: int = 1_000_000) -> DataFrame:
    """The rows of ``df`` that represent their group of near duplicates: the one with the smallest id.

    Of repeated rows with a representative's id one stays. Rows with a null id stay. All columns are kept.
    """
    return representatives(df, near_duplicates(df, doc_id, text, budget), doc_id, most_broadcast)


def representatives(df: DataFrame, found: DataFrame, doc_id: str, most_broadcast: int) -> DataFrame:
    """The rows of ``df`` whose id is their component's; ``found``: doc_id, component_id of each row."""
    found = cut(found)
    gone = found.where("doc_id != component_id").select("doc_id").distinct()
    twice = found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    key = free_name(df, "__id")
    gone, twice = (cut(x.withColumnRenamed("doc_id", key)) for x in (gone, twice))
    kept = df.join(F.broadcast(gone) if small_enough(gone, most_broadcast) else gone, col(doc_id) == F.col(key), "left_anti")
    if twice.isEmpty():
        return kept
    twice = F.broadcast(twice) if small_enough(twice, most_broadcast) else twice
    again = kept.join(twice, col(doc_id) == F.col(key), "left_semi").dropDuplicates([doc_id])
    return kept.join(twice, col(doc_id) == F.col(key), "left_anti").unionByName(again)
