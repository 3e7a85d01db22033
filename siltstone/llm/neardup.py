"""Near-duplicate documents by five-word shingles of which 0.8 or more agree (Jaccard), without a pair lost.

Fingerprints that differ in few bits are linked by the tries of ``simhash`` and each link is checked by its shingles;
what that joins needs no more pairs among itself. The other pairs are found by their rarest shingles: of two sets
that agree to a share s, the first n - ceil(s n) + 1 of each in any common order share one. The order puts shingles
of many documents last, so that a line that many share pairs none of them. Parities of the shingles by 1024 remainders
differ in no more places than the sets do, which tells most other pairs; each pair left is checked exactly.

A large group of near copies shares its first shingles, and all its pairs would be many. So while pairs of documents
that aren't joined yet are many times the rows, each document is only checked against a few others of each of its
shingles, by another random order in each round; what agrees is joined, and pairs within what is joined are never made.
What is left after that is checked pair by pair, so that no link is lost.

Sets of shingles are larger than the texts, so they are never written: steps hash the texts again, and only those that
they need. What is shuffled of shingles is packed: 48 bits of the hashes, sorted, as differences. A chance agreement
of 48 bits only adds a pair to check, and in a check is one shingle in n * m / 2**48 of two sets of n and m.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from siltstone.llm import simhash
from siltstone.llm.common import col, cut, gathered, lean, partitions, small_enough
from siltstone.llm.components import components

WORDS = 5
SHARE = 0.8
#: A shingle of more documents than that is put last in the order; of so many at most, the most frequent.
FREQUENT = 32
MOST_FREQUENT = 200_000
#: Rounds against HUBS others, while pairs are more than MANY times the rows.
ROUNDS, HUBS, MANY = 1, 8, 4
PARITIES = 1024
CLOSE = 1e-9
#: Texts whose shingles are in a worker's memory at once.
AT_ONCE = 64
#: About how many shingles a task packs at once.
FLUSH = 1 << 18
#: Packed rows unfold to several times their size in a task, so they go to so many times the usual partitions.
PARTS = 2


def parities(grams: np.ndarray) -> np.ndarray:
    """Whether an odd number of ``grams`` has each remainder modulo PARITIES, a bit each."""
    found = np.bincount((grams % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES)
    return np.packbits((found & 1).astype(bool)).view(np.int64)


def hashed(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches, with the hashes of the shingles of each text in the column ``text``."""
    for batch in batches:
        for k in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(k, AT_ONCE)
            yield part, [simhash.shingle_hashes(t.as_py() or b"", WORDS) for t in part.column(text)]


def distinct(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """The node and the set of a text's shingles, ascending."""
    grams = np.unique(hashes)
    return simhash.signed(xxhash.xxh64_intdigest(grams.tobytes())), grams


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0, their bytes of equal weight together, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.decompress(raw, n * 8, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=np.uint64(0))


def sets(df: DataFrame) -> DataFrame:
    """doc_id, node (of equal shingle sets), simhash, odd (parities) of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, hashes in hashed(batches, 1):
            node, grams = zip(*map(distinct, hashes), strict=True)
            odd = [parities(g) for g in grams]
            prints = [simhash.signed(simhash.fingerprint(h)) for h in hashes]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(node, pa.int64()), pa.array(prints, pa.int64()), pa.array(odd, pa.list_(pa.int64()))], ["doc_id", "node", "simhash", "odd"])

    kind = StructType([df.schema["doc_id"], StructField("node", LongType()), StructField("simhash", LongType()), StructField("odd", ArrayType(LongType()))])
    return df.select("doc_id", F.col("text").cast("binary")).mapInArrow(lean(run), kind)


def least_shared(n: int, share: float) -> int:
    """How many of ``n`` shingles a set must share at least with one that agrees to ``share``."""
    return int(np.ceil(share * n - CLOSE))


def part_of(grams: np.ndarray, parts: int) -> np.ndarray:
    """The part that a shingle is dealt to, by the highest of its 48 bits; ascending shingles have ascending parts."""
    return ((grams >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def runs(key: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each run of equal entries begins and ends."""
    edge = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]) if len(key) else []
    yield from zip(edge[:-1], edge[1:], strict=True)


def frequent(df: DataFrame, share: float) -> np.ndarray:
    """Shingles (48 bits) that many documents have among the first ones by hash, ascending."""
    parts = PARTS * partitions(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            grams, c = np.unique(np.concatenate(held), return_counts=True)
            at = part_of(grams, parts)
            rows = [(at[i], j - i, packed(steps(grams[i:j])), packed(c[i:j])) for i, j in runs(at)]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["part", "n", "gram", "c"])

        for _, hashes in hashed(batches, 0):
            for _, g in map(distinct, hashes):
                held.append(g[: int(1.5 * (len(g) - least_shared(len(g), share))) + 1] >> np.uint64(16))
                n += len(held[-1])
            if n > FLUSH:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(unpacked(g.as_py(), n), unpacked(c.as_py(), n)) for b in batches for n, g, c in zip(b.column(1).to_pylist(), b.column(2), b.column(3), strict=True)]
        if not found:
            return
        grams, c = (np.concatenate(x) for x in zip(*((np.cumsum(g, dtype=np.uint64), c) for g, c in found), strict=True))
        order = np.argsort(grams)
        grams, c = grams[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        grams, c = grams[first], np.add.reduceat(c, first)
        many = c > FREQUENT
        yield pa.RecordBatch.from_arrays([pa.array(x[many].astype(np.int64)) for x in (grams, c)], ["gram", "count"])

    counts = df.select(F.col("text").cast("binary")).mapInArrow(lean(count), "part int, n int, gram binary, c binary")
    counts = counts.repartition(parts, "part").mapInArrow(lean(total), "gram long, count long")
    top = counts.orderBy(F.desc("count"), "gram").limit(MOST_FREQUENT).select("gram").toPandas()
    return np.sort(top["gram"].to_numpy(np.uint64))


def with_partner(gram: np.ndarray, size: np.ndarray, place: np.ndarray, share: float) -> np.ndarray:
    """Which rows have a row of the same shingle (sorted by it) that they may agree with by size and place; all of
    a shingle with more than 2 * FREQUENT rows."""
    keep = np.zeros(len(gram), bool)
    for i, j in ((i, j) for i, j in runs(gram) if j - i > 2 * FREQUENT):
        keep[i:j] = True
    for d in range(1, 2 * FREQUENT):
        i = np.flatnonzero(gram[d:] == gram[:-d])
        if not len(i):
            break
        rest = np.minimum(size[i] - place[i], size[i + d] - place[i + d])
        i = i[rest * (1 + share) >= share * (size[i] + size[i + d]) - CLOSE]
        keep[i] = keep[i + d] = True
    return keep


def shared(df: DataFrame, last: np.ndarray, share: float) -> DataFrame:
    """(gram, node, size, place) of the first shingles of each text that several nodes may have, ``last`` ones ordered
    last, each (gram, node) once.

    Tasks pack the rows for the part of each shingle, where those that one node alone has leave. Rows of ``last``
    shingles, of which one may be in any number of texts, are dealt by shingle and node and all stay.
    """
    parts = PARTS * partitions(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(last)
    columns = ("gram", "node", "size", "place")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            gram, node, size, place, hot = (np.concatenate(x) for x in zip(*held, strict=True))
            at = np.where(hot, (((gram ^ node) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % parts, part_of(gram, parts)) * 2 + hot
            order = np.lexsort((gram, at))
            gram, node, size, place, at = (x[order] for x in (gram, node, size, place, at))
            rows = [(at[i] >> 1, bool(at[i] & 1), j - i, packed(steps(gram[i:j])), *(packed(x[i:j]) for x in (node, size, place))) for i, j in runs(at)]
            kinds = (pa.int32(), pa.bool_(), pa.int32(), *[pa.binary()] * 4)
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "hot", "n", *columns])

        for _, hashes in hashed(batches, 0):
            for node, g in map(distinct, hashes):
                if not len(g):
                    continue
                size, g = len(g), g >> np.uint64(16)
                late = np.zeros(size, bool)
                if len(sent.value):
                    late = sent.value[np.minimum(np.searchsorted(sent.value, g), len(sent.value) - 1)] == g
                    order = np.argsort(late, kind="stable")
                    g, late = g[order], late[order]
                k = size - least_shared(size, share) + 1
                held.append((g[:k], np.full(k, node).view(np.uint64), np.full(k, size), np.arange(k), late[:k]))
                n += k
            if n > FLUSH:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {True: [], False: []}
        for b in batches:
            for hot, n, *raw in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), *b.columns[3:], strict=True):
                gram, *rest = (unpacked(x.as_py(), n) for x in raw)
                found[hot].append((np.cumsum(gram, dtype=np.uint64), *rest))
        for hot, rows in found.items():
            if not rows:
                continue
            gram, node, size, place = (np.concatenate(x) for x in zip(*rows, strict=True))
            order = np.lexsort((place, node, gram))
            gram, node, size, place = (x[order].view(np.int64) for x in (gram, node, size, place))
            once = np.concatenate([[True], (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])])
            gram, node, size, place = (x[once] for x in (gram, node, size, place))
            keep = np.ones(len(gram), bool) if hot else with_partner(gram, size, place, share)
            for k in range(0, len(at := np.flatnonzero(keep)), FLUSH):
                i = at[k : k + FLUSH]
                yield pa.RecordBatch.from_arrays([pa.array(gram[i]), pa.array(node[i]), pa.array(size[i].astype(np.int32)), pa.array(place[i].astype(np.int32))], columns)

    dealt = df.select(F.col("text").cast("binary")).mapInArrow(lean(deal), "part int, hot boolean, n int, gram binary, node binary, size binary, place binary")
    return cut(dealt.repartition(parts, "part").mapInArrow(lean(meet), "gram long, node long, size int, place int"))


def rooted(rows: DataFrame, roots: DataFrame, most_broadcast: int) -> tuple[DataFrame, int, int]:
    """``rows`` with the root of their node and the commonest root of their shingle, only those of shingles with several
    roots; how many rows, and how many pairs of different roots share a shingle."""
    named = roots.select(F.col("u").alias("node"), F.col("v").alias("root"))
    named = F.broadcast(named) if small_enough(named, most_broadcast) else named
    rows = rows.join(named, "node", "left").withColumn("root", F.coalesce("root", "node"))
    each = rows.groupBy("gram", "root").agg(F.count("*").alias("c"))
    per = each.groupBy("gram").agg(F.max(F.struct("c", "root")).alias("most"), F.sum("c").alias("n"), F.sum(F.col("c").cast("double") * F.col("c")).alias("q"), F.count("*").alias("roots"))
    per = cut(per.where("roots > 1").select("gram", F.col("most.root").alias("major"), "n", ((F.col("n").cast("double") * F.col("n") - F.col("q")) / 2).alias("pairs")))
    n, pairs = per.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("pairs"), F.lit(0.0))).first()
    few = per.select("gram", "major")
    return rows.join(F.broadcast(few) if small_enough(few, most_broadcast) else few, "gram"), int(n), int(pairs)


def meeting(left: DataFrame, right: DataFrame, odd: DataFrame, share: float) -> DataFrame:
    """Distinct (u, v), u < v, of nodes of different roots that share a shingle and may agree by size, place and
    parities (``odd``: of each node). Parities are the widest column, so they come last."""
    left, right = left.join(odd, "node"), right.join(odd, "node")
    names = ("node", "root", "size", "place", "odd")
    a, b = left.select("gram", *(F.col(c).alias(f"{c}1") for c in names)), right.select("gram", *names)
    rest = F.least(F.col("size1") - F.col("place1"), F.col("size") - F.col("place"))  # the pair's first common shingle and all after it
    near = (F.col("root") != F.col("root1")) & (rest * (1 + share) >= share * (F.col("size") + F.col("size1")) - CLOSE)
    apart = functools.reduce(Column.__add__, (F.bit_count(F.col("odd")[k].bitwiseXOR(F.col("odd1")[k])) for k in range(PARITIES // 64)))
    near = near & (apart * (1 + share) <= (1 - share) * (F.col("size") + F.col("size1")) + CLOSE)
    return a.join(b, "gram").where(near).select(F.least("node", "node1").alias("u"), F.greatest("node", "node1").alias("v")).distinct()


def hubs(rows: DataFrame, turn: int) -> DataFrame:
    """A few rows of each shingle by a random order of the nodes, another one in each turn; Spark keeps as few of each
    task before the shuffle."""
    order = Window.partitionBy("gram").orderBy(F.xxhash64(F.lit(turn), "node"), "node")
    return rows.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= HUBS).select("gram", "node", "root", "size", "place")


def agreeing(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, share: float, most_broadcast: int = 1_000_000) -> DataFrame:
    """The (u, v) of ``pairs`` (written) whose shingle sets agree to ``share`` or more; ``docs``: doc_id, text;
    ``nodes``: node, least (an id that has it).

    Of a pair the node with more pairs is the hub. Only texts in pairs are hashed. The set of a hub and those to compare
    with it meet in tasks, as many for each hub as its pairs need, the hub's own first.
    """
    n = pairs.count()
    pairs = gathered(pairs, n)
    degree = gathered(pairs.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count("*").alias("d")), n)
    degree = F.broadcast(degree) if n <= most_broadcast else degree
    both = pairs.join(degree.withColumnsRenamed({"node": "u", "d": "du"}), "u").join(degree.withColumnsRenamed({"node": "v", "d": "dv"}), "v")
    first, salts = F.col("du") >= F.col("dv"), F.ceil(F.greatest("du", "dv") / AT_ONCE).cast("int")
    both = cut(both.select(F.when(first, F.col("u")).otherwise(F.col("v")).alias("hub"), F.when(first, F.col("v")).otherwise(F.col("u")).alias("node"), salts.alias("salts")))
    others = both.select("hub", "node", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), F.lit(False).alias("own"))
    own = both.select("hub", "salts").distinct().select("hub", F.col("hub").alias("node"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("own"))
    wanted = cut(gathered(others.unionByName(own).join(nodes.select("node", F.col("least").alias("__id")), "node"), 2 * n))
    few = F.broadcast(wanted) if small_enough(wanted, most_broadcast) else wanted
    raw = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = raw.join(few, F.col("doc_id") == F.col("__id")).select("text", "hub", "salt", "own", "node")
    rows = rows.mapInArrow(lean(packed_sets), "hub long, salt int, own boolean, node long, n int, grams binary")
    if not (lost := wanted.where("__id is null")).isEmpty():  # nodes of rows without an id only
        nameless = raw.where("doc_id is null").select("text", *(F.lit(None).cast(t).alias(c) for c, t in (("hub", "long"), ("salt", "int"), ("own", "boolean"), ("node", "long"))))
        nameless = nameless.mapInArrow(lean(packed_sets), "hub long, salt int, own boolean, node long, n int, grams binary").select("node", "n", "grams").dropDuplicates(["node"])
        rows = rows.unionByName(lost.join(nameless, "node").select(*rows.columns))
    met = rows.repartition(partitions(docs.sparkSession), "hub", "salt").sortWithinPartitions("hub", "salt", F.desc("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, grams = None, None
        for batch in batches:
            out = []
            for h, own, node, n, raw in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4)), batch.column(5), strict=True):
                if own:
                    if h != hub:
                        hub, grams = h, np.cumsum(unpacked(raw.as_py(), n), dtype=np.uint64)
                    continue
                if h != hub:
                    raise ValueError(f"the shingles of {h} did not come first")
                same = len(np.intersect1d(grams, np.cumsum(unpacked(raw.as_py(), n), dtype=np.uint64)))
                if same * (1 + share) >= share * (n + len(grams)) - CLOSE:
                    out.append((min(h, node), max(h, node)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["u", "v"])

    return cut(met.mapInArrow(lean(run), "u long, v long").distinct())


def packed_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """hub, salt, own, node, n, grams of (text, hub, salt, own, node); rows whose text has another node than theirs leave."""
    text, node, n, grams = None, None, 0, b""
    for batch in batches:
        for k in range(0, batch.num_rows, AT_ONCE):
            part, found = batch.slice(k, AT_ONCE), []
            for t, wanted in zip(part.column(0), part.column(4).to_pylist(), strict=True):
                t = t.as_py() or b""
                if t != text:
                    text, (node, g) = t, distinct(simhash.shingle_hashes(t, WORDS))
                    n, grams = len(g), packed(steps(g >> np.uint64(16)))
                found.append((node, n, grams) if wanted in (None, node) else (None, None, None))
            sets_ = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)]
            whole = pa.RecordBatch.from_arrays([*part.columns[1:4], *sets_], ["hub", "salt", "own", "node", "n", "grams"])
            yield whole.filter(sets_[0].is_valid())


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = SHARE, most_broadcast: int = 1_000_000) -> DataFrame:
    """One row per row of ``df``: doc_id, component_id (the smallest id reachable over links of texts whose five-word
    shingles agree to ``share`` or more, the row itself included).

    ``df`` is read several times and must give the same rows each time; its texts are hashed again instead of kept.
    Words are cut and lower-cased as by ``simhash``; a text of fewer than five words is one shingle, texts without
    words agree with each other. Null ids and repeated rows are treated as by ``simhash.near_duplicates``.
    """
    docs = df.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    found = cut(sets(docs))
    n = found.count()
    nodes = cut(gathered(found.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("simhash").alias("simhash")), n))
    heads = cut(gathered(nodes.groupBy("simhash").agg(F.min("node").alias("head")), n))
    near = simhash.links(heads.select("simhash"))
    name = lambda k: heads.select(F.col("simhash").alias(k), F.col("head").alias(f"n{k}"))
    near = near.join(name("u"), "u").join(name("v"), "v").select(F.col("nu").alias("u"), F.col("nv").alias("v"))
    near = near.unionByName(nodes.join(heads, "simhash").where("node != head").select(F.col("head").alias("u"), F.col("node").alias("v")))
    near = agreeing(cut(near.distinct()), docs, nodes, share, most_broadcast)
    roots = components(near)
    rows = shared(docs, frequent(docs, share), share)
    odd = found.select("node", "odd").dropDuplicates(["node"])
    for turn in range(ROUNDS + 1):
        crossing, among, pairs = rooted(rows, roots, most_broadcast)
        last = pairs <= MANY * among or turn == ROUNDS
        few = crossing.where("root != major") if last else hubs(crossing, turn)
        more = cut(meeting(few, crossing, odd, share))
        more = agreeing(more, docs, nodes, share, most_broadcast)
        roots = components(roots.unionByName(more))
        if last:
            break
    roots = roots.withColumnsRenamed({"u": "node", "v": "root"})
    named = nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return found.select("doc_id", "node").join(named.join(least, "root").select("node", "component_id"), "node").select("doc_id", "component_id")


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = SHARE, most_broadcast: int = 1_000_000) -> DataFrame:
    """The rows of ``df`` that represent their group of near duplicates, as by ``simhash.deduplicate``."""
    return simhash.representatives(df, near_duplicates(df, doc_id, text, share, most_broadcast), doc_id, most_broadcast)
