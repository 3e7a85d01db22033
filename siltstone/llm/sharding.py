"""Shards of near equal bytes: the leaves of a k-d tree over the metadata of documents.

A node that is to become ``m`` shards is split along its widest dimension, where ``m // 2`` of ``m`` parts of its bytes lie
to the left. All nodes of a level are split together, and the weighted median of each is found by histograms: bytes are
summed per node and bin, the bin in which the median lies is divided again, until it holds a row, or so few bytes that it
doesn't matter. Rows that agree in the dimension are told apart by id, and repeated rows by their place in a written table.
The driver sees a row per node and pass, never documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, NumericType

from siltstone.llm.common import col, partitions, rewritten

#: Keys stay below this, so that the difference of two is a long.
FAR = 2**62 - 1
MOST_SHARDS = 1_000_000
SPLIT = "node int, dim int, part int, lo long, hi long, step long, v0 long, v1 long, before long, want long"


def as_key(docs: DataFrame, name: str) -> Column:
    """A long that orders rows by a column: numbers by their whole part, others by a digest; null comes as 0."""
    if isinstance(docs.schema[name].dataType, NumericType):
        whole = col(name).try_cast("long")  # least and greatest would pass over a null
        return F.when(whole.isNull(), 0).when(whole > FAR, FAR).when(whole < -FAR, -FAR).otherwise(whole).cast("long")
    return F.coalesce(F.conv(F.substring(F.sha2(col(name).cast("string"), 256), 1, 15), 16, 10).cast("long"), F.lit(0))


def narrow(docs: DataFrame, dimensions: tuple[str, ...], id_column: str, text: str, keep: list[str], overhead: int) -> DataFrame:
    """What the tree looks at, written once: size, checksum, dimensions d0, d1, ..., tie and a number for each row."""
    body = F.coalesce(col(text), F.lit(""))
    dims = [as_key(docs, d).alias(f"d{k}") for k, d in enumerate(dimensions)]
    id_kind = docs.schema[id_column].dataType
    tie = as_key(docs, id_column) if isinstance(id_kind, NumericType) else F.coalesce(as_key(docs, id_column), F.lit(-1))
    tie = F.when(col(id_column).isNull(), F.lit(-FAR)).otherwise(tie).alias("tie")
    rows = docs.select(F.struct(*(col(c).alias(c) for c in keep)).alias("kept"), (F.octet_length(body) + overhead).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("crc"), *dims, tie)
    return rewritten(rows.withColumn("seq", F.monotonically_increasing_id()))


def choose(key: str, width: int) -> Column:
    """The dimension that a row's node is split along."""
    return F.coalesce(*(F.when(F.col(key) == k, F.col(f"d{k}")) for k in range(width)))


def medians(state: DataFrame, nodes: dict[int, dict], width: int, bins: int) -> list[tuple]:
    """(node, dim, b0, b1, b2, right) for each node of ``nodes`` (dim, lo, hi, total, left, parts, slack): rows whose
    (dimension, tie, seq) is below the bound go left.

    A row goes left if the middle of its bytes is at or below the wanted point; a last bin of at most ``slack`` bytes
    is treated as one row.
    """
    spark, found = state.sparkSession, []
    todo = {node: x | {"part": 0, "before": 0, "v0": 0, "v1": 0} for node, x in nodes.items()}
    while todo:
        rows = [(node, x["dim"], x["part"], x["lo"], x["hi"], (x["hi"] - x["lo"]) // bins + 1, x["v0"], x["v1"], x["before"], x["total"] * x["left"] // x["parts"]) for node, x in todo.items()]
        at = F.broadcast(spark.createDataFrame(rows, SPLIT))  # a row per node, at most MOST_SHARDS
        value = choose("dim", width)
        key = F.when(F.col("part") == 0, value).when(F.col("part") == 1, F.col("tie")).otherwise(F.col("seq"))
        same = (F.col("part") == 0) | ((value == F.col("v0")) & ((F.col("part") == 1) | (F.col("tie") == F.col("v1"))))
        seen = state.join(at, "node").where(same).withColumn("key", key).where("key between lo and hi")
        edges = [f(c).alias(f"{name}_{c}") for c in ("key", "tie", "seq") for name, f in (("min", F.min), ("max", F.max))]
        sums = seen.groupBy("node", "before", "want", F.expr("(key - lo) div step").alias("bin")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), *edges)
        upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("bin")) + F.col("before")  # at most ``bins`` rows
        names = ["bin", "upto", "bytes", "n", *(f"{name}_{c}" for c in ("key", "tie", "seq") for name in ("min", "max"))]
        best = sums.withColumn("upto", upto).where("upto > want").groupBy("node").agg(F.min(F.struct(*names)).alias("b")).collect()
        for node, b in best:
            x = todo.pop(node)
            before, want = b.upto - b.bytes, x["total"] * x["left"]
            bound = [x["v0"], x["v1"]][: x["part"]]
            if b.n == 1 or b.bytes <= x["slack"] or before * x["parts"] >= want:
                left = (before + b.upto) * x["parts"] <= 2 * want
                bound = [*bound, b.max_key + 1 if left else b.min_key, -(2**63), -(2**63)][:3]
                found.append((node, x["dim"], *bound, node + x["left"]))
            elif b.min_key < b.max_key:
                todo[node] = x | {"lo": b.min_key, "hi": b.max_key, "before": before}
            elif x["part"] == 0:
                todo[node] = x | {"part": 1, "v0": b.min_key, "lo": b.min_tie, "hi": b.max_tie, "before": before}
            else:
                todo[node] = x | {"part": 2, "v1": b.min_key, "lo": b.min_seq, "hi": b.max_seq, "before": before}
    return found


def descend(state: DataFrame, splits: list[tuple], width: int) -> DataFrame:
    """``state`` with each row in the child of its node that it belongs to."""
    at = F.broadcast(state.sparkSession.createDataFrame(splits, "node int, dim int, b0 long, b1 long, b2 long, right int"))  # a row per node
    value = choose("dim", width)
    left = (value < F.col("b0")) | ((value == F.col("b0")) & ((F.col("tie") < F.col("b1")) | ((F.col("tie") == F.col("b1")) & (F.col("seq") < F.col("b2")))))
    child = F.when(F.col("right").isNull() | left, F.col("node")).otherwise(F.col("right"))
    return state.join(at, "node", "left").select(*(child.alias("node") if c == "node" else c for c in state.columns))


def numbered(state: DataFrame) -> DataFrame:
    """``state`` with ``slot``, from 0 without gaps in each node, in order of tie and seq.

    Ranges of (node, tie, seq) are sorted by themselves; a node's rows in a range follow those of the ranges before it.
    """
    order = ["node", "tie", "seq"]
    rows = state.repartitionByRange(partitions(state.sparkSession), *order).sortWithinPartitions(*order)
    rows = rewritten(rows.withColumn("at", F.monotonically_increasing_id()))
    runs = rows.groupBy("node", F.shiftright("at", 33).alias("range")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("node").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select("node", "range", (earlier - F.col("first")).alias("shift"))
    at = F.broadcast(starts)  # ranges are in order of node, so there are at most as many rows as partitions and nodes
    return rows.withColumn("range", F.shiftright("at", 33)).join(at, ["node", "range"]).withColumn("slot", F.col("at") + F.col("shift")).drop("range", "shift", "at")


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, dimensions: tuple[str, ...] = ("source", "lang", "n_chars"), id_column: str = "doc_id", text: str = "text", keep: list[str] | None = None, overhead: int = 16, tolerance: float = 1e-4, bins: int = 1024) -> DataFrame:
    """``keep`` (all columns by default) with size, text_crc32, shard and slot.

    Give either the number of ``shards`` or the ``target_bytes`` of one. A row's size is the UTF-8 bytes of its text
    (null: none) plus ``overhead``. Dimensions that ``docs`` lacks are left out; without any, ids alone decide. Null
    metadata counts as 0, a null id comes before all others; rows that are equal in everything are dealt by their place.
    A text longer than a shard is a shard's only row or with few others; with fewer rows than shards some stay empty; an
    empty table gives no rows. Columns named as the added ones are replaced. At most a million shards.
    """
    added = ("size", "text_crc32", "shard", "slot")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    dims = tuple(d for d in dimensions if d in docs.columns) or (id_column,)
    width = len(dims)
    rows = narrow(docs, dims, id_column, text, keep, overhead)
    ends = [f(f"d{k}") for k in range(width) for f in (F.min, F.max)]
    total, *extent = rows.agg(F.sum("size"), *ends).first()
    parts = 1 if total is None else shards or max(1, -(-total // target_bytes))
    if parts > MOST_SHARDS:
        raise ValueError(f"{parts} shards are more than {MOST_SHARDS}")
    state, level = rows.withColumn("node", F.lit(0)), {0: parts}
    slack = tolerance * (total or 0) / parts
    while any(m > 1 for m in level.values()):
        open_nodes = {n: m for n, m in level.items() if m > 1}
        stats = state.groupBy("node").agg(F.sum("size"), *ends).collect()  # a row per node
        nodes = {}
        for node, bytes_, *reach in stats:
            if node in open_nodes:
                spread = [float(reach[2 * k + 1] - reach[2 * k]) / float(extent[2 * k + 1] - extent[2 * k] or 1) for k in range(width)]
                dim = spread.index(max(spread))
                m = open_nodes[node]
                nodes[node] = {"dim": dim, "lo": reach[2 * dim], "hi": reach[2 * dim + 1], "total": bytes_, "left": m // 2, "parts": m, "slack": slack}
        if not nodes:
            break
        state = descend(state, medians(state, nodes, width, bins), width)
        level = {child: part for n, m in level.items() for child, part in ([(n, m // 2), (n + m // 2, m - m // 2)] if n in nodes else [(n, 1)])}
    return numbered(state).select("kept.*", "size", F.col("crc").cast(LongType()).alias("text_crc32"), F.col("node").alias("shard"), F.col("slot").cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """A folder of Parquet files for each shard. Rows of ``shard`` come in order of their shard, so files are few."""
    sharded.write.partitionBy("shard").parquet(path)
