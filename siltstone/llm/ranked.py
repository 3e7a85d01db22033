"""The highest-scoring documents of each query text, from an index of two levels.

The index has a row per document with those terms of the queries that it holds. Its first level is a byte per term, the
term's share of a score rounded up to 255ths; the second are the counts that the exact score needs. A first pass adds up
bytes: what they add up to is an upper bound of the score, and less one step per term a lower bound. The k-th highest
lower bound of a query is a floor that no document of its result is below, so the second pass rescores, in exact
integers, each document whose upper bound reaches the floor, and only those. Tasks hand on k rows per query at most.

Queries are taken in blocks, whose terms and floors are all that is sent to the tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from siltstone.llm.common import col, lean, rewritten

#: A term's share of a score is below this many parts, ``STEP`` of which are one step of a byte.
WHOLE = 1_000_000
STEP = -(-WHOLE // 255)
#: Terms are ASCII letters and digits and everything beyond ASCII; only A to Z are lower-cased.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Documents whose postings a task has in memory at once.
SLICE = 4096


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def raw(column: pa.Array) -> Iterator[bytes]:
    for x in column.cast(pa.binary()):
        yield x.as_py() or b""


def query_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, term), each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in raw(batch.column(1))]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array([t for f in found for t in f], pa.binary())], ["item", "term"])

    rows = items.select(col(item).alias("item"), col(text).alias("text"))
    return rows.mapInArrow(lean(run), StructType([StructField("item", items.schema[item].dataType), StructField("term", BinaryType())])).distinct()


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs) of each document with a term: how many terms, and which of the vocabulary how often."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lengths, terms, tfs, ends = [], [], [], [0]
            for text in raw(batch.column(1)):
                words = terms_of(text)
                lengths.append(len(words))
                for word, tf in Counter(words).items():
                    if (k := known.get(word)) is not None:
                        terms.append(k)
                        tfs.append(tf)
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (terms, tfs)]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), *lists], ["id", "n", "terms", "tfs"])
            yield out.filter(pa.array([n > 0 for n in lengths], pa.bool_()))

    ints = ArrayType(IntegerType())
    return docs.mapInArrow(lean(run), StructType([StructField("id", docs.schema["id"].dataType), StructField("n", LongType()), StructField("terms", ints), StructField("tfs", ints)]))


def shares(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The exact share of a term, in parts of ``WHOLE``, before its weight."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each element, and the elements, of the non-null lists of a column."""
    ends = np.asarray(column.offsets, dtype=np.int64)
    return np.repeat(np.arange(len(column)), np.diff(ends)), np.asarray(column.values, dtype=np.int64)[ends[0] : ends[-1]]


def quantised(counts: DataFrame, documents: int, length: int) -> DataFrame:
    """``counts`` with m, the document's length as the score sees it, and a byte for each of its terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.asarray(batch.column(1), dtype=np.int64)
            m = 50 + 50 * n * documents // length
            row, tf = lists(batch.column(3))
            steps = (-(-shares(tf, m[row]) // STEP)).astype(np.uint8).tobytes()
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(n)))]).astype(np.int32)
            impacts = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(steps)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m), *batch.columns[2:], impacts], ["id", "m", "terms", "tfs", "impacts"])

    fields = counts.schema.fields
    return counts.mapInArrow(lean(run), StructType([fields[0], StructField("m", LongType()), *fields[2:], StructField("impacts", BinaryType())]))


class Postings:
    """The postings of some documents by term."""

    def __init__(self, terms: pa.ListArray, impacts: pa.Array, size: int):
        row, term = lists(terms)
        byte = np.frombuffer(b"".join(raw(impacts)), np.uint8).astype(np.int64)
        self.order = np.argsort(term, kind="stable")
        self.row, self.byte, self.n = row[self.order], byte[self.order], len(terms)
        self.starts = np.searchsorted(term[self.order], np.arange(size + 1))

    def of(self, term: int) -> slice:
        return slice(self.starts[term], self.starts[term + 1])

    def bounds(self, query: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bound of each document's score for the query's (term, weight)."""
        total, present = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        for term, w in query:
            at = self.of(term)
            total[self.row[at]] += w * self.byte[at]
            present[self.row[at]] += w * (self.byte[at] > 0)
        return STEP * total, STEP * total - (STEP - 1) * present


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE):
            yield batch.slice(k, SLICE)


def lower_bounds(index: DataFrame, queries: list[list[tuple[int, int]]], size: int, k: int) -> DataFrame:
    """(query, low): the ``k`` highest positive lower bounds of each query in each task."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, np.int64)] * len(shared.value)
        for batch in sliced(batches):
            postings = Postings(batch.column(0), batch.column(1), size)
            for q, query in enumerate(shared.value):
                low = postings.bounds(query)[1]
                low = np.concatenate([best[q], low[low > (best[q].min() if len(best[q]) == k else 0)]])
                best[q] = np.partition(low, len(low) - k)[-k:] if len(low) > k else low
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(best)), [len(b) for b in best]), pa.int32()), pa.array(np.concatenate([*best, np.zeros(0, np.int64)]))], ["query", "low"])

    return index.select("terms", "impacts").mapInArrow(lean(run), "query int, low long")


def rescored(index: DataFrame, queries: list[list[tuple[int, int]]], floors: list[int], size: int, k: int) -> DataFrame:
    """(query, id, score): the ``k`` best of each query in each task, of all documents whose upper bound reaches its floor."""
    shared = index.sparkSession.sparkContext.broadcast((queries, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, floors = shared.value
        best: list[list[tuple]] = [[] for _ in queries]
        kind = None
        for batch in sliced(batches):
            kind = batch.schema.field(0).type
            postings = Postings(batch.column(2), batch.column(4), size)
            tf = lists(batch.column(3))[1][postings.order]
            m = np.asarray(batch.column(1), dtype=np.int64)
            for q, query in enumerate(queries):
                reach = postings.bounds(query)[0] >= floors[q]
                if not reach.any():
                    continue
                score = np.zeros(postings.n, np.int64)
                for term, w in query:
                    at = postings.of(term)
                    hit = reach[postings.row[at]]
                    row = postings.row[at][hit]
                    score[row] += w * shares(tf[at][hit], m[row])
                rows = np.flatnonzero(score > 0)
                if len(rows) > k:
                    rows = rows[score[rows] >= np.partition(score[rows], len(rows) - k)[len(rows) - k]]
                if len(best[q]) == k:
                    rows = rows[score[rows] >= -best[q][-1][0]]
                if len(rows):
                    ids = batch.column(0).take(pa.array(rows)).to_pylist()
                    found = [(-s, i is not None, i) for s, i in zip(score[rows].tolist(), ids, strict=True)]
                    best[q] = sorted(best[q] + found)[:k] if None not in ids else sorted(best[q] + found, key=lambda r: r[:2] + (r[2] or 0,))[:k]
        if kind is not None:
            rows = [(q, i, -s) for q, b in enumerate(best) for s, _, i in b]
            columns = [[r[c] for r in rows] for c in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], kind), pa.array(columns[2], pa.int64())], ["query", "id", "score"])

    kinds = StructType([StructField("query", IntegerType()), index.schema["id"], StructField("score", LongType())])
    return index.select("id", "m", "terms", "tfs", "impacts").mapInArrow(lean(run), kinds)


def first_of(rows: DataFrame, order: list, k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each query, first of those of a 64th of the tasks, then of all, so that no group grows with the tasks."""
    some = rows.withColumn("some", F.pmod(F.spark_partition_id(), F.lit(64)))
    some = some.withColumn(name, F.row_number().over(Window.partitionBy("query", "some").orderBy(*order))).where(F.col(name) <= k).drop("some", name)
    return some.withColumn(name, F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col(name) <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id", item_text: str = "text", block: int = 2000) -> DataFrame:
    """(item, rank, id, score): each item's ``k`` highest-scoring documents with a score above 0, or all if there are fewer.

    Equal scores go by ascending id (null first). A null text has no terms; an item without terms, or one that no
    document shares a term with, gives no rows. Rows of one item id are one query of all their terms; repeated rows of a
    document are documents of their own, with ranks of their own. Texts count whole, however long. Empty tables give no
    rows. Other columns are not looked at.
    """
    if id_column == item_column:
        raise ValueError("items and documents need ids of different names")
    spark = docs.sparkSession
    docs = docs.select(col(id_column).alias("id"), col(text).alias("text"))
    asked = rewritten(query_terms(items, item_column, item_text))
    blocks = -(-asked.select("item").distinct().count() // block)
    out = None
    for number in range(max(1, blocks)):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(max(1, blocks))) == number).collect()  # about ``block`` items
        names = list(dict.fromkeys(r.item for r in mine))
        vocabulary = {t: n for n, t in enumerate(dict.fromkeys(bytes(r.term) for r in mine))}
        counts = rewritten(counted(docs, vocabulary))
        documents, length = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        holding = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row per term of the block
        weights = [weight(documents, holding[t]) if t in holding else 0 for t in range(len(vocabulary))]
        where = {name: q for q, name in enumerate(names)}
        queries: list[list[tuple[int, int]]] = [[] for _ in names]
        for r in mine:
            term = vocabulary[bytes(r.term)]
            if weights[term] > 0:
                queries[where[r.item]].append((term, weights[term]))
        index = rewritten(quantised(counts, documents, length or 1))
        low = first_of(lower_bounds(index, queries, len(vocabulary), k), [F.desc("low")], k).where(F.col("rank") == k)
        floors = [1] * len(names)
        for q, value, _ in low.collect():  # a row per item of the block
            floors[q] = max(1, value)
        best = first_of(rescored(index, queries, floors, len(vocabulary), k), [F.desc("score"), F.asc_nulls_first("id")], k)
        named = spark.createDataFrame(list(enumerate(names)), StructType([StructField("query", IntegerType()), StructField(item_column, items.schema[item_column].dataType)]))
        found = best.join(F.broadcast(named), "query").select(col(item_column), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_column), "score")
        out = found if out is None else out.unionByName(found)
    return out
