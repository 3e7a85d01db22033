"""Removal of repeated line runs by a suffix array over line ids.

Lines get 128-bit ids. Only stretches of lines that all occur more than once can hold a repeated run; equal stretches
are one node of the array with several places, of which the first stays. A suffix array of the stretches, and of the
stretches read backwards, is built by prefix doubling: the rank of a suffix by its first 2h lines is the rank of the
pair (rank by its first h, rank of the suffix h lines further on). Pairs are counted where they are, ranked by one
range-partitioned sort of the distinct ones, and brought back by a join.

A run counts from ``min_words`` words, which a suffix has in its first m lines. With the ranks by h lines, h the
greatest power of two up to m, the pair (rank of the suffix, rank of the suffix m - h lines further on) orders the
suffixes by their first m lines, and neighbours in that order have a longest common prefix of m lines or more if and
only if their pairs are equal. Neighbours with such a prefix form an interval; all of its suffixes begin with the same
run, and each but the first is a later copy. Read forwards an interval gives the run's beginning, read backwards its
end; as both are at least ``min_words`` words long, together they cover every line of every maximal repeated run. No
prefix longer than the greatest m is asked for, so doubling stops there.

A line is thus deleted if it lies in a run of consecutive lines with ``min_words`` words or more that also begins
earlier, in the order of ids and lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, IntegralType, LongType, StructField, StructType

from siltstone.llm.common import col, cut, free_name, lean, partitions, small_enough

MIN_WORDS = 50


def line_ids(text: Column) -> Column:
    """Per line: its position, id (two hashes) and number of words (cut at ASCII white space)."""
    return F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("pos"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"), F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")).alias("w")))


def stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """Runs of consecutive repeated lines with enough words: doc, th, start, a, b, w (arrays)."""
    kind = lines.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, th, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                begin = 0
                for k in range(1, len(rows) + 1):
                    if k < len(rows) and rows[k]["pos"] == rows[k - 1]["pos"] + 1:
                        continue
                    part = rows[begin:k]
                    if sum(r["w"] for r in part) >= min_words:
                        out.append((doc, th, part[0]["pos"], [r["a"] for r in part], [r["b"] for r in part], [r["w"] for r in part]))
                    begin = k
            if out:
                types = (batch.schema.field(0).type, pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["doc", "th", "start", "a", "b", "w"])

    return lines.mapInArrow(lean(run), f"doc {kind}, th long, start int, a array<long>, b array<long>, w array<int>")


def ranked(pairs: DataFrame, keys: list[str], deal: int) -> DataFrame:
    """``pairs`` (distinct keys with a count n) with ``rank``: 1 + the sum of n over all smaller keys.

    One range-partitioned sort; tasks sum their own counts, and the driver adds up one number per task.
    """
    names = [*keys, "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            n = batch.column(len(keys)).to_numpy()
            before = total + np.cumsum(n) - n
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], [*names, "before"])

    sorted_pairs = pairs.select(*names).repartitionByRange(deal, *keys).sortWithinPartitions(*keys)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sorted_pairs.schema.fields)
    summed = cut(sorted_pairs.mapInArrow(lean(run), fields + ", before long").withColumn("task", F.spark_partition_id()))
    totals = {r[0]: r[1] for r in summed.groupBy("task").agg(F.max(F.col("before") + F.col("n"))).collect()}
    offsets, at = {}, 0
    for task in sorted(totals):
        offsets[task] = at
        at += totals[task]
    if not offsets:
        return summed.select(*keys, "n", F.lit(1).cast("long").alias("rank"))
    shift = F.element_at(F.create_map(*(F.lit(x) for kv in offsets.items() for x in kv)), F.col("task"))
    return summed.select(*keys, "n", (F.col("before") + shift + 1).cast("long").alias("rank"))


def suffixes(runs: DataFrame, longest: int, deal: int) -> DataFrame:
    """(sid, back, at, lines, m, x, y) of the suffixes of ``runs`` (sid, back, a, b, m: arrays) with m > 0: x and y are
    the ranks by h lines of the suffix and of its m-th line's window, h the greatest power of two up to m."""
    # The first ranks are those of the lines themselves; forward and backward suffixes never share one.
    each = runs.select("sid", "back", F.posexplode(F.arrays_zip("a", "b", "m")).alias("at", "line")).select("sid", "back", "at", "line.*")
    names = ranked(each.groupBy("back", "a", "b").agg(F.count("*").alias("n")), ["back", "a", "b"], deal)
    ranks = gathered(each.join(names, ["back", "a", "b"]))
    h, classes, out, n = 1, None, None, F.size("r")
    while True:
        final = 2 * h > longest
        if not final:
            ahead = F.concat(F.slice("r", h + 1, n), F.array_repeat(F.lit(0).cast("long"), F.least(F.lit(h), n)))
            pairs = ranks.select("sid", "back", F.posexplode(F.arrays_zip(F.col("r").alias("x"), ahead.alias("y"), "m")).alias("at", "p")).select("sid", "back", "at", "p.*")
            names = ranked(pairs.groupBy("x", "y").agg(F.count("*").alias("n")), ["x", "y"], deal)
            now = names.count()
            final = now == classes  # no class was split: suffixes of one class are equal to their ends
            classes = now
        rest = lambda m, i: F.when(F.lit(final) & (m >= 2 * h), F.lit(0)).otherwise(F.get(F.col("r"), i + m - h))  # noqa: B023, E731
        here = F.transform("m", lambda m, i: F.struct(i.alias("at"), n.alias("lines"), m.alias("m"), F.get(F.col("r"), i).alias("x"), rest(m, i).alias("y")))
        here = F.filter(here, lambda s: (s["m"] >= h) & (F.lit(final) | (s["m"] < 2 * h)))
        named = ranks.select("sid", "back", F.explode(here).alias("s")).select("sid", "back", "s.*")
        out = named if out is None else out.unionByName(named)
        if final:
            return out
        ranks = gathered(pairs.join(names, ["x", "y"]))
        h *= 2


def gathered(rows: DataFrame) -> DataFrame:
    return cut(rows.groupBy("sid", "back").agg(F.sort_array(F.collect_list(F.struct("at", "rank", "m"))).alias("s")).select("sid", "back", F.col("s.rank").alias("r"), F.col("s.m").alias("m")))


def with_prefixes(runs: DataFrame, min_words: int) -> DataFrame:
    """``runs`` (sid, back, a, b, w) with m instead of w: per position the lines of the suffix's shortest prefix with
    enough words, 0 without one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = []
            for w in batch.column(4):
                sums = np.concatenate([[0], np.cumsum(w.values.to_numpy(), dtype=np.int64)])
                ends = np.maximum(np.searchsorted(sums, sums[:-1] + min_words), np.arange(1, len(sums)))
                m.append(np.where(ends < len(sums), ends - np.arange(len(sums) - 1), 0).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(m, pa.list_(pa.int32()))], ["sid", "back", "a", "b", "m"])

    return runs.select("sid", "back", "a", "b", "w").mapInArrow(lean(run), "sid long, back boolean, a array<long>, b array<long>, m array<int>")


def later_copies(rows: DataFrame, deal: int) -> DataFrame:
    """The suffixes (sid, at, m, x, y) that are later copies: those in an interval of the suffix array that isn't theirs
    alone, but for the first of each interval.

    Rows are sorted by their first m lines over range partitions. Within a partition neighbours are compared in turn; an
    interval that goes on in the next partition is closed with one row per partition on the driver.
    """
    name = ["m", "x", "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, number = None, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            ranks = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
            shares = np.zeros(batch.num_rows, bool)  # whether the common prefix with the one before has m lines
            shares[1:] = (ranks[:, 1:] == ranks[:, :-1]).all(axis=0)
            shares[0] = last is not None and (ranks[:, 0] == last).all()
            last = ranks[:, -1].copy()
            ids = number + np.cumsum(~shares)
            number = int(ids[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids)], [*name, "sid", "at", "part"])

    order = [*name, "sid", "at"]
    rows = rows.select(*order).repartitionByRange(deal, *order).sortWithinPartitions(*order)
    parts = cut(rows.mapInArrow(lean(run), "m int, x long, y long, sid long, at int, part long").withColumn("task", F.spark_partition_id()))
    # The first and last interval of each partition: equal ones of neighbours are one.
    ends = parts.groupBy("task").agg(F.min_by(F.struct(*name, "part"), "part").alias("first"), F.max_by(F.struct(*name, "part"), "part").alias("last")).orderBy("task").collect()
    same, open_name, before = {}, None, None
    for e in ends:
        if before is not None and before[:3] == e["first"][:3]:
            same[(e["task"], e["first"]["part"])] = open_name
        if e["first"]["part"] != e["last"]["part"] or (e["task"], e["first"]["part"]) not in same:
            open_name = (e["task"], e["last"]["part"])
        before = e["last"]
    named = F.struct("task", "part")
    if same:
        pair = lambda k: F.struct(F.lit(k[0]).cast("int").alias("task"), F.lit(int(k[1])).cast("long").alias("part"))
        joined = F.create_map(*(x for k, v in same.items() for x in (pair(k), pair(v))))
        named = F.coalesce(F.try_element_at(joined, named), named)
    parts = parts.withColumn("interval", named)
    first = parts.groupBy("interval").agg(F.min(F.struct("sid", "at")).alias("first"))
    return parts.join(first, "interval").where(F.struct("sid", "at") != F.col("first")).select("sid", "at", "m")


def deletions(df: DataFrame, doc_id: str, text: str, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, th, start, end): half-open spans of deleted lines, by id and hash of the document's text; spans may overlap."""
    deal = partitions(df.sparkSession)
    docs = df.select(ordered(df, doc_id).alias("doc"), F.xxhash64(F.coalesce(col(text), F.lit(""))).alias("th"), line_ids(F.coalesce(col(text), F.lit(""))).alias("lines"))
    # Both are written: the lines are read twice, and of two written tables Spark can split a very frequent line's join.
    lines = cut(docs.select("doc", "th", F.explode("lines").alias("l")).select("doc", "th", "l.*"))
    repeated = cut(lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b"))
    kept = lines.join(repeated, ["a", "b"]).groupBy("doc", "th").agg(F.sort_array(F.collect_set(F.struct("pos", "a", "b", "w"))).alias("rows"))
    found = cut(stretches(kept, min_words))
    # Of equal stretches the first stays to be looked at; the others are copies from end to end.
    keyed = found.select("doc", "th", "start", "a", "b", "w", F.xxhash64("a").alias("p"), F.xxhash64(F.lit(7), "b").alias("q"))
    distinct = keyed.groupBy("p", "q").agg(F.min(F.struct(F.struct("doc", "th", "start").alias("place"), "a", "b", "w")).alias("x"))
    distinct = distinct.select("p", "q", "x.place.*", "x.a", "x.b", "x.w").orderBy("doc", "th", "start").withColumn("sid", F.monotonically_increasing_id())
    distinct = cut(distinct)
    firsts = distinct.select("p", "q", F.col("doc").alias("doc1"), F.col("th").alias("th1"), F.col("start").alias("start1"))
    copies = keyed.join(firsts, ["p", "q"]).where("not (doc <=> doc1 and th = th1 and start = start1)").select("doc", "th", "start", (F.col("start") + F.size("a")).alias("end"))

    runs = distinct.select("sid", F.lit(False).alias("back"), "a", "b", "w").unionByName(distinct.select("sid", F.lit(True).alias("back"), F.reverse("a").alias("a"), F.reverse("b").alias("b"), F.reverse("w").alias("w")))
    runs = cut(with_prefixes(runs, min_words))
    longest = runs.agg(F.max(F.array_max("m"))).first()[0] or 0
    if not longest:
        return copies.distinct()
    # Position of the run's first line in its stretch, whichever way it was read: earlier copies come first.
    begin = F.when(F.col("back"), F.col("lines") - F.col("at") - F.col("m")).otherwise(F.col("at"))
    later = later_copies(suffixes(runs, longest, deal).withColumn("at", begin), deal)
    later = later.join(distinct.select("sid", "doc", "th", "start"), "sid").select("doc", "th", (F.col("start") + F.col("at")).alias("start"), (F.col("start") + F.col("at") + F.col("m")).alias("end"))
    return later.unionByName(copies).distinct()


def ordered(df: DataFrame, doc_id: str) -> Column:
    """The id as it is ordered: whole numbers as such, all else as text; null comes first."""
    whole = isinstance(df.schema[doc_id].dataType, IntegralType)
    return col(doc_id).cast("long" if whole else "string")


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, most_broadcast: int = 1_000_000) -> DataFrame:
    """``df`` with the later copies of repeated line runs deleted from ``text``; n_lines, n_deleted and
    deleted_spans (merged, half-open, in order) tell what was there.

    Copies are ordered by id (null first; ids of another type than whole numbers as text), then by a hash of the text, then by line. Rows that are equal in
    id and text are one document, so repeated rows don't delete each other's lines. A null text stays null and
    has no lines; an empty text has one empty line. Lines without words count towards a run but not its
    words. Columns of the three names are replaced, all others kept; an empty table gives none.
    A text's lines are numbered in one row of an array, so a very long text needs memory in proportion to its lines; the
    work per line doesn't grow with them, blank or repeated lines included.
    Up to ``most_broadcast`` spans are broadcast to the texts; more are joined with them by shuffle.
    """
    df = df.drop("n_lines", "n_deleted", "deleted_spans")
    spans = cut(deletions(df, doc_id, text, min_words))
    doc, th, gone = (free_name(df, x) for x in ("__doc", "__th", "__gone"))
    few = small_enough(spans, most_broadcast)
    per_doc = spans.groupBy(F.col("doc").alias(doc), F.col("th").alias(th)).agg(F.collect_list(F.struct("start", "end")).alias(gone))
    same = ordered(df, doc_id).eqNullSafe(F.col(doc)) & (F.xxhash64(F.coalesce(col(text), F.lit(""))) == F.col(th))
    joined = df.join(F.broadcast(per_doc) if few else per_doc, same, "left").select(*map(col, df.columns), gone)
    where, names = df.columns.index(text), df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for whole, found in zip((x.as_py() for x in batch.column(where)), batch.column(len(names)).to_pylist(), strict=True):
                if whole is None or not found:
                    out.append((whole, 0 if whole is None else whole.count("\n") + 1, 0, []))
                    continue
                lines, merged = whole.split("\n"), []
                for s in sorted((x["start"], x["end"]) for x in found):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1] = (merged[-1][0], max(merged[-1][1], s[1]))
                    else:
                        merged.append(s)
                kept, at = [], 0
                for start, end in merged:
                    kept += lines[at:start]
                    at = end
                kept += lines[at:]
                out.append(("\n".join(kept), len(lines), len(lines) - len(kept), [{"start": a, "end": b} for a, b in merged]))
            texts, n, k, merged_spans = zip(*out, strict=True) if out else ((), (), (), ())
            arrays = [*batch.columns[:where], pa.array(texts, pa.string()), *batch.columns[where + 1 : len(names)], pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(merged_spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "n_lines", "n_deleted", "deleted_spans"])

    spans_type = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
    return joined.mapInArrow(lean(run), StructType([*df.schema.fields, StructField("n_lines", LongType()), StructField("n_deleted", LongType()), StructField("deleted_spans", spans_type)]))
