"""URL filter: host and path rules, and a character language-model ratio for the rest.

Two variable-order Markov models, of accepted and of rejected URLs, give each character of ``host + path`` a
probability from its longest known context, smoothed by the shorter ones. The score is the difference of the
two log-likelihoods divided by the length; the threshold is calibrated on URLs that the models haven't seen.

Counts are exact: a context with its character is a number of its own, and Spark sums the counts of each. While
there are at most ``most_grams`` of them they are broadcast; of more, chunks of URLs are joined by shuffle with the
counts that they need.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from siltstone.llm.common import col, cut, free_name, lean, small_enough

#: Of dense tables for a few texts (``slots``).
SLOTS = 1 << 19
ORDER = 4
#: Bits of a character (a byte, or a text's beginning) in a code.
BITS = 9
#: Texts of a chunk.
CHUNK = 4096
#: Strength of the shorter context in a longer one's estimate.
PULL = 2.0
BINS = 4000
SPAN = 4.0


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    found = F.regexp_extract(rest(url), r"^([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(rest(url), r"^[^/?#]*([^?#]*)", 1)


def rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host_column: Column, path_column: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null where none fits. ``rules``: verdict, host, path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_column == h) | host_column.endswith("." + h)) & path_column.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of each character with its context (a row per order, 0 to ORDER), of the contexts, and each character's
    text. Different contexts have different codes, and no context has that of a character in one."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    lengths = np.array([len(r) for r in raw], np.int64)
    owner = np.repeat(np.arange(len(raw)), lengths)
    at = np.arange(lengths.sum()) + ORDER * (owner + 1)
    data = np.zeros(lengths.sum() + ORDER * (len(raw) + 1), np.int64)  # 0: a text's beginning is a context of its own
    data[at] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64) + 1
    grams, contexts = [], []
    context = np.zeros(len(at), np.int64)
    for n in range(ORDER + 1):
        if n:
            context = context | data[at - n] << BITS * (n - 1)
        contexts.append(context | n + 1 << BITS * ORDER)
        grams.append(contexts[-1] << BITS | data[at])
    return np.array(grams), np.array(contexts), owner


def slots(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``codes`` folded to SLOTS, for counts of a few texts in dense tables; the queries count by codes."""
    fold = lambda x: ((x.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)).astype(np.int64) % SLOTS
    grams, contexts, owner = codes(texts)
    return fold(grams), fold(contexts), owner


def log_likelihood(grams: np.ndarray, contexts: np.ndarray, gram_counts: np.ndarray, context_counts: np.ndarray) -> np.ndarray:
    """Of each character, from the shortest context to the longest."""
    p = np.full(grams.shape[1], 1 / 256)
    for n in range(ORDER + 1):
        p = (gram_counts[grams[n]] + PULL * p) / (np.maximum(context_counts[contexts[n]], gram_counts[grams[n]]) + PULL)
    return np.log(p)


@dataclass
class Model:
    """Codes in ascending order and their counts by [rejected, accepted]."""

    codes: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, found: pa.Table) -> Model:
        code, *counts = (found.column(c).to_numpy() for c in ("code", "rejected", "accepted"))
        order = np.argsort(code)
        return cls(code[order], np.array([np.append(c[order], 0) for c in counts], np.float64))  # the last is of unknown codes

    def places(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(wanted.shape, np.int64)
        at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        return np.where(self.codes[at] == wanted, at, len(self.codes))

    def score(self, texts: list[str]) -> np.ndarray:
        g, c, owner = codes(texts)
        g, c = self.places(g), self.places(c)
        gain = log_likelihood(g, c, self.counts[1], self.counts[1]) - log_likelihood(g, c, self.counts[0], self.counts[0])
        total = np.bincount(owner, weights=gain, minlength=len(texts))
        return total / np.maximum(np.bincount(owner, minlength=len(texts)), 1)


def count(df: DataFrame, text: str, accepted: str) -> DataFrame:
    """(code, rejected, accepted) of all rows' contexts and characters in them. Each batch is summed before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for y in (0, 1):
                if mine := [t for t, label in zip(texts, labels, strict=True) if label == y]:
                    g, c, _ = codes(mine)
                    code, n = np.unique(np.concatenate([g.ravel(), c.ravel()]), return_counts=True)
                    by = [n, np.zeros_like(n)]
                    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(by[y]), pa.array(by[1 - y])], ["code", "rejected", "accepted"])

    found = df.select(col(text), col(accepted)).mapInArrow(lean(run), "code long, rejected long, accepted long")
    return cut(found.groupBy("code").agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted")))


def score(df: DataFrame, model: Model | DataFrame, text: str, to: str) -> DataFrame:
    if isinstance(model, DataFrame):
        return shuffle_score(df, model, text, to)
    sent = df.sparkSession.sparkContext.broadcast(model)
    where = df.columns.index(text)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sent.value.score([t or "" for t in batch.column(where).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*names, to])

    return df.mapInArrow(lean(run), StructType([*df.schema.fields, StructField(to, DoubleType())]))


def shuffle_score(df: DataFrame, table: DataFrame, text: str, to: str) -> DataFrame:
    """As by a broadcast model, each distinct text in a chunk with the counts of the codes that the chunk holds."""
    texts = df.select(col(text).alias("t")).distinct()
    chunks = max(1, texts.count() // CHUNK)
    texts = texts.select(F.pmod(F.xxhash64("t"), F.lit(chunks)).alias("chunk"), "t")

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, found = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for k in np.unique(chunk).tolist():
                g, c, _ = codes([found[j] or "" for j in np.flatnonzero(chunk == k)])
                code = np.unique(np.concatenate([g.ravel(), c.ravel()]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), k)), pa.array(code)], ["chunk", "code"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        t = left.column("t")
        return pa.table({"t": t, "s": pa.array(Model.of(right).score([x or "" for x in t.to_pylist()]))})

    needed = texts.repartition("chunk").mapInArrow(lean(held), "chunk long, code long").distinct().join(table, "code")
    scored = texts.groupBy("chunk").cogroup(needed.groupBy("chunk")).applyInArrow(run, "t string, s double")
    scored = scored.withColumnsRenamed({"t": free_name(df, "__t"), "s": to})
    return df.join(scored, col(text).eqNullSafe(F.col(scored.columns[0]))).select(*map(col, df.columns), to)


def fit(df: DataFrame, text: str, accepted: str, most_grams: int) -> tuple[Model | DataFrame, float]:
    """Counts of the rows with ``accepted`` 1 or 0 (a model, or the table of more than ``most_grams``), and the least
    score that is allowed; four fifths of the texts are counted, the rest calibrate.

    The threshold is the middle of the scores (on a fixed grid) at which the shares of wrongly allowed and
    wrongly blocked texts have the least sum; without rows of both kinds among the rest it is 0.
    """
    kept = F.pmod(F.crc32(col(text)), F.lit(5)) == 0
    model, threshold = count(df.where(~kept), text, accepted), 0.0
    if small_enough(model, most_grams):
        model = Model.of(model.toArrow())
    width = 2 * SPAN / BINS
    box = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((F.col("__s") + SPAN) / width))).cast("int")
    boxes = score(df.where(kept).select(text, accepted), model, text, "__s").groupBy(box.alias("box"), col(accepted).alias("y")).count().collect()
    hist = np.zeros((2, BINS))
    for b, y, n in boxes:
        hist[y, b] = n
    if hist.sum(axis=1).all():
        share = hist / hist.sum(axis=1, keepdims=True)
        wrong = np.concatenate([[0], np.cumsum(share[1])]) + 1 - np.concatenate([[0], np.cumsum(share[0])])
        best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
        threshold = float(np.median(best)) * width - SPAN
    return model, threshold


def judge(df: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", most_grams: int = 1_000_000) -> DataFrame:
    """``df`` with host, path, rule, verdict (allow or block), score.

    Rows that a rule fits take its verdict and train the models; the others are allowed from the threshold on.
    A null URL, or one without ``://``, has empty host and path, no rule and the score 0. Columns of these
    names are replaced, all others kept; equal URLs get equal verdicts; an empty table gives none.
    """
    df = df.drop("host", "path", "rule", "verdict", "score")
    df = df.withColumn("host", host(col(url))).withColumn("path", path(col(url)))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    text, given, accepted = (free_name(df, x) for x in ("__text", "__given", "__accepted"))
    df = df.withColumn("rule", name).withColumn(given, verdict).withColumn(text, F.concat("host", "path"))
    known = df.where(F.col(given).isNotNull()).select(text, (F.col(given) == "allow").cast("int").alias(accepted))
    model, threshold = fit(known, text, accepted, most_grams)
    out = score(df, model, text, "score")
    return out.withColumn("verdict", F.coalesce(given, F.when(F.col("score") >= threshold, "allow").otherwise("block"))).drop(given, text)
