"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line's potential comes from its own features and those of the lines
before and after it; neighbouring labels are tied by transition weights. A document's score is the mean of
the lines' forward-backward marginals of "good", weighted by their lengths. Training lines carry their
document's label. The model is fitted on the driver on at most ``sample_rows`` labelled rows; scoring is one
pass without a shuffle, each document by itself, so it may have any number of lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from siltstone.llm.common import col, lean, texts_of

UPPER, LOWER, DIGIT, SPACE, PIPE, SHOUT, MILD, SYMBOL, WIDE, NEWLINE, KINDS = range(11)
SCORES = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("n_lines", LongType()), StructField("bad_lines", LongType())])


def byte_kinds() -> np.ndarray:
    kinds = np.full(256, SYMBOL, np.int64)
    kinds[128:] = WIDE
    for chars, kind in (("ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER), ("abcdefghijklmnopqrstuvwxyz", LOWER), ("0123456789", DIGIT), (" \t\r", SPACE), ("|", PIPE), ("!", SHOUT), (".,;:?'\"-()", MILD), ("\n", NEWLINE)):
        kinds[[ord(c) for c in chars]] = kind
    return kinds


BYTE_KINDS = byte_kinds()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of features per line of all texts, the lines' lengths (in bytes) and where each text's lines begin.

    A text always has a line: the empty text has one empty line.
    """
    raw = "\n".join(texts).encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    lines = [line for t in texts for line in t.split("\n")]
    starts = np.concatenate([[0], np.cumsum([t.count("\n") + 1 for t in texts])]).astype(np.int64)
    kinds = BYTE_KINDS[data]
    line_of = np.cumsum(kinds == NEWLINE)
    line_of -= kinds == NEWLINE  # a newline counts with the line that it ends
    counts = np.bincount(line_of * KINDS + kinds, minlength=len(lines) * KINDS).reshape(-1, KINDS).astype(np.float64) if len(data) else np.zeros((len(lines), KINDS))
    counts = counts[: len(lines)]
    counts[:, NEWLINE] = 0
    size = counts.sum(axis=1)
    words = np.zeros((len(lines), 3))
    for k, line in enumerate(lines):
        w = line.split()
        if w:
            words[k] = len(w), len(set(w)), sum(map(eq, w, w[1:])) if len(w) > 1 else 0
    n = np.maximum(words[:, 0], 1)
    share = counts / np.maximum(size, 1)[:, None]
    letters = np.maximum(counts[:, UPPER] + counts[:, LOWER], 1)
    upper = counts[:, UPPER] / letters
    repeated = 1 - words[:, 1] / n
    own = np.stack(
        [
            upper, upper > 0.5, share[:, DIGIT], 4 * share[:, SYMBOL], share[:, SYMBOL] > 0.04, 4 * share[:, PIPE], share[:, PIPE] > 0.01,
            4 * share[:, SHOUT], share[:, SHOUT] > 0.02, 4 * share[:, MILD], repeated, repeated * (words[:, 0] > 8), words[:, 2] / n,
            words[:, 2] > 3, np.log1p(words[:, 0]) / 4, words[:, 0] <= 2, (size - counts[:, SPACE]) / n / 10, size == 0,
        ],
        axis=1,
    ).astype(np.float64)
    first, last = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    first[starts[:-1]] = last[starts[1:] - 1] = True
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    x = np.concatenate([own, before, after, first[:, None], last[:, None], np.ones((len(lines), 1))], axis=1)
    return x, size, starts


def marginals(node: np.ndarray, move: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once: P(label) per line, the summed P(pair) of neighbours, log Z per chain.

    ``node`` has the lines' log potentials of the two labels, ``move`` those of the transitions.
    """
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = starts[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # chains that have a line t
    e = np.exp(node - node.max(axis=1, keepdims=True))
    a, b, scale = np.zeros_like(e), np.ones_like(e), np.ones(len(e))
    t_exp = np.exp(move)
    for t in range(longest):
        at = begin[: active[t]] + t
        cur = e[at] if t == 0 else (a[at - 1] @ t_exp) * e[at]
        scale[at] = cur.sum(axis=1)
        a[at] = cur / scale[at][:, None]
    for t in range(longest - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        b[at] = (e[at + 1] * b[at + 1]) @ t_exp.T / scale[at + 1][:, None]
    p = a * b
    p /= p.sum(axis=1, keepdims=True)
    inner = np.ones(len(e), bool)
    inner[starts[1:] - 1] = False
    i = np.flatnonzero(inner)
    pairs = np.einsum("ni,ij,nj->ij", a[i], t_exp, e[i + 1] * b[i + 1] / scale[i + 1][:, None]) if len(i) else np.zeros((2, 2))
    log_z = np.add.reduceat(np.log(scale) + node.max(axis=1), starts[:-1]) if len(sizes) else np.zeros(0)
    return p, pairs, log_z


@dataclass
class Model:
    weights: np.ndarray  # log-odds of good against bad, per feature
    move: np.ndarray
    slope: float = 1.0  # of the document's log-odds in those of its mean marginal
    offset: float = 0.0

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: the weighted mean marginal of good, its lines, and how many are likelier bad."""
        x, size, starts = line_features(texts)
        half = x @ self.weights / 2
        p, _, _ = marginals(np.stack([-half, half], axis=1), self.move, starts)
        weight = size + 1e-6  # lines without text count only where there is nothing else
        good = np.add.reduceat(p[:, 1] * weight, starts[:-1]) / np.add.reduceat(weight, starts[:-1])
        odds = np.log(np.clip(good, 1e-6, 1 - 1e-6) / (1 - np.clip(good, 1e-6, 1 - 1e-6)))
        good = 1 / (1 + np.exp(-(self.slope * odds + self.offset)))
        return good, np.diff(starts), np.add.reduceat((p[:, 1] < 0.5).astype(np.int64), starts[:-1])


def fit_model(texts: list[str], labels: list[int], rounds: int = 150, decay: float = 1e-3) -> Model:
    """The greatest conditional likelihood of the labels, by Adam on all chains; without both labels, a model of no features."""
    if len(set(labels)) < 2:
        x, _, _ = line_features([""])
        w = np.zeros(x.shape[1])
        w[-1] = 6.0 * (2 * labels[0] - 1) if labels else 0.0
        return Model(w, np.zeros((2, 2)))
    x, _, starts = line_features(texts)
    y = np.repeat(np.array(labels), np.diff(starts))
    lines = len(y)
    inner = np.ones(lines, bool)
    inner[starts[1:] - 1] = False
    i = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[i], y[i + 1]), 1)
    p = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, rounds + 1):
        half = x @ p[:-4] / 2
        got, pairs, _ = marginals(np.stack([-half, half], axis=1), p[-4:].reshape(2, 2), starts)
        g = np.concatenate([x.T @ (got[:, 1] - y) / lines, (pairs - seen).ravel() / lines]) + decay * p
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    model = Model(p[:-4], p[-4:].reshape(2, 2))
    return calibrated(model, texts, np.array(labels))


def calibrated(model: Model, texts: list[str], labels: np.ndarray, rounds: int = 500) -> Model:
    """Scale the documents' log-odds so that scores are probabilities of a good label on the training rows."""
    mean, _, _ = model.score(texts)
    odds = np.log(mean / (1 - mean))
    scale = max(1.0, float(np.abs(odds).max()))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        miss = 1 / (1 + np.exp(-np.clip(a * odds / scale * 4 + b, -40, 40))) - labels
        a -= 2.0 * float((miss * odds / scale * 4).mean())
        b -= 2.0 * float(miss.mean())
    model.slope, model.offset = max(a, 0.01) * 4 / scale, b
    return model


def held_out(doc_id) -> object:
    """Whether a row is kept from training: crc32 of its id as text, mod 5, is 0."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality", sample_rows: int = 4000) -> Model:
    """Fit on at most ``sample_rows`` labelled rows that aren't held out, taken by a hash of the id.

    Rows without an id or a label of 0 or 1 are not used; an id with several labels counts as good only
    if all say so.
    """
    known = labels.select(col(doc_id).alias("__id"), col(quality).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)")
    known = known.where(~held_out(F.col("__id"))).groupBy("__id").agg(F.min("__y").alias("__y"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
    rows = docs.select(col(doc_id).alias("__id"), F.coalesce(col(text), F.lit("")).alias("__t")).join(F.broadcast(known), "__id").groupBy("__id").agg(F.min("__t").alias("__t"), F.min("__y").alias("__y"))
    found = sorted(rows.collect())
    return fit_model([r[1] for r in found], [r[2] for r in found])


def score(df: DataFrame, model: Model, text: str = "text", cut_at: float = 0.3, most_bytes: int = 2_000_000) -> DataFrame:
    """``df`` with score (0 to 1, likelihood of good quality), predicted (1 if score >= ``cut_at``), n_lines, bad_lines.

    A null text is scored as the empty text, which is one empty line. Columns of these names are replaced,
    all others kept; equal texts get equal scores; an empty table gives none.
    """
    df = df.drop(*SCORES.names)
    names = df.columns
    where = names.index(text)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(where)), 0).to_pylist()
            begin = 0
            while begin < len(sizes):
                end, total = begin, 0
                while end < len(sizes) and (end == begin or total + sizes[end] <= most_bytes):
                    total += sizes[end]
                    end += 1
                good, lines, bad = sent.value.score(list(texts_of(batch.column(where).slice(begin, end - begin))))
                out = [good, (good >= cut_at).astype(np.int32), lines.astype(np.int64), bad]
                yield pa.RecordBatch.from_arrays([*(c.slice(begin, end - begin) for c in batch.columns), *map(pa.array, out)], [*names, *SCORES.names])
                begin = end

    return df.mapInArrow(lean(run), StructType([*df.schema.fields, *SCORES.fields]))
