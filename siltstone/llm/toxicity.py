"""Toxicity by cumulative-link ordinal regression on sparse text features.

One weight per feature is shared by all severity grades; ordered thresholds cut the weighted sum into
grades: P(grade <= k) = logistic(threshold_k - w.x). The features are counts of words and of word beginnings
that are much more frequent in toxic than in other training texts, and the text's length.

The labels only say toxic or not. Grades of the toxic training rows are therefore derived: the number of
hits of their features, cut at its terciles, gives 1, 2 or 3; other rows have grade 0. The model is fitted on
the driver on at most ``sample_rows`` labelled rows; scoring is one pass over the rows without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Container, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from siltstone.llm.common import col, lean, texts_of

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6, 7, 8)
SCORES = StructType([StructField("severity", DoubleType()), StructField("grade", IntegerType()), StructField("toxic_probability", DoubleType()), StructField("toxic", IntegerType())])


def word_features(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in BEGINNINGS if len(word) > n)]


def text_features(text: str, only: Container[str] | None = None) -> Counter:
    """Counts of a text's features, or of those in ``only``."""
    c: Counter = Counter()
    for w, n in Counter(WORD.findall(text.lower())).items():
        for f in word_features(w):
            if only is None or f in only:
                c[f] += n
    return c


@dataclass
class Model:
    weights: dict[str, float]
    length_weight: float
    thresholds: np.ndarray

    def scorer(self, most_words: int = 100_000):
        """A function from text to the weighted sum; it remembers the features of words it has met."""
        known: dict[str, tuple[str, ...]] = {}
        weights = self.weights

        def score(text: str) -> float:
            words = WORD.findall(text.lower())
            if len(known) > most_words:
                known.clear()
            hits: dict[str, int] = defaultdict(int)
            for w in words:
                found = known.get(w)
                if found is None:
                    found = known[w] = tuple(f for f in word_features(w) if f in weights)
                for f in found:
                    hits[f] += 1
            return sum(weights[f] * np.log1p(n) for f, n in hits.items()) + self.length_weight * np.log1p(len(words))

        return score


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_thresholds(x: np.ndarray, grades: np.ndarray, levels: int = 4, rounds: int = 400, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds with the greatest likelihood, by Adam on all rows; the gaps stay positive."""
    n, width = x.shape
    p = np.zeros(width + levels - 1)  # weights, first threshold, logs of the gaps
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, rounds + 1):
        gaps = np.exp(p[width + 1 :])
        cuts = np.concatenate([[-np.inf], p[width] + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]])
        z = (x @ p[:width].astype(x.dtype)).astype(np.float64)
        high, low = logistic(cuts[grades + 1] - z), logistic(cuts[grades] - z)
        high, low = np.where(grades == levels - 1, 1.0, high), np.where(grades == 0, 0.0, low)
        mass = np.maximum(high - low, 1e-9)
        up, down = high * (1 - high) / mass, low * (1 - low) / mass
        g = np.zeros_like(p)
        g[:width] = x.T @ (up - down).astype(x.dtype) / n + decay * p[:width]
        by_cut = np.array([-(up * (grades == k)).sum() + (down * (grades == k + 1)).sum() for k in range(levels - 1)]) / n
        g[width] = by_cut.sum()
        for k in range(levels - 2):
            g[width + 1 + k] = by_cut[k + 1 :].sum() * gaps[k]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return p[:width], p[width] + np.concatenate([[0], np.cumsum(np.exp(p[width + 1 :]))])


def fit_model(texts: list[str], labels: list[int], least_ratio: float = 6.0) -> Model:
    """Fit on texts and their toxic labels. Without a toxic row nothing is ever toxic."""
    # Texts are gone over again for each count, so that memory holds the counts of candidates only.
    rows, totals, chars = Counter(), (Counter(), Counter()), [1, 1]
    for text in (t for t, y in zip(texts, labels, strict=True) if y):
        c = text_features(text)
        rows.update(c.keys())
        totals[1].update(c)
    least = max(3, round(0.005 * sum(labels)))
    candidates = {f for f, n in rows.items() if n >= least}
    words = []
    for text, y in zip(texts, labels, strict=True):
        words.append(len(WORD.findall(text.lower())))
        chars[y] += words[-1]
        if not y:
            totals[0].update(text_features(text, candidates))
    chosen = sorted(f for f in candidates if totals[1][f] / chars[1] >= least_ratio * (totals[0][f] + 0.5) / chars[0])
    if not chosen:
        return Model({}, 0.0, np.array([20.0, 21.0, 22.0]))
    place = {f: k for k, f in enumerate(chosen)}
    x = np.zeros((len(texts), len(chosen) + 1), np.float32)
    hits = np.zeros(len(texts))
    for r, text in enumerate(texts):
        for f, n in text_features(text, place).items():
            x[r, place[f]] = np.log1p(n)
            hits[r] += n
        x[r, -1] = np.log1p(words[r])
    y = np.array(labels)
    terciles = np.quantile(hits[y == 1], [1 / 3, 2 / 3])
    grades = np.where(y == 1, 1 + np.searchsorted(terciles, hits), 0)
    w, cuts = fit_thresholds(x, grades)
    return Model({f: float(w[k]) for f, k in place.items()}, float(w[-1]), cuts)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", sample_rows: int = 6000) -> Model:
    """Fit on at most ``sample_rows`` labelled rows with crc32(id) mod 5 not 0, taken by a hash of the id.

    Rows without an id, or whose label is neither 0 nor 1, are not used; an id with several labels counts
    as toxic if one of them says so.
    """
    known = labels.select(col(doc_id).alias("__id"), col(toxic).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)")
    known = known.where(F.pmod(F.crc32(F.col("__id").cast("string")), F.lit(5)) != 0).groupBy("__id").agg(F.max("__y").alias("__y"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
    rows = docs.select(col(doc_id).alias("__id"), F.coalesce(col(text), F.lit("")).alias("__t")).join(F.broadcast(known), "__id").groupBy("__id").agg(F.min("__t").alias("__t"), F.max("__y").alias("__y"))
    found = sorted(rows.collect())
    return fit_model([r[1] for r in found], [r[2] for r in found])


def score(df: DataFrame, model: Model, text: str = "text", cut_at: float = 0.5) -> DataFrame:
    """``df`` with severity (expected grade, 0 to 3), grade (the likeliest), toxic_probability (of any grade
    above 0) and toxic (1 if that is at least ``cut_at``).

    Null and empty texts have the sum 0 and are thus not toxic under any model that has seen clean texts.
    Columns of these names are replaced, all others kept; equal rows get equal scores.
    """
    df = df.drop(*SCORES.names)
    names = df.columns
    where = names.index(text)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = sent.value.scorer()
        for batch in batches:
            z = np.array([sums(t) for t in texts_of(batch.column(where))], dtype=np.float64)
            above = logistic(z[:, None] - sent.value.thresholds[None, :])  # P(grade > k)
            steps = np.concatenate([np.ones((len(z), 1)), above, np.zeros((len(z), 1))], axis=1)
            out = [above.sum(axis=1), np.argmax(steps[:, :-1] - steps[:, 1:], axis=1).astype(np.int32), above[:, 0], (above[:, 0] >= cut_at).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, out)], [*names, *SCORES.names])

    return df.mapInArrow(lean(run), StructType([*df.schema.fields, *SCORES.fields]))
