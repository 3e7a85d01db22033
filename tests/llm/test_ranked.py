import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm import queries, ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for item, ts in asked.items():
        scored = []
        for d, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def found(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("block", [2000, 3])
def test_same_as_scoring_every_document(spark, block):
    rng = random.Random(12)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice(["", "", "1", "é", "Z"])
    docs = [(k, " ".join(word() for _ in range(rng.randrange(1, 30)))) for k in range(300)]
    docs += [(k, "the same copy of Zé") for k in range(300, 380)] + [(7, "twice x"), (7, "twice x"), (None, "copy of nothing"), (381, None), (382, "..."), (383, "word " * 60_000 + "rare")]
    items = [(k, ", ".join(word() for _ in range(rng.randrange(1, 12)))) for k in range(8)] + [(8, "a COPY of zé"), (8, "and more"), (9, None), (10, "unheardof"), (None, "rare twice"), (10, "unheardof")]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string").selectExpr("*", "1 as id", "2 as score")
    got = ranked.search(frame(docs, "doc_id").repartition(7), frame(items, "item_id"), k=20, block=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == brute(docs, items, 20)


def test_bounds_hold_and_are_tight():
    rng = np.random.default_rng(1)
    tf, m = rng.integers(1, 40, 500), rng.integers(50, 4000, 500)
    exact = ranked.shares(tf, m)
    step = -(-exact // ranked.STEP)
    assert step.max() <= 255
    postings = ranked.Postings(pa.array([[0]] * 500, pa.list_(pa.int32())), pa.array([bytes([s]) for s in step]), 1)
    high, low = postings.bounds([(0, 9)])
    assert (low <= 9 * exact).all() and (9 * exact <= high).all() and (high - low < 9 * ranked.STEP).all()


def test_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "three"), ("d", "four"), ("e", "five")], "name string, body string")
    items = spark.createDataFrame([("q", "One")], "item_id string, text string")
    rows = ranked.search(docs, items, id_column="name", text="body").collect()
    assert [(r.item_id, r["rank"], r.name) for r in rows] == [("q", 1, "a"), ("q", 2, "b")]
    assert ranked.search(docs.limit(0), items, id_column="name", text="body").count() == 0
    assert ranked.search(docs, items.limit(0), id_column="name", text="body").count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    read = lambda name, *columns: [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(*columns).collect()]
    assert found(queries.QUERIES["op12_ranked_search"](spark, sf)) == brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"), 50)
