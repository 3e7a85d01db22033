import random

import numpy as np
import xxhash

from siltstone.llm import components, simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, budget=3):
    v = np.array(values, dtype=np.uint64)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= budget
    label = [-1] * len(v)
    for s in range(len(v)):
        if label[s] < 0:
            stack, label[s] = [s], s
            while stack:
                for y in np.flatnonzero(near[stack.pop()]):
                    if label[y] < 0:
                        label[y] = s
                        stack.append(y)
    return label


def test_fingerprint():
    for text in ("", "  ", "one", "One two", "a b c d e", "Ä b\x0bc\x85d", "x " * 70_000):
        assert simhash.simhash(text.encode()) == brute_print(text)


def test_links_keep_all_components_however_they_are_dealt(spark):
    rng = random.Random(2)
    values = {rng.getrandbits(64) for _ in range(30)}
    for b in list(values)[:6]:
        for _ in range(60):
            x = b
            for _ in range(rng.randrange(1, 6)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    values = sorted(values)
    label = brute_components(values)
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "simhash long")
    for hot in (10**6, 40, 2):
        roots = {r.u: r.v for r in components.components(simhash.links(df, 3, hot)).collect()}
        pairs = {(roots.get(simhash.signed(v), simhash.signed(v)), lab) for v, lab in zip(values, label, strict=True)}
        assert len(pairs) == len(set(label)) == len({r for r, _ in pairs})


def test_a_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001)], "u long, v long")
    got = {r.u: r.v for r in components.components(links).collect()}
    assert got == {k: 0 for k in range(1, 301)} | {1001: 1000}
    assert components.components(links.where("u < 0")).collect() == []


def test_documents(spark):
    text = " ".join(f"word{k}" for k in range(400))
    near = text.replace("word7 ", "other ")
    rows = [(9, text, 1), (2, near, 1), (4, "something else entirely here", 1), (5, None, 1), (6, "", 1), (None, " \n", 1), (2, near, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, simhash int")
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == {(9, 2), (2, 2), (4, 4), (5, 5), (6, 5), (None, 5)}
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in simhash.deduplicate(df).collect())
    assert kept == [(False, 2), (False, 4), (False, 5), (True, 0)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == [] and simhash.deduplicate(empty).collect() == []


def test_few_links_go_to_few_tasks(spark):
    chains = [(100 * c + k, 100 * c + k + 1) for c in range(20) for k in range(30)]
    links = spark.createDataFrame(chains, "u long, v long").repartition(40)
    want = {u: 100 * (u // 100) for u in {x for pair in chains for x in pair} if u % 100}
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for most_broadcast in (500_000, 0):
            roots = components.components(links, most_broadcast)
            assert {r.u: r.v for r in roots.collect()} == want
            assert roots.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
