import random

from siltstone.llm import neardup


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def agree(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def brute(docs):
    sets, root = [grams(t) for _, t in docs], list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if agree(sets[i], sets[j]) and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    return {i: min(docs[k][0] for k in range(len(docs)) if root[k] == root[at]) for at, (i, _) in enumerate(docs)}


def corpus():
    rng = random.Random(8)
    line = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    common, docs = line(14), [(0, None), (1, ""), (2, "a b"), (3, "A  b"), (4, "a b c")]
    for _ in range(60):
        text = line(rng.randrange(20, 160)).split()
        docs.append((len(docs), " ".join(text) + (" " + common if rng.random() < 0.8 else "")))
        for _ in range(rng.randrange(4)):
            other = list(text)
            for _ in range(rng.randrange(1, 4)):
                other[rng.randrange(len(other))] = "other"
            docs.append((len(docs), " ".join(other)))
    return docs


def test_components_against_brute_force(spark, monkeypatch):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    assert len(set(want.values())) < len(docs) - 30
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()} == want
    assert {r.doc_id for r in neardup.deduplicate(df, most_broadcast=0).collect()} == set(want.values())
    monkeypatch.setattr(neardup, "MANY", 0)
    monkeypatch.setattr(neardup, "ROUNDS", 2)
    monkeypatch.setattr(neardup, "FREQUENT", 2)
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()} == want


def test_the_pipeline_drops_what_agrees_to_four_fifths(spark):
    import corpus_pipeline

    docs = corpus()
    df = spark.createDataFrame([(i, t, "en") for i, t in docs], "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()} == set(brute(docs).values())


def test_pairs_agree_alike_with_and_without_a_broadcast_and_without_ids(spark):
    docs = corpus()[:80]
    links = []
    for named, limit in ((True, 1_000_000), (True, 0), (False, 1_000_000)):
        df = spark.createDataFrame([(i if named else None, t) for i, t in docs], "doc_id long, text string")
        nodes = neardup.cut(neardup.sets(df).groupBy("node").agg(neardup.F.min("doc_id").alias("least")))
        names = nodes.select("node")
        pairs = neardup.cut(names.withColumnRenamed("node", "u").join(names.withColumnRenamed("node", "v"), neardup.F.col("u") < neardup.F.col("v")))
        links.append({tuple(r) for r in neardup.agreeing(pairs, df, nodes, 0.8, limit).collect()})
    sets = {neardup.distinct(neardup.simhash.shingle_hashes((t or "").encode(), 5))[0]: grams(t) for _, t in docs}
    want = {(u, v) for u in sets for v in sets if u < v and agree(sets[u], sets[v])}
    assert links == [want] * 3 and len(want) > 10


def test_packed_numbers_come_back():
    for n in (0, 1, 1000):
        numbers = neardup.np.sort(neardup.np.random.default_rng(n).integers(0, 2**64, n, dtype=neardup.np.uint64))
        assert neardup.np.array_equal(neardup.unpacked(neardup.packed(numbers), n), numbers)
        assert neardup.np.array_equal(neardup.np.cumsum(neardup.unpacked(neardup.packed(neardup.steps(numbers)), n), dtype=neardup.np.uint64), numbers)
