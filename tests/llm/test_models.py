import random

import numpy as np

from siltstone.llm import quality, toxicity, url_filter
from siltstone.llm.queries import URL_RULES

NICE = "the of and to in that was for with this from have which were their there been would when will".split()
RUDE = "idiot moron scum loser".split()


def sentences(rng, n, words=NICE):
    return "\n".join(" ".join(rng.choice(words) for _ in range(rng.randrange(5, 20))).capitalize() + "." for _ in range(n))


def toxic_corpus(n=400):
    rng = random.Random(4)
    docs, labels = [], []
    for k in range(n):
        t = sentences(rng, rng.randrange(1, 8))
        if k % 4 == 0:
            w = t.split()
            for _ in range(1 + len(w) // 25):
                w.insert(rng.randrange(len(w)), rng.choice(RUDE))
            t = " ".join(w)
        docs.append((k, t))
        labels.append((k, int(k % 4 == 0)))
    return docs, labels


def test_ordered_thresholds_and_gradient():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(300, 2)), np.ones((300, 1))], axis=1)
    grades = np.clip(np.floor(x[:, 0] + 1.5 + 0.1 * rng.normal(size=300)), 0, 3).astype(int)
    w, cuts = toxicity.fit_thresholds(x, grades, rounds=800)
    assert (np.diff(cuts) > 0).all()
    got = (x @ w)[:, None] > cuts[None, :]
    assert (got.sum(axis=1) == grades).mean() > 0.9


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert sum(got[i].toxic == y for i, y in labels) >= 0.98 * len(labels)
    assert all(0 <= r.severity <= 3 and (r.severity > 0.5) == bool(r.toxic or r.severity > 0.5) for r in got.values())


def test_toxicity_edges(spark):
    docs, labels = toxic_corpus(80)
    rows = [(None, "idiot moron scum", 1.5), (1, None, 0.0), (2, "", 0.0), (3, "the " * 60_000, 0.0), (3, "the " * 60_000, 0.0)]
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (3, None), (4, 7)], "doc_id long, toxic int"))
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, severity double"), model).collect()
    assert len(got) == 5 and [r.toxic for r in got if r.doc_id is not None] == [0, 0, 0, 0]
    none = toxicity.fit(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.toxic for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, severity double"), none).collect()] == [0] * 5


def junk(rng, n):
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join([rng.choice(NICE)] * 40 * n)
    if kind == 1:
        return "\n".join(" | ".join(rng.choice(NICE) for _ in range(12)) for _ in range(n))
    return "\n".join(" ".join(rng.choice(NICE).upper() + "!!" for _ in range(12)) for _ in range(n))


def test_quality_on_held_out_rows(spark):
    rng = random.Random(8)
    docs = [(k, junk(rng, 3) if k % 3 == 0 else sentences(rng, 6)) for k in range(300)]
    docs += [(k, sentences(rng, 1) + "\n" + junk(rng, 6)) for k in range(300, 360)]  # a good line before much junk
    labels = [(k, int(k % 3 != 0) if k < 300 else 0) for k, _ in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = quality.fit(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r.doc_id: r for r in quality.score(df.withColumn("held", quality.held_out(df.doc_id)), model).collect()}
    held = [(got[i].predicted, y) for i, y in labels if got[i].held]
    assert len(held) > 30 and sum(p == y for p, y in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_marginals_against_enumeration():
    rng = np.random.default_rng(3)
    node, move, starts = rng.normal(size=(9, 2)), rng.normal(size=(2, 2)), np.array([0, 4, 5, 9])
    p, pairs, log_z = quality.marginals(node, move, starts)
    total = np.zeros((2, 2))
    for c in range(3):
        a, b = starts[c], starts[c + 1]
        z, mass = 0.0, np.zeros((b - a, 2))
        for code in range(2 ** (b - a)):
            y = [code >> k & 1 for k in range(b - a)]
            weight = np.exp(sum(node[a + k, y[k]] for k in range(b - a)) + sum(move[y[k], y[k + 1]] for k in range(b - a - 1)))
            z += weight
            for k in range(b - a):
                mass[k, y[k]] += weight
        assert np.allclose(p[a:b], mass / z) and np.isclose(log_z[c], np.log(z))
        for code in range(2 ** (b - a)):
            y = [code >> k & 1 for k in range(b - a)]
            weight = np.exp(sum(node[a + k, y[k]] for k in range(b - a)) + sum(move[y[k], y[k + 1]] for k in range(b - a - 1)))
            for k in range(b - a - 1):
                total[y[k], y[k + 1]] += weight / z
    assert np.allclose(pairs, total)


def test_quality_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "\n\n", "x"), (4, "word " * 50_000, "x"), (4, "word " * 50_000, "x"), (None, "É | ß", "x"), (5, "\n".join(["a b"] * 5000), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    empty = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (empty, spark.createDataFrame([(4, 1), (5, 1), (None, 0), (1, None)], "doc_id long, quality int")):
        got = quality.score(df, quality.fit(df, labels)).collect()
        assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert quality.score(df.where("false"), quality.fit(df, empty)).collect() == []


def test_url_parts_and_rules(spark):
    urls = [("http://A.Example.COM/en/1?x#y", "a.example.com", "/en/1", "example.com/en/", "block"), ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"), ("ftp://x.com", "x.com", "", None, None), ("http://x.com?q=/en/", "x.com", "", None, None), ("net/es/", "", "", None, None), (None, "", "", None, None), ("http://com/", "com", "/", "com/", "allow"), ("http://xnet/fr/", "xnet", "/fr/", None, None), ("http://ÄB.net/fr/#a", "Äb.net", "/fr/", "net/fr/", "block"), ("a://b://c/d", "b:", "//c/d", None, None)]
    df = spark.createDataFrame([(k, u[0], 1) for k, u in enumerate(urls)] + [(0, urls[0][0], 1)], "page_id long, url string, host int")
    got = url_filter.judge(df, URL_RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        _, host, path, rule, verdict = urls[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block") and verdict in (None, r.verdict)
    assert url_filter.judge(df.where("false"), URL_RULES).collect() == []


def test_url_model_learns_the_rules(spark):
    rng = random.Random(0)
    rows = [(k, f"http://{'shop-pills' if k % 2 else 'library'}{rng.randrange(9)}.example.{'com' if k % 3 else 'org'}/{rng.randrange(999)}") for k in range(900)]
    rules = [("block", f"shop-pills{n}.example.com", "/") for n in range(9)] + [("allow", f"library{n}.example.com", "/") for n in range(9)]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).where("rule is null").collect()
    assert len(got) == 300 and all(r.verdict == ("block" if r.page_id % 2 else "allow") for r in got)


def test_url_likelihoods_add_up():
    """With one class's counts the probabilities of all characters after a context sum to about one."""
    texts = ["abcabd", "abx"] * 5
    g, c, _ = url_filter.slots(texts)
    grams, contexts = np.bincount(g.ravel(), minlength=url_filter.SLOTS).astype(float), np.bincount(c.ravel(), minlength=url_filter.SLOTS).astype(float)
    probe = ["ab" + chr(k) for k in range(1, 128)]
    g, c, owner = url_filter.slots(probe)
    last = np.flatnonzero(np.diff(np.append(owner, -1)))
    assert 0.9 < np.exp(url_filter.log_likelihood(g, c, grams, contexts))[last].sum() < 1.01
