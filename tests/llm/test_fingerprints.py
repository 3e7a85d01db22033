import hashlib
import unicodedata

from pyspark.sql import functions as F

from siltstone.llm import fingerprints


def canon(text):
    for form in ("fold", "NFKC"):
        text = unicodedata.normalize("NFKC", text).casefold() if form == "fold" else unicodedata.normalize("NFKC", text)
    return " ".join(text.split())


ROWS = [(5, "Ab  c"), (1, "ab c "), (2, None), (3, ""), (4, " \t\n"), (7, "É"), (6, "é"), (8, "ﬁ Straße"), (9, "fi STRASSE"), (9, "fi STRASSE"), (None, "ab c"), (10, "x" * 200_000)]


def test_groups_are_those_of_the_canonical_texts(spark):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in ROWS], "doc_id long, text string, fingerprint string, copies int")
    got = fingerprints.fingerprint(df).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for i, t in ROWS:
        groups.setdefault(canon(t or ""), []).append(i)
    by_print = {}
    for r in got:
        by_print.setdefault(r.fingerprint, []).append(r)
    assert sorted(sorted(map(str, g)) for g in groups.values()) == sorted(sorted(str(r.doc_id) for r in rows) for rows in by_print.values())
    for rows in by_print.values():
        ids = [r.doc_id for r in rows if r.doc_id is not None]
        assert {r.group_id for r in rows} == {min(ids)} and {r.copies for r in rows} == {len(rows)}


def test_next_row_over_uneven_keys_ties_and_nulls(spark):
    for keys in ([3], [1, 2, 3], [0, 10**15, 7, 7, -5, None], list(range(0, 900, 3)) + [10**12]):
        df = spark.createDataFrame([(k, f"t{k}-{n}") for n, k in enumerate(keys)], "k long, v string")
        got = fingerprints.with_next(df, "k", ["v"], rows_per_bucket=4).collect()
        rows = sorted(((k if k is not None else -(2**63), f"t{k}-{n}") for n, k in enumerate(keys)))
        want = sorted((v, rows[(j + 1) % len(rows)][1]) for j, (_, v) in enumerate(rows))
        assert sorted((r.v, r.next_v) for r in got) == want
    assert fingerprints.with_next(spark.createDataFrame([], "k long, v string"), "k", ["v"]).collect() == []


def test_edited_text_counts_code_points(spark):
    cases = [("abcd", "xyz"), ("abcde", "x"), ("", "x"), ("😀é日x", "日本"), ("a", "b")]
    df = spark.createDataFrame(cases, "a string, b string").select("a", "b", fingerprints.edited(F.col("a"), F.col("b")).alias("e"))
    for r in df.collect():
        half = len(r.a) // 2
        assert r.e == r.a[: len(r.a) - half] + r.b[:half]


def test_a_collision_does_not_merge_texts(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "digest", lambda c: F.lit("0" * 64) if c is not None else c)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    got = {r.doc_id: (r.group_id, r.copies) for r in fingerprints.fingerprint(df).collect()}
    assert got == {1: (1, 2), 3: (1, 2), 2: (2, 1)}


def test_empty_table(spark):
    assert fingerprints.fingerprint(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_holds_against_brute_force(spark, tmp_path):
    from siltstone.llm.queries import QUERIES

    docs = [(2 * k, f"Text {k % 7} " * (k % 5)) for k in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op3_fingerprints"](spark, str(tmp_path)).collect()}
    for k, (i, t) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + following[:half]
        assert got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert (got[i].near_edited, got[i].near_next) == (float(canon(e) == canon(t)), float(canon(t) == canon(following)))
