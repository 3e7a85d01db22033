import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import linededup
from siltstone.llm.common import table
from siltstone.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, min_words):
    """Every run that begins earlier as well, by comparing all pairs of lines."""
    lines = [t.split("\n") for t in docs]
    words = [[len(WORD.findall(x)) for x in d] for d in lines]
    places = [(d, i) for d in range(len(lines)) for i in range(len(lines[d]))]
    gone = [set() for _ in lines]
    for d, i in places:
        best = 0
        for e, k in places:
            if (e, k) >= (d, i):
                break
            n = 0
            while i + n < len(lines[d]) and k + n < len(lines[e]) and lines[d][i + n] == lines[e][k + n]:
                n += 1
            best = max(best, n)
        if best and sum(words[d][i : i + best]) >= min_words:
            gone[d] |= set(range(i, i + best))
    return ["\n".join(x for k, x in enumerate(line) if k not in g) for line, g in zip(lines, gone, strict=True)]


def run(spark, docs, min_words):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    return [r.text for r in linededup.deduplicate(df, min_words=min_words).orderBy("doc_id").collect()]


def test_against_brute_force(spark):
    rng = random.Random(5)
    docs = ["\n".join(rng.choice(["a", "b c", "d e f", "", "x y"]) for _ in range(rng.randrange(0, 25))) for _ in range(40)]
    for min_words in (4, 11):
        assert run(spark, docs, min_words) == brute(docs, min_words)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b b", "c c c"]), max_size=8), min_size=1, max_size=8))
def test_any_small_corpus(spark, docs):
    texts = ["\n".join(d) for d in docs]
    assert run(spark, texts, 3) == brute(texts, 3)


def test_tail_of_a_maximal_run_goes_too(spark):
    passage = " ".join(f"w{k}" for k in range(60)) + "\nshort tail"
    got = run(spark, [f"intro\n{passage}\nend one", f"other\n{passage}\nend two"], 50)
    assert got == [f"intro\n{passage}\nend one", "other\nend two"]


def test_edges(spark):
    long = "\n".join(f"line {k} of a long text" for k in range(3000))
    rows = [(1, long, 9, "x"), (1, long, 9, "x"), (2, None, 0, "y"), (3, "", 0, "z"), (None, "alone", 1, "n"), (4, long, 1, "copy")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, `__doc` string")
    got = sorted(linededup.deduplicate(df).collect(), key=str)
    assert len(got) == 6
    by = {(r.doc_id, r["__doc"]): r for r in got}
    assert by[1, "x"].text == long and by[4, "copy"].text == "" and by[4, "copy"].n_deleted == 3000
    assert by[2, "y"].text is None and by[2, "y"].n_lines == 0 and by[3, "z"].text == "" and by[None, "n"].text == "alone"
    assert linededup.deduplicate(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_ids_of_text_and_blank_lines_in_linear_time(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    df = spark.createDataFrame([("b", f"x\n{passage}\nend"), ("a", f"{passage}\nother"), (None, passage)], "doc_id string, text string")
    assert {r.doc_id: r.n_deleted for r in linededup.deduplicate(df).collect()} == {None: 0, "a": 1, "b": 1}
    times = []
    for n in (2_000, 30_000):
        blank = f"{passage}" + "\n" * n + passage
        began = time.time()
        rows = linededup.deduplicate(spark.createDataFrame([(1, blank), (2, "start\n" + blank)], "doc_id long, text string")).orderBy("doc_id").collect()
        times.append(time.time() - began)
        assert rows[0].n_deleted == 1 and rows[1].text == "start"
    assert times[1] < 6 * times[0]


def test_ranks_decide(spark, monkeypatch):
    """With ranks that don't tell lines apart, unlike runs would be taken for copies."""
    texts = [" ".join(f"{d}w{k}" for k in range(30)) + "\n" + "shared " * 30 + "\n" + d for d in "abc"] * 2
    want = brute(texts, 50)
    assert run(spark, texts, 50) == want
    whole = linededup.ranked
    monkeypatch.setattr(linededup, "ranked", lambda *a: whole(*a).withColumn("rank", linededup.F.lit(1).cast("long")))
    assert run(spark, texts, 50) != want


def test_the_query_against_all_pairs_of_windows(spark):
    """The query's rows on a whole table against a dictionary of all windows of whole lines with 50 words."""
    sf_dir = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    seen, gone = set(), {k: set() for k in docs}
    for back in (False, True):
        for k in sorted(docs):
            lines = (docs[k] or "").split("\n")
            words = [len(WORD.findall(x)) for x in lines]
            spans = []
            for i in range(len(lines)):
                ends = range(i + 1, len(lines) + 1) if not back else range(len(lines) - i, -1, -1)
                for e in ends:
                    b, z = (i, e) if not back else (e, len(lines) - i)
                    if sum(words[b:z]) >= 50:
                        spans.append((b, z))
                        break
            for b, z in sorted(spans):
                name = (back, tuple(lines[b:z]))
                if name in seen:
                    gone[k] |= set(range(b, z))
                seen.add(name)
    rows = {r.doc_id: r for r in QUERIES["op1_line_dedup"](spark, sf_dir).collect()}
    assert {k: r.n_deleted for k, r in rows.items()} == {k: len(g) for k, g in gone.items()}
    assert all(r.text == (None if docs[k] is None else "\n".join(x for j, x in enumerate(docs[k].split("\n")) if j not in gone[k])) for k, r in rows.items())
