import hashlib
import random
import re

from siltstone.llm import infill, queries

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def brute(doc, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    spm = h[3] % 100 < 80
    return n, "spm" if spm else "psm", p, m, s, f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def test_parts_and_round_trip(spark):
    rng = random.Random(13)
    pieces = [" ", "\t\n", "a", "Ä", "\x01", "\x02", "\x02d", "\x02e", "<", "<P", "P>", "S>", "<M", "$0", "\\", " ", "\x85", "😀", "word"]
    rows = [(k, "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))) for k in range(600)]
    rows += [(None, "a b c"), (700, None), (701, ""), (702, "   "), (703, "x <S> y"), (704, "w " * 150_000), (705, " " * 100_000), (706, "twice the same"), (706, "twice the same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as Form", "1 as body")
    out = infill.fill_in_middle(docs)
    assert out.columns == ["doc_id", "text", "body", "n", "form", "prefix", "middle", "suffix", "output"]
    back = out.select("*", infill.restored(out.output, out.form).alias("back")).collect()
    assert len(back) == len(rows)
    for r in back:
        assert tuple(r[c] for c in ("n", "form", "prefix", "middle", "suffix", "output")) == brute(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in back} == {"plain", "psm", "spm"}


def test_other_tags_text_ids_and_no_rows(spark):
    docs = spark.createDataFrame([("k", "one two three"), ("k", "one two three")], "name string, body string")
    out = infill.fill_in_middle(docs, "name", "body", rate=100, tags=("<fim_p>", "<fim_s>", "<fim_m>"))
    back = out.select(infill.restored(out.output, out.form, ("<fim_p>", "<fim_s>", "<fim_m>")).alias("t"), "form").collect()
    assert [(r.t, r.form != "plain") for r in back] == [("one two three", True)] * 2
    assert infill.fill_in_middle(docs.limit(0), "name", "body").count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_fill_in_middle"](spark, sf).collect()
    assert len(rows) == len(texts)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in rows:
        n, form, p, m, _, output = brute(r.doc_id, texts[r.doc_id])
        parts = (None, None) if form == "plain" else (len(p), len(m))
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, *parts, sha(output), sha(texts[r.doc_id] or ""))
