import random

import corpus_pipeline


def test_stages_on_a_planted_corpus(spark, tmp_path):
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in ("an", "er", "th", "on", "in", "ti") for b in ("es", "ou", "ly", "nd", "re", "st") for c in ("", "al", "ing")]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    docs = {k: "\n".join(line(rng.randrange(8, 20)) for _ in range(8)) for k in range(120)}
    labels = [(k, 1, int(k % 6 == 0)) for k in range(100)]
    for k in range(0, 120, 6):
        docs[k] = docs[k].replace(" ", " idiot ", 3).replace(". ", " moron scum. ", 1) + "\nidiot moron scum loser here."
    passage = line(70)
    docs[41] += "\n" + passage
    docs[43] += "\n" + passage
    docs[55] = docs[53]
    docs[63] = docs[61].replace(docs[61].split()[0], "other", 1)
    item = line(30)
    docs[77] = docs[77] + "\nsee " + item + " end"
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    write([(k, t, "en", "s", len(t)) for k, t in docs.items()] + [(500, None, None, None, None), (501, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long", "documents")
    write(labels, "doc_id long, quality int, toxic int", "labels")
    write([(1, item)], "item_id long, text string", "benchmark")

    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen, names = {}, rows.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, str(tmp_path))
        out.write.parquet(f"{tmp_path}/stage{k}")
        rows = spark.read.parquet(f"{tmp_path}/stage{k}")
        seen[name] = {r.doc_id: r for r in rows.collect()}
        if k < 4:
            assert rows.columns == names
    toxic = {k for k in range(120) if k % 6 == 0}
    assert toxic.isdisjoint(seen["toxicity"]) and len(seen["toxicity"]) == 122 - len(toxic)
    after = seen["line dedup"]
    assert passage in after[41].text and passage not in after[43].text and after[43].n_chars == len(after[43].text)
    assert 55 not in after and after[500].text is None and after[501].text == ""
    assert 77 not in seen["benchmark decontamination"] and 500 in seen["SimHash near-dedup"] and 501 not in seen["SimHash near-dedup"]
    clean = {k for k in range(120) if k % 6 and k not in (55, 63, 77)}
    last = seen["BPE encoding and decoding"]
    assert clean <= set(last) and all(last[k].n_tokens == len(last[k].ids) > 0 for k in clean)
    assert {(r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {(i, r.n_tokens) for i, r in last.items()}
