"""Each operator's way beyond its broadcast bound gives the rows of the way below it."""

from siltstone.llm import decontaminate, fingerprints, linededup, simhash

PASSAGE = " ".join(f"w{k}" for k in range(60))
ROWS = [(1, f"a start\n{PASSAGE}\nan end"), (2, f"other\n{PASSAGE}\nlast"), (3, f"a start\n{PASSAGE}\nan end"), (4, None), (5, ""), (None, "x"), (7, "x"), (7, "x")]


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def rows(df):
    return sorted(map(str, df.collect()))


def test_fingerprint_copies(spark):
    assert rows(fingerprints.copies(frame(spark), most_broadcast=0)) == rows(fingerprints.copies(frame(spark)))


def test_line_dedup(spark):
    assert rows(linededup.deduplicate(frame(spark), most_broadcast=0)) == rows(linededup.deduplicate(frame(spark)))


def test_near_duplicates(spark):
    few, many = simhash.deduplicate(frame(spark)), simhash.deduplicate(frame(spark), most_broadcast=0)
    assert rows(few) == rows(many) and few.count() == 5


def test_decontamination(spark):
    items = spark.createDataFrame([(1, PASSAGE), (2, "x")], "item_id long, text string")
    want = rows(decontaminate.decontaminate(frame(spark), items))
    assert rows(decontaminate.decontaminate(frame(spark), items, most_broadcast=0, most_windows=1)) == want
    assert len(want) == 2
