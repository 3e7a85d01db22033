import random

from siltstone.llm import decontaminate

ITEM = "Anna has 5 apples and buys 7 more. How many apples does Anna have after she gives 2 kg to Bert and walks 3 miles home?"


def test_reparameterised_question_and_inconsistent_one(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = [(1, "so: Mary has 15 apples and buys 27 more. How many apples does Mary have after she gives 4 pounds to Tom and walks 8 km home? yes"), (2, "so: Mary has 15 apples and buys 27 more. How many apples does Jane have after she gives 15 pounds to Mary and walks 27 km home? no"), (3, ITEM.upper()), (4, ITEM.lower() + " " + "filler " * 3000), (5, ITEM[:60])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for limit in (200_000, 1):
        got = {r.doc_id: r.share for r in decontaminate.matches(df, bench, most_windows=limit).collect()}
        assert set(got) == {1, 3, 4} and all(s >= 0.8 for s in got.values())


def test_against_brute_force_on_verbatim_copies(spark):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("an", "er", "th", "on", "in") for b in ("ti", "es", "ou", "ly", "nd", "re", "st")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, text(rng.randrange(15, 40))) for k in range(20)]
    docs = []
    for k in range(120):
        t = text(rng.randrange(0, 80))
        if k % 3 == 0:
            t += " " + items[k % 20][1] + " " + text(10)
        docs.append((k, t))
    want = {(i, b) for i, t in docs for b, u in items if f" {u} " in f" {t} "}
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want
    kept = {r.doc_id for r in decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}


def test_edges(spark):
    items = spark.createDataFrame([(1, ITEM, "c"), (1, ITEM, "c"), (2, None, "c"), (3, "", "c"), (4, "two words", "c"), (None, "a b c d e f g", "c")], "item_id long, text string, window string")
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "Two words!", 1), (4, "two words more", 1), (None, ITEM, 1), (6, ITEM, 1), (6, ITEM, 1), (7, "x a b c d e f g y", 1), (8, "1 2 3 4 5 6 " * 20_000, 1)], "doc_id long, text string, share int")
    for limit in (200_000, 1):
        got = sorted(((r.doc_id, r.item_id) for r in decontaminate.matches(docs, items, most_windows=limit).collect()), key=str)
        assert got == sorted([(3, 4), (None, 1), (6, 1), (7, None)], key=str)
    assert decontaminate.matches(docs.where("false"), items).collect() == [] and decontaminate.matches(docs, items.where("false")).collect() == []
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, items).collect()) == [1, 2, 4, 8]


def test_other_text_does_not_outvote_a_copy(spark):
    short = "tom has 5 apples and buys 7 more today"
    first = "Mary has 15 apples and buys 27 more. How many apples does Mary have after she gives 4 pounds to Tom and walks 8 km home?"
    second = "Paul has 6 apples and buys 9 more. How many apples does Paul have after he gives 3 tons to Eva and walks 11 feet home?".replace(" he ", " she ")
    mixed = ITEM.replace("Anna has after", "Jane has after").replace("2 kg", "5 kg").replace("3 miles", "7 miles")
    items = spark.createDataFrame([(1, short), (2, ITEM)], "item_id long, text string")
    docs = [(1, f"{short} and " + "ann has 9 apples and buys some " * 4), (2, f"{first} then {second}"), (3, f"{second} {first} " * 3), (4, mixed), (5, first.replace("apples does", "apples oh dear me does"))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = [sorted((r.doc_id, r.item_id, r.matched, r.windows) for r in decontaminate.matches(df, items, most_windows=limit).collect()) for limit in (200_000, 1)]
    assert rows[0] == rows[1] and {(i, b) for i, b, _, _ in rows[0]} >= {(1, 1), (2, 2), (3, 2)}
    assert all(m == n for i, _, m, n in rows[0] if i == 1) and 4 not in {r[0] for r in rows[0]}
