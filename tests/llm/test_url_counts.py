import math
import random
import zlib
from collections import Counter

from siltstone.llm import url_filter


def test_scores_against_exact_counts(spark):
    rng = random.Random(3)
    text = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789-") for _ in range(40))
    rows = [(k, f"http://{'good' if k % 2 else 'bad'}.example/{text()}") for k in range(4000)] + [(4000, "http://else.example/" + text()), (4001, None)]
    rules = [("allow", "good.example", "/"), ("block", "bad.example", "/")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    counts = {y: Counter() for y in "gb"}
    for _, url in rows[:4000]:
        t = url[7:]
        if zlib.crc32(t.encode()) % 5:
            t = "\0" * 4 + t
            counts[t[4]].update(t[k - n : k + e] + f"|{n}{e}" for k in range(4, len(t)) for n in range(5) for e in (0, 1))

    def likelihood(t, c):
        t, total = "\0" * 4 + t, 0
        for k in range(4, len(t)):
            p = 1 / 256
            for n in range(5):
                p = (c[t[k - n : k + 1] + f"|{n}1"] + 2 * p) / (c[t[k - n : k] + f"|{n}0"] + 2)
            total += math.log(p)
        return total / (len(t) - 4)

    got = {r.page_id: r for r in url_filter.judge(df, rules).collect()}
    for k in [*range(0, 4000, 37), 4000]:
        t = rows[k][1][7:]
        assert abs(got[k].score - likelihood(t, counts["g"]) + likelihood(t, counts["b"])) < 1e-9
    assert got[4001].score == 0
    assert {r.page_id: r for r in url_filter.judge(df, rules, most_grams=1).collect()} == got
