import random
import zlib
from collections import Counter, defaultdict

from siltstone.llm import queries, sharding


def brute(rows, parts, extent, low=0, out=None):
    """Shard of each (dims, tie, seq, size), by sorting every node whole."""
    out = {} if out is None else out
    if parts == 1 or not rows:
        out.update({r[2]: low for r in rows})
        return out
    spread = [(max(r[0][k] for r in rows) - min(r[0][k] for r in rows)) / ((extent[k][1] - extent[k][0]) or 1) for k in range(len(extent))]
    k = spread.index(max(spread))
    total, left, cum, sides = sum(r[3] for r in rows), parts // 2, 0, ([], [])
    for r in sorted(rows, key=lambda r: (r[0][k], r[1], r[2])):
        cum += r[3]
        sides[(2 * cum - r[3]) * parts > 2 * total * left].append(r)
    brute(sides[0], left, extent, low, out)
    return brute(sides[1], parts - left, extent, low + left, out)


def expect(spark, rows, shards, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").selectExpr("*", "0 as Slot", "'k' as kept")
    out = sharding.shard(docs, shards, tolerance=0, bins=4, **options)
    assert out.columns == ["doc_id", "text", "source", "n_chars", "kept", "size", "text_crc32", "shard", "slot"]
    slots = defaultdict(list)
    got = out.collect()
    for r in got:
        assert r.size == len((r.text or "").encode()) + 16 and r.text_crc32 == zlib.crc32((r.text or "").encode())
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


def test_same_shards_as_sorting_every_node(spark):
    rng = random.Random(11)
    rows = [(k, "é" * rng.randrange(200) + "x" * rng.randrange(3), rng.choice("aaaaab") * 2, rng.randrange(50)) for k in range(700)]
    rows += [(700, None, None, None), (701, "y" * 3000, "zz", 10**18), (702, "", "aa", -5)]
    got = expect(spark, rows, 7)
    import hashlib

    dims = lambda r: (int(hashlib.sha256(r[2].encode()).hexdigest()[:15], 16) if r[2] is not None else 0, r[3] or 0)
    items = [(dims(r), r[0], r[0], len((r[1] or "").encode()) + 16) for r in rows]
    extent = [(min(i[0][k] for i in items), max(i[0][k] for i in items)) for k in range(2)]
    assert {r.doc_id: r.shard for r in got} == brute(items, 7, extent)
    by_id = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.shard, r.doc_id)):
        by_id[r.shard].append(r.slot)
    assert all(s == sorted(s) for s in by_id.values())


def test_repeated_rows_null_ids_and_one_hot_source(spark):
    rows = [(None, "same text", "a", 9)] * 90 + [(1, "same text", "a", 9)] * 90
    sizes = Counter(r.shard for r in expect(spark, rows, 4))
    assert sorted(sizes.values()) == [45, 45, 45, 45]


def test_target_bytes_text_ids_few_rows_and_none(spark):
    docs = spark.createDataFrame([(f"k{k}", "x" * 84) for k in range(20)], "name string, body string")
    out = sharding.shard(docs, target_bytes=500, id_column="name", text="body").collect()
    assert Counter(r.shard for r in out) == {k: 5 for k in range(4)}
    few = sharding.shard(docs.limit(3), 40, id_column="name", text="body").collect()
    assert len({r.shard for r in few}) == 3 and all(r.slot == 0 for r in few)
    assert sharding.shard(docs.limit(0), 40, id_column="name", text="body").count() == 0


def test_files_of_shards(spark, tmp_path):
    docs = spark.createDataFrame([(k, "x" * 84) for k in range(20)], "doc_id long, text string")
    sharding.write_shards(sharding.shard(docs, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["shard"], r["count"]) for r in back.groupBy("shard").count().collect()) == [(k, 5) for k in range(4)]


def test_query(spark):
    rows = queries.QUERIES["op11_sharding"](spark, "/root/testdata/sf0.01").collect()
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    assert len(rows) == 1000 and set(size) == set(range(40)) and {r.law for r in rows} == {"bytes"}
    mean = sum(size.values()) / 40
    assert all(abs(s - mean) <= max(r.size for r in rows) for s in size.values())
