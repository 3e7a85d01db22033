import pytest
from pyspark.sql import functions as F

from siltstone.operators import store

SCHEMA = "record_id string, event_class string, producer_id string, body string"


def counts(frame):
    return {r.status: r["count"] for r in frame.groupBy("status").count().collect()}


def test_writes_once_and_reports_conflicts(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([("a", "x", "p", "1"), ("a", "x", "p", "1"), ("b", "x", "q", "2"), ("b", "x", "q", "3"), ("c", "y/ /é", None, None), (None, "x", "p", "4")], SCHEMA)
    assert counts(store.write_once(rows, path)) == {"written": 3, "unchanged": 1, "conflict": 1, "refused": 1}
    before = sorted(map(str, (tmp_path / "store").rglob("*.parquet")))
    assert counts(store.write_once(rows, path)) == {"unchanged": 4, "conflict": 1, "refused": 1}
    assert sorted(map(str, (tmp_path / "store").rglob("*.parquet"))) == before
    more = spark.createDataFrame([("a", "x", "p", "other"), ("d", "x", "p", "5")], SCHEMA)
    assert counts(store.write_once(more, path)) == {"conflict": 1, "written": 1}
    assert counts(store.write_once(rows.limit(0), path)) == {}
    got = store.view(spark, path, SCHEMA + ", new_column int").collect()
    assert sorted((r.record_id, r.producer_id or "", r.new_column) for r in got) == [("a", "p", None), ("b", "q", None), ("c", "", None), ("d", "p", None)]


def test_what_no_manifest_lists_is_not_read(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([(f"r{k}", f"c{k % 3}", f"p{k % 2}", str(k)) for k in range(60)], SCHEMA)
    assert store.view(spark, path, SCHEMA).count() == 0
    broken = rows.withColumn("body", F.when(F.col("record_id") == "r59", F.raise_error(F.lit("lost"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="lost"):
        store.write_once(broken, path)
    assert store.view(spark, path, SCHEMA).count() == 0
    store.write_once(rows, path)
    rows.limit(3).withColumn("body_hash", F.lit("h")).write.parquet(f"{path}/data/batch=stray")
    assert store.view(spark, path, SCHEMA).count() == 60
    some = store.view(spark, path, SCHEMA, "event_class = 'c1' and producer_id = 'p0'")
    assert {r.event_class + r.producer_id for r in some.collect()} == {"c1p0"} and some.count() == 10
    assert all("p_class=c1-" in f and "p_producer=p0-" in f for f in some.inputFiles())
