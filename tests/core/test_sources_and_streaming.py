import json

import pytest
from pyspark.sql import functions as F

from siltstone.sources import provider, readers
from siltstone.streaming.ingest import ingest_stream, judged, marked, windowed_counts


def test_provider_pages_retries_and_missing(spark):
    spark.dataSource.register(provider.ProviderSource)
    df = spark.read.format("siltstone_provider").option("repository", "r").option("pull_requests", "1,3").option("transport", "tests.core.recorded:transport").option("pause", "0").load()
    rows = df.collect()
    assert sum(r.kind == "commit" and r.pull_request == 1 for r in rows) == 230
    assert [r.missing for r in rows if r.kind == "pull_request" and r.pull_request == 3] == [True]
    one = [r for r in rows if r.kind == "check" and r.pull_request == 1]
    assert len(one) == 1 and json.loads(one[0].payload) == {"id": 1, "b": 2, "a": "é"}


def test_page_bound_is_an_error():
    from tests.core import recorded

    with pytest.raises(OSError, match="more than 10 pages"):
        provider.pages(recorded.endless, "r/x", pause=0)
    with pytest.raises(OSError, match="503"):
        provider.pages(lambda path, page: (503, []), "r/x", pause=0)


def test_readers(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "e/1.json").write_text(json.dumps({"event_id": "a", "limitations": ["x"], "payload": {"k": 1}}))
    (tmp_path / "e/2.json").write_text("{broken")
    got = {r.event_id: (r.malformed, r.raw_payload) for r in readers.events(spark, f"{tmp_path}/e").collect()}
    assert got == {"a": (False, '{"k":1}'), None: (True, None)}
    (tmp_path / "l.jsonl").write_text('{"sequence":1}\n\n  \n{"sequence":2}\n')
    assert [r.sequence for r in readers.json_lines(spark, f"{tmp_path}/l.jsonl", "sequence long").collect()] == [1, 2]
    (tmp_path / "r.json").write_text(json.dumps({"source_snapshot_id": "s", "rows": [{"n": 1}, {"n": 2}]}))
    assert [tuple(r) for r in readers.report_rows(spark, f"{tmp_path}/r.json", "n: bigint").collect()] == [("s", 1), ("s", 2)]


def test_stream_equals_batch_after_redelivery(spark, tmp_path):
    rows = [(k, f"r{k % 7}") for k in range(40)]
    df = spark.createDataFrame(rows, "delivery long, record_id string")
    for part in range(4):
        df.where(F.col("delivery") % 4 == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second start has nothing new
        ingest_stream(spark, f"{tmp_path}/in", df.schema, f"{tmp_path}/store", files_per_batch=1).awaitTermination()
    df.where("delivery < 10").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    ingest_stream(spark, f"{tmp_path}/in", df.schema, f"{tmp_path}/store", files_per_batch=1).awaitTermination()
    ledger = spark.read.parquet(f"{tmp_path}/store/ledger")
    assert {r.disposition: r["count"] for r in ledger.groupBy("disposition").count().collect()} == {"accepted": 7, "duplicate": 43}
    assert spark.read.parquet(f"{tmp_path}/store/records").select("record_id").distinct().count() == 7


def test_repeats_null_ids_and_corrections_in_any_order(spark, tmp_path):
    schema = "delivery long, record_id string, kind string, replacement string"
    batches = [
        [(5, "a", None, None), (5, "a", None, None), (3, "a", None, None), (1, None, None, None), (2, None, None, None), (6, "late", "correction", "r1")],
        [(7, "a", None, None), (8, "late", None, None), (9, "a", "correction", "r2"), (10, "a", "correction", "r1"), (None, "b", None, None)],
        [(11, "a", "correction", "r1"), (12, "never", "correction", "r3"), (13, "b", None, None), (14, "b", "correction", None), (15, "old", None, None)],
    ]
    stored = spark.createDataFrame([("old", None)], "record_id string, superseded_by string")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        ingest_stream(spark, f"{tmp_path}/in", schema, f"{tmp_path}/store", stored=stored).awaitTermination()
    ledger = spark.read.parquet(f"{tmp_path}/store/ledger")
    got = sorted((r.delivery or 0, r.record_id or "", r.disposition) for r in ledger.collect())
    assert got == [
        (0, "b", "accepted"), (1, "", "quarantined"), (2, "", "quarantined"), (3, "a", "accepted"), (5, "a", "duplicate"), (5, "a", "duplicate"), (6, "late", "recorded"), (7, "a", "duplicate"), (8, "late", "accepted"),
        (9, "a", "recorded"), (10, "a", "recorded"), (11, "a", "recorded"), (12, "never", "recorded"), (13, "b", "duplicate"), (14, "b", "recorded"), (15, "old", "duplicate"),
    ]
    assert sorted((r.record_id, r.superseded_by) for r in spark.read.parquet(f"{tmp_path}/store/overlay").collect()) == [("a", "r2"), ("late", "r1")]
    assert sorted(r.record_id for r in spark.read.parquet(f"{tmp_path}/store/records").collect()) == ["a", "b", "late"]


def test_batches_are_judged_without_python(spark):
    rows = spark.createDataFrame([(4, "a", "event", None), (None, "a", "event", None), (5, "b", "event", None), (6, "b", "correction", "b"), (7, "c", "correction", "r1"), (8, "d", "correction", "r1"), (9, "d", "correction", "r0")], "delivery long, record_id string, kind string, replacement string")
    known = spark.createDataFrame([("b", True, None), ("c", False, "r2"), ("d", True, "r0"), ("z", True, "r9")], "record_id string, accepted boolean, superseded_by string")
    parts = marked(judged(rows, known))
    assert "Python" not in parts["ledger"]._jdf.queryExecution().executedPlan().toString().replace("Scan ExistingRDD", "")
    assert sorted((r.record_id, r.delivery or 0, r.disposition, r.superseded_by) for r in parts["ledger"].collect()) == [
        ("a", 0, "accepted", None), ("a", 4, "duplicate", None), ("b", 5, "duplicate", None), ("b", 6, "recorded", "b"), ("c", 7, "recorded", "r1"), ("d", 8, "recorded", "r1"), ("d", 9, "recorded", "r0")]
    assert [(r.record_id, r.delivery) for r in parts["records"].collect()] == [("a", None)]
    assert [(r.record_id, r.superseded_by) for r in parts["overlay"].collect()] == [("d", "r1")]
    assert sorted(tuple(r) for r in parts["known"].collect()) == [("a", True, None), ("d", True, "r1")]


def test_windows(spark):
    df = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 01:00:00", "a", 4.0)], "t string, event_type string, value double").withColumn("ts", F.to_timestamp("t"))
    assert sorted((r.n, r.total) for r in windowed_counts(df).collect()) == [(1, 4.0), (2, 3.0)]
