import pytest

from siltstone.__main__ import main
from siltstone.operators import publish


def test_list_run_and_verify(spark, tmp_path, capsys):
    assert main(["list"]) == 0 and "recurrence" in capsys.readouterr().out
    rows = [(k, "2024-01-01 00:00:00", k % 9, "error", 1.5, '{"k": 3}') for k in range(30)]
    spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    assert main(["run", "recurrence", "--tables", str(tmp_path), "--output", f"{tmp_path}/out", "--format", "json"]) == 0
    assert spark.read.json(f"{tmp_path}/out").count() > 0
    with pytest.raises(SystemExit):
        main(["run", "nothing", "--tables", "x"])
    members = {"rules.json": b"[]"}
    (tmp_path / "a").write_bytes(publish.archive(members | {"manifest.json": publish.manifest(members)}))
    (tmp_path / "b").write_bytes(publish.archive(members))
    assert (main(["verify-archive", str(tmp_path / "a")]), main(["verify-archive", str(tmp_path / "b")])) == (0, 3)


def test_ingest_command(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "delivery long, record_id string").coalesce(1).write.parquet(f"{tmp_path}/in")
    assert main(["ingest", "--source", f"{tmp_path}/in", "--schema", "delivery long, record_id string", "--store", f"{tmp_path}/s"]) == 0
    assert spark.read.parquet(f"{tmp_path}/s/records").count() == 2
