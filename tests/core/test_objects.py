import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators import history, objects

SCHEMA = "scope string, source string, kind string, payload string, run_attempt int, limitations array<string>"


def normalized(spark, rows):
    made = [("s", str(k), kind, p if isinstance(p, (str, type(None))) else json.dumps(p), attempt, limits) for k, (kind, p, attempt, limits) in enumerate(rows)]
    return objects.normalized(spark.createDataFrame(made, SCHEMA))


def test_kinds_and_what_is_odd_in_them(spark):
    rows = [
        ("pull_request", {"number": 7, "base": {"sha": "b"}, "head": "h", "auto_merge": None}, None, None),
        ("timeline_event", {"event": "labeled"}, None, None), ("timeline_event", {"event": "base_ref_changed"}, None, ["x", "x"]),
        ("commit", {"sha": "c1", "parents": []}, None, None), ("commit", {"sha": "c2", "parents": [{"sha": "c1"}, {"sha": ""}, 3, {"sha": "c0"}]}, None, None),
        ("workflow_run", {"id": 5, "head_sha": "c2", "run_attempt": True, "path": " ", "workflow_id": 9}, 3, None), ("workflow_attempt", {"id": "", "name": "n", "run_attempt": 0}, None, None),
        ("ci_job", {"id": 1, "run_id": 5, "run_attempt": 2, "name": "t", "conclusion": "failure", "steps": [{"name": "a", "conclusion": "success"}, {"name": "b", "status": "failure"}, {"conclusion": "failure"}, 4]}, None, None),
        ("ci_job", {"id": 2, "run_id": 5, "name": "t", "conclusion": "failure"}, None, ["old"]),
        ("check_run", {"id": 3, "name": "lint"}, None, None), ("job_log", "raw, not JSON", None, None), ("commit", "[1]", None, None), ("commit", None, None, None), ("unheard_of", {}, None, None),
    ]
    got = {}
    for r in normalized(spark, rows).collect():
        got.setdefault(int(r.source), []).append(r)
    assert {k: sorted(r.kind for r in v) for k, v in got.items()} == {
        0: ["pull_request"], 2: ["review_signal"], 3: ["commit"], 4: ["change", "commit"], 5: ["ci_execution"], 6: ["ci_execution"], 7: ["ci_job", "failure"], 8: ["ci_job", "failure"], 9: ["validation"], 10: ["textual_hint"]}
    change = next(r for r in got[4] if r.kind == "change")
    assert (change.before_revision, change.parents, change.is_merge, change.weakening, change.file_count) == ("c1", ["c1", "c0"], True, ["files_unobserved"], 0)
    assert (got[0][0].before_revision, got[0][0].revision, got[0][0].availability) == ("b", None, "partial") and got[2][0].limitations == ["x"]
    assert (got[5][0].execution_ref, got[5][0].workflow, got[6][0].execution_ref, got[6][0].workflow, got[6][0].attempt) == ("5:attempt:3", " ", None, "n", None)
    one, two = (next(r for r in got[k] if r.kind == "failure") for k in (7, 8))
    assert (one.failed_steps, one.execution_ref, two.failed_steps, two.limitations) == (["b"], "5:attempt:2", [], ["failed_step_unavailable", "old"])
    assert one.semantic_identity != two.semantic_identity and one.occurrence_identity != two.occurrence_identity
    assert normalized(spark, rows[:1]).limit(0).count() == 0


@pytest.mark.parametrize(("path", "status", "patch", "flags"), [
    ("x.lock", "modified", None, "lockfile_changed"), ("Tests/a.py", "modified", "", "test_changed"), ("a/tests/b", "removed", None, "test_changed,validation_file_removed"), (".github/workflows/x", "removed", None, "workflow_changed,validation_file_removed"),
    ("a.py", "modified", "+@unittest.skip", "validation_skip_added"), ("a.py", "modified", "+++ unittest.skip\n-pytest.skip(", ""), ("a.yml", "modified", "x\r\n+ IF: False", "validation_skip_added"), ("d/requirements-dev.txt", "modified", None, "environment_changed"),
    ("Poetry.lock", "modified", None, "environment_changed,lockfile_changed"), ("my_dockerfile", "modified", None, ""), ("contest_x.py", "modified", None, "")])
def test_flags_of_a_file(spark, path, status, patch, flags):
    files = F.array(F.struct(F.lit(path).alias("path"), F.lit(status).alias("status"), F.lit(patch).cast("string").alias("patch")))
    row = spark.range(1).select(*(c.alias(n) for n, c in history.change_flags(files).items())).first()
    names = ("workflow_changed", "test_changed", "environment_changed", "lockfile_changed")
    assert ",".join([n for n in names if row[n]] + row.weakening) == flags


def job(ref, run, attempt, name, conclusion, failed=()):
    steps = [{"name": s, "conclusion": "failure" if s in failed else "success"} for s in ("a", "b")]
    return ("ci_job", {"id": ref, "run_id": run, "run_attempt": attempt, "name": name, "conclusion": conclusion, "steps": steps}, None, None)


def run(ref, attempt, revision, conclusion):
    return ("workflow_run", {"id": ref, "run_attempt": attempt, "head_sha": revision, "path": "ci", "conclusion": conclusion}, None, None)


def test_failures_before_and_after_by_identity(spark):
    rows = [
        ("pull_request", {"number": 1, "base": {"sha": "c0"}, "head": {"sha": "c2"}}, None, None),
        ("commit", {"sha": "c1", "parents": [{"sha": "c0"}], "files": [{"filename": "a.py"}]}, None, None), ("commit", {"sha": "c2", "parents": [{"sha": "c1"}], "files": [{"filename": "b.py"}]}, None, None),
        run(1, 1, "c0", "failure"), job(11, 1, 1, "t", "failure", "a"), job(12, 1, 1, "u", "failure", "b"), job(13, 1, 1, "gone", "failure", "a"),
        run(2, 1, "c1", "failure"), job(21, 2, 1, "t", "success"), job(22, 2, 1, "u", "failure", "a"), job(23, 2, 1, "v", "failure", "a"),
        run(3, 1, "c2", "success"), job(31, 3, 1, "u", "success"), job(32, 3, 1, "v", "success"),
    ]
    got = {(r.job_ref): r for r in history.episodes(normalized(spark, rows)).collect()}
    assert {k: (r.after_execution_ref, r.before_failure_count, r.new_failure_count, r.failure_after, r.outcome, r.grade) for k, r in got.items()} == {
        "11": ("2:attempt:1", 3, 2, "absent", "new_failure", "C"), "12": ("2:attempt:1", 3, 2, "absent", "new_failure", "C"), "13": ("2:attempt:1", 3, 2, "unknown", "outcome_unknown", "U"),
        "22": ("3:attempt:1", 2, 0, "absent", "clean_verified", "C"), "23": ("3:attempt:1", 2, 0, "absent", "clean_verified", "C"),
    }
    assert got["13"].equivalence_reasons == ["job_removed"] and got["22"].confounders == ["multiple_failure_fingerprints"]
    assert history.episodes(normalized(spark, rows[1:])).count() == 0  # no pull request, no context


def test_values_read_once_are_told_apart_by_type(spark):
    from pyspark.sql import functions as F

    from siltstone.operators import objects

    given = ["1", "1.0", "2.5", "-1", '"x"', '""', "true", "null", "[1]", "{}", "99999999999", "1e2", None]
    rows = spark.createDataFrame([(k, None if v is None else f'{{"id":{v},"other":1}}') for k, v in enumerate(given)], "k int, doc string")
    v = rows.select("k", F.try_variant_get(F.try_parse_json("doc"), "$", objects.fields("id")).alias("v"))
    got = v.select(objects.a_number(F.col("v.id")), objects.a_name(F.col("v.id")), objects.a_text(F.col("v.id"))).orderBy("k").collect()
    assert [r[0] for r in got] == [1, 1, None, None, None, None, None, None, None, None, None, 100, None]
    assert [r[1] for r in got] == ["1", "1", None, "-1", "x", None, None, None, None, None, "99999999999", "100.0", None]
    assert [r[2] for r in got] == [None] * 4 + ["x"] + [None] * 8


def test_rows_of_episodes_move_twice_and_repeated_jobs_count(spark, monkeypatch):
    """What is joined per run moves once for all its joins, nothing is written that nobody reads, and names come out as they
    went in, whether they are hashes or not. A job that was observed twice gives its failures twice, as in a join."""
    rows = [("pull_request", {"number": 7}, None, None), run(1, 1, "c0", "failure"), job(10, 1, 1, "test", "failure", "b"), job(11, 1, 1, "test", "failure", "b"), job(12, 1, 1, "build", "failure", "a")]
    rows += [run(2, 1, "c1", "failure"), job(20, 2, 1, "test", "failure", "b"), job(22, 2, 1, "build", "success")]
    rows += [("commit", {"sha": "c0", "parents": []}, None, None), ("commit", {"sha": "c1", "parents": [{"sha": "c0"}], "files": [{"filename": "a.py", "status": "modified"}]}, None, None)]
    seen = normalized(spark, rows)
    again = seen.where("kind = 'ci_job' and ref = '12'").withColumn("observation_id", F.lit("twice"))
    seen = seen.withColumn("observation_id", F.when((F.col("kind") == "failure") & (F.col("ref") == "11"), "plain").otherwise(F.col("observation_id"))).unionByName(again).cache()
    written, plans = [], []
    cut = history.cut

    def noted(rows):
        written.append(rows.columns)
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return cut(rows)

    monkeypatch.setattr(history, "cut", noted)
    got = [(r.job_ref, r.failure_id, r.before_failure_count, r.new_failure_count, r.failure_after, r.change_count, r.outcome) for r in history.episodes(seen).collect()]
    names = {r.ref: r.observation_id for r in seen.where("kind = 'failure'").collect()}
    assert names["11"] == "plain" and names["10"].startswith("hno_")
    assert sorted(got) == sorted([(ref, names[ref], 2, 0, "present", 1, "repeated_failure") for ref in ("10", "11")] + [("12", names["12"], 2, 1, "absent", 1, "new_failure")] * 2)
    assert not {"occurrence_identity", "availability", "observation_id", "limitations"} & {c for columns in written for c in columns}
    assert sum("Exchange hashpartitioning" in line and "semantic_identity" in line for line in plans[-1].splitlines()) <= 3
    assert sum("Exchange" in line for line in plans[-1].splitlines()) <= 20
    seen.unpersist()
