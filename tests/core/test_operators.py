import hashlib
import hmac
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.functions import canonical
from siltstone.operators import candidates, effectiveness, history, ingest, metrics, ordered, publish, snapshot
from siltstone.schemas import OBSERVATION


def obs(spark, rows):
    names = [c.split()[0] for c in OBSERVATION.replace("\n", " ").split(",")]
    base = {"record_id": "r", "producer_id": "p", "event_class": "static_finding", "occurrence_scope": "s", "recurrence_fingerprint": "f" * 64}
    return spark.createDataFrame([tuple((base | r).get(n) for n in names) for r in rows], OBSERVATION.replace("\n", " "))


def test_unanimity_counts_null_as_a_value(spark):
    rows = [{"recurrence_fingerprint": "a", "canonical_rule_id": x} for x in ("x", None)] + [{"recurrence_fingerprint": "b", "canonical_rule_id": "x"}] * 2 + [{"recurrence_fingerprint": "c"}]
    got = {r.recurrence_fingerprint: r.canonical_rule_id for r in metrics.recurrence(obs(spark, rows)).collect()}
    assert got == {"a": None, "b": "x", "c": None}


def test_unknown_effort_is_never_zero(spark):
    rows = [{"remediation_class": "m"}, {"remediation_class": "k", "effort_minutes": 10}, {"remediation_class": "k", "effort_minutes": 30}, {"remediation_class": "k"}]
    atlas = metrics.effort_atlas(obs(spark, rows))
    got = {r.remediation_class: r for r in atlas.collect()}
    assert (got["m"].total_minutes, got["m"].mean_minutes, got["m"].p95_minutes, got["m"].unknown_observation_count) == (None, None, None, 1)
    assert (got["k"].total_minutes, got["k"].mean_minutes, got["k"].median_minutes, got["k"].p95_minutes) == (40, 20.0, 20.0, 30.0)
    assert metrics.mean_effort_by_class(atlas).first().mean_effort_minutes == 20.0


def test_nearest_rank_percentile(spark):
    for n in (1, 2, 19, 20, 21, 100):
        got = metrics.effort_atlas(obs(spark, [{"effort_minutes": k} for k in range(1, n + 1)])).first().p95_minutes
        assert got == -(-95 * n // 100)


def test_cooccurrence_needs_two_fingerprints_in_a_scope(spark):
    marks = [("s1", "a"), ("s1", "b"), ("s1", "a"), ("s2", "a"), ("s2", "b"), ("s3", "a"), ("s4", "c")]
    got = metrics.cooccurrence(obs(spark, [{"occurrence_scope": s, "recurrence_fingerprint": f} for s, f in marks])).collect()
    assert [(r.left_fingerprint, r.right_fingerprint, r.shared_scope_count, r.jaccard_ratio) for r in got] == [("a", "b", 2, round(2 / 3, 12))]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("xyz"), st.sampled_from("abcd")), max_size=12), st.randoms())
def test_cooccurrence_ignores_order_and_repeats(spark, marks, rng):
    rows = [{"occurrence_scope": s, "recurrence_fingerprint": f} for s, f in marks]
    other = rows * 2
    rng.shuffle(other)
    result = lambda r: sorted(map(tuple, metrics.cooccurrence(obs(spark, r)).collect()))
    assert result(rows) == result(other)


def report(spark, rows):
    return spark.createDataFrame(rows, "canonical_rule_id string, success_ratio double, false_positive_ratio double")


def test_rule_without_report_reads_the_null_rule_by_row(spark):
    recurrence = spark.createDataFrame([("own",), ("partly",), ("absent",), (None,)], "canonical_rule_id string")
    got = {r.canonical_rule_id: (r.success_ratio, r.false_positive_ratio) for r in candidates.with_rule_effectiveness(recurrence, report(spark, [("own", 0.9, 0.1), ("partly", None, None), (None, 0.5, 0.25)])).collect()}
    assert got == {"own": (0.9, 0.1), "partly": (None, None), "absent": (0.5, 0.25), None: (0.5, 0.25)}
    bare = candidates.with_rule_effectiveness(recurrence, report(spark, [("own", 0.9, 0.1)])).where("canonical_rule_id is null").first()
    assert bare.success_ratio is None


def test_score_ceilings(spark):
    def score(occ, scopes, effort, success, fp):
        rec = spark.createDataFrame([("f" * 64, "static_finding", "r", occ, scopes)], "recurrence_fingerprint string, event_class string, canonical_rule_id string, occurrence_count long, distinct_scope_count long")
        mean = spark.createDataFrame([("static_finding", effort)], "event_class string, mean_effort_minutes double")
        row = candidates.candidates(rec, report(spark, [("r", success, fp)]), mean).first()
        return float(row.score), row.state

    assert score(100, 50, None, None, None) == (2.5, "deferred")
    assert score(100, 50, 500.0, None, None) == (3.25, "compiled_candidate")
    assert score(100, 50, None, 1.0, 0.0) == (4.25, "promotion_eligible")
    assert score(0, 0, -5.0, 0.0, 1.0) == (0.0, "deferred")


def test_scores_of_counts_beyond_a_scores_own_digits(spark):
    rec = spark.createDataFrame([("f" * 64, "static_finding", "r", 10**12, 10**9)], "recurrence_fingerprint string, event_class string, canonical_rule_id string, occurrence_count long, distinct_scope_count long")
    mean = spark.createDataFrame([("static_finding", 1e9)], "event_class string, mean_effort_minutes double")
    row = candidates.candidates(rec, report(spark, [("r", 1.0, 0.0)]), mean).first()
    assert [float(row[c]) for c in ("recurrence_score", "scope_score", "effort_score", "score")] == [5.0] * 4


def test_regression_of_fixtures(spark):
    compiled = spark.createDataFrame([("c1", "k", "f1", "deferred"), ("c2", "k", "f2", "compiled_candidate")], "candidate_id string, event_class string, recurrence_fingerprint string, state string")
    got = candidates.regression(compiled, candidates.fixtures(compiled)).collect()
    assert {(r.fixture_id, r.expected_match, r.passed) for r in got} == {("c2:positive", True, True), ("c2:negative", False, True)}


@pytest.mark.parametrize(("row", "state"), [((19, 0.9, None, None, None), "insufficient_evidence"), ((20, 0.20, None, None, None), "retirement_recommended"), ((20, 0.10, None, None, None), "rollback_recommended"), ((20, None, 0.2, None, None), "rollback_recommended"), ((20, None, None, 0.25, None), "rollback_recommended"), ((20, 0.05, None, None, None), "investigate"), ((20, None, None, None, 201), "investigate"), ((20, None, None, None, 200), "retain")])
def test_rule_states(spark, row, state):
    df = spark.createDataFrame([("r", *row)], "canonical_rule_id string, evaluation_count long, false_positive_ratio double, escape_ratio double, quick_fix_revert_ratio double, p95_latency_ms long")
    assert effectiveness.rule_recommendations(df).first().state == state


def packs(spark, *sides):
    names = "pack_id string, period string, evaluation_count long, prevention_ratio double, escape_ratio double, false_positive_ratio double, unknown_ratio double, coverage_ratio double, p95_latency_ms long"
    return spark.createDataFrame([("p", side, n, *m, 0.0, 1.0, lat) for side, n, m, lat in sides], names)


@pytest.mark.parametrize(("now", "latency", "state"), [((0.5, 0.1, 0.20), 10, "critical_regression"), ((0.5, 0.1, 0.13), 10, "degraded"), ((0.5, 0.1, 0.1), 110, "degraded"), ((0.55, 0.1, 0.1), 10, "improved"), ((0.5, 0.1, None), 10, "stable")])
def test_drift_states(spark, now, latency, state):
    got = effectiveness.drift(packs(spark, ("baseline", 5, (0.5, 0.1, 0.1), 10), ("current", 5, now, latency)), "pack_id", "period").first()
    assert got.state == state
    assert effectiveness.drift(packs(spark, ("baseline", 5, (0.5, 0.1, 0.1), 10)), "pack_id", "period").first().state == "insufficient_evidence"


def test_p95_of_a_pack_is_over_its_rules(spark):
    rows = [("p", f"r{k % 2}", "detected_in_CI", 1 if k % 2 else k) for k in range(1, 41)]
    rules = effectiveness.rule_metrics(spark.createDataFrame(rows, "pack_id string, canonical_rule_id string, outcome_class string, latency_ms long"), "pack_id")
    assert sorted(r.p95_latency_ms for r in rules.collect()) == [1, 38]
    assert effectiveness.pack_metrics(rules, "pack_id").first().p95_latency_ms == 38


def test_hmac_and_canonical_json(spark):
    key = b"k" * 40
    df = spark.createDataFrame([("é x",), (None,)], "v string").select(canonical.hmac_sha256(key, F.col("v")).alias("h"))
    assert [r.h for r in df.collect()] == [hmac.new(key, "é x".encode(), hashlib.sha256).hexdigest(), None]
    docs = spark.createDataFrame([('{"b": 1, "a": {"z": null, "y": [1, "\\u001f é"]}}',), ('{"a":1,"a":2}',), ("nope",)], "d string")
    got = [r.c for r in docs.select(canonical.canonical_json(F.col("d")).alias("c")).collect()]
    assert got == ['{"a":{"y":[1,"\\u001f é"],"z":null},"b":1}', None, None]
    with pytest.raises(ValueError, match="32"):
        canonical.hmac_sha256(b"short", F.lit("x"))
    with pytest.raises(ValueError, match="differ"):
        canonical.distinct_keys(key, key)
    assert spark.createDataFrame([("e\u0301",), ("plain",), (None,)], "t string").select(canonical.nfc(F.col("t")).alias("n")).collect()[0].n == "é"


def test_redaction_rules(spark):
    cases = {"Bearer abcdefghijklmnop": "credential_1", "ghp_" + "a" * 20: "credential_2", "github_pat_" + "b" * 22: "credential_3", "AKIA" + "A" * 16: "credential_4", "in /home/me/x": "absolute_path", "C:\\x\\y": "absolute_path", "a" * 40: "object_id", "-----BEGIN RSA PRIVATE KEY-----": "credential_0"}
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", ingest.redaction_hits(F.col("t")).alias("hits"))
    assert all(cases[r.t] in r.hits for r in df.collect())
    fine = spark.createDataFrame([("a" * 64,), ("src/home/x",), ("rotate the token budget",), (None,)], "t string")
    assert [r.h for r in fine.select(ingest.redaction_hits(F.col("t")).alias("h")).collect()] == [[], [], [], []]
    docs = spark.createDataFrame([(1, '{"a":[{"b":"/tmp/x"},{"password":1}]}'), (2, "{"), (3, None)], "id long, doc string")
    assert {tuple(r) for r in ingest.redaction_paths(docs, "id", "doc").collect()} == {(1, "a[0].b", "sensitive_value"), (1, "a[1].password", "sensitive_key"), (2, "", "malformed")}


def test_ledger_is_dense_in_any_arrival_order(spark):
    rng = random.Random(3)
    keys = rng.sample(range(10**6), 500)
    got = ingest.ledger(spark.createDataFrame([(k,) for k in keys], "delivery long"), ["delivery"])
    assert sorted((r.delivery, r.sequence) for r in got.collect()) == [(k, n + 1) for n, k in enumerate(sorted(keys))]
    assert ingest.ledger_gaps(got).collect() == []
    gaps = ingest.ledger_gaps(got.where("sequence not in (7, 499)").unionByName(got.where("sequence = 3"))).collect()
    assert {tuple(r) for r in gaps} == {(3, 3, "repeated"), (7, 7, "missing"), (499, 499, "missing")}


def test_numbers_go_on_and_a_hot_value_is_split(spark):
    rows = spark.createDataFrame([("hot", k) for k in range(400)] + [(None, 1), ("a", 2)], "note string, k long").repartition(3)
    first = ingest.ledger(rows, ["note"])
    got = sorted((r.sequence, r.note or "") for r in first.collect())
    assert [s for s, _ in got] == list(range(1, 403)) and got[:2] == [(1, ""), (2, "a")]
    assert first.select(F.spark_partition_id()).distinct().count() > 1
    assert sorted(r.sequence for r in ingest.ledger(rows.limit(5), ["note"], first).collect()) == list(range(403, 408))
    assert ingest.ledger(rows.limit(0), ["note"]).count() == 0


def test_tree_digest_of_any_order(spark):
    texts = [f"t{k % 90}" for k in range(100)] + ["é"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    level = sorted(hashlib.sha256(t.encode()).hexdigest() for t in texts)
    while True:
        level = [hashlib.sha256("".join(level[k : k + 7]).encode()).hexdigest() for k in range(0, len(level), 7)]
        if len(level) == 1:
            break
    for shape in (frame, frame.repartition(5), frame.orderBy(F.desc("t")).coalesce(1)):
        assert tuple(ordered.tree_digest(shape, "t", 7).first()) == (101, level[0])
    assert tuple(ordered.tree_digest(frame.limit(0), "t").first()) == (0, hashlib.sha256(b"").hexdigest())


def test_snapshot_keeps_records_without_observations_and_raw_keys(spark, tmp_path):
    records = spark.createDataFrame([("r1", "A/b", "p", "ACCEPTED", None), ("r2", "A_b", "p", "ACCEPTED", "old"), ("r3", "A_b", "p", "RETRACTED", None)], "record_id string, event_class string, producer_id string, lifecycle_state string, superseded_by string")
    overlay = spark.createDataFrame([("r2", "new")], "record_id string, superseded_by string")
    rows = snapshot.snapshot_rows(records, spark.createDataFrame([("r2", 5), ("r2", 6)], "record_id string, effort_minutes long"), overlay)
    assert sorted((r.record_id, r.effort_minutes or 0, r.superseded_by) for r in rows.collect()) == [("r1", 0, None), ("r2", 5, "new"), ("r2", 6, "new")]
    snapshot.write_snapshot(rows, f"{tmp_path}/s")
    back = snapshot.read_snapshot(spark, f"{tmp_path}/s", rows.schema)
    assert {r.event_class for r in back.collect()} == {"A/b", "A_b"}
    digest = lambda df: snapshot.snapshot_digest(df, "record_id", "event_class", "effort_minutes").first().digest
    assert digest(back) == digest(rows.orderBy(F.rand())) != digest(rows.limit(2))
    assert len({r.directory for r in snapshot.partition_plan(rows).collect()}) == 2


def test_predecessors_and_overlay(spark):
    records = spark.createDataFrame([("a", "e1", "p", "k", "c", "h1"), ("b", "e1", "p", "k", "c", "h2"), ("d", "e2", "p", "k", "c", "h3")], "record_id string, source_event_id string, producer_id string, event_class string, producer_contract string, payload_hash string")
    none = spark.createDataFrame([], "target string, replacement_event_id string")
    assert {tuple(r) for r in ingest.predecessors(records, none).collect()} == {("a", "b"), ("b", "a")}
    fix = spark.createDataFrame([("a", "e1"), ("b", "e2")], "target string, replacement_event_id string")
    assert ingest.predecessors(records, fix).collect() == []
    assert {tuple(r) for r in ingest.superseded(fix, records).collect()} == {("a", "b"), ("b", "d")}


def test_archives_are_the_same_bytes_twice(spark, tmp_path):
    from siltstone.sources.readers import archive_members

    members = {"rules.json": b"[]", "z/x.yml": b"a: 1"}
    members["manifest.json"] = publish.manifest(members)
    data = publish.archive(members)
    assert data == publish.archive(dict(reversed(members.items()))) and publish.verify_archive(data) == []
    bad = publish.archive(members | {"rules.json": b"[1]"})
    assert publish.verify_archive(bad) == ["hash of rules.json"]
    with pytest.raises(ValueError, match="unsafe"):
        publish.archive({"../x": b""})
    (tmp_path / "a.tar.gz").write_bytes(data)
    (tmp_path / "b.tar.gz").write_bytes(bad)
    assert {r.path[-8:]: list(r.problems) for r in archive_members(spark, str(tmp_path)).collect()} == {"a.tar.gz": [], "b.tar.gz": ["hash of rules.json"]}


def test_paths_of_a_commit_graph(spark):
    commits = spark.createDataFrame([("w", r, p) for r, p in [("a", None), ("b", "a"), ("c", "b"), ("d", "b"), ("m", "c"), ("m", "d"), ("n", "m"), ("x", "y"), ("y", "x")]], "workflow string, revision string, parent string")
    pairs = [("a", "c"), ("a", "a"), ("b", "m"), ("m", "n"), ("c", "d"), ("x", "q")]
    wanted = spark.createDataFrame([("w", a, b) for a, b in pairs], "workflow string, before string, after string")
    got = {(r.before, r.after): r.path for r in history.unique_paths(commits, wanted).collect()}
    assert got == {("a", "c"): ["b", "c"], ("a", "a"): [], ("m", "n"): ["n"]}


def test_flakes_need_conclusions_side_by_side(spark):
    runs = [("r1", c) for c in ("failure", None, "success", "failure")] + [("r2", c) for c in ("failure", "cancelled", "success")] + [("r3", "success")]
    df = spark.createDataFrame([(r, "w", k, "t", k, c) for k, (r, c) in enumerate(runs)], "revision string, workflow string, attempt int, updated_at string, run_id int, conclusion string")
    got = {r.revision: (r.alternations, r.flake_class) for r in history.flake_classes(df).collect()}
    assert got == {"r1": (2, "verified"), "r2": (0, "suspected"), "r3": (0, "none")}


def test_gaps_of_any_length_and_at_the_start(spark):
    rows = [(k,) for k in range(1, 61) if k not in (1, 2, 9, 20, 21, 22, 23, 24, 41)] + [(30,), (0,), (-3,), (None,), (10**15,)]
    for width in (100_000, 7, 10):
        got = {tuple(r) for r in ingest.ledger_gaps(spark.createDataFrame(rows, "sequence long"), width).collect()}
        gaps = {(1, 2), (9, 9), (20, 24), (41, 41), (61, 10**15 - 1)}
        assert got == {(*g, "missing") for g in gaps} | {(30, 30, "repeated")} | {(k, k, "invalid") for k in (0, -3, None)}
    assert ingest.ledger_gaps(spark.createDataFrame([], "sequence long")).collect() == []


def test_a_store_with_planted_faults(spark):
    fields = "producer_id string, producer_contract string, event_class string, snapshot_or_run_id string, payload_hash string"
    rows = spark.createDataFrame([("p", "c", "e", f"run{k}", f"h{k}") for k in range(5)], fields)
    rows = rows.withColumn("record_id", ingest.record_id(rows))
    ids = [r.record_id for r in rows.orderBy("snapshot_or_run_id").collect()]
    entries = spark.createDataFrame([(k + 1, i, "accepted") for k, i in enumerate(ids)], "sequence long, record_id string, disposition string")
    fine = rows.select("record_id")
    assert ingest.verify_store(rows, entries, observation=fine).collect() == []
    bad = rows.withColumn("payload_hash", F.when(F.col("snapshot_or_run_id") == "run3", "x").otherwise(F.col("payload_hash"))).where("snapshot_or_run_id != 'run0'")
    got = {tuple(r) for r in ingest.verify_store(bad.unionByName(bad.where("snapshot_or_run_id = 'run1'")), entries.where("sequence != 3"), observation=fine).collect()}
    assert got == {("ledger missing", 1), ("ledger record missing", 1), ("orphan observation", 1), ("record identity", 1), ("record repeated", 1), ("record never accepted", 1)}


def test_outcomes_delivered_twice_in_one_row(spark):
    rows = spark.createDataFrame([("o", 1, "h"), ("o", 1, "h"), ("o", 1, "z"), ("o", 2, "h"), ("o", 3, None), ("p", None, None)], "outcome_id string, delivery long, document_hash string")
    got = sorted((r.outcome_id, r.delivery or 0, r.status) for r in effectiveness.outcome_ingest(rows).collect())
    assert got == [("o", 1, "accepted"), ("o", 1, "conflict"), ("o", 1, "duplicate"), ("o", 2, "duplicate"), ("o", 3, "conflict"), ("p", 0, "accepted")]


def test_projections_of_nulls(spark):
    resolved = spark.createDataFrame([(1, "f", "passed"), (2, None, None), (3, " ", "odd")], "record_id long, failure_fingerprint string, validation_result string").withColumn("remediation_class", F.lit(None).cast("string"))
    got = {r.record_id: r for r in ingest.resolver_observations(resolved).collect()}
    assert [got[k].validation_outcome for k in (1, 2, 3)] == ["passed", None, "unknown"] and len({got[k].recurrence_fingerprint for k in got} - {None}) == 3
    past = spark.createDataFrame([("1", "partial_resolution", False, "f"), ("2", None, False, None), ("3", "clean_verified", False, "f")], "record_id string, outcome string, suspected_flake boolean, semantic_identity string")
    seen = {r.record_id: r for r in ingest.historical_observations(past).collect()}
    assert [seen[k].validation_outcome for k in "123"] == ["unknown", None, "passed"] and seen["3"].recurrence_fingerprint == got[1].recurrence_fingerprint


def test_paths_of_any_length(spark):
    chain = spark.createDataFrame([("w", f"r{k}", f"r{k - 1}" if k else None) for k in range(81)], "workflow string, revision string, parent string")
    found = history.unique_paths(chain, spark.createDataFrame([("w", "r0", "r80")], "workflow string, before string, after string")).first()
    assert found.path == [f"r{k}" for k in range(1, 81)]
