import hashlib
import json

from pyspark.sql import functions as F

from siltstone.operators import artifacts, candidates, effectiveness, metrics, outputs
from siltstone.operators.ordered import grouped_digest

OBS = "record_id string, producer_id string, event_class string, producer_contract string, occurrence_scope string, recurrence_fingerprint string, canonical_rule_id string, remediation_class string, effort_minutes double, validation_outcome string, false_positive_disposition string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def root(texts, fan_out):
    level = sorted(sha(t or "") for t in texts)
    while True:
        level = [sha("".join(level[k : k + fan_out])) for k in range(0, len(level), fan_out)]
        if len(level) == 1:
            return level[0]


def observations(spark, n=40):
    rows = [(f"r{k}", f"p{k % 2}", "gate_outcome" if k % 3 else "static_finding", "c/v1", f"scope{k % 9}" if k % 10 else f"record:r{k}", sha(f"f{k % 4}"), None if k % 5 == 0 else f"rule_{k % 4}", "fix" if k % 2 else None, float(k) if k % 7 else None, "passed", "confirmed_true_positive") for k in range(n)]
    return spark.createDataFrame(rows, OBS)


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_a_groups_digest_is_its_own(spark):
    texts = {"a": [str(k) for k in range(50)] + ["7", "7"], "b": ["x"], None: ["y", None], "c": [str(k) for k in range(9)]}
    rows = [(g, t) for g, ts in texts.items() for t in ts]
    want = {g: (len(ts), root(ts, 3)) for g, ts in texts.items()}
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "g string, t string").repartition(5)
        assert {r.g: (r.row_count, r.digest) for r in grouped_digest(frame, ["g"], "t", fan_out=3).collect()} == want
    assert grouped_digest(spark.createDataFrame([], "g string, t string"), ["g"], "t").count() == 0


def test_an_analysis_is_its_observations_and_every_fault_is_a_row(spark):
    obs = observations(spark)
    rows, manifest, run = outputs.analysis(obs, "cs")
    again = outputs.analysis(obs.repartition(7), "cs")[2]
    assert run.collect() == again.collect()
    assert outputs.analysis(obs, "other")[2].first().run_id != run.first().run_id
    assert run.first().limitations == sorted(outputs.LIMITATIONS.values()) and run.first().observation_count == 40
    assert found(outputs.verify_analytics(rows, manifest, run)) == []
    empty = outputs.analysis(obs.limit(0), "cs")
    assert found(outputs.verify_analytics(*empty)) == [] and {r.row_count for r in empty[1].collect()} == {0}
    id_ = run.first().run_id
    lost = rows.where("not (name = 'effort' and row like '%static_finding%')")
    assert found(outputs.verify_analytics(lost, manifest, run)) == [(id_, "effort", "report hash"), (id_, "effort", "row count")]
    moved = manifest.withColumn("source_snapshot_id", F.when(F.col("name") == "effort", "x").otherwise(F.col("source_snapshot_id")))
    assert found(outputs.verify_analytics(rows, moved, run)) == [(id_, "effort", "report snapshot")]
    twice = manifest.unionByName(manifest.where("name = 'effort'"))
    assert (id_, "effort", "report repeated") in found(outputs.verify_analytics(rows, twice, run).na.fill("", ["name"]))
    counted = run.withColumn("observation_count", F.lit(1).cast("long"))
    assert found(outputs.verify_analytics(rows, manifest, counted)) == [(id_, None, "output hash")]


def test_a_reports_ratios_are_rounded_once(spark):
    scopes = {"a" * 64: range(273), "b" * 64: range(233, 233 + 19777)}  # 40 of 20010 shared: 0.00199900049975
    rows = [(f"r{f[0]}{k}", "p", "gate_outcome", "c/v1", f"scope{k}", f, None, None, None, None, None) for f, ks in scopes.items() for k in ks]
    report = outputs.analysis(spark.createDataFrame(rows, OBS), "cs")[0]
    assert json.loads(report.where("name = 'cooccurrence'").first().row)["jaccard_ratio"] == "0.001999000"


def compiled(spark):
    obs = observations(spark)
    run = outputs.analysis(obs, "cs")[2]
    scored = candidates.candidates(metrics.recurrence(obs), metrics.rule_effectiveness(obs), metrics.mean_effort_by_class(metrics.effort_atlas(obs)))
    return artifacts.candidate_documents(scored.withColumn("state", F.when(F.col("occurrence_count") % 2 == 0, "compiled_candidate").otherwise("promotion_eligible")), run)


def test_files_of_candidates(spark):
    docs = compiled(spark)
    files = {r.file: r.body for r in artifacts.files(docs).collect()}
    for d in docs.collect():
        invariant = json.loads(files[f"invariants/{d.candidate_id}.json"])
        assert invariant["severity"] == ("warning" if d.state == "promotion_eligible" else "info") and list(invariant) == sorted(invariant)
        if d.candidate_kind == "ast_grep":
            lines = files[f"rules/{d.candidate_id}.yml"].splitlines()
            assert f"message: {d.title}" in lines and lines[0] == f"id: {d.candidate_id}" and lines[-1] == "severity: warning"
        else:
            contract = json.loads(files[f"contracts/{d.candidate_id}.json"])
            assert contract["selector"] == {"event_class": d.event_class, "recurrence_fingerprint": d.recurrence_fingerprint} and contract["blocking"] is False
        assert d.title == f"Prevent recurring {d.event_class} pattern {d.recurrence_fingerprint[:12]}"
    assert len(files) == 2 * docs.count()


def test_yaml_scalars(spark):
    texts = ["plain text", "yes", "a: b", "# no", 'q"uote', "", None, "1.5", "ends ", "line\nbreak"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(artifacts.yaml_text(F.col("t")).alias("y"))
    assert [r.y for r in rows.collect()] == ["plain text", '"yes"', '"a: b"', '"# no"', '"q\\"uote"', '""', "null", '"1.5"', '"ends "', '"line\\nbreak"']


def test_faults_of_a_compilation(spark):
    docs = compiled(spark)
    files = artifacts.files(docs).select("file", "body")
    lines, made = outputs.compilation(docs, files, candidates.regression(docs, candidates.fixtures(docs)))
    assert found(outputs.verify_compilation(files, lines, made)) == []
    first = min(r.file for r in files.collect())
    changed = files.withColumn("body", F.when(F.col("file") == first, "x").otherwise(F.col("body")))
    assert found(outputs.verify_compilation(changed, lines, made)) == [(first, "file hash")]
    assert found(outputs.verify_compilation(files.where(F.col("file") != first), lines, made)) == [(first, "file missing")]
    assert {f for _, f in found(outputs.verify_compilation(files, lines.where(F.col("file") != first), made).na.fill(""))} == {"file unlisted", "files digest", "file count"}
    assert {f for _, f in found(outputs.verify_compilation(files, lines, made.withColumn("fixtures_failed", F.lit(1).cast("long"))))} == {"output hash", "regression failed"}
    assert {f for _, f in found(outputs.verify_compilation(files, lines, made.withColumn("run_id", F.lit("ar_x"))))} == {"output hash", "compilation identity"}


def test_faults_of_effectiveness_reports(spark):
    rows = [(f"pack{k % 3}", f"rule{k % 4}", "repair_succeeded" if k % 2 else "escaped_detection", k, f"t{k}") for k in range(60)]
    seen = spark.createDataFrame(rows, "pack_id string, canonical_rule_id string, outcome_class string, latency_ms long, observed_at string")
    report, manifest = outputs.effectiveness_reports(seen, effectiveness.rule_metrics(seen, "pack_id"))
    assert found(outputs.verify_effectiveness(report, manifest, seen.withColumn("observed_at", F.lit("later")))) == []
    assert found(outputs.verify_effectiveness(report, manifest, seen.where("latency_ms != 4"))) == [("pack1", "observation count"), ("pack1", "outcome lineage")]
    assert found(outputs.verify_effectiveness(report.where("pack_id != 'pack0'"), manifest.where("pack_id != 'pack2'"), seen)) == [("pack0", "report missing"), ("pack2", "report unlisted")]
    other = manifest.withColumn("report_id", F.lit("er_x"))
    assert {f for _, f in found(outputs.verify_effectiveness(report, other, seen))} == {"report identity"}


def test_hashes_move_as_bytes_without_a_tie_of_equal_rows(spark):
    from siltstone.operators import ordered

    frame = spark.createDataFrame([("a",), ("b",), ("b",)], "t string").select(ordered.leaf("t").alias("h"))
    moved = ordered.numbered(frame, ["h"])
    assert [(f.name, f.dataType.simpleString()) for f in moved.schema] == [("h", "binary"), ("sequence", "bigint")]
    assert sorted((hashlib.sha256(t).digest(), k) for t, k in ((b"a", 3), (b"b", 1), (b"b", 2))) == sorted((bytes(r.h), r.sequence) for r in moved.collect())


def test_an_analysis_writes_only_what_reports_read_and_several_share_it(spark):
    obs, made = observations(spark), spark.sparkContext.accumulator(0)

    def mark(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    counted = obs.mapInArrow(mark, obs.schema)
    ids = F.udf(lambda x: made.add(1) or x, "string").asNondeterministic()
    want = outputs.analysis(obs, "cs")[2].collect()
    assert outputs.analysis(obs.withColumn("record_id", ids("record_id")), "cs")[2].collect() == want and made.value == 0
    kept = outputs.observed(counted)
    assert outputs.analysis(kept, "cs", is_written=True)[2].collect() == want
    outputs.analysis(kept.where("event_class = 'gate_outcome'"), "other", is_written=True)
    assert made.value == 40
