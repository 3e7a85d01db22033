"""One query per operator over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import canonical
from siltstone.operators import artifacts as A
from siltstone.operators import candidates as C
from siltstone.operators import channels as N
from siltstone.operators import effectiveness as E
from siltstone.operators import envelope as V
from siltstone.operators import history as H
from siltstone.operators import ingest as I
from siltstone.operators import metrics as M
from siltstone.operators import objects as O
from siltstone.operators import outputs as R
from siltstone.operators import publish as P
from siltstone.operators import snapshot as S
from siltstone.operators import store as W
from siltstone.sources.bridge import table, view

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.with_fallbacks(view(spark, sf_dir, "observations_stored"))


@query
def observation_fallbacks(spark, sf_dir):
    return observations(spark, sf_dir)


@query
def recurrence(spark, sf_dir):
    return M.recurrence(observations(spark, sf_dir))


@query
def cooccurrence(spark, sf_dir):
    return M.cooccurrence(observations(spark, sf_dir))


@query
def effort_atlas(spark, sf_dir):
    return M.effort_atlas(observations(spark, sf_dir))


@query
def rule_effectiveness(spark, sf_dir):
    return M.rule_effectiveness(observations(spark, sf_dir))


@query
def mean_effort_by_class(spark, sf_dir):
    return M.mean_effort_by_class(M.effort_atlas(observations(spark, sf_dir)))


@query
def limitation_flags(spark, sf_dir):
    return M.limitation_flags(observations(spark, sf_dir))


def compiled(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return C.candidates(M.recurrence(obs), M.rule_effectiveness(obs), M.mean_effort_by_class(M.effort_atlas(obs)))


@query
def candidate_scores(spark, sf_dir):
    parts = ["recurrence_score", "scope_score", "effort_score", "success_score", "safety_score", "score"]
    rows = compiled(spark, sf_dir)
    return rows.select("recurrence_fingerprint", "event_class", "canonical_rule_id", "candidate_kind", "state", "candidate_id", *(F.col(p).cast("double").alias(p) for p in parts))


@query
def compile_summary(spark, sf_dir):
    rows = compiled(spark, sf_dir)
    return C.compile_summary(rows, C.regression(rows, C.fixtures(rows)))


@query
def regression_results(spark, sf_dir):
    rows = compiled(spark, sf_dir)
    return C.regression(rows, C.fixtures(rows))


@query
def emitted_rules(spark, sf_dir):
    return C.emitted_rules(compiled(spark, sf_dir))


def outcomes(spark, sf_dir):
    return view(spark, sf_dir, "outcomes")


@query
def rule_metrics(spark, sf_dir):
    return E.rule_metrics(outcomes(spark, sf_dir), "pack_id")


@query
def pack_metrics(spark, sf_dir):
    return E.pack_metrics(E.rule_metrics(outcomes(spark, sf_dir), "pack_id"), "pack_id")


@query
def rule_recommendations(spark, sf_dir):
    return E.rule_recommendations(E.rule_metrics(outcomes(spark, sf_dir), "pack_id"), "pack_id")


@query
def pack_recommendation(spark, sf_dir):
    rules = E.rule_metrics(outcomes(spark, sf_dir), "pack_id")
    return E.pack_recommendations(E.pack_metrics(rules, "pack_id"), E.rule_recommendations(rules, "pack_id"), "pack_id")


def period_packs(spark, sf_dir):
    return E.pack_metrics(E.rule_metrics(outcomes(spark, sf_dir), "pack_id", "period"), "pack_id", "period")


@query
def metric_deltas(spark, sf_dir):
    return E.deltas(period_packs(spark, sf_dir), "pack_id", "period")


@query
def drift(spark, sf_dir):
    return E.drift(period_packs(spark, sf_dir), "pack_id", "period")


@query
def surface_domain(spark, sf_dir):
    rows = outcomes(spark, sf_dir).withColumn("allowed", E.valid_for_surface(F.col("surface"), F.col("outcome_class")))
    return rows.groupBy("surface", "outcome_class", "allowed").agg(F.count(F.lit(1)).alias("n"))


@query
def outcome_dedup(spark, sf_dir):
    rows = outcomes(spark, sf_dir).select(F.concat("pack_id", F.lit(":"), "canonical_rule_id", F.lit(":"), "surface").alias("outcome_id"), F.col("outcome_key").alias("delivery"), F.sha2(F.concat("outcome_class"), 256).alias("document_hash"))
    return E.outcome_ingest(rows)


def deliveries(spark, sf_dir):
    rows = view(spark, sf_dir, "deliveries")
    return rows.withColumn("text", F.col("note")).withColumn("payload_hash", F.sha2(F.concat(F.lit("note:"), "note"), 256))


def disposed(spark, sf_dir):
    """Deliveries against a store that has some of their records already, a few of those with another payload."""
    rows = view(spark, sf_dir, "deliveries")
    old = rows.where("delivery % 50 = 0").withColumn("payload_hash", F.sha2("payload_json", 256))
    old = old.select(I.record_id(old).alias("record_id"), F.when(F.col("delivery") % 100 == 0, "another").otherwise(F.col("payload_hash")).alias("payload_hash"))
    return V.dispositions(rows.select("delivery", "document"), I.registry(spark), old.where("record_id is not null"))


@query
def ingest_dispositions(spark, sf_dir):
    return disposed(spark, sf_dir).select("delivery", "record_id", "reason", "disposition")


@query
def ledger_counts(spark, sf_dir):
    return disposed(spark, sf_dir).groupBy("disposition", "reason").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("record_id").alias("records"))


@query
def envelope_errors(spark, sf_dir):
    return V.validation_errors(view(spark, sf_dir, "deliveries").select("delivery", "document"))


def json_text(**fields) -> F.Column:
    """A JSON object of text fields, without those that are null."""
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())))


def contract_events(spark, sf_dir):
    """Accepted events of four contracts: bundles from order lines, feedback, history and a gate's outcome from orders."""
    lines = table(spark, sf_dir, "lineitem")
    place = F.when(F.col("l_quantity") > 10, F.array(F.struct(F.concat(F.lit("src/"), F.col("l_returnflag")).alias("normalized_path"))))
    one = F.struct(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("finding_id"),
        F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit("rule_"), (F.col("l_partkey") % 50).cast("string"))).otherwise(F.when(F.col("l_partkey") % 2 == 0, "")).alias("canonical_rule_id"),
        F.when(F.col("l_suppkey") % 7 != 0, F.concat(F.lit("fp"), F.col("l_suppkey").cast("string"))).alias("fingerprint"), place.alias("locations"))
    repo = lambda k: F.when(k % 9 != 0, F.concat(F.lit("repo_"), (k % 40).cast("string")))
    bundles = lines.groupBy("l_orderkey").agg(F.collect_list(one).alias("findings"))
    event = lambda prefix, k, contract, payload: (F.concat(F.lit(prefix), k.cast("string")).alias("record_id"), F.lit("p").alias("producer_id"), F.lit("static_finding").alias("event_class"), F.lit(contract).alias("producer_contract"), payload.alias("payload"))
    out = bundles.select(*event("b-", F.col("l_orderkey"), V.SDK, json_text(bundle=F.struct("findings"), repository_pseudonym=repo(F.col("l_orderkey")))))
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    feedback = json_text(
        failure=F.struct(F.when(F.col("o_custkey") % 9 != 0, F.concat(F.lit("f"), (F.col("o_custkey") % 100).cast("string"))).alias("fingerprint")), resolution=F.struct(F.when(F.col("o_orderstatus") == "O", "code_change").alias("remediation_class")),
        validation=F.struct(F.when(k % 4 == 0, "passed").when(k % 4 == 1, "failed").when(k % 4 == 2, "flaky").alias("result"), F.when(k % 5 == 0, "short").alias("duration_bucket")), repository_pseudonym=repo(k))
    names = ["clean_verified", "target_failure_resolved", "repeated_failure", "new_failure", "partial_resolution", "outcome_unknown", "unresolved", "unheard_of"]
    past = json_text(
        failure=F.struct(F.when(k % 5 != 0, F.concat(F.lit("h"), (k % 77).cast("string"))).alias("semantic_failure_identity"), F.when(k % 7 < 3, "canonical").when(k % 7 < 6, "historical").alias("identity_authority")),
        intervention=F.struct(F.when(k % 2 == 0, "code_change").alias("remediation_class")), validation=F.struct(F.when(k % 11 != 0, F.element_at(F.array(*map(F.lit, names)), (k % 8 + 1).cast("int"))).alias("outcome")),
        historical_evidence=F.struct((k % 9 == 0).alias("suspected_flake")), repository_identity=repo(k))
    for prefix, left, contract, payload in (("f-", 0, V.RESOLVER, feedback), ("h-", 1, V.HISTORY, past), ("g-", 2, "gate-outcome/v1", json_text(repository_pseudonym=repo(k)))):
        out = out.unionByName(orders.where(k % 3 == left).select(*event(prefix, k, contract, payload)))
    return out


@query
def learning_projection(spark, sf_dir):
    return V.observations(contract_events(spark, sf_dir)).withColumn("limitations", F.array_join("limitations", "; "))


@query
def ledger_sequence(spark, sf_dir):
    return I.ledger(deliveries(spark, sf_dir).select("delivery", "event_id"), ["delivery"])


@query
def ledger_batches(spark, sf_dir):
    """Two batches, one numbered behind the other, in an order in which one value is that of a third of the rows."""
    rows = deliveries(spark, sf_dir).select("delivery", F.when(F.col("delivery") % 3 == 0, "hot").otherwise(F.col("note")).alias("note"))
    first = I.ledger(rows.where("delivery % 2 = 0"), ["note", "delivery"])
    return first.unionByName(I.ledger(rows.where("delivery % 2 = 1"), ["note", "delivery"], first))


@query
def ledger_gaps(spark, sf_dir):
    rows = I.ledger(deliveries(spark, sf_dir).select("delivery", "event_id"), ["delivery"])
    odd = rows.where("sequence % 2500 = 11").withColumn("sequence", F.when(F.col("sequence") % 5000 == 11, -F.col("sequence")))
    return I.ledger_gaps(rows.where("sequence > 2 and sequence % 1000 not in (7, 20, 21, 22, 23, 24)").unionByName(rows.where("sequence % 1000 = 9")).unionByName(odd))


def records(spark, sf_dir):
    rows = deliveries(spark, sf_dir).where("event_id is not null").withColumn("record_id", I.record_id(deliveries(spark, sf_dir)))
    kept = rows.groupBy("record_id").agg(F.min_by(F.struct("event_id", "producer_id", "event_class", "producer_contract", "payload_hash", "delivery"), "delivery").alias("x")).select("record_id", "x.*")
    state = F.when(F.col("delivery") % 19 == 0, "RETRACTED").when(F.col("delivery") % 17 == 0, "QUARANTINED").otherwise("ACCEPTED")
    return kept.withColumnRenamed("event_id", "source_event_id").withColumn("lifecycle_state", state).withColumn("superseded_by", F.lit(None).cast("string"))


@query
def dedup_records(spark, sf_dir):
    return records(spark, sf_dir).select("record_id", "source_event_id", "delivery")


@query
def canonical_ids(spark, sf_dir):
    rows = deliveries(spark, sf_dir)
    return rows.select("delivery", I.record_id(rows).alias("record_id"))


def corrections(spark, sf_dir):
    rows = records(spark, sf_dir)
    replaced = F.concat(F.lit("ev-"), (F.regexp_extract("source_event_id", r"(\d+)$", 1).cast("bigint") + 1).cast("string"))
    return rows.where("delivery % 11 = 0").select(F.col("record_id").alias("target"), replaced.alias("replacement_event_id"))


@query
def supersession_overlay(spark, sf_dir):
    return I.superseded(corrections(spark, sf_dir), records(spark, sf_dir))


@query
def predecessors(spark, sf_dir):
    return I.predecessors(records(spark, sf_dir), corrections(spark, sf_dir))


def learned(spark, sf_dir):
    """Observations of the records: some have none, some two, and some belong to no record."""
    rows = records(spark, sf_dir).where("delivery % 4 != 0")
    both = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(5 * k + 5).cast("bigint").alias("effort_minutes")) for k in (0, 1)))
    twice = rows.select(F.when(F.col("delivery") % 83 == 0, F.concat("record_id", F.lit("x"))).otherwise(F.col("record_id")).alias("record_id"), "delivery", F.explode(both).alias("o"))
    return twice.where("o.k = 0 or delivery % 3 = 0").select("record_id", F.col("o.effort_minutes").alias("effort_minutes"))


@query
def integrity_anti_joins(spark, sf_dir):
    targets = corrections(spark, sf_dir).select(F.concat("target", F.when(F.substring("target", -1, 1) == "0", "y").otherwise("")).alias("record_id"))
    return I.orphans(records(spark, sf_dir), observation=learned(spark, sf_dir), correction=targets)


def snapshot(spark, sf_dir):
    rows = records(spark, sf_dir)
    return S.snapshot_rows(rows, learned(spark, sf_dir), I.superseded(corrections(spark, sf_dir), rows))


@query
def snapshot_rows(spark, sf_dir):
    return snapshot(spark, sf_dir).select("record_id", "event_class", "producer_id", "superseded_by", "effort_minutes")


@query
def partition_plan(spark, sf_dir):
    return S.partition_plan(snapshot(spark, sf_dir))


@query
def collision_groups(spark, sf_dir):
    rows = deliveries(spark, sf_dir).where("event_id is not null")
    return S.collisions(rows, "event_id", "payload_hash")


@query
def snapshot_digest(spark, sf_dir):
    return S.snapshot_digest(observations(spark, sf_dir), "record_id", "recurrence_fingerprint")


@query
def manifest_changes(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("n"), F.col("p_partkey").alias("k"))
    named = parts.select(F.concat(F.lit("part-"), F.col("k").cast("string")).alias("name"), F.sha2("n", 256).alias("hash"), "k")
    actual = named.where("k % 50 != 3").withColumn("hash", F.when(F.col("k") % 40 == 7, F.sha2("hash", 256)).otherwise(F.col("hash")))
    return S.changed_hashes(named.where("k % 60 != 5"), actual)


@query
def unsorted_rows(spark, sf_dir):
    rows = deliveries(spark, sf_dir).select("producer_id", "delivery", F.concat(F.lit("r"), F.lpad((F.col("delivery") - F.when(F.col("delivery") % 37 == 5, 60).otherwise(0)).cast("string"), 12, "0")).alias("record_id"))
    return S.unsorted_rows(rows, ["producer_id"], "delivery", "record_id")


@query
def redaction_hits(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    notes = deliveries(spark, sf_dir).select(F.lit("note").alias("kind"), F.col("delivery").alias("id"), F.col("note").alias("text"))
    rows = docs.unionByName(pages).unionByName(notes).withColumn("rule", F.explode(I.redaction_hits(F.col("text"))))
    return rows.select("kind", "id", "rule")


@query
def float_rejection(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"v":'), F.col("event_id").cast("string"), F.lit(".5}"))).when(F.col("event_id") % 3 == 1, F.col("props")).otherwise(F.lit('{"v":"1.5","w":[1,2]}')).alias("doc"))
    return rows.select("event_id", I.has_float(F.col("doc")).alias("has_float"))


@query
def finding_explode(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    one = F.struct(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("finding_id"),
        F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit("rule_"), (F.col("l_partkey") % 50).cast("string"))).otherwise(F.when(F.col("l_partkey") % 2 == 0, "")).alias("canonical_rule_id"),
        F.when(F.col("l_suppkey") % 7 != 0, F.concat(F.lit("fp"), F.col("l_suppkey").cast("string"))).alias("fingerprint"),
        F.when(F.col("l_quantity") > 10, F.array(F.struct(F.concat(F.lit("src/"), F.col("l_returnflag")).alias("normalized_path")))).otherwise(F.array().cast("array<struct<normalized_path:string>>")).alias("locations"),
    )
    bundles = lines.groupBy(F.col("l_orderkey").alias("record_id")).agg(F.collect_list(one).alias("findings"))
    return I.finding_observations(bundles.withColumn("occurrence_scope", F.concat(F.lit("repo_"), (F.col("record_id") % 40).cast("string"))))


@query
def resolver_projection(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("record_id"), F.when(F.col("o_custkey") % 9 != 0, F.concat(F.lit("f"), (F.col("o_custkey") % 100).cast("string"))).alias("failure_fingerprint"),
        F.when(F.col("o_orderstatus") == "O", "code_change").alias("remediation_class"),
        F.when(F.col("o_orderkey") % 4 == 0, "passed").when(F.col("o_orderkey") % 4 == 1, "failed").when(F.col("o_orderkey") % 4 == 2, "flaky").alias("validation_result"))
    return I.resolver_observations(rows)


@query
def historical_projection(spark, sf_dir):
    names = ["clean_verified", "target_failure_resolved", "repeated_failure", "new_failure", "partial_resolution", "outcome_unknown", "unresolved", "unheard_of"]
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        k.cast("string").alias("record_id"), F.when(k % 11 != 0, F.element_at(F.array(*map(F.lit, names)), (k % 8 + 1).cast("int"))).alias("outcome"),
        (k % 9 == 0).alias("suspected_flake"), F.when(k % 5 != 0, F.concat(F.lit("historical:"), (k % 77).cast("string"))).alias("semantic_identity"))
    return I.historical_observations(rows)


def runs(spark, sf_dir):
    rows = view(spark, sf_dir, "runs_raw")
    number = F.floor((F.col("seq") - 1) / 4)
    return rows.select("run_id", "workflow", F.concat("workflow", F.lit("-r"), number.cast("string")).alias("revision"), number.alias("number"), F.when(F.col("run_id") % 23 != 0, (F.col("seq") - 1) % 4 + 1).alias("attempt"), "conclusion", "updated_at")


def commits(spark, sf_dir):
    return commits_of(runs(spark, sf_dir))


def commits_of(all_runs):
    """A chain of revisions per workflow; every fifth revision is a merge that also has the one before the last as parent."""
    revs = all_runs.select("workflow", "number").distinct()
    name = lambda n: F.concat("workflow", F.lit("-r"), n.cast("string"))
    parents = F.when(F.col("number") == 0, F.array(F.lit(None).cast("bigint"))).when((F.col("number") % 5 == 0), F.array(F.col("number") - 1, F.col("number") - 2)).otherwise(F.array(F.col("number") - 1))
    return revs.select("workflow", "number", F.explode(parents).alias("p")).select("workflow", name(F.col("number")).alias("revision"), F.when(F.col("p").isNotNull(), name(F.col("p"))).alias("parent"))


def wanted(all_runs):
    """All pairs of a revision and one that is not before it, of each workflow."""
    revs = all_runs.select("workflow", "number", "revision").distinct()
    pairs = revs.select("workflow", F.col("number").alias("n0"), F.col("revision").alias("before")).join(revs.select("workflow", "number", F.col("revision").alias("after")), "workflow")
    return pairs.where("n0 <= number").select("workflow", "before", "after")


@query
def path_unique(spark, sf_dir):
    all_runs = H.cut(runs(spark, sf_dir))  # read several times
    found = H.unique_paths(commits_of(all_runs), wanted(all_runs))
    return found.select("workflow", "before", "after", F.array_join("path", ">").alias("path"))


@query
def flake_classes(spark, sf_dir):
    return H.flake_classes(runs(spark, sf_dir))


@query
def next_run(spark, sf_dir):
    all_runs = H.cut(runs(spark, sf_dir))  # read many times
    failed = all_runs.where("conclusion = 'failure'")
    return H.next_runs(failed, all_runs, H.nearest_descendants(commits_of(all_runs), failed, all_runs))


@query
def episode_attribution(spark, sf_dir):
    k = F.col("event_id")
    text = lambda *names: F.when(k % 13 == 0, F.array(*map(F.lit, names))).otherwise(F.array().cast("array<string>"))
    rows = table(spark, sf_dir, "events").select(
        k.alias("episode"), F.lit("ci").alias("before_workflow"), F.when(k % 29 == 0, "cd").otherwise("ci").alias("after_workflow"), F.lit("test").alias("before_job"),
        F.when(k % 23 == 0, F.lit(None)).when(k % 31 == 0, "lint").otherwise("test").alias("after_job"), F.array(F.lit("build"), F.lit("run")).alias("before_steps"),
        F.when(k % 7 == 0, F.array().cast("array<string>")).when(k % 37 == 0, F.array(F.lit("run"))).otherwise(F.array(F.lit("build"), F.lit("run"))).alias("after_steps"),
        (k % 41 == 0).alias("step_skipped"), (k % 11 == 0).alias("workflow_changed"), (k % 43 == 0).alias("environment_changed"), (k % 5 == 0).alias("test_changed"),
        (k % 17 == 0).alias("lockfile_changed"), (k % 19 == 0).alias("is_merge"), text("test_skipped").alias("weakening"), (k % 3).alias("change_count"),
        (1 + (k % 21 == 0).cast("int")).alias("before_failure_count"), (k % 6 == 0).alias("same_revision"), (k % 47 == 0).alias("attempt_history_missing"),
        F.lit("failure").alias("before_conclusion"), F.when(k % 53 == 0, "cancelled").otherwise("success").alias("after_conclusion"), F.array().cast("array<string>").alias("extra_confounders"),
        F.when(k % 8 == 0, "failure").when(k % 59 == 0, "skipped").when(k % 61 != 0, "success").alias("target_conclusion"), (k % 67 == 0).alias("empty_change"),
        (k % 10 == 0).alias("target_failure_present"), (k % 12 == 1).cast("int").alias("new_failure_count"), (k % 71 == 0).alias("other_failure"),
        F.when(k % 4 == 1, "suspected").otherwise("none").alias("flake_class"))
    out = H.attribution(H.confounders(H.equivalence(rows)))
    return out.select("episode", F.array_join("equivalence_reasons", ",").alias("reasons"), "completeness", F.array_join("confounders", ",").alias("confounders"), F.array_join("limitations", ",").alias("limitations"), "grade", "attribution_class", "outcome", "evidence_completeness", "suspected_flake", H.strength(F.col("grade")).alias("strength"))


@query
def native_event_stack(spark, sf_dir):
    episodes = table(spark, sf_dir, "orders").select(F.concat(F.lit("hep_"), F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("episode_id"))
    return H.episode_events(episodes).select("event_id", "parent_event_id", "observation_kind")


@query
def evidence_graph(spark, sf_dir):
    nodes, edges = H.graph(runs(spark, sf_dir), commits(spark, sf_dir))
    kinds = nodes.groupBy(F.lit("node").alias("part"), "type").agg(F.count(F.lit(1)).alias("n"))
    return kinds.unionByName(edges.groupBy(F.lit("edge").alias("part"), "type").agg(F.count(F.lit(1)).alias("n")))


@query
def change_features(spark, sf_dir):
    k = F.col("p_partkey")
    file = lambda path, patch, status="modified": F.struct(F.lit(path).alias("path"), F.lit(status).alias("status"), F.lit(patch).cast("string").alias("patch"))
    files = F.array_compact(F.array(
        F.when(k % 2 == 0, file("src/core/app.py", "+x = 1\n-y = 2")), F.when(k % 3 == 0, file("tests/test_app.py", "-    assert x\n+    pass")), F.when(k % 5 == 0, file(".github/workflows/ci.yml", "+  if: FALSE")),
        F.when(k % 7 == 0, file("deps/x.lock", None)), F.when(k % 11 == 0, file("docker/Dockerfile", "+FROM x")), F.when(k % 13 == 0, file("src/tests/old.py", None, "removed")), F.when(k % 17 == 0, file("src/b_test.py", "+++ a\n+@unittest.skip"))))
    rows = H.change_features(table(spark, sf_dir, "part").select(k.alias("change"), F.when(k % 19 != 0, files).alias("files")))
    return rows.select("change", "file_count", "workflow_changed", "test_changed", "environment_changed", "lockfile_changed", F.array_join("weakening", ",").alias("weakening"))


@query
def channel_history(spark, sf_dir):
    k = F.col("o_orderkey")
    version = F.concat((k % 12).cast("string"), F.lit("."), (k % 5).cast("string"), F.lit(".0"))
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("channel_"), (F.col("o_custkey") % 50).cast("string")).alias("channel"), k.alias("sequence"), version.alias("pack_version"), F.sha2(version, 256).alias("archive_hash"))
    return P.channel_history(rows)


@query
def metadata_table(spark, sf_dir):
    rows = snapshot(spark, sf_dir)
    return rows.agg(F.lit("snapshot/v1").alias("format_version"), F.count_distinct("record_id").cast("bigint").alias("record_count"), F.count(F.lit(1)).cast("bigint").alias("row_count"))


@query
def pseudonyms(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    return rows.select("c_custkey", canonical.pseudonym("repository_", b"a key of the test that is long enough", F.col("c_name")).alias("token"))


@query
def redaction_paths(spark, sf_dir):
    rows = deliveries(spark, sf_dir).select("delivery", F.to_json(F.struct(F.struct("note", F.col("event_id").alias("api_key")).alias("payload"))).alias("doc"))
    return I.redaction_paths(rows, "delivery", "doc").withColumnRenamed("key", "delivery")


@query
def windowed_events(spark, sf_dir):
    from siltstone.streaming.ingest import windowed_counts

    out = windowed_counts(table(spark, sf_dir, "events"))
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query
def streaming_ingest(spark, sf_dir):
    """Deliveries through the stream to a store in the shared folder, a twentieth of them twice, with corrections of
    records that come, that came, and that never do; the ledger's and the overlay's totals."""
    import uuid

    from siltstone.session import shared_folder
    from siltstone.streaming.ingest import ingest_stream

    store = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    null = F.lit(None).cast("string")
    rows = deliveries(spark, sf_dir).select("delivery", F.sha2("event_id", 256).alias("record_id"), null.alias("kind"), null.alias("replacement"))
    target = F.when(F.col("delivery") % 22 == 0, F.concat("record_id", F.lit("x"))).otherwise(F.col("record_id"))
    fixes = rows.where("delivery % 11 = 0 and record_id is not null").select("delivery", target.alias("record_id"), F.lit("correction").alias("kind"), F.concat(F.lit("r"), F.col("delivery").cast("string")).alias("replacement"))
    files = max(2, spark.sparkContext.defaultParallelism)  # of each part; two batches
    for part in (fixes, rows.where("delivery % 20 = 0"), rows):
        part.repartition(files, "delivery").write.mode("append").parquet(f"{store}/source")
    ingest_stream(spark, f"{store}/source", rows.schema, store, files_per_batch=-(-3 * files // 2)).awaitTermination()
    ledger = spark.read.parquet(f"{store}/ledger").select("kind", "disposition", "record_id", null.alias("superseded_by"))
    overlay = spark.read.parquet(f"{store}/overlay").groupBy("kind", "disposition", "record_id").agg(F.max("superseded_by").alias("superseded_by"))
    return ledger.unionByName(overlay).groupBy("kind", "disposition").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("record_id").alias("records"), F.max("superseded_by").alias("last"))


REPOSITORY_KEY, PATH_KEY = b"a key of the test that is long enough", b"another key of the test, also long"


def finding_bundles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    one = F.struct(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("finding_id"), F.array(F.struct(F.concat(F.lit("src/"), F.col("l_returnflag"), F.lit(".py")).alias("normalized_path"), F.col("l_linenumber").alias("start_line"))).alias("locations"))
    rows = lines.groupBy(F.col("l_orderkey").alias("record")).agg(F.array_sort(F.collect_list(one)).alias("findings"))
    text = F.col("record").cast("string")
    return rows.withColumn("snapshot", F.struct(F.concat(F.lit("snap"), text).alias("snapshot_id"), F.concat(F.lit("rev"), text).alias("revision"), F.lit("/home/dev/repo").alias("repository_root"))).withColumn("repository", F.concat(F.lit("repo"), (F.col("record") % 9).cast("string")))


@query
def redacted_bundles(spark, sf_dir):
    rows = I.redacted_bundles(finding_bundles(spark, sf_dir), PATH_KEY)
    return rows.select("record", F.explode("findings").alias("f"), "snapshot").select("record", "f.finding_id", F.col("f.locations")[0]["normalized_path"].alias("path"), "snapshot.snapshot_id", "snapshot.revision")


@query
def bundle_envelopes(spark, sf_dir):
    return I.envelopes(I.redacted_bundles(finding_bundles(spark, sf_dir), PATH_KEY), REPOSITORY_KEY).select("record", "event_class", "redaction_status", "repository_identity", F.length("event_id").alias("id_length"))


@query
def unknown_lineage(spark, sf_dir):
    k = F.col("o_orderkey")
    lineage = F.map_from_arrays(F.when(k % 3 == 0, F.array(F.lit("parent"), F.lit("zeta"), F.lit("odd"))).otherwise(F.array(F.lit("parent"))), F.when(k % 3 == 0, F.array(*map(F.lit, "abc"))).otherwise(F.array(F.lit("a"))))
    rows = I.unknown_lineage(table(spark, sf_dir, "orders").select(k.alias("delivery"), lineage.alias("lineage")), ("parent", "source"))
    return rows.select("delivery", F.array_join("unknown_keys", ",").alias("unknown_keys"))


@query
def ingress_status(spark, sf_dir):
    k = F.col("o_orderkey")
    kinds = F.element_at(F.array(*map(F.lit, ("accepted", "conflict", "quarantined", "unavailable", "duplicate"))), (k % 5 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select(k.alias("request"), F.when(k % 11 == 0, "/other").otherwise("/events").alias("path"), F.when(k % 13 == 0, "GET").otherwise("POST").alias("method"), F.when(k % 19 != 0, k % 17 != 0).alias("authorized"), F.when(k % 23 == 0, 2000000).otherwise(10).alias("size"), (k % 29 == 0).alias("malformed"), kinds.alias("disposition"))
    return rows.select("request", I.ingress_status().alias("status"))


@query
def verify_store(spark, sf_dir):
    """A store with planted faults: entries missing and pointing nowhere, a changed payload hash, lost observations."""
    rows = records(spark, sf_dir)
    runs_of = deliveries(spark, sf_dir).select("delivery", "snapshot_or_run_id")
    rows = rows.join(runs_of, "delivery").withColumn("payload_hash", F.when(F.col("delivery") % 301 == 7, "changed").otherwise(F.col("payload_hash")))
    entries = I.ledger(deliveries(spark, sf_dir).select("delivery"), ["delivery"]).join(rows.select("delivery", "record_id"), "delivery", "left")
    entries = entries.withColumn("record_id", F.when(F.col("delivery") % 211 == 3, F.concat("record_id", F.lit("z"))).otherwise(F.col("record_id")))
    entries = entries.withColumn("disposition", F.when(F.col("record_id").isNotNull(), "accepted").otherwise("quarantined"))
    return I.verify_store(rows, entries.where("sequence % 500 != 3"), observation=learned(spark, sf_dir))


@query
def report_document(spark, sf_dir):
    rows = M.recurrence(observations(spark, sf_dir)).select("recurrence_fingerprint", "event_class", "canonical_rule_id", "occurrence_count")
    return S.report_document(rows, "cs_test", "recurrence_fingerprint", "event_class")


@query
def graph_digest(spark, sf_dir):
    return H.graph_digest(*H.graph(runs(spark, sf_dir), commits(spark, sf_dir)))


@query
def normalized_runs(spark, sf_dir):
    k = F.col("event_id")
    doc = F.to_json(F.struct(k.cast("string").alias("id"), F.concat(F.lit("sha"), F.col("user_id").cast("string")).alias("head_sha"), (k % 4).alias("run_attempt"), F.when(k % 3 == 0, ".github/ci.yml").when(k % 3 == 1, " ").alias("path"), F.when(k % 5 != 0, (k % 7).cast("string")).alias("workflow_id"), F.lit("CI").alias("name"), F.when(k % 2 == 0, "success").alias("conclusion")))
    return H.normalized_runs(table(spark, sf_dir, "events").select(doc.alias("payload")))


@query
def hydrated_episodes(spark, sf_dir):
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(k.alias("n"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"))
    name = lambda prefix, x: F.concat(F.lit(prefix), x.cast("string"))
    episodes = rows.select(F.col("n").alias("episode_id"), name("j", F.col("n")).alias("job_ref"), name("r", F.col("n")).alias("before_run"), name("r", F.col("n") + 1).alias("after_run"), name("c", F.col("n")).alias("revision"))
    jobs = rows.where("n % 3 != 0").select(name("j", F.col("n")).alias("job_ref"), F.when(F.col("n") % 2 == 0, F.col("at")).alias("completed_at"), F.when(F.col("n") % 5 != 0, F.col("at")).alias("started_at"))
    all_runs = rows.where("n % 7 != 0").select(name("r", F.col("n")).alias("run_ref"), F.when(F.col("n") % 4 != 0, F.col("at")).alias("updated_at"), F.col("at").alias("created_at"))
    times = rows.where("n % 4 = 1").select(name("c", F.col("n")).alias("revision"), F.col("at").alias("committed_at"))
    return H.hydrated(episodes, jobs, all_runs, times)


def provider_objects(spark, sf_dir):
    """Seven kinds of provider objects in a pull request per workflow: two jobs per run, a commit per revision with the
    parents of ``commits``, and of some kinds what is missing, blank or of the wrong type."""
    all_runs = H.cut(runs(spark, sf_dir))  # each kind reads it
    all_runs = all_runs.withColumn("user", F.regexp_extract("workflow", r"(\d+)$", 1).cast("bigint"))
    n, k, user = F.col("number"), F.col("run_id"), F.col("user")
    text = lambda c: c.cast("string")
    shape = lambda kind, source, payload, attempt=F.lit(None), limitations=F.array(): (F.col("workflow").alias("scope"), source.alias("source"), F.lit(kind).alias("kind"), payload.alias("payload"), attempt.cast("int").alias("run_attempt"), limitations.cast("array<string>").alias("limitations"))
    name = lambda x: F.concat("workflow", F.lit("-r"), text(x))
    json = lambda **fields: F.to_json(F.struct(*(v.alias(x) for x, v in fields.items())))
    users = all_runs.groupBy("workflow", "user").agg(F.max("number").alias("number"))
    pulls = users.select(*shape("pull_request", F.lit("pull"), json(number=user, base=F.struct(name(F.lit(0)).alias("sha")), head=F.struct(F.when(user % 6 != 0, name(n)).alias("sha")), auto_merge=F.struct(F.when(user % 7 == 0, "squash").otherwise("").alias("merge_method")))))
    signals = users.where("user % 5 < 3").select(*shape("timeline_event", F.lit("event"), json(event=F.when(user % 5 == 0, "base_ref_changed").when(user % 5 == 1, "head_ref_force_pushed").otherwise("labeled"), created_at=F.lit("t"))))
    file = lambda path, patch, status="modified": F.struct(F.lit(path).alias("filename"), F.lit(status).alias("status"), F.lit(patch).cast("string").alias("patch"))
    files = F.array_compact(F.array(
        F.when(n % 29 != 9, file("src/a.py", "+x")), F.when(n % 7 == 3, file(".github/workflows/ci.yml", "+y")), F.when(n % 11 == 4, file("pyproject.toml", None)), F.when(n % 3 == 1, file("tests/test_a.py", "+z")), F.when(n % 13 == 5, file("poetry.lock", None)),
        F.when(n % 17 == 6, file("tests/old.py", None, "removed")), F.when(n % 19 == 7, file("src/b.py", "+@pytest.mark.skip"))))
    tips = commits_of(all_runs).groupBy("workflow", "revision").agg(F.sort_array(F.collect_list(F.struct(F.col("parent").alias("sha"))), asc=False).alias("parents"))
    tips = tips.join(all_runs.select("workflow", "revision", "number").distinct(), ["workflow", "revision"]).where("number % 31 != 10")
    made = tips.select(*shape("commit", F.concat(F.lit("c"), text(n)), json(sha=F.col("revision"), parents=F.filter("parents", lambda p: p["sha"].isNotNull()), files=F.when(n % 23 != 8, files), commit=F.struct(F.struct(F.concat(F.lit("d"), text(n)).alias("date")).alias("committer")))))
    gap = F.when(k % 47 == 0, F.array(F.lit("provider_attempt_history_missing"))).otherwise(F.array())
    ran = all_runs.select(*shape("workflow_run", F.concat(F.lit("r"), text(k)), json(id=k, head_sha=F.col("revision"), run_attempt=F.col("attempt"), path=F.lit("ci.yml"), conclusion=F.col("conclusion"), updated_at=F.col("updated_at")), limitations=gap))
    step = lambda title, state: F.struct(F.lit(title).alias("name"), state.alias("conclusion"))
    tested = F.when(k % 41 == 0, F.array().cast("array<struct<name:string,conclusion:string>>")).when(k % 37 == 0, F.array(step("run", F.col("conclusion")))).otherwise(F.array(step("setup", F.lit("success")), step("run", F.when((k % 43 == 0) & (F.col("conclusion") == "success"), "skipped").otherwise(F.col("conclusion")))))
    job = lambda ref, title, ended, steps: json(id=ref, run_id=k, head_sha=F.col("revision"), run_attempt=F.col("attempt"), name=F.lit(title), conclusion=ended, completed_at=F.col("updated_at"), steps=steps)
    test = all_runs.where("run_id % 31 != 0").select(*shape("ci_job", F.concat(F.lit("t"), text(k)), job(2 * k + 1, "test", F.col("conclusion"), tested)))
    built = F.when(k % 14 == 3, "failure").otherwise("success")
    build = all_runs.select(*shape("ci_job", F.concat(F.lit("b"), text(k)), job(2 * k, "build", built, F.array(step("compile", built)))))
    checks = all_runs.where("run_id % 10 = 0").select(*shape("check_run", F.concat(F.lit("k"), text(k)), json(id=text(k), head_sha=F.lit(""), name=F.lit("lint"), conclusion=F.col("conclusion"))))
    logs = all_runs.where("run_id % 10 = 1").select(*shape("job_log", F.concat(F.lit("l"), text(k)), F.concat(F.lit("raw text "), text(k))))
    odd = all_runs.where("run_id % 100 = 2").select(*shape("ci_job", F.concat(F.lit("o"), text(k)), F.lit("[1]")))
    out = pulls
    for part in (signals, made, ran, test, build, checks, logs, odd):
        out = out.unionByName(part)
    return out


@query
def normalized_objects(spark, sf_dir):
    rows = O.normalized(provider_objects(spark, sf_dir))
    return rows.select("scope", "source", "kind", "ref", "execution_ref", "revision", "name", "attempt", "conclusion", F.array_join("parents", ",").alias("parents"), F.array_join("weakening", ",").alias("weakening"), F.array_join("failed_steps", ",").alias("failed_steps"), "availability", F.array_join("limitations", ",").alias("limitations"))


@query
def episodes(spark, sf_dir):
    rows = H.episodes(O.normalized(provider_objects(spark, sf_dir)))
    return rows.select("scope", "before_execution_ref", "after_execution_ref", "job_ref", "name", "change_count", "before_failure_count", "new_failure_count", "failure_after", F.array_join("equivalence_reasons", ",").alias("reasons"), F.array_join("confounders", ",").alias("confounders"), F.array_join("limitations", ",").alias("limitations"), "grade", "attribution_class", "outcome", "evidence_completeness", "suspected_flake")


STORED = "record_id string, event_class string, producer_id string, source_event_id string, delivery bigint"


def written(spark, sf_dir):
    """A store in the shared folder, and what its three writes said: a half of the records, all of them with some bodies
    changed, and all of them again."""
    import uuid

    from siltstone.session import shared_folder

    path = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    rows = records(spark, sf_dir).select("record_id", "event_class", "producer_id", "source_event_id", "delivery")
    changed = rows.withColumn("source_event_id", F.when(F.col("delivery") % 10 == 4, "changed").otherwise(F.col("source_event_id")))
    said = None
    for number, batch in enumerate((rows.where("delivery % 2 = 0"), changed, changed), 1):
        out = W.write_once(batch, path).select(F.lit(number).alias("write"), "record_id", "status")
        said = out if said is None else said.unionByName(out)
    return path, said


@query
def store_write_once(spark, sf_dir):
    return written(spark, sf_dir)[1]


@query
def manifest_view(spark, sf_dir):
    path, _ = written(spark, sf_dir)
    records(spark, sf_dir).limit(5).write.parquet(f"{path}/data/batch=stray")  # no manifest lists these
    return W.view(spark, path, STORED, "event_class = 'static_finding'")


SNAPSHOT_ID = "cs_test"


@query
def report_manifest(spark, sf_dir):
    return R.analysis(observations(spark, sf_dir), SNAPSHOT_ID)[1]


@query
def verify_analytics(spark, sf_dir):
    """A run with planted faults (recurrence rows lost, a changed row of each rule with failures, a report unlisted) beside
    an intact one and one that is nowhere listed; the name of the snapshot stands for the run's identity."""
    obs = R.observed(observations(spark, sf_dir))
    rows, manifest, run = R.analysis(obs, SNAPSHOT_ID, is_written=True)
    other_rows, other_manifest, other = R.analysis(obs.where("occurrence_scope not like 'record:%'"), "cs_other", is_written=True)
    lost = (F.col("name") == "recurrence") & F.col("row").rlike('"recurrence_fingerprint":"0')
    rows = rows.where(~lost).withColumn("row", F.when((F.col("name") == "effectiveness") & ~F.col("row").contains('"failed_count":0,'), F.concat("row", F.lit(" "))).otherwise(F.col("row")))
    manifest = manifest.where("name != 'cooccurrence'")
    stray = rows.where("name = 'effort'").withColumn("run_id", F.lit("ar_stray"))
    found = R.verify_analytics(rows.unionByName(other_rows).unionByName(stray), manifest.unionByName(other_manifest), run.unionByName(other))
    named = run.unionByName(other).select("run_id", "source_snapshot_id")
    return found.join(F.broadcast(named), "run_id", "left").select("source_snapshot_id", "name", "fault")


def documents_of(spark, sf_dir):
    run = R.analysis(observations(spark, sf_dir), SNAPSHOT_ID)[2]
    return A.candidate_documents(compiled(spark, sf_dir), run)


@query
def candidate_documents(spark, sf_dir):
    return documents_of(spark, sf_dir).select("candidate_id", "run_id", "source_snapshot_id", "recurrence_fingerprint", "title", "rationale", "state", F.array_join("limitations", "|").alias("limitations"))


@query
def artifact_files(spark, sf_dir):
    return A.files(documents_of(spark, sf_dir)).select("file", "body")


@query
def verify_compilation(spark, sf_dir):
    """A compilation whose files were lost, changed or added afterwards, by the first digit of their fingerprint."""
    docs = documents_of(spark, sf_dir)
    files = A.files(docs)
    lines, made = R.compilation(docs, files, C.regression(docs, C.fixtures(docs)))
    first = docs.select("candidate_id", F.left("recurrence_fingerprint", F.lit(1)).alias("first"))
    now = files.join(first, "candidate_id").where("first != '1'").withColumn("body", F.when(F.col("first") == "2", F.concat("body", F.lit("#"))).otherwise(F.col("body")))
    stray = now.where("first = '3'").withColumn("file", F.concat("file", F.lit(".bak")))
    return R.verify_compilation(now.unionByName(stray).select("file", "body"), lines, made)


@query
def outcome_digests(spark, sf_dir):
    from siltstone.operators.ordered import grouped_digest

    return grouped_digest(R.outcome_texts(outcomes(spark, sf_dir)), ["pack_id"], "row")


@query
def verify_effectiveness(spark, sf_dir):
    """Reports of packs (one per pack and rule) whose outcomes, rows or manifest lines changed afterwards."""
    seen = outcomes(spark, sf_dir).withColumn("pack_id", F.concat_ws(":", "pack_id", "canonical_rule_id"))
    rows, manifest = R.effectiveness_reports(seen, E.rule_metrics(seen, "pack_id"))
    late = seen.where("not (pack_id like '%:rule_1_' and outcome_class = 'repair_failed')").withColumn("observed_at", F.lit("later"))
    rows = rows.where("pack_id not like '%:rule_2'").withColumn("row", F.when(F.col("pack_id").like("%:rule_3_"), F.concat("row", F.lit(" "))).otherwise(F.col("row")))
    manifest = manifest.where("pack_id not like '%:rule_4'").withColumn("report_id", F.when(F.col("pack_id").like("pack_0:rule_5"), "er_other").otherwise(F.col("report_id")))
    return R.verify_effectiveness(rows, manifest, late)


def publications(spark, sf_dir):
    k = F.col("o_orderkey")
    version = F.concat((k % 12).cast("string"), F.lit("."), (k % 5).cast("string"), F.lit(".0"))
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("channel_"), (F.col("o_custkey") % 50).cast("string")).alias("channel"), k.alias("sequence"), version.alias("pack_version"), F.sha2(version, 256).alias("archive_hash"))


def published(spark, sf_dir):
    """An index in the shared folder after three batches, a stale writer and the first batch again; and what each was told."""
    import uuid

    from siltstone.session import shared_folder

    path = f"{shared_folder(spark)}/channels-{uuid.uuid4().hex}"
    rows = publications(spark, sf_dir)
    third = F.floor(F.col("sequence") * 3 / F.lit(rows.agg(F.max("sequence")).first()[0] + 1))
    batches = [rows.where(third == k) for k in range(3)]
    said = None
    for number, (batch, expected) in enumerate(((batches[0], 0), (batches[1], 1), (batches[2], 1), (batches[2], 2), (batches[0], 3)), 1):
        out = N.publish(batch, path, expected).select(F.lit(number).alias("write"), "channel", "sequence", "status")
        said = out if said is None else said.unionByName(out)
    return path, said


@query
def channel_index(spark, sf_dir):
    return N.entries(spark, published(spark, sf_dir)[0])


@query
def channel_writes(spark, sf_dir):
    return published(spark, sf_dir)[1]


def retirements(spark, sf_dir):
    k, rows = F.col("sequence"), publications(spark, sf_dir)
    reason = F.when(k % 21 == 0, " ").when(k % 35 == 0, F.lit(None)).otherwise(F.concat(F.lit("reason "), (k % 4).cast("string")))
    return rows.where("sequence % 7 = 0").select(F.col("channel").alias("pack_id"), "pack_version", F.col("archive_hash").alias("pack_sha256"), reason.alias("reason"), F.when(k % 2 == 0, "99.0.0").alias("replacement_version"), F.lit("2026-01-01T00:00:00Z").alias("retired_at"), F.when(k % 77 != 0, "ops").otherwise("").alias("issuer"))


@query
def retirement_ledger(spark, sf_dir):
    """Retirements written in two batches that overlap: how often each was said to be what."""
    import uuid

    from siltstone.session import shared_folder

    path = f"{shared_folder(spark)}/retired-{uuid.uuid4().hex}"
    rows = retirements(spark, sf_dir)
    first, second = N.retire(rows.where("pack_version < '5'"), path), N.retire(rows, path)
    return first.unionByName(second).groupBy("retirement_id", "status").agg(F.count(F.lit(1)).alias("n"))


@query
def channels_in_force(spark, sf_dir):
    offered = N.entries(spark, published(spark, sf_dir)[0])
    return N.in_force(offered, retirements(spark, sf_dir).where("reason is not null")).select("channel", "pack_version", "sequence", "previous_version", "retired", "replacement_version")
