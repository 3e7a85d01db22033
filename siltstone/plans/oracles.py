"""The same queries in the oracle's SQL, written independently of the operators."""

from __future__ import annotations

from siltstone.sources.bridge import cte

ORACLES: dict[str, str] = {}

NUL = "chr(0)"
OBS = """obs as (select record_id, producer_id, event_class, producer_contract,
  coalesce(nullif(trim(stored_scope), ''), 'record:' || record_id) as occurrence_scope,
  case when length(stored_key) = 64 then stored_key else sha256(event_class || chr(0) || payload_hash) end as recurrence_fingerprint,
  canonical_rule_id, remediation_class, case when stored_effort >= 0 then stored_effort end as effort_minutes,
  validation_outcome, false_positive_disposition from observations_stored)"""
RECURRENCE = """recurrence as (select recurrence_fingerprint, event_class,
  case when count(canonical_rule_id) = count(*) and min(canonical_rule_id) = max(canonical_rule_id) then min(canonical_rule_id) end as canonical_rule_id,
  count(*) as occurrence_count, count(distinct occurrence_scope) as distinct_scope_count, count(distinct producer_id) as distinct_producer_count,
  min(occurrence_scope) as first_scope, max(occurrence_scope) as last_scope from obs group by 1, 2)"""
ATLAS = """atlas as (select event_class, remediation_class, count(effort_minutes) as known_observation_count,
  count(*) - count(effort_minutes) as unknown_observation_count, cast(sum(effort_minutes) as bigint) as total_minutes,
  round(avg(effort_minutes), 12) as mean_minutes, median(effort_minutes) as median_minutes,
  cast(quantile_disc(effort_minutes, 0.95) as double) as p95_minutes from obs group by 1, 2)"""
RULES = """rules as (select canonical_rule_id, count(*) as attempt_count,
  count(*) filter (false_positive_disposition = 'confirmed_false_positive') as confirmed_false_positive_count,
  count(*) filter (false_positive_disposition = 'confirmed_true_positive') as confirmed_true_positive_count,
  count(*) filter (false_positive_disposition = 'inconclusive') as inconclusive_count,
  count(*) filter (validation_outcome = 'passed') as successful_count, count(*) filter (validation_outcome = 'failed') as failed_count,
  count(*) filter (validation_outcome = 'partial') as partial_count from obs group by 1),
effectiveness as (select *, attempt_count - confirmed_false_positive_count - confirmed_true_positive_count - inconclusive_count as unknown_count,
  attempt_count - successful_count - failed_count - partial_count as validation_unknown_count,
  round(confirmed_false_positive_count / nullif(confirmed_false_positive_count + confirmed_true_positive_count, 0), 12) as false_positive_ratio,
  round(successful_count / nullif(successful_count + failed_count + partial_count, 0), 12) as success_ratio from rules)"""
MEANS = "means as (select event_class, round_even(avg(mean_minutes), 6) as mean_effort_minutes from atlas where mean_minutes is not null group by 1)"
# Decimals throughout, halves to even, as the operator computes them.
CANDIDATES = """joined as (select r.*, m.mean_effort_minutes,
  case when e.canonical_rule_id is not null then e.success_ratio else n.success_ratio end as success_ratio,
  case when e.canonical_rule_id is not null then e.false_positive_ratio else n.false_positive_ratio end as false_positive_ratio
  from recurrence r left join effectiveness e on r.canonical_rule_id = e.canonical_rule_id
  left join (select * from effectiveness where canonical_rule_id is null) n on true left join means m on m.event_class = r.event_class),
parts as (select *, cast(least(5, occurrence_count * 5 / 10.0) as decimal(10,6)) as recurrence_score,
  cast(least(5, distinct_scope_count * 5 / 5.0) as decimal(10,6)) as scope_score,
  cast(least(5, greatest(0, round_even(cast(coalesce(cast(mean_effort_minutes as decimal(20,6)), 0) * 5 as double) / 120, 6))) as decimal(10,6)) as effort_score,
  cast(round_even(cast(coalesce(success_ratio, 0) as decimal(20,12)) * 5, 6) as decimal(10,6)) as success_score,
  case when false_positive_ratio is null then 0 else cast(round_even((1 - cast(false_positive_ratio as decimal(20,12))) * 5, 6) as decimal(10,6)) end as safety_score from joined),
scored as (select *, least(5, greatest(0, round_even(recurrence_score * 0.30 + scope_score * 0.20 + effort_score * 0.15 + success_score * 0.15 + safety_score * 0.20, 6))) as score,
  case when event_class in ('gate_outcome', 'CI_failure_classification') then 'sdk_architecture_contract' else 'ast_grep' end as candidate_kind from parts),
compiled as (select *, case when score >= 4 then 'promotion_eligible' when score >= 3 then 'compiled_candidate' else 'deferred' end as state,
  'candidate_' || sha256('{"event_class":"' || event_class || '","fingerprint":"' || recurrence_fingerprint || '","kind":"' || candidate_kind || '"}') as candidate_id from scored),
fixtures as (select candidate_id, recurrence_fingerprint as own, unnest(['positive', 'negative']) as kase, unnest([recurrence_fingerprint, sha256(recurrence_fingerprint || ':negative')]) as fingerprint,
  unnest([true, false]) as expected_match from compiled where state <> 'deferred'),
results as (select candidate_id || ':' || kase as fixture_id, candidate_id, kase as "case", expected_match, own = fingerprint as matched, (own = fingerprint) = expected_match as passed from fixtures)"""


def metrics_sql(keys: str) -> str:
    return f"""counted as (select {keys}, canonical_rule_id, count(*) as evaluation_count,
  count(*) filter (outcome_class in ('rule_not_evaluated', 'evaluation_incomplete', 'outcome_unknown')) as unknown_outcome_count,
  count(*) filter (outcome_class in ('prevented_before_merge', 'diagnostic_accepted')) as prevention_count,
  count(*) filter (outcome_class in ('detected_in_CI', 'diagnostic_shown')) as detection_count,
  count(*) filter (outcome_class = 'escaped_detection') as escape_count, count(*) filter (outcome_class = 'confirmed_false_positive') as false_positive_count,
  count(*) filter (outcome_class = 'diagnostic_accepted') as accepted_diagnostic_count, count(*) filter (outcome_class = 'diagnostic_dismissed') as dismissed_diagnostic_count,
  count(*) filter (outcome_class = 'quick_fix_applied') as quick_fix_applied_count, count(*) filter (outcome_class = 'quick_fix_reverted') as quick_fix_reverted_count,
  count(*) filter (outcome_class = 'repair_succeeded') as repair_success_count, count(*) filter (outcome_class in ('repair_failed', 'repair_rolled_back')) as repair_failure_count,
  quantile_disc(latency_ms, 0.95) as p95_latency_ms from outcomes group by all),
metrics as (select *, evaluation_count - unknown_outcome_count as known_outcome_count,
  round(prevention_count / nullif(prevention_count + detection_count + escape_count, 0), 12) as prevention_ratio,
  round(escape_count / nullif(prevention_count + detection_count + escape_count, 0), 12) as escape_ratio,
  round(false_positive_count / nullif(accepted_diagnostic_count + dismissed_diagnostic_count + false_positive_count, 0), 12) as false_positive_ratio,
  round(quick_fix_reverted_count / nullif(quick_fix_applied_count + quick_fix_reverted_count, 0), 12) as quick_fix_revert_ratio,
  round(repair_success_count / nullif(repair_success_count + repair_failure_count, 0), 12) as repair_success_ratio from counted),
packs as (select {keys}, cast(60 as bigint) as active_rule_count, count(*) as observed_rule_count, cast(sum(evaluation_count) as bigint) as evaluation_count,
  round(sum(prevention_count) / nullif(sum(prevention_count + detection_count + escape_count), 0), 12) as prevention_ratio,
  round(sum(escape_count) / nullif(sum(prevention_count + detection_count + escape_count), 0), 12) as escape_ratio,
  round(sum(false_positive_count) / nullif(sum(accepted_diagnostic_count + dismissed_diagnostic_count + false_positive_count), 0), 12) as false_positive_ratio,
  round(sum(unknown_outcome_count) / nullif(sum(evaluation_count), 0), 12) as unknown_ratio, quantile_disc(p95_latency_ms, 0.95) as p95_latency_ms,
  round(count(*) / 60, 12) as coverage_ratio from metrics group by {keys}),
advice as (select {keys}, canonical_rule_id, evaluation_count, false_positive_ratio, escape_ratio, quick_fix_revert_ratio, p95_latency_ms,
  case when evaluation_count < 20 then 'insufficient_evidence' when false_positive_ratio >= 0.20 then 'retirement_recommended'
    when false_positive_ratio >= 0.10 or escape_ratio >= 0.20 or quick_fix_revert_ratio >= 0.25 then 'rollback_recommended'
    when false_positive_ratio >= 0.05 or escape_ratio >= 0.10 or quick_fix_revert_ratio >= 0.10 or p95_latency_ms > 200 then 'investigate' else 'retain' end as state from metrics)"""


DELTAS = """sides as (select pack_id, m.metric, max(v) filter (period = 'baseline') as baseline, max(v) filter (period = 'current') as current from (
  select pack_id, period, unnest(['prevention_ratio', 'escape_ratio', 'false_positive_ratio', 'unknown_ratio', 'coverage_ratio', 'p95_latency_ms']) as metric,
    unnest([prevention_ratio, escape_ratio, false_positive_ratio, unknown_ratio, coverage_ratio, cast(p95_latency_ms as double)]) as v from packs) m group by all),
deltas as (select pack_id, metric, baseline, current, round(current - baseline, 12) as absolute_delta, case when baseline <> 0 then round((current - baseline) / baseline, 12) end as relative_delta from sides)"""
HITS = """case when regexp_matches({t}, '-----BEGIN [A-Z ]*PRIVATE KEY-----') then 'credential_0' end, case when regexp_matches({t}, '(?i)\\bbearer\\s+[A-Za-z0-9._~+/=-]{{12,}}') then 'credential_1' end,
  case when regexp_matches({t}, '\\bgh[pousr]_[A-Za-z0-9]{{20,}}\\b') then 'credential_2' end, case when regexp_matches({t}, '\\bgithub_pat_[A-Za-z0-9_]{{20,}}\\b') then 'credential_3' end,
  case when regexp_matches({t}, '\\bAKIA[0-9A-Z]{{16}}\\b') then 'credential_4' end, case when regexp_matches({t}, '(^|[^A-Za-z0-9_.-])(/(home|Users|var|tmp|private|opt)/\\S+|[A-Za-z]:\\\\\\S+)') then 'absolute_path' end,
  case when regexp_matches({t}, '\\b[0-9a-fA-F]{{40}}\\b') then 'object_id' end"""
DELIVERED = """delivered as (select *, sha256('note:' || note) as payload_hash,
  'cr_' || sha256('{"event_class":"' || event_class || '","payload_hash":"' || sha256('note:' || note) || '","producer_contract":"' || producer_contract || '","producer_id":"' || producer_id || '","snapshot_or_run_id":"' || snapshot_or_run_id || '"}') as record_id from deliveries)"""
JUDGED = (
    """hashed as (select *, sha256(payload_json) as hash, k.* from deliveries, lateral (select delivery % 97 = 5 or (delivery % 97 = 6 and delivery % 113 <> 11) as malformed,
    event_class = 'weather' or event_id is null or delivery % 107 = 9 or delivery % 109 = 10 or delivery % 113 = 11 as wrong) k),
  named as (select *, 'cr_' || sha256('{"event_class":"' || event_class || '","payload_hash":"' || hash || '","producer_contract":"' || producer_contract || '","producer_id":"' || producer_id || '","snapshot_or_run_id":"' || snapshot_or_run_id || '"}') as rid from hashed),
  stored as (select rid, min(case when delivery % 100 = 0 then 'another' else hash end) as old from named where delivery % 50 = 0 group by 1),
  reasons as (select n.delivery, case when not malformed and not wrong then n.rid end as record_id, old is not null as known, case when malformed then 'malformed_event' when wrong then 'invalid_schema'
    when producer_id not in ('sdk', 'resolver') then 'unknown_producer'
    when event_class <> (case producer_id when 'sdk' then 'static_finding' else 'repair_attempt' end) then 'incompatible_producer_contract'
    when producer_contract <> (case producer_id when 'sdk' then 'finding-bundle/v1' else 'resolver-feedback/v1' end) then 'incompatible_producer_contract'
    when sdk_contract is distinct from (case producer_id when 'sdk' then 'sdk/v1' end) then 'incompatible_sdk_contract'
    when delivery % 101 = 7 then 'redaction_required' when coalesce(HITS) is not null or delivery % 103 = 8 then 'sensitive_content' when old <> hash then 'fingerprint_collision' end as reason from named n left join stored s on s.rid = n.rid),
judged as (select *, case when reason is not null then 'quarantined' when not known and delivery = min(delivery) filter (reason is null) over (partition by record_id) then 'accepted' else 'duplicate' end as disposition from reasons)"""
).replace("HITS", HITS.format(t="note"))
RECORDS = """firsts as (select * from delivered where event_id is not null qualify row_number() over (partition by record_id order by delivery) = 1),
records as (select record_id, event_id as source_event_id, producer_id, event_class, producer_contract, payload_hash, delivery,
  case when delivery % 19 = 0 then 'RETRACTED' when delivery % 17 = 0 then 'QUARANTINED' else 'ACCEPTED' end as lifecycle_state from firsts),
corrections as (select record_id as target, 'ev-' || cast(cast(regexp_extract(source_event_id, '([0-9]+)$', 1) as bigint) + 1 as varchar) as replacement_event_id from records where delivery % 11 = 0),
overlay as (select target as record_id, replacement as superseded_by from (select c.target, r.record_id as replacement, r.record_id not in (select target from corrections) as final
  from corrections c join records r on r.source_event_id = c.replacement_event_id where r.record_id <> c.target) qualify row_number() over (partition by target order by final desc, replacement desc) = 1),
learned as (select case when delivery % 83 = 0 then record_id || 'x' else record_id end as record_id, cast(5 * k + 5 as bigint) as effort_minutes
  from records, (select unnest([0, 1]) as k) where delivery % 4 <> 0 and (k = 0 or delivery % 3 = 0)),
snapshot as (select r.record_id, r.event_class, r.producer_id, o.superseded_by, l.effort_minutes from records r left join overlay o using (record_id) left join learned l on l.record_id = r.record_id
  where lifecycle_state not in ('RETRACTED', 'REJECTED', 'QUARANTINED'))"""
RUNS = """runs as (select run_id, workflow, workflow || '-r' || cast((seq - 1) // 4 as varchar) as revision, (seq - 1) // 4 as number, case when run_id % 23 <> 0 then (seq - 1) % 4 + 1 end as attempt, conclusion, updated_at from runs_raw),
revs as (select distinct workflow, number from runs),
commits as (select workflow, workflow || '-r' || number as revision, case when number > 0 then workflow || '-r' || (number - 1) end as parent from revs
  union all select workflow, workflow || '-r' || number, workflow || '-r' || (number - 2) from revs where number % 5 = 0 and number > 0),
wanted as (select a.workflow, a.workflow || '-r' || a.number as goal, b.workflow || '-r' || b.number as tip from revs a join revs b on a.workflow = b.workflow and a.number <= b.number),
walk as (select workflow, goal, tip, tip as spot, [tip] as path, 0 as depth from wanted
  union all select w.workflow, w.goal, w.tip, c.parent, list_append(w.path, c.parent), w.depth + 1 from walk w join commits c on c.workflow = w.workflow and c.revision = w.spot
  where c.parent is not null and w.spot <> w.goal and not list_contains(w.path, c.parent)),
paths as (select workflow, goal as before, tip as after, list_reverse(min(path)[:-2]) as path from walk where spot = goal group by 1, 2, 3 having count(*) = 1)"""


def add(name: str, select: str, *ctes: str, recursive: bool = False) -> None:
    """Register ``select`` over ``ctes``; a select that begins with a comma goes on with CTEs of its own."""
    head = f"with {'recursive ' if recursive else ''}{', '.join(ctes)}" if ctes else ""
    ORACLES[name] = f"{head}{'' if select.startswith(',') else ' '}{select}".strip()


stored, outcomes, deliveries, runs_raw = (cte(n) for n in ("observations_stored", "outcomes", "deliveries", "runs_raw"))
add("observation_fallbacks", "select * from obs", stored, OBS)
add("recurrence", "select * from recurrence", stored, OBS, RECURRENCE)
add("cooccurrence", """, marks as (select distinct occurrence_scope as s, recurrence_fingerprint as f from obs), counts as (select f, count(*) as n from marks group by 1),
  pairs as (select a.f as l, b.f as r, count(*) as shared from marks a join marks b on a.s = b.s and a.f < b.f group by 1, 2)
  select l as left_fingerprint, r as right_fingerprint, shared as shared_scope_count, x.n as left_scope_count, y.n as right_scope_count, round(shared / (x.n + y.n - shared), 12) as jaccard_ratio
  from pairs join counts x on x.f = l join counts y on y.f = r""", stored, OBS)  # fmt: skip
add("effort_atlas", "select * from atlas", stored, OBS, ATLAS)
add("rule_effectiveness", "select * from effectiveness", stored, OBS, RULES)
add("mean_effort_by_class", "select * from means", stored, OBS, ATLAS, MEANS)
add("limitation_flags", "select bool_or(occurrence_scope like 'record:%') as record_local_scope, bool_or(canonical_rule_id is null) as rule_unknown, bool_or(effort_minutes is null) as effort_unknown from obs", stored, OBS)
chain = (stored, OBS, RECURRENCE, ATLAS, RULES, MEANS, CANDIDATES)
add("candidate_scores", """select recurrence_fingerprint, event_class, canonical_rule_id, candidate_kind, state, candidate_id, cast(recurrence_score as double) as recurrence_score, cast(scope_score as double) as scope_score,
  cast(effort_score as double) as effort_score, cast(success_score as double) as success_score, cast(safety_score as double) as safety_score, cast(score as double) as score from compiled""", *chain)  # fmt: skip
add("compile_summary", """select count(*) as candidates, count(*) filter (state = 'promotion_eligible') as promotion_eligible, count(*) filter (state = 'compiled_candidate') as compiled_candidate,
  count(*) filter (state = 'deferred') as deferred, (select count(*) from results where passed) as fixtures_passed, (select count(*) from results where not passed) as fixtures_failed from compiled""", *chain)  # fmt: skip
add("regression_results", "select * from results", *chain)
add("emitted_rules", """select candidate_id, 'debt.' || substring(replace(candidate_id, 'candidate_', ''), 1, 32) as rule_id, candidate_kind as kind, case when candidate_kind = 'ast_grep' then 'warning' else 'error' end as severity,
  case when candidate_kind = 'ast_grep' then 'rules/' || candidate_id || '.yml' else 'contracts/' || candidate_id || '.json' end as path from compiled where state = 'promotion_eligible'""", *chain)  # fmt: skip
by_pack, by_period = metrics_sql("pack_id"), metrics_sql("pack_id, period")
add("rule_metrics", "select * from metrics", outcomes, by_pack)
add("pack_metrics", "select * from packs", outcomes, by_pack)
add("rule_recommendations", "select * from advice", outcomes, by_pack)
add("pack_recommendation", """select pack_id, p.evaluation_count, unknown_ratio, case when p.evaluation_count < 100 then 'insufficient_evidence' when bad then 'rollback_recommended'
  when odd or unknown_ratio >= 0.25 then 'investigate' else 'retain' end as state from packs p join (select pack_id, bool_or(state in ('retirement_recommended', 'rollback_recommended')) as bad,
  bool_or(state = 'investigate') as odd from advice group by 1) using (pack_id)""", outcomes, by_pack)  # fmt: skip
add("metric_deltas", "select * from deltas", outcomes, by_period, DELTAS)
add("drift", """, d as (select pack_id, max(absolute_delta) filter (metric = 'false_positive_ratio') as fp, max(absolute_delta) filter (metric = 'escape_ratio') as esc,
  max(absolute_delta) filter (metric = 'p95_latency_ms') as lat, max(absolute_delta) filter (metric = 'prevention_ratio') as prev from deltas group by 1),
  n as (select pack_id, cast(sum(case when period = 'baseline' then evaluation_count else 0 end) as bigint) as n_baseline, cast(sum(case when period = 'current' then evaluation_count else 0 end) as bigint) as n_current from packs group by 1)
  select pack_id, n_baseline, n_current, case when n_baseline = 0 or n_current = 0 then 'insufficient_evidence' when fp >= 0.10 or esc >= 0.15 or lat >= 800 then 'critical_regression'
  when fp >= 0.03 or esc >= 0.05 or lat >= 100 then 'degraded' when prev >= 0.05 then 'improved' else 'stable' end as state from n left join d using (pack_id)""", outcomes, by_period, DELTAS)  # fmt: skip
add("surface_domain", """select surface, outcome_class, case surface when 'CI' then outcome_class in ('prevented_before_merge', 'detected_in_CI', 'escaped_detection', 'rule_not_evaluated', 'evaluation_incomplete')
  when 'LSP' then outcome_class in ('diagnostic_shown', 'diagnostic_accepted', 'diagnostic_dismissed', 'confirmed_false_positive', 'quick_fix_applied', 'quick_fix_reverted', 'rule_not_evaluated', 'evaluation_incomplete')
  else outcome_class in ('repair_succeeded', 'repair_failed', 'repair_partial', 'repair_rolled_back', 'outcome_unknown') end as allowed, count(*) as n from outcomes group by all""", outcomes)  # fmt: skip
add("outcome_dedup", """, rows as (select pack_id || ':' || canonical_rule_id || ':' || surface as outcome_id, outcome_key as delivery, outcome_class from outcomes),
  ranked as (select *, first_value(delivery) over w as d0, first_value(outcome_class) over w as c0 from rows window w as (partition by outcome_id order by delivery, sha256(outcome_class)))
  select outcome_id, delivery, case when delivery = d0 then 'accepted' when outcome_class = c0 then 'duplicate' else 'conflict' end as status from ranked""", outcomes)  # fmt: skip
judged = (deliveries, JUDGED)
add("ingest_dispositions", "select delivery, record_id, reason, disposition from judged", *judged)
add("ledger_counts", "select disposition, reason, count(*) as n, count(distinct record_id) as records from judged group by all", *judged)
CLASSES = "static_finding, CI_failure_classification, repair_attempt, verification_outcome, editor_diagnostic_outcome, false_positive_disposition, gate_outcome"
add("envelope_errors", f""", e as (select delivery, unnest([case when delivery % 107 = 9 then {{'path': '', 'message': 'has unknown fields colour'}} end, case when event_class = 'weather' then {{'path': 'event_class', 'message': 'is none of {CLASSES}'}} end,
  case when event_id is null then {{'path': 'event_id', 'message': 'is not of type string, but null'}} end, case when delivery % 113 = 11 then {{'path': 'payload', 'message': 'is not of type object, but array'}} end,
  case when delivery % 109 = 10 then {{'path': 'unknowns/0/reason', 'message': 'is none of not_observed, not_applicable, producer_did_not_emit, redacted, incompatible_version, unavailable'}} end]) as x from deliveries where delivery % 97 <> 5 and (delivery % 97 <> 6 or delivery % 113 = 11))
  select delivery, x.path as path, x.message as message from e where x is not null union all select delivery, '', 'is malformed' from deliveries where delivery % 97 = 5 or (delivery % 97 = 6 and delivery % 113 <> 11)""", deliveries)  # fmt: skip
add("learning_projection", f"""with l as (select l_orderkey as k, nullif(case when l_partkey % 5 <> 0 then 'rule_' || (l_partkey % 50) end, '') as rule, case when l_suppkey % 7 <> 0 then 'fp' || l_suppkey else l_orderkey || '-' || l_linenumber end as fp, case when l_quantity > 10 then 'src/' || l_returnflag end as component from lineitem),
  o as (select o_orderkey as k, case when o_orderkey % 9 <> 0 then 'repo_' || (o_orderkey % 40) end as repo, * from orders),
  h as (select *, case when k % 5 <> 0 then 'h' || (k % 77) end as id, case when k % 7 < 3 then 'canonical' when k % 7 < 6 then 'historical' end as authority, case when k % 11 <> 0 then ['clean_verified', 'target_failure_resolved', 'repeated_failure', 'new_failure', 'partial_resolution', 'outcome_unknown', 'unresolved', 'unheard_of'][k % 8 + 1] end as said,
    case when k % 11 <> 0 then ['passed', 'passed', 'failed', 'failed', 'unknown', 'unknown', 'unknown', 'unknown'][k % 8 + 1] end as v from o where k % 3 = 1),
  f as (select *, case when o_custkey % 9 <> 0 then 'f' || (o_custkey % 100) end as id, case k % 4 when 0 then 'passed' when 1 then 'failed' when 2 then 'flaky' end as said from o where k % 3 = 0),
  u as (select 'b-' || k as record_id, 'finding-bundle/v1' as producer_contract, case when k % 9 <> 0 then 'repo_' || (k % 40) end as repo, case when rule is not null then sha256('rule' || {NUL} || rule) else sha256('producer-fingerprint' || {NUL} || fp) end as recurrence_fingerprint, rule as canonical_rule_id, component,
      null as remediation_class, null as validation_outcome, null as false_positive_disposition, [case when k % 9 = 0 then 'scope is record-local: no repository' end, case when rule is null then 'recurrence is of the instance: no rule' end] as notes from l
    union all select 'f-' || k, 'resolver-feedback/v1', repo, case when id is not null then sha256('failure' || {NUL} || id) else sha256('record' || {NUL} || 'f-' || k) end, null, null, case when o_orderstatus = 'O' then 'code_change' end, case said when 'flaky' then 'unknown' else said end, null,
      [case when repo is null then 'scope is record-local: no repository' end, case when id is null then 'recurrence is record-local: no failure' end, case when said = 'flaky' then 'result unknown: flaky' end, case when k % 5 = 0 then 'effort is a bucket' end] from f
    union all select 'h-' || k, 'historical-resolution/v1', repo, case when id is not null then sha256('failure' || {NUL} || id) else sha256('record' || {NUL} || 'h-' || k) end, case when authority = 'canonical' then id end, null, case when k % 2 = 0 then 'code_change' end, v,
      case when k % 9 = 0 then 'inconclusive' when v = 'passed' then 'confirmed_true_positive' end, [case when repo is null then 'scope is record-local: no repository' end, case when id is null then 'recurrence is record-local: no failure' end,
      case when authority = 'historical' then 'rule unknown: authority historical' end, case when said in ('partial_resolution', 'unheard_of') then 'outcome unknown: ' || said end, case when k % 9 = 0 then 'suspected flake: no repair credit' end, 'effort is unknown: reconstructed'] from h
    union all select 'g-' || k, 'gate-outcome/v1', repo, sha256('record' || {NUL} || 'g-' || k), null, null, null, null, null, [case when repo is null then 'scope is record-local: no repository' end, 'no projection for gate-outcome/v1'] from o where k % 3 = 2)
  select record_id, 'p' as producer_id, 'static_finding' as event_class, producer_contract, coalesce(repo, 'record:' || record_id) as occurrence_scope, recurrence_fingerprint, canonical_rule_id,
    case when producer_contract = 'historical-resolution/v1' then coalesce(repo, 'record:' || record_id) when producer_contract = 'gate-outcome/v1' then null else repo end as repository_identity, component, remediation_class, validation_outcome, false_positive_disposition, cast(null as bigint) as effort_minutes,
    array_to_string(list_filter(notes, lambda x: x is not null), '; ') as limitations from u""")  # fmt: skip
add("ledger_sequence", "select delivery, event_id, row_number() over (order by delivery) as sequence from deliveries", deliveries)
add("ledger_batches", """, r as (select delivery, case when delivery % 3 = 0 then 'hot' else note end as note from deliveries)
  select delivery, note, row_number() over (order by note, delivery) as sequence from r where delivery % 2 = 0 union all
  select delivery, note, row_number() over (order by note, delivery) + (select count(*) from r where delivery % 2 = 0) from r where delivery % 2 = 1""", deliveries)  # fmt: skip
add("ledger_gaps", """, s as (select row_number() over (order by delivery) as sequence from deliveries), e as (select * from s where sequence > 2 and sequence % 1000 not in (7, 20, 21, 22, 23, 24) union all select * from s where sequence % 1000 = 9),
  o as (select case when sequence % 5000 = 11 then -sequence end as sequence from s where sequence % 2500 = 11), g as (select distinct sequence, lag(sequence, 1, 0) over (order by sequence) as before from (select distinct sequence from e))
  select sequence as first, sequence as last, 'repeated' as problem from e group by 1 having count(*) > 1 union all select distinct sequence, sequence, 'invalid' from o
  union all select before + 1, sequence - 1, 'missing' from g where sequence > before + 1""", deliveries)  # fmt: skip
stored_records = (deliveries, DELIVERED, RECORDS)
add("dedup_records", "select record_id, source_event_id, delivery from records", *stored_records)
add("canonical_ids", "select delivery, record_id from delivered", deliveries, DELIVERED)
add("supersession_overlay", "select record_id, superseded_by from overlay", *stored_records)
add("predecessors", """select a.record_id, b.record_id as predecessor from records a join records b using (source_event_id, producer_id, event_class, producer_contract)
  where a.payload_hash <> b.payload_hash and a.record_id <> b.record_id and b.record_id not in (select target from corrections)""", *stored_records)  # fmt: skip
add("integrity_anti_joins", """select distinct 'observation' as kind, record_id from learned where record_id not in (select record_id from records) union all
  select distinct 'correction', target || 'y' from corrections where right(target, 1) = '0'""", *stored_records)  # fmt: skip
add("snapshot_rows", "select * from snapshot", *stored_records)
SAFE = "coalesce(nullif(left(regexp_replace(regexp_replace({c}, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), 120), ''), 'unknown') || '-' || left(sha256({c}), 8)"
add("partition_plan", f"""select event_class, producer_id, count(distinct record_id) as record_count, count(*) as row_count,
  'class=' || {SAFE.format(c='event_class')} || '/producer=' || {SAFE.format(c='producer_id')} as directory from snapshot group by event_class, producer_id""", *stored_records)  # fmt: skip
add("collision_groups", "select event_id, count(distinct payload_hash) as digests, count(*) as rows from delivered where event_id is not null group by 1 having count(distinct payload_hash) > 1", deliveries, DELIVERED)
add("manifest_changes", """with named as (select 'part-' || p_partkey as name, sha256(p_name) as hash, p_partkey as k from part), m as (select * from named where k % 60 <> 5),
  a as (select name, case when k % 40 = 7 then sha256(hash) else hash end as hash from named where k % 50 <> 3)
  select name, m.hash as expected, a.hash as actual from m full join a using (name) where m.hash is distinct from a.hash""")  # fmt: skip
add("unsorted_rows", """, r as (select producer_id, delivery, 'r' || lpad(cast(delivery - case when delivery % 37 = 5 then 60 else 0 end as varchar), 12, '0') as record_id from deliveries)
  select * exclude (b) from (select *, lag(record_id) over (partition by producer_id order by delivery) as b from r) where b > record_id""", deliveries)  # fmt: skip
add("redaction_hits", f""", t as (select 'document' as kind, doc_id as id, text from documents union all select 'page', page_id, html from pages union all select 'note', delivery, note from deliveries)
  select kind, id, rule from (select kind, id, unnest([{HITS.format(t='text')}]) as rule from t) where rule is not null""", deliveries)  # fmt: skip
add("float_rejection", "select event_id, event_id % 3 = 0 as has_float from events")
add("finding_explode", f"""with f as (select l_orderkey as record_id, 'repo_' || (l_orderkey % 40) as occurrence_scope, l_orderkey || '-' || l_linenumber as finding_id,
  case when l_partkey % 5 <> 0 then 'rule_' || (l_partkey % 50) when l_partkey % 2 = 0 then '' end as canonical_rule_id, case when l_suppkey % 7 <> 0 then 'fp' || l_suppkey else l_orderkey || '-' || l_linenumber end as fp, case when l_quantity > 10 then 'src/' || l_returnflag end as component from lineitem)
  select record_id, occurrence_scope, finding_id, canonical_rule_id, case when coalesce(canonical_rule_id, '') <> '' then sha256('rule' || {NUL} || canonical_rule_id) else sha256('producer-fingerprint' || {NUL} || fp) end as recurrence_fingerprint, component from f""")  # fmt: skip
add("resolver_projection", f"""select o_orderkey as record_id, case when o_custkey % 9 <> 0 then sha256('failure' || {NUL} || 'f' || (o_custkey % 100)) else sha256('record' || {NUL} || o_orderkey) end as recurrence_fingerprint, case when o_orderstatus = 'O' then 'code_change' end as remediation_class,
  case o_orderkey % 4 when 0 then 'passed' when 1 then 'failed' when 2 then 'unknown' end as validation_outcome, cast(null as bigint) as effort_minutes from orders""")  # fmt: skip
add("historical_projection", f"""with h as (select cast(o_orderkey as varchar) as record_id, o_orderkey as k, case when o_orderkey % 11 <> 0 then ['passed', 'passed', 'failed', 'failed', 'unknown', 'unknown', 'unknown', 'unknown'][o_orderkey % 8 + 1] end as v from orders)
  select record_id, case when k % 5 <> 0 then sha256('failure' || {NUL} || 'historical:' || (k % 77)) else sha256('record' || {NUL} || record_id) end as recurrence_fingerprint, v as validation_outcome,
  case when k % 9 = 0 then 'inconclusive' when v = 'passed' then 'confirmed_true_positive' end as false_positive_disposition from h""")  # fmt: skip
history = (runs_raw, RUNS)
add("path_unique", "select workflow, before, after, array_to_string(path, '>') as path from paths", *history, recursive=True)
add("flake_classes", """, s as (select *, lag(conclusion) over (partition by revision, workflow order by coalesce(attempt, 0), updated_at, run_id) as b from runs where conclusion is not null),
  c as (select revision, workflow, count(*) filter (b in ('failure', 'success') and conclusion in ('failure', 'success') and b <> conclusion) as alternations, count(*) filter (conclusion = 'failure') as failures,
  count(*) filter (conclusion = 'success') as successes, count(*) filter (conclusion in ('cancelled', 'timed_out')) as interrupted from s group by 1, 2)
  select *, case when alternations >= 2 then 'verified' when failures > 0 and successes > 0 then 'suspected' else 'none' end as flake_class from c""", *history, recursive=True)  # fmt: skip
add("next_run", """, c as (select f.run_id, r.run_id as next_run_id, 0 as kind, coalesce(r.attempt, 0) as far from runs f join runs r on r.workflow = f.workflow and r.revision = f.revision and r.run_id <> f.run_id and coalesce(r.attempt > f.attempt, true) where f.conclusion = 'failure'
  union all select f.run_id, r.run_id, 1, len(p.path) from runs f join paths p on p.workflow = f.workflow and p.before = f.revision and len(p.path) > 0 join runs r on r.workflow = f.workflow and r.revision = p.after where f.conclusion = 'failure')
  select run_id, next_run_id, cast(case when kind = 0 then 0 else far end as bigint) as distance from c qualify row_number() over (partition by run_id order by kind, far, next_run_id) = 1""", *history, recursive=True)  # fmt: skip
add("evidence_graph", """select 'node' as part, 'run' as type, count(distinct run_id) as n from runs union all select 'node', 'workflow', count(distinct workflow) from runs
  union all select 'node', 'revision', count(*) from (select revision from runs union select revision from commits) union all select 'edge', 'executes', count(*) from (select distinct run_id, workflow from runs)
  union all select 'edge', 'tests', count(*) from (select distinct run_id, revision from runs) union all select 'edge', 'parent', count(*) from (select distinct revision, parent from commits where parent is not null)""", *history, recursive=True)  # fmt: skip
# What a case and a flaky workflow add to the confounders, and the reasons of each case.
CONFOUNDED = "list_sort(list_distinct(list_filter(list_concat({found}, [case when kase = 1 then 'flaky_failure_pattern' end, case when kase in (1, 5) then 'rerun_without_code_change' end, case when kase = 3 then 'intervention_evidence_missing' end, case when flaky then 'verified_flaky_failure' end]), lambda x: x is not null)))"
LIMITS = """list_sort(list_concat(case kase when 1 then ['same revision fail/pass cannot receive repair credit'] when 2 then list_concat({reasons}, ['validation_equivalence_not_proved']) when 3 then ['revision changed without complete intervention evidence']
  when 4 then ['validation_outcome_unavailable'] when 5 then ['rerun without revision change carries no repair credit'] when 6 then ['material confounders cap attribution strength'] else [] end, case when flaky then ['verified flaky failure cannot receive repair credit'] else [] end))"""
add("episode_attribution", """with e as (select event_id as k from events),
  a as (select k, k % 23 = 0 as gone, k % 3 as changes, k % 6 = 0 as same, case when k % 8 = 0 then 'failure' when k % 59 = 0 then 'skipped' when k % 61 <> 0 then 'success' end as result from e),
  b as (select *, list_sort(list_distinct(list_filter([case when k % 29 = 0 then 'workflow_identity_changed' end, case when gone then 'job_removed' end, case when not gone and k % 31 = 0 then 'job_semantics_changed' end,
    case when k % 11 = 0 then 'workflow_definition_changed' end, case when k % 43 = 0 then 'material_environment_change_unaccounted' end,
    case when not gone and ((k % 7 <> 0 and k % 37 = 0) or k % 41 = 0) then 'validation_contract_changed' end, case when k % 13 = 0 then 'test_skipped' end], lambda x: x is not null))) as r,
    list_sort(list_filter([case when k % 3 > 1 then 'multiple_commits_between_failure_and_success' end, case when k % 21 = 0 then 'multiple_failure_fingerprints' end, case when same then 'rerun_without_code_change' end,
    case when k % 17 = 0 then 'dependency_lockfile_change' end, case when k % 11 = 0 then 'workflow_definition_change' end, case when k % 43 = 0 then 'environment_change' end, case when k % 5 = 0 then 'test_change' end,
    case when k % 19 = 0 then 'merge_commit' end, case when k % 47 = 0 then 'provider_missing_attempt_history' end, case when k % 53 = 0 then 'concurrency_cancellation' end], lambda x: x is not null)) as c from a),
  d as (select *, greatest(0, 100 - case when not gone and not (k % 41 = 0) and k % 7 = 0 then 15 else 0 end - case when len(r) > 0 then 35 else 0 end) as complete from b),
  f as (select *, case when same and result = 'success' then 1 when len(r) > 0 then 2 when not same and (changes = 0 or k % 67 = 0) then 3 when result is null or result in ('cancelled', 'timed_out', 'skipped') then 4
    when same then 5 when changes > 1 or len(list_filter(c, lambda x: x <> 'rerun_without_code_change')) > 0 then 6 else 7 end as kase,
    case when k % 10 = 0 then 'repeated_failure' when k % 12 = 1 or k % 71 = 0 then 'new_failure' when result = 'success' then 'clean_verified' when result = 'failure' then 'partial_resolution' else 'outcome_unknown' end as raw from d),
  g as (select *, case when kase <= 3 then 'outcome_unknown' when kase = 4 then 'unresolved' when kase = 5 and raw = 'clean_verified' then 'outcome_unknown' else raw end as o from f),
  h as (select *, k % 4 = 1 and o = 'clean_verified' as flaky, ['C', 'U', 'U', 'U', 'C', 'C', 'B'][kase] as g0, least(complete, [70, 50, 50, 60, 75, 85, 100][kase]) as c0,
    ['transition_inferred', 'unresolved', 'unresolved', 'unresolved', 'transition_inferred', 'transition_inferred', 'direct_transition_verified'][kase] as k0 from g)
  select k as episode, array_to_string(r, ',') as reasons, complete as completeness, array_to_string(""" + CONFOUNDED.format(found='c') + """, ',') as confounders, case when flaky then 'U' else g0 end as grade, case when flaky then 'unresolved' else k0 end as attribution_class,
  case when flaky then 'outcome_unknown' else o end as outcome, case when flaky then least(50, c0) else c0 end as evidence_completeness, kase = 1 or flaky as suspected_flake,
  case when flaky or g0 = 'U' then 'unknown' when g0 = 'B' then 'strong' else 'moderate' end as strength, array_to_string(""" + LIMITS.format(reasons='r') + """, ',') as limitations from h""")  # fmt: skip
add("native_event_stack", """with e as (select 'hep_' || sha256(cast(o_orderkey as varchar)) as id from orders), s as (select id, unnest([0, 1, 2]) as k from e)
  select id || ':' || k as event_id, case when k > 0 then id || ':' || (k - 1) end as parent_event_id, ['failure', 'repair', 'verification'][k + 1] as observation_kind from s""")  # fmt: skip
add("change_features", """with c as (select p_partkey as k, p_partkey % 19 <> 0 as seen from part)
  select k as change, cast(case when seen then (k % 2 = 0)::int + (k % 3 = 0)::int + (k % 5 = 0)::int + (k % 7 = 0)::int + (k % 11 = 0)::int + (k % 13 = 0)::int + (k % 17 = 0)::int else 0 end as int) as file_count, seen and k % 5 = 0 as workflow_changed,
  seen and (k % 3 = 0 or k % 13 = 0 or k % 17 = 0) as test_changed, seen and k % 11 = 0 as environment_changed, seen and k % 7 = 0 as lockfile_changed,
  concat_ws(',', case when not seen then 'files_unobserved' end, case when seen and k % 13 = 0 then 'validation_file_removed' end, case when seen and (k % 5 = 0 or k % 17 = 0) then 'validation_skip_added' end) as weakening from c""")  # fmt: skip
add("channel_history", """with p as (select 'channel_' || (o_custkey % 50) as channel, o_orderkey as sequence, (o_orderkey % 12) || '.' || (o_orderkey % 5) || '.0' as v from orders),
  q as (select *, lag(v) over (partition by channel order by sequence) as pv, max(sequence) over (partition by channel) as top from p),
  l as (select * from q qualify row_number() over (partition by channel, v order by sequence desc) = 1)
  select channel, sha256(v) as archive_hash, sequence, v as pack_version, pv as previous_version, sequence = top as is_active, row_number() over (partition by channel order by v, sha256(v)) as history_position,
  row_number() over (partition by channel order by cast(split_part(v, '.', 1) as int), cast(split_part(v, '.', 2) as int)) as semver_rank from l""")  # fmt: skip
add("metadata_table", "select 'snapshot/v1' as format_version, count(distinct record_id) as record_count, count(*) as row_count from snapshot", *stored_records)
add("redaction_paths", """, n as (select delivery, note, event_id from deliveries)
  select delivery, 'payload.api_key' as path, 'sensitive_key' as rule from n where event_id is not null union all
  select delivery, 'payload.note', 'sensitive_value' from n where delivery % 47 = 0 union all
  select delivery, 'payload.note', 'sensitive_value' from n where delivery % 47 <> 0 and delivery % 53 = 0 union all
  select delivery, 'payload.note', 'sensitive_value' from n where delivery % 47 <> 0 and delivery % 53 <> 0 and delivery % 59 = 0 union all
  select delivery, 'payload.note', 'sensitive_value' from n where delivery % 47 <> 0 and delivery % 53 <> 0 and delivery % 59 <> 0 and delivery % 61 = 0""", deliveries)  # fmt: skip
add("windowed_events", "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
add("streaming_ingest", """, r as (select delivery, sha256(event_id) as id from deliveries union all select delivery, sha256(event_id) from deliveries where delivery % 20 = 0),
  c as (select delivery, sha256(event_id) || case when delivery % 22 = 0 then 'x' else '' end as id from deliveries where delivery % 11 = 0 and event_id is not null),
  o as (select id, max('r' || delivery) as last from c where id in (select id from r) group by 1)
  select 'event' as kind, 'accepted' as disposition, count(distinct id) as n, count(distinct id) as records, null as last from r union all select 'event', 'duplicate', count(id) - count(distinct id), (select count(*) from (select id from r where id is not null group by 1 having count(*) > 1)), null from r
  union all select 'event', 'quarantined', count(*), 0, null from r where id is null union all select 'correction', 'recorded', count(*), count(distinct id), null from c union all select 'overlay', 'superseded', count(*), count(*), max(last) from o""", deliveries)  # fmt: skip


def hmac_sql(key: bytes, value: str) -> str:
    block = key.ljust(64, b"\0")
    inner, outer = ("".join(f"\\x{b ^ pad:02X}" for b in block) for pad in (0x36, 0x5C))
    return f"sha256('{outer}'::blob || unhex(sha256('{inner}'::blob || encode({value}))))"


REPOSITORY_KEY, PATH_KEY = b"a key of the test that is long enough", b"another key of the test, also long"
add("pseudonyms", f"select c_custkey, 'repository_' || {hmac_sql(REPOSITORY_KEY, 'c_name')} as token from customer")
add("redacted_bundles", f"""select l_orderkey as record, l_orderkey || '-' || l_linenumber as finding_id, 'path_' || {hmac_sql(PATH_KEY, "'src/' || l_returnflag || '.py'")} as path,
  'sha256:' || sha256('snap' || l_orderkey) as snapshot_id, 'sha256:' || sha256('rev' || l_orderkey) as revision from lineitem""")  # fmt: skip
add("bundle_envelopes", f"""select distinct l_orderkey as record, 'static_finding' as event_class, 'producer_redacted' as redaction_status, 'repository_' || {hmac_sql(REPOSITORY_KEY, "'repo' || (l_orderkey % 9)")} as repository_identity,
  cast(79 as int) as id_length from lineitem""")  # fmt: skip
add("unknown_lineage", "select o_orderkey as delivery, 'odd,zeta' as unknown_keys from orders where o_orderkey % 3 = 0")
add("ingress_status", """select o_orderkey as request, cast(case when o_orderkey % 11 = 0 then 404 when o_orderkey % 13 = 0 then 405 when o_orderkey % 19 = 0 or o_orderkey % 17 = 0 then 401 when o_orderkey % 23 = 0 then 413
  when o_orderkey % 29 = 0 then 422 else [201, 409, 422, 503, 201][o_orderkey % 5 + 1] end as int) as status from orders""")  # fmt: skip
add("verify_store", """, s as (select delivery, row_number() over (order by delivery) as k from deliveries), e as (select s.*, case when s.delivery % 211 = 3 then record_id || 'z' else record_id end as record_id from s left join records r using (delivery) where k % 500 <> 3),
  p as (select 'ledger missing' as problem from s where k % 500 = 3 and k < (select max(k) from e) union all select 'orphan observation' from (select distinct record_id from learned where record_id not in (select record_id from records))
    union all select 'ledger record missing' from e where record_id is not null and record_id not in (select record_id from records) union all select 'record never accepted' from records where record_id not in (select record_id from e where record_id is not null)
    union all select 'record identity' from records where delivery % 301 = 7)
  select problem, count(*) as n from p group by 1""", *stored_records)  # fmt: skip
add("report_document", """, j as (select recurrence_fingerprint as f, event_class as c, '{"canonical_rule_id":' || case when canonical_rule_id is null then 'null' else '"' || canonical_rule_id || '"' end || ',"event_class":"' || event_class || '","occurrence_count":' || occurrence_count
  || ',"recurrence_fingerprint":"' || recurrence_fingerprint || '"}' as j from recurrence), w as (select '{"rows":[' || string_agg(j, ',' order by f, c) || '],"source_snapshot_id":"cs_test"}' as document from j)
  select document, sha256(document) as report_hash from w""", stored, OBS, RECURRENCE)  # fmt: skip
#: The tree over rows ``r`` of texts ``j``, up to 4096 ** 3 of them.
TREE = ", ".join(["t0 as (select sha256(j) as h, row_number() over (order by sha256(j)) as s from r)", *(f"t{k} as (select sha256(string_agg(h, '' order by s)) as h, (s - 1) // 4096 + 1 as s from t{k - 1} group by 2)" for k in (1, 2, 3))])
ROOT = "select (select count(*) from r) as row_count, case when (select count(*) from t1) = 1 then (select min(h) from t1) when (select count(*) from t2) = 1 then (select min(h) from t2) else (select min(h) from t3) end as digest"
add("snapshot_digest", """, r as (select '{"record_id":"' || record_id || '","recurrence_fingerprint":"' || recurrence_fingerprint || '"}' as j from obs), """ + TREE + " " + ROOT, stored, OBS)
add("graph_digest", """, r as (select '{"type":"run","id":"' || run_id || '"}' as j from (select distinct run_id from runs) union all select '{"type":"workflow","id":"' || workflow || '"}' from (select distinct workflow from runs)
  union all select '{"type":"revision","id":"' || revision || '"}' from (select revision from runs union select revision from commits) union all select '{"type":"executes","source":"' || run_id || '","target":"' || workflow || '"}' from (select distinct run_id, workflow from runs)
  union all select '{"type":"tests","source":"' || run_id || '","target":"' || revision || '"}' from (select distinct run_id, revision from runs)
  union all select '{"type":"parent","source":"' || revision || '","target":"' || parent || '"}' from (select distinct revision, parent from commits where parent is not null)), """ + TREE + " " + ROOT, *history, recursive=True)  # fmt: skip
add("normalized_runs", """select cast(event_id as varchar) as provider_run_ref, 'run:' || event_id || ':attempt:' || greatest(1, event_id % 4) as execution_ref, 'sha' || user_id as revision,
  case when event_id % 3 = 0 then '.github/ci.yml' when event_id % 5 <> 0 then cast(event_id % 7 as varchar) else 'CI' end as workflow_identity, cast(nullif(event_id % 4, 0) as int) as attempt,
  case when event_id % 2 = 0 then 'success' end as conclusion from events""")  # fmt: skip
add("hydrated_episodes", """with e as (select event_id as n, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as t from events), r as (select n, t from e where n % 7 <> 0)
  select e.n as episode_id, coalesce(case when e.n % 3 <> 0 and (e.n % 2 = 0 or e.n % 5 <> 0) then e.t end, a.t) as failure_at, coalesce(case when e.n % 4 = 1 then e.t end, b.t) as repair_at, b.t as validated_at
  from e left join r a on a.n = e.n left join r b on b.n = e.n + 1""")  # fmt: skip
#: What the provider's objects say, by the arithmetic that made them; paths again, as some commits were never seen.
OBJECTS = """ex as (select *, run_id as k, cast(regexp_extract(workflow, '([0-9]+)$', 1) as bigint) as u, run_id || case when attempt is not null then ':attempt:' || attempt else '' end as ref, coalesce(conclusion = 'failure', false) and run_id % 31 <> 0 as test_failed, run_id % 14 = 3 as build_failed from runs),
changed as (select workflow, workflow || '-r' || number as revision, number as n, number % 23 <> 8 as seen from revs where number > 0 and number % 31 <> 10),
flags as (select *, seen and n % 7 = 3 as wf, seen and (n % 11 = 4 or n % 13 = 5) as env, seen and (n % 3 = 1 or n % 17 = 6) as test, seen and n % 13 = 5 as lock, n % 5 = 0 as merged, seen and n % 17 = 6 as removed, seen and n % 19 = 7 as skips,
  not seen or not (n % 29 <> 9 or n % 7 = 3 or n % 11 = 4 or n % 3 = 1 or n % 13 = 5 or n % 17 = 6 or n % 19 = 7) as empty from changed),
known as (select c.* from commits c join flags f on f.workflow = c.workflow and f.revision = c.revision),
stroll as (select workflow, goal, tip, tip as spot, [tip] as path from wanted union all select w.workflow, w.goal, w.tip, c.parent, list_append(w.path, c.parent) from stroll w join known c on c.workflow = w.workflow and c.revision = w.spot where c.parent is not null and w.spot <> w.goal),
ways as (select workflow, goal as before, tip as after, list_reverse(min(path)[:-2]) as path from stroll where spot = goal group by 1, 2, 3 having count(*) = 1)"""
add("normalized_objects", """, """ + OBJECTS + """, j as (select *, unnest([0, 1]) as t from ex),
  w as (select f.*, concat_ws(',', case when not seen then 'files_unobserved' end, case when removed then 'validation_file_removed' end, case when skips then 'validation_skip_added' end) as weak from flags f),
  jobs as (select workflow as scope, case t when 0 then 'b' else 't' end || k as source, cast(2 * k + t as varchar) as jref, ref, revision, case t when 0 then 'build' else 'test' end as name, attempt, case when t = 1 then conclusion when build_failed then 'failure' else 'success' end as conclusion,
    case when t = 1 and k % 41 = 0 then '' when t = 1 then 'run' else 'compile' end as failed from j where t = 0 or k % 31 <> 0),
  p as (select workflow as scope, max(u) as u, max(number) as top from ex group by 1)
  select scope, 'pull' as source, 'pull_request' as kind, cast(u as varchar) as ref, null as execution_ref, case when u % 6 <> 0 then scope || '-r' || top end as revision, case when u % 7 = 0 then 'squash' end as name, cast(null as int) as attempt, null as conclusion, null as parents, null as weakening, null as failed_steps,
    case when u % 6 <> 0 then 'complete' else 'partial' end as availability, '' as limitations from p
  union all select scope, 'event', 'review_signal', null, null, null, case u % 5 when 0 then 'base_ref_changed' else 'head_ref_force_pushed' end, null, null, null, null, null, 'direct_provider_event', '' from p where u % 5 < 2
  union all select r.workflow, 'c' || number, 'commit', null, null, r.workflow || '-r' || number, null, null, null, case when number = 0 then '' when number % 5 = 0 then r.workflow || '-r' || greatest(number - 1, number - 2) || ',' || r.workflow || '-r' || (number - 2) else r.workflow || '-r' || (number - 1) end, null, null, 'complete', '' from revs r where number % 31 <> 10
  union all select workflow, 'c' || n, 'change', null, null, revision, null, null, null, case when n % 5 = 0 then workflow || '-r' || (n - 1) || ',' || workflow || '-r' || (n - 2) else workflow || '-r' || (n - 1) end, weak, null, case when empty then 'partial' else 'complete' end, '' from w
  union all select workflow, 'r' || k, 'ci_execution', cast(k as varchar), ref, revision, null, cast(attempt as int), conclusion, null, null, null, 'complete', case when k % 47 = 0 then 'provider_attempt_history_missing' else '' end from ex
  union all select scope, source, 'ci_job', jref, ref, revision, name, cast(attempt as int), conclusion, null, null, null, 'complete', '' from jobs
  union all select scope, source, 'failure', jref, ref, revision, name, cast(attempt as int), null, null, null, failed, case when failed = '' then 'partial' else 'complete' end, case when failed = '' then 'failed_step_unavailable' else '' end from jobs where conclusion = 'failure'
  union all select workflow, 'k' || k, 'validation', cast(k as varchar), null, null, 'lint', null, conclusion, null, null, null, 'complete', '' from ex where k % 10 = 0
  union all select workflow, 'l' || k, 'textual_hint', null, null, null, 'job_log', null, null, null, null, null, 'digest_only', 'raw_log_not_normalized_or_projected' from ex where k % 10 = 1""", *history, recursive=True)  # fmt: skip
add("episodes", """, """ + OBJECTS + """, fl as (select *, lag(conclusion) over (partition by revision, workflow order by coalesce(attempt, 0), updated_at, run_id) as b from runs where conclusion is not null),
  fc as (select revision, workflow, count(*) filter (b in ('failure', 'success') and conclusion in ('failure', 'success') and b <> conclusion) >= 2 or (bool_or(conclusion = 'failure') and bool_or(conclusion = 'success')) as unsteady from fl group by 1, 2),
  bad as (select *, k as k1 from ex where test_failed or build_failed),
  cand as (select f.k1, r.k as k2, 0 as kind, coalesce(r.attempt, 0) as far, r.ref from bad f join ex r on r.workflow = f.workflow and r.revision = f.revision and r.k <> f.k1 and coalesce(r.attempt > f.attempt, true)
    union all select f.k1, r.k, 1, len(p.path), r.ref from bad f join ways p on p.workflow = f.workflow and p.before = f.revision and len(p.path) > 0 join ex r on r.workflow = f.workflow and r.revision = p.after),
  nx as (select k1, k2 from cand qualify row_number() over (partition by k1 order by kind, far, ref) = 1),
  st as (select workflow, before, after, unnest(path) as revision from ways),
  ch as (select st.workflow, before, after, count(*) as n, bool_or(wf) as wf, bool_or(env) as env, bool_or(test) as test, bool_or(lock) as lock, bool_or(merged) as merged, bool_or(empty) as empty, bool_or(removed) as removed, bool_or(skips) as skips, bool_or(not seen) as unseen from st join flags f on f.workflow = st.workflow and f.revision = st.revision group by 1, 2, 3),
  fails as (select k1, 'test' as name, 2 * k1 + 1 as job, case when k1 % 41 = 0 then 'test:' else 'test:run' end as id from bad where test_failed union all select k1, 'build', 2 * k1, 'build' from bad where build_failed),
  sides as (select f.*, a.workflow, a.u, a.ref as ref1, z.ref as ref2, z.k as k2, a.revision as rev1, z.revision as rev2, a.revision = z.revision as same, a.conclusion as c1, z.conclusion as c2, z.test_failed as tf, z.build_failed as bf, f.name = 'test' and z.k % 31 = 0 as gone, a.test_failed and a.build_failed as two,
    case when z.k % 41 = 0 then 'test:' else 'test:run' end as id2 from fails f join nx using (k1) join ex a on a.k = k1 join ex z on z.k = k2),
  j as (select s.*, coalesce(len(p.path), 0) as way, coalesce(ch.n, 0) as n, coalesce(wf, false) as wf, coalesce(env, false) as env, coalesce(test, false) as test, coalesce(lock, false) as lock, coalesce(merged, false) as merged, coalesce(empty, false) as empty, coalesce(removed, false) as removed, coalesce(skips, false) as skips, coalesce(unseen, false) as unseen, coalesce(unsteady, false) as unsteady,
    case when gone then null when name = 'test' then c2 when bf then 'failure' else 'success' end as result, (tf and name = 'test' and id = id2) or (bf and name = 'build') as present, tf::int + bf::int as all2
    from sides s left join ways p on p.workflow = s.workflow and p.before = rev1 and p.after = rev2 left join ch on ch.workflow = s.workflow and ch.before = rev1 and ch.after = rev2 left join fc on fc.workflow = s.workflow and fc.revision = rev1),
  x as (select *, all2 - present::int as fresh, all2 - (coalesce(result, '') = 'failure')::int > 0 as other, name = 'build' or (k1 % 41 <> 0 and k2 % 41 <> 0) as named,
    not gone and name = 'test' and ((k1 % 41 <> 0 and k2 % 41 <> 0 and (k1 % 37 = 0) <> (k2 % 37 = 0)) or (k2 % 43 = 0 and coalesce(c2, '') = 'success' and k2 % 41 <> 0 and k2 % 37 <> 0 and k1 % 41 <> 0)) as contract from j),
  y as (select *, list_sort(list_filter([case when gone then 'job_removed' end, case when wf then 'workflow_definition_changed' end, case when env then 'material_environment_change_unaccounted' end, case when unseen then 'files_unobserved' end, case when removed then 'validation_file_removed' end, case when skips then 'validation_skip_added' end, case when contract then 'validation_contract_changed' end], lambda v: v is not null)) as r,
    list_sort(list_filter([case when n > 1 then 'multiple_commits_between_failure_and_success' end, case when two then 'multiple_failure_fingerprints' end, case when same then 'rerun_without_code_change' end, case when lock then 'dependency_lockfile_change' end, case when wf then 'workflow_definition_change' end, case when env then 'environment_change' end, case when test then 'test_change' end,
    case when merged then 'merge_commit' end, case when k1 % 47 = 0 or k2 % 47 = 0 then 'provider_missing_attempt_history' end, case when coalesce(c1 = 'cancelled', false) or coalesce(c2 = 'cancelled', false) then 'concurrency_cancellation' end, case when u % 5 = 0 then 'base_branch_update' end, case when u % 5 = 1 then 'force_updated_pr_branch' end, case when u % 7 = 0 then 'squash_merge' end, case when n <> way then 'intervention_evidence_missing' end], lambda v: v is not null)) as cf from x),
  z as (select *, 100 - case when not gone and not contract and not named then 15 else 0 end - case when len(r) > 0 then 35 else 0 end as complete,
    case when same and result = 'success' then 1 when len(r) > 0 then 2 when n <> way or (not same and (n = 0 or empty)) then 3 when result is null or result in ('cancelled', 'timed_out', 'skipped') then 4 when same then 5 when len(list_filter(cf, lambda v: v <> 'rerun_without_code_change')) > 0 then 6 else 7 end as kase,
    case when present then 'repeated_failure' when fresh > 0 or other then 'new_failure' when result = 'success' then 'clean_verified' when result = 'failure' then 'partial_resolution' else 'outcome_unknown' end as raw from y),
  o as (select *, case when kase <= 3 then 'outcome_unknown' when kase = 4 then 'unresolved' when kase = 5 and raw = 'clean_verified' then 'outcome_unknown' else raw end as oc from z), q as (select *, unsteady and oc = 'clean_verified' as flaky from o)
  select workflow as scope, ref1 as before_execution_ref, ref2 as after_execution_ref, cast(job as varchar) as job_ref, name, n as change_count, 1 + two::int as before_failure_count, fresh as new_failure_count, case when present then 'present' when gone then 'unknown' else 'absent' end as failure_after, array_to_string(r, ',') as reasons,
  array_to_string(""" + CONFOUNDED.format(found="cf") + """, ',') as confounders, array_to_string(""" + LIMITS.format(reasons="r") + """, ',') as limitations, case when flaky then 'U' else ['C', 'U', 'U', 'U', 'C', 'C', 'B'][kase] end as grade,
  case when flaky then 'unresolved' else ['transition_inferred', 'unresolved', 'unresolved', 'unresolved', 'transition_inferred', 'transition_inferred', 'direct_transition_verified'][kase] end as attribution_class, case when flaky then 'outcome_unknown' else oc end as outcome,
  least(complete, [70, 50, 50, 60, 75, 85, 100][kase], case when flaky then 50 else 100 end) as evidence_completeness, kase = 1 or flaky as suspected_flake from q""", *history, recursive=True)  # fmt: skip
add("store_write_once", """ select 1 as write, record_id, 'written' as status from records where delivery % 2 = 0 union all
  select 2, record_id, case when delivery % 10 = 4 then 'conflict' when delivery % 2 = 0 then 'unchanged' else 'written' end from records union all select 3, record_id, case when delivery % 10 = 4 then 'conflict' else 'unchanged' end from records""", *stored_records)  # fmt: skip
add("manifest_view", "select record_id, event_class, producer_id, source_event_id, delivery from records where event_class = 'static_finding'", *stored_records)


def json_sql(**fields: str) -> str:
    """JSON of the fields by name; each is an expression of a text, a whole number (``#`` before it), a number with a point
    (``.``) or of JSON (``@``)."""

    def value(e: str) -> str:
        kind, inner = (e[0], e[1:]) if e[0] in "#.@" else ("", e)
        text = {"#": f"cast({inner} as varchar)", ".": f"'\"' || printf('%.9f', round(cast({inner} as double), 9)) || '\"'", "@": f"{inner}", "": f"cast(to_json({inner}) as varchar)"}[kind]
        return f"coalesce({text}, 'null')"

    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {value(fields[k])}" for k in sorted(fields)) + " || '}'"


def grouped_sql(by: str) -> str:
    """Digests of ``r`` (``by``, j) per group, as a tree of two levels: up to 4096 x 4096 rows in a group."""
    return f"""g0 as (select {by}, sha256(coalesce(j, '')) as h, row_number() over (partition by {by} order by sha256(coalesce(j, ''))) - 1 as s from r),
  g1 as (select {by}, s // 4096 as s, count(*) as n, sha256(string_agg(h, '' order by s)) as h from g0 group by 1, 2),
  digests as (select {by}, cast(sum(n) as bigint) as row_count, case when count(*) = 1 then min(h) else sha256(string_agg(h, '' order by s)) end as digest from g1 group by 1)"""


PAIRS = """marks as (select distinct occurrence_scope as s, recurrence_fingerprint as f from obs), counts as (select f, count(*) as n from marks group by 1),
  pairs as (select a.f as l, b.f as r, count(*) as shared from marks a join marks b on a.s = b.s and a.f < b.f group by 1, 2),
  cooccurrence as (select l, r, shared, x.n as ln, y.n as rn, shared / (x.n + y.n - shared) as jaccard from pairs join counts x on x.f = l join counts y on y.f = r)"""
RULE_COUNTS = ("attempt_count", "confirmed_false_positive_count", "confirmed_true_positive_count", "inconclusive_count", "successful_count", "failed_count", "partial_count", "unknown_count", "validation_unknown_count")
REPORT_TEXTS = f"""r as (select 'recurrence' as name, {json_sql(recurrence_fingerprint="recurrence_fingerprint", event_class="event_class", canonical_rule_id="canonical_rule_id", first_scope="first_scope", last_scope="last_scope", **{c: "#" + c for c in ("occurrence_count", "distinct_scope_count", "distinct_producer_count")})} as j from recurrence
  union all select 'cooccurrence', {json_sql(left_fingerprint="l", right_fingerprint="r", shared_scope_count="#shared", left_scope_count="#ln", right_scope_count="#rn", jaccard_ratio=".jaccard")} from cooccurrence
  union all select 'effort', {json_sql(event_class="event_class", remediation_class="remediation_class", known_observation_count="#known_observation_count", unknown_observation_count="#unknown_observation_count", total_minutes="#total_minutes", mean_minutes=".mean_minutes", median_minutes=".median_minutes", p95_minutes=".p95_minutes")} from atlas
  union all select 'effectiveness', {json_sql(canonical_rule_id="canonical_rule_id", false_positive_ratio=".false_positive_ratio", success_ratio=".success_ratio", **{c: "#" + c for c in RULE_COUNTS})} from effectiveness)"""
LIMITED = """limited as (select list_sort(list_filter([case when bool_or(canonical_rule_id is null) then 'canonical_rule_id unavailable for some records' end, case when bool_or(effort_minutes is null) then 'effort_minutes unavailable for some records' end,
  case when bool_or(occurrence_scope like 'record:%') then 'occurrence_scope unavailable for some records; record identity was used as a non-cooccurring fallback' end], lambda x: x is not null)) as limitations from obs)"""
RUN = f"""run as (select 'ar_' || sha256({json_sql(source_snapshot_id="'cs_test'", contract="'analytics-contract/v1'", report_hashes="(select string_agg(name || '=' || digest, chr(10) order by name) from digests)")}) as run_id, 'cs_test' as source_snapshot_id)"""
analysed = (stored, OBS, RECURRENCE, ATLAS, RULES, MEANS, PAIRS, REPORT_TEXTS, grouped_sql("name"), RUN)
add("report_manifest", "select run_id, source_snapshot_id, name, row_count, digest from digests, run", *analysed)
add("verify_analytics", """select 'cs_test' as source_snapshot_id, 'recurrence' as name, unnest(['report hash', 'row count']) as fault where exists (select 1 from recurrence where recurrence_fingerprint like '0%')
  union all select 'cs_test', 'effectiveness', 'report hash' where exists (select 1 from effectiveness where failed_count > 0) union all select 'cs_test', 'cooccurrence', 'report missing'
  union all select 'cs_test', null, unnest(['output hash', 'run identity']) union all select null, 'effort', unnest(['report missing', 'run missing'])""", *analysed)  # fmt: skip
MATCH = "@" + "'{\"event_class\":\"' || event_class || '\",\"recurrence_fingerprint\":\"' || recurrence_fingerprint || '\"}'"
EVIDENCE = "@" + json_sql(analysis_run_id="run_id", recurrence_fingerprint="recurrence_fingerprint", source_snapshot_id="source_snapshot_id")
ACTION = "@'{\"automatic_fix\":false,\"behavior\":\"diagnose\",\"blocking\":false}'"
NAMED = f"""docs as (select c.* exclude (candidate_id), run_id, source_snapshot_id, 'Prevent recurring ' || event_class || ' pattern ' || left(recurrence_fingerprint, 12) as title,
  'candidate_' || sha256({json_sql(source_snapshot_id="source_snapshot_id", analysis_run_id="run_id", recurrence_fingerprint="recurrence_fingerprint", candidate_kind="candidate_kind", match_contract=MATCH, action_contract=ACTION)}) as candidate_id from compiled c, run)"""
BODIES = f"""files as (select recurrence_fingerprint, case when candidate_kind = 'ast_grep' then 'rules/' || candidate_id || '.yml' else 'contracts/' || candidate_id || '.json' end as file, case when candidate_kind = 'ast_grep' then
  'id: ' || candidate_id || chr(10) || 'language: generic' || chr(10) || 'message: ' || title || chr(10) || 'metadata:' || chr(10) || '  analysis_run_id: ' || run_id || chr(10) || '  automatic_fix: false' || chr(10) || '  blocking: false' || chr(10)
  || '  score: ' || cast(cast(score as decimal(10,6)) as varchar) || chr(10) || '  source_snapshot_id: ' || source_snapshot_id || chr(10) || '  state: candidate' || chr(10) || 'rule:' || chr(10) || '  kind: candidate_placeholder' || chr(10)
  || '  regex: CANDIDATE_' || left(recurrence_fingerprint, 16) || chr(10) || 'severity: warning' || chr(10)
  else {json_sql(schema="'architecture-contract-candidate/v1'", contract_id="candidate_id", state="'candidate'", blocking="@'false'", selector=MATCH, expectation="@" + json_sql(automatic_remediation="@'false'", diagnostic="title"), lineage=EVIDENCE)} end as body from docs where state <> 'deferred'
  union all select recurrence_fingerprint, 'invariants/' || candidate_id || '.json', {json_sql(schema_version="'generated-invariant/v1'", invariant_id="'invariant_' || sha256(" + json_sql(candidate_id="candidate_id", statement="title") + ")", candidate_id="candidate_id", statement="title", scope="event_class", severity="case when state = 'promotion_eligible' then 'warning' else 'info' end", evidence=EVIDENCE, state="'candidate'")} from docs where state <> 'deferred')"""
documented = (*analysed, CANDIDATES, NAMED)
add("candidate_documents", """select candidate_id, run_id, source_snapshot_id, recurrence_fingerprint, title, 'Observed ' || occurrence_count || ' times across ' || distinct_scope_count || ' distinct scopes.' as rationale, state,
  array_to_string(limitations, '|') as limitations from docs, limited""", *documented, LIMITED)  # fmt: skip
add("artifact_files", "select file, body from files", *documented, BODIES)
add("verify_compilation", """select file, 'file missing' as fault from files where recurrence_fingerprint like '1%' union all select file, 'file hash' from files where recurrence_fingerprint like '2%'
  union all select file || '.bak', 'file unlisted' from files where recurrence_fingerprint like '3%'""", *documented, BODIES)  # fmt: skip
add("outcome_digests", f", r as (select pack_id, {json_sql(**{c: c for c in ('outcome_key', 'pack_id', 'canonical_rule_id', 'surface', 'outcome_class', 'period')}, latency_ms='#latency_ms')} as j from outcomes), {grouped_sql('pack_id')} select pack_id, row_count, digest from digests", outcomes)
add("verify_effectiveness", """, packs as (select pack_id || ':' || canonical_rule_id as pack, count(*) filter (outcome_class = 'repair_failed') as failed, count(*) as n from outcomes group by 1)
  select pack as pack_id, unnest(['outcome lineage', 'observation count']) as fault from packs where pack like '%:rule_1_' and failed > 0 union all select pack, 'report missing' from packs where pack like '%:rule_2'
  union all select pack, 'report hash' from packs where pack like '%:rule_3_' union all select pack, 'report unlisted' from packs where pack like '%:rule_4'
  union all select pack, 'report identity' from packs where pack = 'pack_0:rule_5'""", outcomes)  # fmt: skip
PUBLISHED = """p as (select 'channel_' || (o_custkey % 50) as channel, o_orderkey as sequence, (o_orderkey % 12) || '.' || (o_orderkey % 5) || '.0' as v, o_orderkey * 3 // (max(o_orderkey) over () + 1) as third from orders),
  q as (select *, lag(v) over (partition by channel order by sequence) as pv, max(sequence) over (partition by channel) as top, max(sequence) over (partition by channel, v) as last from p)"""
RETIRED = f"""retired as (select channel, v, sha256(v) as pack_sha256, case when sequence % 21 = 0 then ' ' when sequence % 35 = 0 then null else 'reason ' || (sequence % 4) end as reason, case when sequence % 2 = 0 then '99.0.0' end as replacement,
  case when sequence % 77 <> 0 then 'ops' else '' end as issuer from p where sequence % 7 = 0),
  named as (select *, case when trim(reason) <> '' and issuer <> '' then 'retire_' || sha256({json_sql(pack_id="channel", pack_version="v", pack_sha256="pack_sha256", reason="reason", replacement_version="replacement", retired_at="'2026-01-01T00:00:00Z'", issuer="issuer")}) end as id from retired)"""
add("channel_index", "select channel, sha256(v) as archive_hash, v as pack_version, sequence, pv as previous_version, sequence = top as is_active from q where sequence = last", PUBLISHED)
add("channel_writes", """select third + 1 as "write", channel, sequence, 'published' as status from q where third < 2 union all select 3, channel, sequence, 'conflict' from q where third = 2
  union all select 4, channel, sequence, 'published' from q where third = 2 union all select 5, channel, sequence, case when sequence = last then 'unchanged' else 'late' end from q where third = 0""", PUBLISHED)  # fmt: skip
add("retirement_ledger", """, t as (select id, count(*) as n, min(v) < '5' as early from named where id is not null group by 1)
  select id as retirement_id, 'written' as status, 1 as n from t union all select id, 'unchanged', case when early then 2 * n - 1 else n - 1 end from t where early or n > 1
  union all select null, 'refused', count(*) + count(*) filter (v < '5') from named where id is null having count(*) > 0""", PUBLISHED, RETIRED)  # fmt: skip
add("channels_in_force", """, g as (select pack_sha256, max(struct_pack(k := replacement is not null, replacement := coalesce(replacement, ''))) as x from retired where reason is not null group by 1)
  select channel, v as pack_version, sequence, pv as previous_version, x is not null as retired, nullif(x.replacement, '') as replacement_version from q left join g on pack_sha256 = sha256(v) where sequence = top""", PUBLISHED, RETIRED)  # fmt: skip
