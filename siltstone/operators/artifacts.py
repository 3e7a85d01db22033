"""Candidate documents and the files that compilation makes of them: rules in YAML, contracts and invariants in JSON.

Each is one row of native expressions, so a compilation is a table of files that is written and checked in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.canonical import sha

KEEP_NULLS = {"ignoreNullFields": "false"}


def json_of(**fields: Column) -> Column:
    """JSON of the fields in the order of their names, nulls kept."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), KEEP_NULLS)


def yaml_text(text: Column) -> Column:
    """A text as a YAML scalar: plain where no reader could take it for anything else, else in double quotes."""
    quoted = F.to_json(F.array(text))
    plain = text.rlike(r"^[A-Za-z][A-Za-z0-9_ .-]*[A-Za-z0-9_]$") & ~F.lower(text).isin("true", "false", "yes", "no", "on", "off", "null")
    return F.when(text.isNull(), "null").when(plain, text).otherwise(F.substr(quoted, F.lit(2), F.length(quoted) - 2))


def candidate_documents(scored: DataFrame, run: DataFrame) -> DataFrame:
    """``scored`` candidates with their document columns: an identity that includes the run, title, rationale, limitations.

    ``run``: one row with run_id, source_snapshot_id and limitations (of the reports, sorted). The identity covers run,
    fingerprint, kind, what the rule matches and what it does; a candidate of another run is another candidate.
    """
    one = F.broadcast(run.select("run_id", "source_snapshot_id", "limitations", F.lit(1).alias("__one")))  # one row
    rows = scored.drop("candidate_id", "limitations").withColumn("__one", F.lit(1)).join(one, "__one").drop("__one")
    c = F.col
    match = F.struct("event_class", "recurrence_fingerprint")
    action = F.struct(F.lit(False).alias("automatic_fix"), F.lit("diagnose").alias("behavior"), F.lit(False).alias("blocking"))
    named = json_of(source_snapshot_id=c("source_snapshot_id"), analysis_run_id=c("run_id"), recurrence_fingerprint=c("recurrence_fingerprint"), candidate_kind=c("candidate_kind"), match_contract=match, action_contract=action)
    return rows.withColumns({
        "candidate_id": F.concat(F.lit("candidate_"), sha(named)),
        "title": F.concat(F.lit("Prevent recurring "), "event_class", F.lit(" pattern "), F.left("recurrence_fingerprint", F.lit(12))),
        "rationale": F.concat(F.lit("Observed "), c("occurrence_count").cast("string"), F.lit(" times across "), c("distinct_scope_count").cast("string"), F.lit(" distinct scopes.")),
        "match_contract": match,
        "action_contract": action,
    })


def rule_yaml() -> Column:
    """The rule file of a candidate, keys in order."""
    c = F.col
    lines = [
        ("id: ", yaml_text(c("candidate_id"))),
        ("language: generic\nmessage: ", yaml_text(c("title"))),
        ("metadata:\n  analysis_run_id: ", yaml_text(c("run_id"))),
        ("  automatic_fix: false\n  blocking: false\n  score: ", c("score").cast("decimal(10,6)").cast("string")),
        ("  source_snapshot_id: ", yaml_text(c("source_snapshot_id"))),
        ("  state: candidate\nrule:\n  kind: candidate_placeholder\n  regex: CANDIDATE_", F.left("recurrence_fingerprint", F.lit(16))),
    ]
    return F.concat(*(part for key, value in lines for part in (F.lit(key), value, F.lit("\n"))), F.lit("severity: warning\n"))


def contract_json() -> Column:
    """The architecture contract of a candidate."""
    c = F.col
    expectation = F.struct(F.lit(False).alias("automatic_remediation"), c("title").alias("diagnostic"))
    lineage = F.struct(c("run_id").alias("analysis_run_id"), "recurrence_fingerprint", "source_snapshot_id")
    return json_of(schema=F.lit("architecture-contract-candidate/v1"), contract_id=c("candidate_id"), state=F.lit("candidate"), blocking=F.lit(False), selector=c("match_contract"), expectation=expectation, lineage=lineage)


def invariant_json() -> Column:
    """The invariant that a candidate states."""
    c = F.col
    evidence = F.struct(c("run_id").alias("analysis_run_id"), "recurrence_fingerprint", "source_snapshot_id")
    named = F.concat(F.lit("invariant_"), sha(json_of(candidate_id=c("candidate_id"), statement=c("title"))))
    severity = F.when(c("state") == "promotion_eligible", "warning").otherwise("info")
    return json_of(schema_version=F.lit("generated-invariant/v1"), invariant_id=named, candidate_id=c("candidate_id"), statement=c("title"), scope=c("event_class"), severity=severity, evidence=evidence, state=F.lit("candidate"))


def files(documents: DataFrame) -> DataFrame:
    """(candidate_id, file, body): the rule or contract and the invariant of every candidate that isn't deferred."""
    kind = F.col("candidate_kind") == "ast_grep"
    named = lambda folder, end: F.concat(F.lit(folder), "candidate_id", F.lit(end))
    rule = F.when(kind, F.struct(named("rules/", ".yml").alias("file"), rule_yaml().alias("body"))).otherwise(F.struct(named("contracts/", ".json").alias("file"), contract_json().alias("body")))
    invariant = F.struct(named("invariants/", ".json").alias("file"), invariant_json().alias("body"))
    return documents.where("state != 'deferred'").select("candidate_id", F.explode(F.array(rule, invariant)).alias("f")).select("candidate_id", "f.*")
