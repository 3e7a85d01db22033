"""Provider objects (pull requests, timeline events, commits, runs, jobs, checks, logs) as typed observations.

Each object is JSON of its own shape; one projection over VARIANT dispatches by kind to an array of observations of one
type, which a single explode opens: a commit is also a change, a failed job also a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.canonical import identity
from siltstone.operators.envelope import kind, text_at
from siltstone.operators.history import change_flags
from siltstone.session import spread

STEPS = "array<struct<name:string,state:string>>"
FIELDS = {
    "kind": "string", "ref": "string", "execution_ref": "string", "revision": "string", "before_revision": "string", "workflow": "string", "name": "string", "attempt": "int", "status": "string", "conclusion": "string",
    "started_at": "string", "finished_at": "string", "parents": "array<string>", "is_merge": "boolean", "steps": STEPS, "file_count": "int", "workflow_changed": "boolean", "test_changed": "boolean", "environment_changed": "boolean",
    "lockfile_changed": "boolean", "weakening": "array<string>", "change_fingerprint": "string", "semantic_identity": "string", "occurrence_identity": "string", "failed_steps": "array<string>", "availability": "string", "notes": "array<string>",
}


def row(kind_name: str, /, **columns: Column) -> Column:
    values = columns | {"kind": F.lit(kind_name)}
    return F.struct(*(values.get(n, F.lit(None)).cast(t).alias(n) for n, t in FIELDS.items()))


#: Values at the top of objects that are read, and those in their lists.
READ = ("id", "run_id", "run_attempt", "workflow_id", "sha", "head_sha", "event", "name", "conclusion", "status", "path", "commit_id", "created_at", "updated_at", "started_at", "completed_at", "files")
LISTED = {"parents": ("sha",), "files": ("filename", "status", "patch"), "steps": ("name", "conclusion", "status")}


def fields(*names: str) -> str:
    return f"struct<{','.join(f'{n}:variant' for n in names)}>"


def a_text(value: Column) -> Column:
    """A VARIANT that is a text and not empty; else null."""
    return F.when(F.schema_of_variant(value) == "STRING", F.nullif(F.try_variant_get(value, "$", "string"), F.lit("")))


def is_a(value: Column, *kinds: str) -> Column:
    """Whether a VARIANT is of the given kinds; plain texts and whole numbers are known by their type alone."""
    plain = F.schema_of_variant(value)
    known = F.when(plain == "BIGINT", F.lit("integer" in kinds)).when(plain == "STRING", F.lit("string" in kinds))
    return F.when(value.isNotNull(), F.coalesce(known, kind(value).isin(*kinds)))


def a_number(value: Column) -> Column:
    """A whole number above 0; null for anything else."""
    return F.when(is_a(value, "integer") & (F.try_variant_get(value, "$", "long") > 0), F.try_variant_get(value, "$", "int"))


def a_name(value: Column) -> Column:
    return F.when(is_a(value, "string", "integer"), F.nullif(F.try_variant_get(value, "$", "string"), F.lit("")))


def execution(run: Column, attempt: Column) -> Column:
    return F.when(attempt.isNull(), run).otherwise(F.concat(run, F.lit(":attempt:"), attempt.cast("string")))


def normalized(objects: DataFrame) -> DataFrame:
    """Observations (scope, source, observation_id, limitations and ``FIELDS``) of objects (scope, source, kind, payload as
    JSON, run_attempt: what the acquisition knows of it, limitations).

    Blank texts, numbers of the wrong type and attempts below 1 are unknown. Timeline events other than a changed base and
    a forced push, unknown kinds, and payloads that are no object give nothing; a log gives only that it is there.
    """
    p, c = F.col("p"), F.col
    text = lambda name: a_text(c("v")[name])
    none = F.array().cast("array<string>")
    complete = lambda *needed: F.when(F.coalesce(*[F.when(n.isNull(), F.lit("partial")) for n in needed], F.lit("complete")) == "partial", "partial").otherwise("complete")
    listed = lambda name, keys: F.transform(F.filter(F.try_variant_get(p, f"$.{name}", f"array<{fields(*LISTED[name])}>"), lambda x: x.isNotNull()), keys)

    # What is needed more than once is read once, in projections of its own, as a column `_name`.
    is_commit, is_job, is_pull = (c("kind") == k for k in ("commit", "ci_job", "pull_request"))
    files = F.array_sort(F.filter(listed("files", lambda x: F.struct(a_text(x["filename"]).alias("path"), F.coalesce(a_text(x["status"]), F.lit("unknown")).alias("status"), a_text(x["patch"]).alias("patch"))), lambda f: f["path"].isNotNull()))
    unseen = c("v.files").isNull() | F.is_variant_null("v.files")
    steps = F.filter(listed("steps", lambda x: F.struct(a_text(x["name"]).alias("name"), F.coalesce(a_text(x["conclusion"]), a_text(x["status"]), F.lit("unknown")).alias("state"))), lambda s: s["name"].isNotNull())
    once = {
        "_attempt": F.coalesce(a_number(c("v.run_attempt")), F.when(c("run_attempt") >= 1, c("run_attempt")).cast("int")), "_id": a_name(c("v.id")), "_run": a_name(c("v.run_id")),
        "_base": F.when(is_pull, text_at(p, "base", "sha")), "_head": F.when(is_pull, text_at(p, "head", "sha")), **{f"_{n}": text(n) for n in ("sha", "head_sha", "event", "name", "conclusion", "updated_at")},
        "_parents": F.when(is_commit, F.coalesce(F.array_compact(listed("parents", lambda x: a_text(x["sha"]))), none)),
        "_files": F.when(is_commit & ~unseen, F.coalesce(files, F.array().cast("array<struct<path:string,status:string,patch:string>>"))),
        "_steps": F.when(is_job, F.coalesce(steps, F.from_json(F.lit("[]"), STEPS))),
    }
    then = {"_failed": F.when(is_job & (c("_conclusion") == "failure"), F.transform(F.filter("_steps", lambda s: s["state"] == "failure"), lambda s: s["name"]))}

    pull = row("pull_request", ref=F.try_variant_get(p, "$.number", "string"), before_revision=c("_base"), revision=c("_head"), name=text_at(p, "auto_merge", "merge_method"), finished_at=c("_updated_at"), availability=complete(c("_base"), c("_head")))
    signal = row("review_signal", name=c("_event"), revision=text("commit_id"), started_at=text("created_at"), availability=F.lit("direct_provider_event"))

    flags = change_flags(c("_files"))
    made = {"revision": c("_sha"), "parents": c("_parents"), "finished_at": text_at(p, "commit", "committer", "date"), "is_merge": F.size("_parents") > 1}
    commit = row("commit", **made, availability=complete(c("_sha")))
    change = row("change", **made, before_revision=F.get("_parents", F.lit(0)), **flags, availability=F.when(flags["file_count"] > 0, "complete").otherwise("partial"))

    run = row("ci_execution", ref=c("_id"), execution_ref=execution(c("_id"), c("_attempt")), revision=c("_head_sha"), workflow=F.coalesce(text("path"), a_name(c("v.workflow_id")), c("_name"), F.lit("unknown")), attempt=c("_attempt"), status=text("status"),
              conclusion=c("_conclusion"), started_at=text("created_at"), finished_at=F.coalesce("_updated_at", text("created_at")), availability=complete(c("_id"), c("_head_sha")))

    at = {"ref": c("_id"), "execution_ref": execution(c("_run"), c("_attempt")), "attempt": c("_attempt"), "revision": c("_head_sha"), "name": c("_name")}
    job = row("ci_job", **at, status=text("status"), conclusion=c("_conclusion"), started_at=text("started_at"), finished_at=text("completed_at"), steps=c("_steps"), availability=complete(c("_id"), c("_run"), c("_name")))
    meaning = identity("historical:", {"failed_steps": c("_failed"), "finding_kind": F.lit("ci_job_failure"), "job_name": F.coalesce("_name", F.lit("unknown"))})
    occurrence = identity("hfo_", {"attempt_ref": c("_attempt"), "execution_ref": at["execution_ref"], "job_ref": c("_id"), "revision": c("_head_sha"), "scope": c("scope").cast("string")})
    failure = row("failure", **at, semantic_identity=meaning, occurrence_identity=occurrence, failed_steps=c("_failed"), availability=F.when(F.size("_failed") > 0, "complete").otherwise("partial"), notes=F.when(F.size("_failed") == 0, F.array(F.lit("failed_step_unavailable"))))

    check = row("validation", ref=c("_id"), revision=c("_head_sha"), name=c("_name"), status=text("status"), conclusion=c("_conclusion"), started_at=text("started_at"), finished_at=text("completed_at"), availability=F.lit("complete"))
    log = row("textual_hint", name=F.lit("job_log"), change_fingerprint=F.sha2(c("payload"), 256), availability=F.lit("digest_only"), notes=F.array(F.lit("raw_log_not_normalized_or_projected")))
    usable = p.isNotNull() & c("payload").rlike(r"^[ \t\n\r]*\{")  # valid JSON that begins like an object is one
    found = (
        F.when(c("kind") == "job_log", F.array(log))
        .when(~F.coalesce(usable, F.lit(False)), None)
        .when(is_pull, F.array(pull))
        .when((c("kind") == "timeline_event") & c("_event").isin("base_ref_changed", "head_ref_force_pushed"), F.array(signal))
        .when(is_commit & c("_sha").isNotNull() & (F.size("_parents") > 0), F.array(commit, change))
        .when(is_commit, F.array(commit))
        .when(c("kind").isin("workflow_run", "workflow_attempt"), F.array(run))
        .when(is_job & (c("_conclusion") == "failure"), F.array(job, failure))
        .when(is_job, F.array(job))
        .when(c("kind") == "check_run", F.array(check))
    )
    read = spread(objects).withColumn("p", F.try_parse_json("payload")).withColumn("v", F.try_variant_get("p", "$", fields(*READ))).withColumns(once).withColumns(then)
    rows = read.select("scope", "source", F.coalesce("limitations", none).alias("given"), F.explode(found).alias("o"))
    limits = F.array_sort(F.array_distinct(F.concat("given", F.coalesce("o.notes", none))))
    name = identity("hno_", {"data": F.to_json("o"), "scope": c("scope").cast("string"), "source": c("source").cast("string")})
    return rows.select("scope", "source", name.alias("observation_id"), limits.alias("limitations"), "o.*").drop("notes")
