"""Validation, redaction, disposition, deduplication and projection of corpus events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.canonical import canonical_json, identity, namespaced, pseudonym
from siltstone.operators.ordered import numbered
from siltstone.schemas import REGISTRY

# What must not be in an event (key words, credentials, absolute paths, git object ids).
SENSITIVE_KEY = r"(?i)authorization|password|passwd|secret|token|api[_-]?key|private[_-]?key|client[_-]?secret"
SENSITIVE_VALUES = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"(?i)\bbearer\s+[A-Za-z0-9._~+/=-]{12,}", r"\bgh[pousr]_[A-Za-z0-9]{20,}\b", r"\bgithub_pat_[A-Za-z0-9_]{20,}\b", r"\bAKIA[0-9A-Z]{16}\b")
ABSOLUTE_PATH = r"(^|[^A-Za-z0-9_.-])(/(home|Users|var|tmp|private|opt)/\S+|[A-Za-z]:\\\S+)"
OBJECT_ID = r"\b[0-9a-fA-F]{40}\b"

#: In small letters, what stands in every text that one of the above but OBJECT_ID finds something in. Keep with them.
MARKS = ("\\", "authorization", "passw", "secret", "token", "api", "private", "bearer", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "akia", "/home/", "/users/", "/var/", "/tmp/", "/opt/")


def suspect(small: Column) -> Column:
    """Whether a JSON text, in small letters, may break a rule of redaction. Where this is false none is broken: a mark is
    missing of each, and the quotes around a text bound it as its ends do. ``small`` is best a column of its own."""
    found = small.rlike(r"[0-9a-f]{40}")
    for mark in MARKS:
        found = found | F.contains(small, F.lit(mark))
    return found


def redaction_hits(text: Column, object_ids: bool = True) -> Column:
    """Names of the rules that a value breaks, in a fixed order; words for secrets count in keys alone (``redaction_paths``)."""
    rules = {f"credential_{k}": p for k, p in enumerate(SENSITIVE_VALUES)} | {"absolute_path": ABSOLUTE_PATH} | ({"object_id": OBJECT_ID} if object_ids else {})
    return F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(name)) for name, p in rules.items())))


def has_float(doc: Column) -> Column:
    """Whether a JSON text has a number with a fraction or exponent anywhere; numbers inside strings don't count."""
    outside = F.regexp_replace(F.regexp_replace(doc, r"\\.", ""), r'"[^"]*"', '""')  # escapes first, so that long strings need no stack
    mark = r"\d[.eE]"
    return doc.rlike(mark) & outside.rlike(mark)  # most texts have the mark nowhere, also not in strings


def redaction_paths(docs: DataFrame, key: str, doc: str) -> DataFrame:
    """(key, path, rule) for every value or key of a JSON document that breaks a rule; the walk over open JSON
    is a task for Python, in Arrow batches."""
    import json
    import re

    import pyarrow as pa

    values = [("sensitive_value", re.compile(p)) for p in (*SENSITIVE_VALUES, ABSOLUTE_PATH, OBJECT_ID)]
    word = re.compile(SENSITIVE_KEY)

    def walk(node, path):
        if isinstance(node, dict):
            for k, v in node.items():
                at = f"{path}.{k}" if path else k
                if word.search(k):
                    yield at, "sensitive_key"
                yield from walk(v, at)
        elif isinstance(node, list):
            for k, v in enumerate(node):
                yield from walk(v, f"{path}[{k}]")
        elif isinstance(node, str):
            for name, p in values:
                if p.search(node):
                    yield path, name

    def run(batches):
        for batch in batches:
            out = []
            for k, d in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    out += [(k, at, rule) for at, rule in walk(json.loads(d or "null"), "")]
                except ValueError:
                    out.append((k, "", "malformed"))
            if out:
                names = ["key", "path", "rule"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (batch.schema.field(0).type, pa.string(), pa.string()), strict=True)], names)

    return docs.select(key, doc).mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, path string, rule string")


def registry(spark, rows=REGISTRY) -> DataFrame:
    """The compatibility registry as a table; ``rows`` is a parameter of a few lines."""
    return spark.createDataFrame(list(rows), "r_producer string, r_contract string, r_sdk string, r_status string, r_class string")


def compatibility(events: DataFrame, known: DataFrame) -> DataFrame:
    """``events`` with ``incompatible``: null, or why producer, class, contract or SDK don't fit the registry, in which a
    producer may have several lines. One without an SDK contract must not name any."""
    one = known.where("r_status = 'active'").groupBy("r_producer").agg(*(F.collect_set(c).alias(c) for c in ("r_contract", "r_sdk", "r_class")))
    joined = events.join(F.broadcast(one), events.producer_id == F.col("r_producer"), "left")  # written by hand, a few lines
    among = lambda value, known_values: F.coalesce(F.array_contains(known_values, F.col(value)), F.lit(False))
    sdk = F.when(F.size("r_sdk") == 0, F.col("sdk_contract").isNull()).otherwise(among("sdk_contract", F.col("r_sdk")))
    why = (
        F.when(F.col("r_producer").isNull(), "unknown_producer")
        .when(~among("event_class", F.col("r_class")) | ~among("producer_contract", F.col("r_contract")), "incompatible_producer_contract")
        .when(~sdk, "incompatible_sdk_contract")
    )
    return joined.withColumn("incompatible", why).drop("r_producer", "r_contract", "r_sdk", "r_class")


def record_id(events: DataFrame) -> Column:
    fields = ("producer_id", "producer_contract", "event_class", "snapshot_or_run_id", "payload_hash")
    return identity("cr_", {f: F.col(f) for f in fields})


def unseen(events: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events whose record isn't known yet, one per record, and those that are duplicates of known ones."""
    fresh = events.join(records.select("record_id"), "record_id", "left_anti").dropDuplicates(["record_id"])
    return fresh, events.join(records.select("record_id"), "record_id", "left_semi")


def ledger(rows: DataFrame, order: list[str], stored: DataFrame | None = None) -> DataFrame:
    """``rows`` with a dense ``sequence`` in the given order, from 1, or from behind the last of a ``stored`` ledger."""
    return numbered(rows, order, 0 if stored is None else stored.agg(F.max("sequence")).first()[0] or 0)


def ledger_gaps(entries: DataFrame, width: int = 100_000) -> DataFrame:
    """(first, last, problem): stretches of sequences from 1 on that are missing, sequences that are repeated, and those
    that none can have (below 1, or null); no row if the ledger is dense.

    Ranges of ``width`` sequences are looked through by themselves, and what begins in one reaches to the first sequence
    of the next that has any, so that one huge sequence is one row.
    """
    per = entries.groupBy("sequence").agg(F.count(F.lit(1)).alias("count"))
    never = per.where("sequence is null or sequence < 1").select(F.col("sequence").cast("long").alias("first"), F.col("sequence").cast("long").alias("last"), F.lit("invalid").alias("problem"))
    known = per.where("sequence >= 1").select(F.col("sequence").cast("long").alias("at"), "count")
    twice = known.where("count > 1").select(F.col("at").alias("first"), F.col("at").alias("last"), F.lit("repeated").alias("problem"))
    known = known.withColumn("id", F.floor((F.col("at") - 1) / width))
    inner = known.withColumn("before", F.lag("at").over(Window.partitionBy("id").orderBy("at"))).where("before is not null")
    ends = known.groupBy("id").agg(F.min("at").alias("at"), F.max("at").alias("top"))  # a row per range
    outer = ends.withColumn("before", F.coalesce(F.lag("top").over(Window.orderBy("id")), F.lit(0)))
    missing = inner.select("before", "at").unionByName(outer.select("before", "at")).where("at > before + 1")
    return never.unionByName(twice).unionByName(missing.select((F.col("before") + 1).alias("first"), (F.col("at") - 1).alias("last"), F.lit("missing").alias("problem")))


def superseded(corrections: DataFrame, records: DataFrame) -> DataFrame:
    """(record_id, superseded_by): per corrected record the replacement, preferring records that aren't themselves
    corrected, then the greatest id."""
    targets = corrections.select(F.col("target").alias("t")).distinct().withColumn("is_target", F.lit(True))
    found = corrections.join(records.select(F.col("record_id").alias("replacement"), "source_event_id"), corrections.replacement_event_id == F.col("source_event_id")).where("replacement != target")
    found = found.join(targets, F.col("replacement") == F.col("t"), "left").withColumn("final", F.col("is_target").isNull())
    best = found.groupBy("target").agg(F.max(F.struct("final", "replacement")).alias("best"))
    return best.select(F.col("target").alias("record_id"), F.col("best.replacement").alias("superseded_by"))


def predecessors(events: DataFrame, corrections: DataFrame) -> DataFrame:
    """(record_id, predecessor): records of the same event, producer, class and contract with another payload,
    unless corrected already."""
    same = ["source_event_id", "producer_id", "event_class", "producer_contract"]
    left = events.select(*same, "record_id", "payload_hash")
    right = events.select(*same, F.col("record_id").alias("predecessor"), F.col("payload_hash").alias("old_hash"))
    pairs = left.join(right, same).where("payload_hash != old_hash and record_id != predecessor")
    return pairs.join(corrections.select(F.col("target").alias("predecessor")), "predecessor", "left_anti").select("record_id", "predecessor")


def orphans(records: DataFrame, **children: DataFrame) -> DataFrame:
    """(kind, record_id) of child rows whose record is missing; empty for an intact store."""
    out = None
    for kind, rows in sorted(children.items()):
        found = rows.select("record_id").distinct().join(records.select("record_id"), "record_id", "left_anti").select(F.lit(kind).alias("kind"), "record_id")
        out = found if out is None else out.unionByName(found)
    return out


def said(text: Column) -> Column:
    """The text, null if it is blank."""
    return F.when(F.trim(text) != "", text)


def finding_observations(bundles: DataFrame) -> DataFrame:
    """A row per finding: keyed by its rule, else by the producer's fingerprint, else by the finding's id, else by the
    record; component is the first location's path. An empty bundle gives none."""
    f = F.col("f")
    key = F.when(F.coalesce(f["canonical_rule_id"], F.lit("")) != "", namespaced("rule", f["canonical_rule_id"])).otherwise(namespaced("producer-fingerprint", F.coalesce(said(f["fingerprint"]), said(f["finding_id"]), F.col("record_id").cast("string"))))
    return bundles.select("record_id", "occurrence_scope", F.explode("findings").alias("f")).select("record_id", "occurrence_scope", f["finding_id"].alias("finding_id"), f["canonical_rule_id"].alias("canonical_rule_id"), key.alias("recurrence_fingerprint"), F.try_element_at(f["locations"], F.lit(1))["normalized_path"].alias("component"))


def resolver_observations(feedback: DataFrame) -> DataFrame:
    """One row per feedback; results outside the domain are unknown (none stays null), duration buckets never become
    minutes, and without a failure's fingerprint the record is the key."""
    given = said(F.col("validation_result"))
    result = F.when(given.isin("passed", "failed", "partial"), given).when(given.isNotNull(), "unknown")
    key = F.coalesce(namespaced("failure", said(F.col("failure_fingerprint"))), namespaced("record", F.col("record_id").cast("string")))
    return feedback.select("record_id", key.alias("recurrence_fingerprint"), F.col("remediation_class"), result.alias("validation_outcome"), F.lit(None).cast("bigint").alias("effort_minutes"))


#: Validation outcome of each historical outcome.
HISTORICAL = {"clean_verified": "passed", "target_failure_resolved": "passed", "repeated_failure": "failed", "new_failure": "failed", "outcome_unknown": "unknown", "unresolved": "unknown"}


def historical_observations(events: DataFrame) -> DataFrame:
    """Outcome by literal map, others unknown, none null; a suspected flake is inconclusive, else a passed validation
    confirms the failure. The key is that of the same failure in a resolver's feedback, without one the record's."""
    given = said(F.col("outcome"))
    known = F.create_map(*(F.lit(x) for kv in HISTORICAL.items() for x in kv))
    outcome = F.when(given.isNotNull(), F.coalesce(F.try_element_at(known, given), F.lit("unknown")))
    disposition = F.when(F.col("suspected_flake"), "inconclusive").when(outcome == "passed", "confirmed_true_positive")
    key = F.coalesce(namespaced("failure", said(F.col("semantic_identity"))), namespaced("record", F.col("record_id").cast("string")))
    return events.select("record_id", key.alias("recurrence_fingerprint"), outcome.alias("validation_outcome"), disposition.alias("false_positive_disposition"))


def normalized_event(events: DataFrame) -> DataFrame:
    """Set-like arrays sorted and distinct, the payload in canonical JSON with its hash."""
    out = events
    if "limitations" in events.columns:
        out = out.withColumn("limitations", F.array_sort(F.array_distinct("limitations")))
    if "unknowns" in events.columns:
        out = out.withColumn("unknowns", F.array_sort("unknowns"))
    return out.withColumn("payload", canonical_json(F.col("payload"))).withColumn("payload_hash", F.sha2("payload", 256))


def redacted_bundles(bundles: DataFrame, path_key: bytes) -> DataFrame:
    """Bundles whose paths are keyed tokens, whose snapshot id and revision are hashes, without the repository root."""

    def place(p: Column) -> Column:
        return p.withField("normalized_path", pseudonym("path_", path_key, p["normalized_path"]))

    def finding(f: Column) -> Column:
        return f.withField("locations", F.transform(f["locations"], place))

    hashed = lambda c: F.concat(F.lit("sha256:"), F.sha2(c, 256))
    snapshot = F.col("snapshot").withField("snapshot_id", hashed(F.col("snapshot.snapshot_id"))).withField("revision", hashed(F.col("snapshot.revision"))).dropFields("repository_root")
    return bundles.withColumn("findings", F.transform("findings", finding)).withColumn("snapshot", snapshot)


def envelopes(bundles: DataFrame, repository_key: bytes) -> DataFrame:
    """The event that carries a redacted bundle: id from the document's hash, pseudonym of the repository, payload."""
    payload = F.to_json(F.struct("findings", "snapshot"))
    event = F.concat(F.lit("finding-bundle_"), F.sha2(payload, 256))
    return bundles.select("record", event.alias("event_id"), F.lit("static_finding").alias("event_class"), F.lit("producer_redacted").alias("redaction_status"), pseudonym("repository_", repository_key, F.col("repository")).alias("repository_identity"), payload.alias("payload"))


def unknown_lineage(rows: DataFrame, allowed: tuple[str, ...], lineage: str = "lineage") -> DataFrame:
    """Rows whose lineage map has keys beyond the allowed ones, with those keys."""
    extra = F.array_sort(F.array_except(F.map_keys(lineage), F.array(*map(F.lit, allowed))))
    return rows.withColumn("unknown_keys", extra).where(F.size("unknown_keys") > 0)


def ingress_status() -> Column:
    """HTTP status of a request, in the order of the checks: path, method, token, size, document, disposition."""
    return (
        F.when(F.col("path") != "/events", 404)
        .when(F.col("method") != "POST", 405)
        .when(~F.coalesce(F.col("authorized"), F.lit(False)), 401)
        .when(F.col("size") > 1048576, 413)
        .when(F.col("malformed"), 422)
        .when(F.col("disposition") == "conflict", 409)
        .when(F.col("disposition") == "quarantined", 422)
        .when(F.col("disposition") == "unavailable", 503)
        .otherwise(201)
    )


def verify_store(records: DataFrame, entries: DataFrame, **children: DataFrame) -> DataFrame:
    """(problem, n) over the whole store; empty for an intact one.

    Looks for gaps, repeats and impossible numbers in the ledger, entries whose record isn't there and records that no
    entry accepted (where entries have record_id and disposition), orphans of each kind, repeated records, and records
    whose id is not that of their producer, contract, class, run and payload hash (where they have a run).
    """
    problem = lambda rows, name: rows.select((name if isinstance(name, Column) else F.lit(name)).alias("problem"))
    gaps = ledger_gaps(entries)
    found = [gaps.select(F.concat(F.lit("ledger "), "problem").alias("problem"), (F.col("last") - F.col("first") + 1).alias("n")).select("problem", F.coalesce("n", F.lit(1)).alias("n"))]
    single = [problem(orphans(records, **children), F.concat(F.lit("orphan "), "kind")), problem(records.groupBy("record_id").count().where("count > 1"), "record repeated")] if children else [problem(records.groupBy("record_id").count().where("count > 1"), "record repeated")]
    if {"record_id", "disposition"} <= set(entries.columns):
        kept = entries.where("disposition in ('accepted', 'duplicate')")
        single.append(problem(kept.join(records.select("record_id"), "record_id", "left_anti"), "ledger record missing"))
        single.append(problem(records.join(entries.where("disposition = 'accepted'").select("record_id"), "record_id", "left_anti"), "record never accepted"))
    if "snapshot_or_run_id" in records.columns:
        single.append(problem(records.where(~F.col("record_id").eqNullSafe(record_id(records))), "record identity"))
    for rows in single:
        found.append(rows.withColumn("n", F.lit(1).cast("long")))
    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows)
    return out.groupBy("problem").agg(F.sum("n").alias("n"))
