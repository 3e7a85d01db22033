"""Shortcuts past the full judgement of a document say nothing else than it does."""

import json

from pyspark.sql import functions as F

from siltstone.operators import envelope as V
from siltstone.operators.ingest import suspect
from siltstone.schemas import ENVELOPE_RULES

GOOD = {"schema_version": "corpus-event/v1", "producer_id": "p", "producer_contract": "c", "event_id": "e1", "event_class": "gate_outcome", "event_time": "2026-01-01T00:00:00Z", "snapshot_or_run_id": "s", "redaction_status": "producer_redacted", "limitations": ["a", "b"], "payload": {"n": "x", "k": 1}}
ODD = [
    {}, {"payload": {"o": {"limitations": ["b", "a", "b"]}}}, {"limitations": ["b", "a", "b"]}, {"limitations": []}, {"limitations": ["", "a"]}, {"limitations": [1, "a"]}, {"limitations": "a"}, {"limitations": ["a]", "b,", "a"]},
    {"limitations": [str(k) for k in range(40)]}, {"payload": []}, {"payload": {}}, {"payload": {"a": [1]}}, {"event_id": "e\n"}, {"event_id": "-e"}, {"event_id": "é"}, {"event_time": "2026-13-01T00:00:00Z"}, {"event_time": "2026-01-01T00:00:00.5+01:00"},
    {"producer_id": ""}, {"producer_id": None}, {"producer_id": "x" * 256}, {"sdk_contract": None}, {"sdk_contract": "s"}, {"sdk_contract": 1}, {"colour": "red"}, {"event_class": "x"}, {"schema_version": None},
    {"unknowns": [{"field": "f", "reason": "redacted"}, {"field": "a", "reason": "why"}]}, {"unknowns": [{"field": "z", "reason": "redacted"}, {"field": "f", "reason": "redacted"}]}, {"lineage": {"producer_event_hash": "0" * 64, "parent_event_ids": ["b", "a", "b"]}}, {"lineage": {"producer_event_hash": "0" * 63}},
    {"payload": {"a": 'x","limitations":["b","a","b"]'}}, {"payload": {"v": 1.5}}, {"payload": {"v": "1.5e3"}}, {"snapshot_or_run_id": "\x0b\\"},
]
SECRETS = ["Bearer abcdefghijklmnop", "ghp_" + "a" * 20, "github_pat_" + "a" * 20, "AKIA" + "A" * 16, "-----BEGIN RSA PRIVATE KEY-----", "see /home/x", "/Users/x", "/var/x", "/tmp/x", "/private/x", "/opt/x", "C:\\x", "F" * 40]
KEYS = ["Authorization", "password", "PASSWD", "my_secret", "token", "api_key", "apikey", "private-key", "client_secret"]


def normal(doc):
    """The normal form by Python."""
    doc = json.loads(json.dumps(doc))
    as_set = lambda x: sorted(set(x)) if isinstance(x, list) and all(isinstance(y, str) for y in x) else x
    doc["limitations"] = as_set(doc.get("limitations", []))
    if isinstance(doc.get("unknowns"), list):
        doc["unknowns"].sort(key=lambda u: (u["field"], u["reason"]))
    if "parent_event_ids" in doc.get("lineage", {}):
        doc["lineage"]["parent_event_ids"] = as_set(doc["lineage"]["parent_event_ids"])
    return None if '"v": 1.5}' in json.dumps(doc) else json.dumps(doc, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_normal_forms_and_errors(spark):
    docs = [GOOD | x for x in ODD] + [{k: v for k, v in GOOD.items() if k != gone} for gone in GOOD]
    rows = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "k int, document string")
    rows = V.with_normal_form(rows).localCheckpoint()
    assert {r.k: r.normal for r in rows.collect()} == {k: normal(d) for k, d in enumerate(docs)}
    full = V.errors_of(F.try_parse_json("normal"), ENVELOPE_RULES)
    match = F.col("normal").rlike(rf"\A{V.shape(ENVELOPE_RULES)}\z")
    both = rows.where("normal is not null").select("normal", V.all_errors(F.col("normal"), ENVELOPE_RULES).alias("quick"), full.alias("full"), match.alias("match")).collect()
    assert all(r.quick == r.full and not (r.match and r.full) for r in both)
    assert sum(r.match for r in both) >= 10


def test_whatever_breaks_a_rule_is_suspect(spark):
    texts = [json.dumps({"a": s}) for s in SECRETS] + [json.dumps({k: "x"}) for k in KEYS] + ['{"a":"plain"}']
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(suspect(F.lower("t")).alias("s"), (F.size(V.document_hits(F.col("t"))) > 0).alias("h")).collect()
    assert [(r.s, r.h) for r in got] == [(True, True)] * (len(texts) - 1) + [(False, False)]
