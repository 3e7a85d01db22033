import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators import envelope, ingest

GOOD = {"schema_version": "corpus-event/v1", "producer_id": "sdk", "producer_contract": "finding-bundle/v1", "sdk_contract": "sdk/v1", "event_id": "e1", "event_class": "static_finding", "event_time": "2024-01-02T03:04:05Z", "snapshot_or_run_id": "run-1", "redaction_status": "producer_redacted", "limitations": [], "payload": {"k": 1}}


def deliveries(spark, documents):
    return spark.createDataFrame([(k, d if isinstance(d, (str, type(None))) else json.dumps(d)) for k, d in enumerate(documents)], "delivery long, document string")


def test_every_error_with_its_path(spark):
    bad = [
        GOOD,
        GOOD | {"event_id": " x", "limitations": ["", 3], "colour": "red"},
        {k: v for k, v in GOOD.items() if k not in ("payload", "limitations")},
        GOOD | {"unknowns": [{"field": "f", "reason": "redacted"}, {"reason": "why", "more": 1}, "text"]},
        GOOD | {"lineage": {"parent_event_ids": ["a", ""]}, "payload": [1], "event_time": "2024-13-01T00:00:00Z", "sdk_contract": 4},
        "[1]", "nope", None, '{"a":1,"a":2}', json.dumps(GOOD | {"payload": {"x": 1.5}}),
        GOOD | {"producer_id": "p" * 256, "schema_version": None, "event_class": "weather", "snapshot_or_run_id": ""},
    ]
    rows = envelope.validation_errors(deliveries(spark, bad)).collect()
    got = {k: sorted((r.path, r.message.split(" ")[0] + " " + r.message.split(" ")[1]) for r in rows if r.delivery == k) for k in range(len(bad))}
    assert got == {
        0: [], 2: [("payload", "is missing")],
        1: [("", "has unknown"), ("event_id", "does not"), ("limitations/0", "is shorter"), ("limitations/1", "is not")],
        3: [("unknowns/0", "is not"), ("unknowns/1", "has unknown"), ("unknowns/1/field", "is missing"), ("unknowns/1/reason", "is none")],
        4: [("event_time", "does not"), ("lineage/parent_event_ids/0", "is shorter"), ("lineage/producer_event_hash", "is missing"), ("payload", "is not"), ("sdk_contract", "is not")],
        5: [("", "is malformed")], 6: [("", "is malformed")], 7: [("", "is malformed")], 8: [("", "is malformed")], 9: [("", "is malformed")],
        10: [("event_class", "is none"), ("producer_id", "is longer"), ("schema_version", "is none"), ("snapshot_or_run_id", "is shorter")],
    }


def test_one_normal_form_for_all_spellings(spark):
    one = GOOD | {"limitations": ["b", "a", "b"], "payload": {"caf\u00e9": "\u00fc", "z": [2, 1]}, "unknowns": [{"field": "z", "reason": "redacted"}, {"field": "a", "reason": "redacted"}], "lineage": {"producer_event_hash": "0" * 64, "parent_event_ids": ["q", "p", "q"]}}
    two = dict(reversed((one | {"limitations": ["a", "b"], "payload": {"z": [2, 1], "cafe\u0301": "u\u0308"}, "unknowns": one["unknowns"][::-1], "lineage": {"parent_event_ids": ["p", "q"], "producer_event_hash": "0" * 64}}).items()))
    rows = envelope.opened(deliveries(spark, [one, two, GOOD | {"payload": {"caf\u00e9": 1, "cafe\u0301": 2}}])).orderBy("delivery").collect()
    assert rows[0].event_hash == rows[1].event_hash and rows[0].payload_hash == rows[1].payload_hash
    assert rows[0].payload == '{"caf\u00e9":"\u00fc","z":[2,1]}' and rows[2].payload is None


@pytest.mark.parametrize("payload", [{"password": "hunter2"}, {"a": [{"Api_Key": "x"}]}, {"a": {"b": ["see\n/home/me/x"]}}, {"x": "a \"quoted\" Bearer\tabcdefghijklmnop"}, {"x": "f" * 40}, {"x": "C:\\temp\\y"}])
def test_secrets_anywhere_in_a_payload(spark, payload):
    row = envelope.dispositions(deliveries(spark, [GOOD | {"payload": payload}]), ingest.registry(spark)).first()
    assert (row.disposition, row.reason) == ("quarantined", "sensitive_content")


def test_the_order_of_the_cascade(spark):
    rows = [
        GOOD, GOOD | {"event_id": "e2"}, GOOD | {"payload": {"tokens": 1}}, GOOD | {"redaction_status": "quarantine_required", "payload": {"secret": 1}}, GOOD | {"producer_id": "nobody", "redaction_status": "quarantine_required"},
        GOOD | {"event_class": "weather", "producer_id": "nobody"}, "{", GOOD | {"snapshot_or_run_id": "a" * 40}, GOOD | {"limitations": ["see /tmp/x"]}, GOOD | {"payload": {"value": "a word for password is fine", "k": "x" * 20_000}},
        GOOD | {"payload": {"stored": True}}, GOOD | {"payload": {"other": True}},
    ]
    known = ingest.registry(spark)
    docs = deliveries(spark, rows)
    ids = {r.delivery: (r.record_id, r.payload_hash) for r in envelope.judged(docs, known).collect()}
    stored = spark.createDataFrame([ids[10], (ids[11][0], "another")], "record_id string, payload_hash string")
    got = {r.delivery: (r.disposition, r.reason) for r in envelope.dispositions(docs, known, stored).collect()}
    assert got == {
        0: ("accepted", None), 1: ("duplicate", None), 2: ("quarantined", "sensitive_content"), 3: ("quarantined", "redaction_required"), 4: ("quarantined", "unknown_producer"), 5: ("quarantined", "invalid_schema"),
        6: ("quarantined", "malformed_event"), 7: ("quarantined", "sensitive_content"), 8: ("quarantined", "sensitive_content"), 9: ("accepted", None), 10: ("duplicate", None), 11: ("quarantined", "fingerprint_collision"),
    }


def test_repeats_nulls_and_several_contracts(spark):
    known = ingest.registry(spark, [("p", "c/v1", "s/v1", "active", "static_finding"), ("p", "c/v2", "s/v2", "active", "static_finding")])
    docs = [GOOD | {"producer_id": "p", "producer_contract": "c/v2", "sdk_contract": "s/v2"}] * 2 + [GOOD | {"producer_id": None}, None]
    rows = deliveries(spark, docs).withColumn("delivery", F.when(F.col("delivery") < 2, 7).otherwise(F.col("delivery")))
    got = sorted((r.delivery, r.disposition, r.reason or "") for r in envelope.dispositions(rows, known).collect())
    assert got == [(2, "quarantined", "invalid_schema"), (3, "quarantined", "malformed_event"), (7, "accepted", ""), (7, "duplicate", "")]
    assert envelope.dispositions(rows.limit(0), known).count() == 0


def test_projections_of_what_is_missing(spark):
    cases = [
        ("sdk", {"bundle": {"findings": [{"canonical_rule_id": "r", "locations": [3, {"normalized_path": "path_1"}]}, {"finding_id": "f"}, "no object", {}]}, "repository_pseudonym": "repo"}, "finding-bundle/v1"),
        ("none", {}, "finding-bundle/v1"), ("res", {"failure": {"fingerprint": "x"}, "validation": {"result": "odd", "duration_bucket": "short"}}, "resolver-feedback/v1"),
        ("hist", {"failure": {"semantic_failure_identity": "x", "identity_authority": "canonical"}, "validation": {"outcome": "clean_verified"}}, "historical-resolution/v1"),
        ("flake", {"historical_evidence": {"suspected_flake": True}, "failure": [], "validation": {"outcome": 3}}, "historical-resolution/v1"), ("else", {"repository_pseudonym": ""}, "gate/v1"),
    ]
    events = spark.createDataFrame([(r, "p", "static_finding", c, json.dumps(p)) for r, p, c in cases], "record_id string, producer_id string, event_class string, producer_contract string, payload string")
    rows = envelope.observations(events).collect()
    by = {r.record_id: r for r in rows}
    assert sorted(r.record_id for r in rows) == ["else", "flake", "hist", "res", "sdk", "sdk", "sdk"]
    assert {(r.canonical_rule_id, r.component, r.occurrence_scope) for r in rows if r.record_id == "sdk"} == {("r", "path_1", "repo"), (None, None, "repo")}
    assert by["res"].recurrence_fingerprint == by["hist"].recurrence_fingerprint and by["res"].validation_outcome == "unknown"
    assert by["res"].limitations == ["scope is record-local: no repository", "result unknown: odd", "effort is a bucket"]
    assert (by["hist"].canonical_rule_id, by["hist"].false_positive_disposition, by["flake"].false_positive_disposition, by["flake"].validation_outcome) == ("x", "confirmed_true_positive", "inconclusive", None)
    assert by["else"].limitations == ["scope is record-local: no repository", "no projection for gate/v1"] and by["else"].occurrence_scope == "record:else"
