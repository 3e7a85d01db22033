"""Schemas and closed domains of the data model. Nothing is ever inferred from data."""

from __future__ import annotations

# The closed domains of the event contract.
EVENT_CLASSES = ("static_finding", "CI_failure_classification", "repair_attempt", "verification_outcome", "editor_diagnostic_outcome", "false_positive_disposition", "gate_outcome")
REDACTION_STATES = ("producer_redacted", "intelligence_redacted", "quarantine_required")
VALIDATION_OUTCOMES = ("passed", "failed", "partial", "unknown")
DISPOSITIONS = ("confirmed_false_positive", "confirmed_true_positive", "inconclusive")
EXCLUDED_LIFECYCLE = ("RETRACTED", "REJECTED", "QUARANTINED")
CHANNELS = ("experimental", "shadow", "stable")
POLICY_MODES = ("blocking", "advisory", "shadow", "disabled")
# Which outcomes each surface may report, and the families that the metrics count.
SURFACE_OUTCOMES = {
    "CI": ("prevented_before_merge", "detected_in_CI", "escaped_detection", "rule_not_evaluated", "evaluation_incomplete"),
    "LSP": ("diagnostic_shown", "diagnostic_accepted", "diagnostic_dismissed", "confirmed_false_positive", "quick_fix_applied", "quick_fix_reverted", "rule_not_evaluated", "evaluation_incomplete"),
    "repair": ("repair_succeeded", "repair_failed", "repair_partial", "repair_rolled_back", "outcome_unknown"),
}
OUTCOME_FAMILIES = {
    "unknown": ("rule_not_evaluated", "evaluation_incomplete", "outcome_unknown"),
    "prevention": ("prevented_before_merge", "diagnostic_accepted"),
    "detection": ("detected_in_CI", "diagnostic_shown"),
    "escape": ("escaped_detection",),
    "false_positive": ("confirmed_false_positive",),
    "repair_success": ("repair_succeeded",),
    "repair_failure": ("repair_failed", "repair_rolled_back"),
}
# The compatibility registry (producer, contract, SDK contract, status, event class it may send).
REGISTRY = (
    ("sdk", "finding-bundle/v1", "sdk/v1", "active", "static_finding"),
    ("resolver", "resolver-feedback/v1", None, "active", "repair_attempt"),
    ("historical", "historical-resolution/v1", None, "active", "verification_outcome"),
    ("gate", "gate-outcome/v1", "sdk/v1", "planned", "gate_outcome"),
    ("editor", "editor-outcome/v1", "sdk/v1", "planned", "editor_diagnostic_outcome"),
    ("triage", "disposition/v1", None, "planned", "false_positive_disposition"),
)

# What an event document must be like.
ENVELOPE_RULES = {
    "type": "object",
    "additionalProperties": False,
    "required": ["schema_version", "producer_id", "producer_contract", "event_id", "event_class", "event_time", "snapshot_or_run_id", "redaction_status", "limitations", "payload"],
    "properties": {
        "schema_version": {"const": "corpus-event/v1"},
        "producer_id": {"type": "string", "minLength": 1, "maxLength": 255},
        "producer_contract": {"type": "string", "minLength": 1, "maxLength": 255},
        "sdk_contract": {"type": ["string", "null"]},
        "event_id": {"type": "string", "pattern": "^[A-Za-z0-9][A-Za-z0-9._:-]{0,255}$"},
        "event_class": {"enum": list(EVENT_CLASSES)},
        "event_time": {"type": "string", "pattern": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])[Tt]([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$"},
        "snapshot_or_run_id": {"type": "string", "minLength": 1, "maxLength": 512},
        "redaction_status": {"enum": list(REDACTION_STATES)},
        "limitations": {"type": "array", "items": {"type": "string", "minLength": 1}, "uniqueItems": True},
        "unknowns": {
            "type": "array",
            "items": {
                "type": "object",
                "additionalProperties": False,
                "required": ["field", "reason"],
                "properties": {"field": {"type": "string", "minLength": 1}, "reason": {"enum": ["not_observed", "not_applicable", "producer_did_not_emit", "redacted", "incompatible_version", "unavailable"]}},
            },
        },
        "lineage": {
            "type": "object",
            "additionalProperties": False,
            "required": ["producer_event_hash"],
            "properties": {"producer_event_hash": {"type": "string", "pattern": "^[0-9a-f]{64}$"}, "parent_event_ids": {"type": "array", "items": {"type": "string", "minLength": 1}, "uniqueItems": True}},
        },
        "payload": {"type": "object"},
    },
}

# Columns and documents of the data model.
LEARNING_COLUMNS = ("occurrence_scope", "recurrence_fingerprint", "canonical_rule_id", "repository_identity", "component", "remediation_class", "effort_minutes", "validation_outcome", "false_positive_disposition", "pack_version")
RECORD_COLUMNS = ("record_id", "source_event_id", "producer_id", "event_class", "lifecycle_state", "redaction_status", "producer_contract", "payload_content_hash", "limitations_json", "superseded_by", "source_record_hash")

ENVELOPE = """
schema_version string, producer_id string, producer_contract string, sdk_contract string, event_id string, event_class string,
event_time string, snapshot_or_run_id string, redaction_status string, limitations array<string>,
unknowns array<struct<field: string, reason: string>>, lineage struct<producer_event_hash: string, parent_event_ids: array<string>>,
payload string"""

FINDING_BUNDLE = """
schema string, SDK_version string, generated_at string,
snapshot struct<snapshot_id: string, revision: string, repository_root: string>,
findings array<struct<finding_id: string, canonical_rule_id: string, fingerprint: string, category: string, severity: string,
  confidence: string, message: string, provider_id: string, provider_rule_id: string, snapshot_id: string, evidence_ids: array<string>,
  limitations: array<string>,
  locations: array<struct<normalized_path: string, start_line: bigint, end_line: bigint, start_column: bigint, end_column: bigint>>>>,
summary struct<finding_count: bigint, evidence_count: bigint, provider_count: bigint>, limitations array<string>"""

RESOLVER_FEEDBACK = """
event_id string, repository_pseudonym string, resolver_version string, occurred_at string,
failure struct<fingerprint: string, category: string, attempt_number: int, confidence_bucket: string, repeated: boolean>,
resolution struct<terminal_state: string, remediation_class: string, changed_file_count: int>,
validation struct<result: string, duration_bucket: string, step_count: int>, limitations array<string>"""

HISTORICAL_EVENT = """
event_id string, episode_id string, observation_kind string, occurred_at string, repository_identity string,
failure struct<semantic_failure_identity: string, identity_authority: string, occurrence_identities: array<string>>,
intervention struct<before_revision: string, after_revision: string, change_fingerprint: string, remediation_class: string>,
validation struct<outcome: string, equivalent_validation: boolean, validation_completeness_percent: int>,
historical_evidence struct<grade: string, attribution_strength: string, suspected_flake: boolean>, limitations array<string>"""

OBSERVATION = """
record_id string, producer_id string, event_class string, producer_contract string, occurrence_scope string, recurrence_fingerprint string,
canonical_rule_id string, repository_identity string, component string, remediation_class string, effort_minutes bigint,
validation_outcome string, false_positive_disposition string, pack_version string"""

OUTCOME = """
event_id string, producer_id string, pack_id string, pack_version string, canonical_rule_id string, surface string, outcome_class string,
observation_scope string, observed_at string, policy_mode string, latency_ms bigint, effort_minutes bigint"""
