"""Outcome metrics per rule and pack, recommendations, and drift between two reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.canonical import ratio
from siltstone.schemas import OUTCOME_FAMILIES, SURFACE_OUTCOMES

#: Samples and thresholds of the recommendations and of drift.
LEAST_RULE, LEAST_PACK = 20, 100
P95 = "cast(percentile_disc(0.95) within group (order by {}) as bigint)"


def valid_for_surface(surface: Column, outcome: Column) -> Column:
    """Whether the surface may report the outcome."""
    allowed = F.lit(False)
    for name, outcomes in SURFACE_OUTCOMES.items():
        allowed = F.when(surface == name, outcome.isin(*outcomes)).otherwise(allowed)
    return F.coalesce(allowed, F.lit(False))


def rule_metrics(outcomes: DataFrame, *keys: str) -> DataFrame:
    """14 counts, 5 ratios and the nearest-rank p95 latency per rule (and ``keys``); ratios of nothing are null."""
    kind = F.col("outcome_class")
    family = lambda name: F.count_if(kind.isin(*OUTCOME_FAMILIES[name]))
    rows = outcomes.groupBy(*keys, "canonical_rule_id").agg(
        F.count(F.lit(1)).alias("evaluation_count"),
        family("unknown").alias("unknown_outcome_count"),
        family("prevention").alias("prevention_count"),
        family("detection").alias("detection_count"),
        family("escape").alias("escape_count"),
        family("false_positive").alias("false_positive_count"),
        F.count_if(kind == "diagnostic_accepted").alias("accepted_diagnostic_count"),
        F.count_if(kind == "diagnostic_dismissed").alias("dismissed_diagnostic_count"),
        F.count_if(kind == "quick_fix_applied").alias("quick_fix_applied_count"),
        F.count_if(kind == "quick_fix_reverted").alias("quick_fix_reverted_count"),
        family("repair_success").alias("repair_success_count"),
        family("repair_failure").alias("repair_failure_count"),
        F.expr(P95.format("latency_ms")).alias("p95_latency_ms"),
    )
    c = F.col
    seen = c("prevention_count") + c("detection_count") + c("escape_count")
    return rows.select(
        "*",
        (c("evaluation_count") - c("unknown_outcome_count")).alias("known_outcome_count"),
        ratio(c("prevention_count"), seen).alias("prevention_ratio"),
        ratio(c("escape_count"), seen).alias("escape_ratio"),
        ratio(c("false_positive_count"), c("accepted_diagnostic_count") + c("dismissed_diagnostic_count") + c("false_positive_count")).alias("false_positive_ratio"),
        ratio(c("quick_fix_reverted_count"), c("quick_fix_applied_count") + c("quick_fix_reverted_count")).alias("quick_fix_revert_ratio"),
        ratio(c("repair_success_count"), c("repair_success_count") + c("repair_failure_count")).alias("repair_success_ratio"),
    )


def pack_metrics(rules: DataFrame, *keys: str, active_rules: int = 60) -> DataFrame:
    """Second-level aggregates over rule rows: weighted ratios, and the p95 of the rules' p95s."""
    s = F.sum
    seen = s("prevention_count") + s("detection_count") + s("escape_count")
    return rules.groupBy(*keys).agg(
        F.lit(active_rules).cast("bigint").alias("active_rule_count"),
        F.count(F.lit(1)).alias("observed_rule_count"),
        s("evaluation_count").alias("evaluation_count"),
        ratio(s("prevention_count"), seen).alias("prevention_ratio"),
        ratio(s("escape_count"), seen).alias("escape_ratio"),
        ratio(s("false_positive_count"), s("accepted_diagnostic_count") + s("dismissed_diagnostic_count") + s("false_positive_count")).alias("false_positive_ratio"),
        ratio(s("unknown_outcome_count"), s("evaluation_count")).alias("unknown_ratio"),
        F.expr(P95.format("p95_latency_ms")).alias("p95_latency_ms"),
        ratio(F.count(F.lit(1)), F.lit(active_rules)).alias("coverage_ratio"),
    )


def rule_state() -> Column:
    """The first threshold that is passed decides; a null ratio passes none."""
    fp, escape, revert, p95 = (F.col(c) for c in ("false_positive_ratio", "escape_ratio", "quick_fix_revert_ratio", "p95_latency_ms"))
    at_least = lambda c, x: F.coalesce(c >= x, F.lit(False))
    return (
        F.when(F.col("evaluation_count") < LEAST_RULE, "insufficient_evidence")
        .when(at_least(fp, 0.20), "retirement_recommended")
        .when(at_least(fp, 0.10) | at_least(escape, 0.20) | at_least(revert, 0.25), "rollback_recommended")
        .when(at_least(fp, 0.05) | at_least(escape, 0.10) | at_least(revert, 0.10) | F.coalesce(p95 > 200, F.lit(False)), "investigate")
        .otherwise("retain")
    )


def rule_recommendations(rules: DataFrame, *keys: str) -> DataFrame:
    return rules.select(*keys, "canonical_rule_id", "evaluation_count", "false_positive_ratio", "escape_ratio", "quick_fix_revert_ratio", "p95_latency_ms", rule_state().alias("state"))


def pack_recommendations(packs: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """One state per pack from its sample, its rules' states and its share of unknown outcomes."""
    has = lambda *states: F.bool_or(F.col("state").isin(*states))
    states = rules.groupBy(key).agg(has("retirement_recommended", "rollback_recommended").alias("bad"), has("investigate").alias("odd"))
    state = (
        F.when(F.col("evaluation_count") < LEAST_PACK, "insufficient_evidence")
        .when(F.col("bad"), "rollback_recommended")
        .when(F.col("odd") | (F.col("unknown_ratio") >= 0.25), "investigate")
        .otherwise("retain")
    )
    return packs.join(states, key, "left").select(key, "evaluation_count", "unknown_ratio", state.alias("state"))


METRICS = ("prevention_ratio", "escape_ratio", "false_positive_ratio", "unknown_ratio", "coverage_ratio", "p95_latency_ms")


def deltas(packs: DataFrame, key: str, period: str) -> DataFrame:
    """Per pack and metric: baseline, current, and their rounded differences; null where a side is null."""
    long = packs.select(key, period, *(F.col(m).cast("double").alias(m) for m in METRICS)).unpivot([key, period], list(METRICS), "metric", "value")
    side = lambda p: long.where(F.col(period) == p).select(key, "metric", F.col("value").alias(p))
    both = side("baseline").join(side("current"), [key, "metric"], "full_outer")
    step = F.round(F.col("current") - F.col("baseline"), 12)
    return both.select(key, "metric", "baseline", "current", step.alias("absolute_delta"), F.when(F.col("baseline") != 0, F.round((F.col("current") - F.col("baseline")) / F.col("baseline"), 12)).alias("relative_delta"))


def drift(packs: DataFrame, key: str, period: str) -> DataFrame:
    """The state of each pack's change; thresholds use the rounded differences, and a side without rows gives no evidence."""
    wide = deltas(packs, key, period).groupBy(key).pivot("metric", ["prevention_ratio", "escape_ratio", "false_positive_ratio", "p95_latency_ms"]).agg(F.first("absolute_delta"))
    sizes = packs.groupBy(key).agg(F.sum(F.when(F.col(period) == "baseline", F.col("evaluation_count")).otherwise(0)).alias("n_baseline"), F.sum(F.when(F.col(period) == "current", F.col("evaluation_count")).otherwise(0)).alias("n_current"))
    rows = sizes.join(wide, key, "left")
    at_least = lambda c, x: F.coalesce(F.col(c) >= x, F.lit(False))
    state = (
        F.when((F.col("n_baseline") == 0) | (F.col("n_current") == 0), "insufficient_evidence")
        .when(at_least("false_positive_ratio", 0.10) | at_least("escape_ratio", 0.15) | at_least("p95_latency_ms", 800), "critical_regression")
        .when(at_least("false_positive_ratio", 0.03) | at_least("escape_ratio", 0.05) | at_least("p95_latency_ms", 100), "degraded")
        .when(at_least("prevention_ratio", 0.05), "improved")
        .otherwise("stable")
    )
    return rows.select(key, "n_baseline", "n_current", state.alias("state"))


def outcome_ingest(rows: DataFrame) -> DataFrame:
    """Outcomes by identity: the first delivery is accepted, equal ones are duplicates, and a differing document
    under the same identity is a conflict, reported as a row. Of repeated rows of the first delivery one is accepted."""
    first = rows.groupBy("outcome_id").agg(F.min(F.struct("delivery", "document_hash")).alias("first"))
    again = F.row_number().over(Window.partitionBy("outcome_id", "delivery", "document_hash").orderBy("delivery"))
    it = F.struct("delivery", "document_hash").eqNullSafe(F.col("first"))
    status = F.when(it & (F.col("again") == 1), "accepted").when(F.col("document_hash").eqNullSafe(F.col("first.document_hash")), "duplicate").otherwise("conflict")
    return rows.withColumn("again", again).join(first, "outcome_id").select("outcome_id", "delivery", status.alias("status"))
