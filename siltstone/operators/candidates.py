"""Candidate rules: joins of the reports, scores, states, and their regression fixtures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.canonical import identity

SCORE = "decimal(10,6)"
#: Target, weight of each capped part of the score; then the state limits.
TARGETS = {"recurrence": (10, "0.30"), "scope_breadth": (5, "0.20"), "effort": (120, "0.15")}
SUCCESS_WEIGHT, SAFETY_WEIGHT = "0.15", "0.20"
PROMOTED, COMPILED = 4, 3
CONTRACT_CLASSES = ("gate_outcome", "CI_failure_classification")


def with_rule_effectiveness(recurrence: DataFrame, effectiveness: DataFrame) -> DataFrame:
    """Each row's own rule's ratios; rows whose rule is null or has no report read the row of the null rule.

    The fallback is by row: a rule that has a report keeps its ratios even where they are null.
    """
    rows = effectiveness.select(F.col("canonical_rule_id").alias("rule"), "success_ratio", "false_positive_ratio")
    own = rows.where("rule is not null").withColumn("matched", F.lit(True))
    other = rows.where("rule is null").select(F.struct("success_ratio", "false_positive_ratio").alias("other")).limit(1)
    joined = recurrence.join(own, recurrence.canonical_rule_id == own.rule, "left").drop("rule")
    fallback = F.broadcast(other.withColumn("__one", F.lit(1)))  # one row
    joined = joined.withColumn("__one", F.lit(1)).join(fallback, "__one", "left").drop("__one")
    pick = lambda c: F.when(F.col("matched"), F.col(c)).otherwise(F.col(f"other.{c}"))
    return joined.withColumns({"success_ratio": pick("success_ratio"), "false_positive_ratio": pick("false_positive_ratio")}).drop("other", "matched")


def capped(value: Column, target: int) -> Column:
    """``value``'s share of ``target`` in fives, 0 to 5. It is capped before it is narrowed: a count may be any number."""
    part = F.coalesce(value.cast("decimal(20,6)"), F.lit(0)) * 5 / F.lit(target)
    return F.least(F.lit(5), F.greatest(F.lit(0), F.bround(part, 6))).cast(SCORE)


def score_parts() -> dict[str, Column]:
    """The parts of the score, in decimals, so that every engine rounds alike; unknown counts as 0."""
    of_five = lambda ratio: F.coalesce((F.bround(ratio.cast("decimal(20,12)") * 5, 6)).cast(SCORE), F.lit(0).cast(SCORE))
    return {
        "recurrence_score": capped(F.col("occurrence_count"), TARGETS["recurrence"][0]),
        "scope_score": capped(F.col("distinct_scope_count"), TARGETS["scope_breadth"][0]),
        "effort_score": capped(F.col("mean_effort_minutes"), TARGETS["effort"][0]),
        "success_score": of_five(F.col("success_ratio")),
        "safety_score": of_five(F.lit(1).cast("decimal(20,12)") - F.col("false_positive_ratio").cast("decimal(20,12)")),
    }


def candidates(recurrence: DataFrame, effectiveness: DataFrame, mean_effort: DataFrame) -> DataFrame:
    """Scored candidates: recurrence left-joined with the effectiveness of its rule and the effort of its class."""
    rows = with_rule_effectiveness(recurrence, effectiveness).join(mean_effort, "event_class", "left").withColumns(score_parts())
    weights = {"recurrence_score": TARGETS["recurrence"][1], "scope_score": TARGETS["scope_breadth"][1], "effort_score": TARGETS["effort"][1], "success_score": SUCCESS_WEIGHT, "safety_score": SAFETY_WEIGHT}
    total = sum((F.col(c) * F.lit(w).cast("decimal(3,2)") for c, w in weights.items()), F.lit(0).cast("decimal(20,8)"))
    total = F.least(F.lit(5).cast(SCORE), F.greatest(F.lit(0).cast(SCORE), F.bround(total, 6).cast(SCORE)))
    kind = F.when(F.col("event_class").isin(*CONTRACT_CLASSES), "sdk_architecture_contract").otherwise("ast_grep")
    rows = rows.withColumn("score", total).withColumn("candidate_kind", kind).withColumn("state", state(F.col("score")))
    return rows.withColumn("candidate_id", identity("candidate_", {"event_class": F.col("event_class"), "fingerprint": F.col("recurrence_fingerprint"), "kind": F.col("candidate_kind")}))


def state(score: Column) -> Column:
    return F.when(score >= PROMOTED, "promotion_eligible").when(score >= COMPILED, "compiled_candidate").otherwise("deferred")


def fixtures(compiled: DataFrame) -> DataFrame:
    """A positive and a negative example per candidate that isn't deferred: the negative one has another fingerprint."""
    both = F.array(
        F.struct(F.lit("positive").alias("case"), F.col("recurrence_fingerprint").alias("fingerprint"), F.lit(True).alias("expected_match")),
        F.struct(F.lit("negative").alias("case"), F.sha2(F.concat("recurrence_fingerprint", F.lit(":negative")), 256).alias("fingerprint"), F.lit(False).alias("expected_match")),
    )
    rows = compiled.where("state != 'deferred'").select("candidate_id", "event_class", F.explode(both).alias("f")).select("candidate_id", "event_class", "f.*")
    return rows.withColumn("fixture_id", F.concat("candidate_id", F.lit(":"), "case"))


def regression(compiled: DataFrame, cases: DataFrame) -> DataFrame:
    """Whether each candidate's match contract (class and fingerprint) gives the fixture's expected result."""
    rules = compiled.select("candidate_id", F.col("event_class").alias("rule_class"), "recurrence_fingerprint")
    matched = (F.col("rule_class") == F.col("event_class")) & (F.col("recurrence_fingerprint") == F.col("fingerprint"))
    return cases.join(rules, "candidate_id").select("fixture_id", "candidate_id", "case", "expected_match", matched.alias("matched"), (matched == F.col("expected_match")).alias("passed"))


def compile_summary(compiled: DataFrame, results: DataFrame) -> DataFrame:
    count = lambda s: F.count_if(F.col("state") == s)
    totals = compiled.agg(F.count(F.lit(1)).alias("candidates"), count("promotion_eligible").alias("promotion_eligible"), count("compiled_candidate").alias("compiled_candidate"), count("deferred").alias("deferred"))
    checks = results.agg(F.count_if("passed").alias("fixtures_passed"), F.count_if(~F.col("passed")).alias("fixtures_failed"))
    return totals.withColumn("__one", F.lit(1)).join(checks.withColumn("__one", F.lit(1)), "__one").drop("__one")


def emitted_rules(compiled: DataFrame) -> DataFrame:
    """The artifact that each promoted candidate becomes: its rule name, kind, severity and the file it goes to."""
    rule = F.concat(F.lit("debt."), F.substring(F.replace("candidate_id", F.lit("candidate_")), 1, 32))
    kind = F.col("candidate_kind")
    return compiled.where("state = 'promotion_eligible'").select(
        "candidate_id", rule.alias("rule_id"), kind.alias("kind"),
        F.when(kind == "ast_grep", "warning").otherwise("error").alias("severity"),
        F.concat(F.when(kind == "ast_grep", "rules/").otherwise("contracts/"), "candidate_id", F.when(kind == "ast_grep", ".yml").otherwise(".json")).alias("path"),
    )
