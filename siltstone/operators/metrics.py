"""Recurrence, co-occurrence, effort and rule effectiveness over learning observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.canonical import namespaced, ratio


def with_fallbacks(stored: DataFrame) -> DataFrame:
    """Observations as they are read: a record without scope is its own scope, a key that isn't 64 characters
    long falls back to class and payload, efforts below zero are unknown."""
    scope = F.when(F.trim("stored_scope") != "", F.col("stored_scope"))
    key = F.when(F.length("stored_key") == 64, F.col("stored_key")).otherwise(F.sha2(F.concat("event_class", F.char(F.lit(0)), "payload_hash"), 256))
    effort = F.when(F.col("stored_effort") >= 0, F.col("stored_effort"))
    return stored.select(
        "record_id", "producer_id", "event_class", "producer_contract",
        F.coalesce(scope, F.concat(F.lit("record:"), "record_id")).alias("occurrence_scope"), key.alias("recurrence_fingerprint"),
        "canonical_rule_id", "remediation_class", effort.alias("effort_minutes"), "validation_outcome", "false_positive_disposition",
    )


def unanimous(value: Column) -> Column:
    """Aggregate: the value that all rows share. Null is a value, so null beside another is no agreement."""
    return F.when((F.count(value) == F.count(F.lit(1))) & (F.min(value) == F.max(value)), F.min(value))


def recurrence(obs: DataFrame) -> DataFrame:
    """Counts by fingerprint and class. Least and greatest texts are found by sorting, so rows that say the same are counted
    first, by hash; only one row of each goes on."""
    key = ["recurrence_fingerprint", "event_class"]
    same = obs.groupBy(*key, "canonical_rule_id", "occurrence_scope", "producer_id").agg(F.count(F.lit(1)).alias("n"))
    return same.groupBy(*key).agg(
        unanimous(F.col("canonical_rule_id")).alias("canonical_rule_id"),
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("occurrence_count"),
        F.count_distinct("occurrence_scope").alias("distinct_scope_count"),
        F.count_distinct("producer_id").alias("distinct_producer_count"),
        F.min("occurrence_scope").alias("first_scope"),  # by text, not by time
        F.max("occurrence_scope").alias("last_scope"),
    )


def cooccurrence(obs: DataFrame, places: int = 12) -> DataFrame:
    """Pairs of fingerprints that share scopes, with the Jaccard ratio of their scope sets to ``places``.

    Scopes with a single fingerprint can't form a pair and leave before the self-join, fallback scopes of
    single records among them; a very large scope is split by Spark's skew handling.
    """
    marks = obs.select("occurrence_scope", F.col("recurrence_fingerprint").alias("fp")).distinct()
    counts = marks.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    shared = marks.groupBy("occurrence_scope").count().where("count > 1").select("occurrence_scope")
    marks = marks.join(shared, "occurrence_scope", "left_semi")
    left, right = marks.withColumnRenamed("fp", "left_fingerprint"), marks.withColumnRenamed("fp", "right_fingerprint")
    pairs = left.join(right, "occurrence_scope").where("left_fingerprint < right_fingerprint")
    pairs = pairs.groupBy("left_fingerprint", "right_fingerprint").agg(F.count(F.lit(1)).alias("shared_scope_count"))
    for side in ("left", "right"):
        pairs = pairs.join(counts.select(F.col("fp").alias(f"{side}_fingerprint"), F.col("n").alias(f"{side}_scope_count")), f"{side}_fingerprint")
    whole = F.col("left_scope_count") + F.col("right_scope_count") - F.col("shared_scope_count")
    return pairs.select("left_fingerprint", "right_fingerprint", "shared_scope_count", "left_scope_count", "right_scope_count", ratio(F.col("shared_scope_count"), whole, places).alias("jaccard_ratio"))


def effort_atlas(obs: DataFrame) -> DataFrame:
    """Known and unknown efforts by class and remediation (null is a group); statistics over known ones only."""
    e = F.col("effort_minutes")
    return obs.groupBy("event_class", "remediation_class").agg(
        F.count(e).alias("known_observation_count"),
        F.count_if(e.isNull()).alias("unknown_observation_count"),
        F.sum(e).alias("total_minutes"),
        F.round(F.avg(e), 12).alias("mean_minutes"),
        F.median(e).alias("median_minutes"),
        F.expr("percentile_disc(0.95) within group (order by effort_minutes)").cast("double").alias("p95_minutes"),
    )


def rule_effectiveness(obs: DataFrame) -> DataFrame:
    """Dispositions and validation outcomes per rule; rows without a rule are a group of their own."""
    d, v = F.col("false_positive_disposition"), F.col("validation_outcome")
    named = {"confirmed_false_positive_count": d == "confirmed_false_positive", "confirmed_true_positive_count": d == "confirmed_true_positive", "inconclusive_count": d == "inconclusive", "successful_count": v == "passed", "failed_count": v == "failed", "partial_count": v == "partial"}
    counted = obs.groupBy("canonical_rule_id").agg(F.count(F.lit(1)).alias("attempt_count"), *(F.count_if(c).alias(n) for n, c in named.items()))
    fp, tp, known = F.col("confirmed_false_positive_count"), F.col("confirmed_true_positive_count"), F.col("successful_count") + F.col("failed_count") + F.col("partial_count")
    return counted.select(
        "*",
        (F.col("attempt_count") - fp - tp - F.col("inconclusive_count")).alias("unknown_count"),
        (F.col("attempt_count") - known).alias("validation_unknown_count"),
        ratio(fp, fp + tp).alias("false_positive_ratio"),
        ratio(F.col("successful_count"), known).alias("success_ratio"),
    )


def mean_effort_by_class(atlas: DataFrame) -> DataFrame:
    """The unweighted mean of the groups' means; groups without known efforts don't count."""
    return atlas.where("mean_minutes is not null").groupBy("event_class").agg(F.bround(F.avg("mean_minutes"), 6).alias("mean_effort_minutes"))


def limitation_flags(obs: DataFrame) -> DataFrame:
    return obs.agg(
        F.coalesce(F.bool_or(F.col("occurrence_scope").startswith("record:")), F.lit(False)).alias("record_local_scope"),
        F.coalesce(F.bool_or(F.col("canonical_rule_id").isNull()), F.lit(False)).alias("rule_unknown"),
        F.coalesce(F.bool_or(F.col("effort_minutes").isNull()), F.lit(False)).alias("effort_unknown"),
    )


def rule_key(rule: Column, instance: Column) -> Column:
    """The recurrence key of a finding: its rule if it has one, else the producer's own fingerprint."""
    return F.when(rule.isNotNull() & (rule != ""), namespaced("rule", rule)).otherwise(namespaced("producer-fingerprint", instance))
