"""What analytics, compilation and effectiveness put out, as rows with manifests, and checks that return every fault.

A report is its rows, never one document: its digest is the root of a hash tree over them, so a manifest line covers a
report of any size. Checks take the tables of many runs at once and return one row per fault, none if all is intact.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from siltstone.functions.canonical import sha
from siltstone.operators import metrics
from siltstone.operators.artifacts import json_of
from siltstone.operators.ordered import grouped_digest, tree_digest
from siltstone.session import cut, written

#: The reports of an analysis, and what is said of observations that lack something.
REPORTS = ("cooccurrence", "effectiveness", "effort", "recurrence")
LIMITATIONS = {
    "record_local_scope": "occurrence_scope unavailable for some records; record identity was used as a non-cooccurring fallback",
    "rule_unknown": "canonical_rule_id unavailable for some records",
    "effort_unknown": "effort_minutes unavailable for some records",
}
#: What the reports read of an observation.
READ = ("producer_id", "event_class", "occurrence_scope", "recurrence_fingerprint", "canonical_rule_id", "remediation_class", "effort_minutes", "validation_outcome", "false_positive_disposition")
EMPTY = hashlib.sha256(b"").hexdigest()
PLACES = 9  #: Of numbers with a point in texts that are hashed.


def row_text(df: DataFrame) -> Column:
    """A row as JSON, columns by name, nulls kept; numbers with a point as texts of nine places, which engines print alike."""
    point = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    return json_of(**{c: F.when(F.col(c).isNotNull(), F.format_string(f"%.{PLACES}f", F.round(F.col(c).cast("double"), PLACES))) if c in point else F.col(c) for c in df.columns})


def report_rows(reports: dict[str, DataFrame]) -> DataFrame:
    """(name, row) of all reports."""
    out = None
    for name, df in sorted(reports.items()):
        part = df.select(F.lit(name).alias("name"), row_text(df).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


def hashes_of(manifest: DataFrame, *keys: str) -> DataFrame:
    """(keys, hashes): the names and digests of a run's reports in one text. For reports, of which a run has a few."""
    return manifest.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "name", "digest"))), "\n").alias("hashes"))


def analysis_id() -> Column:
    return F.concat(F.lit("ar_"), sha(json_of(source_snapshot_id=F.col("source_snapshot_id"), contract=F.lit("analytics-contract/v1"), report_hashes=F.col("hashes"))))


def analysis_hash() -> Column:
    return sha(json_of(**{c: F.col(c) for c in ("run_id", "source_snapshot_id", "observation_count", "limitations")}, report_hashes=F.col("hashes")))


def observed(obs: DataFrame) -> DataFrame:
    """The columns of observations that reports read, written once; each report reads its own of them again."""
    return written(obs.select(*READ))


def analysis(obs: DataFrame, snapshot_id: str, is_written: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The four reports of the observations: rows (run_id, name, row), a manifest (run_id, name, source_snapshot_id,
    row_count, digest), and the run (run_id, source_snapshot_id, observation_count, limitations, output_hash).

    The run's identity covers the snapshot and all digests, so the same observations in any order are the same run. A
    report without rows has the digest of the empty text. Of several analyses of one table, ``observed`` writes it once for all
    (``is_written``).
    """
    obs, spark = obs if is_written else observed(obs), obs.sparkSession
    # A ratio is rounded once, to the places of its text: by way of 12 places 40/20010 would end in a 1 instead of a 0.
    rows = cut(report_rows({"recurrence": metrics.recurrence(obs), "cooccurrence": metrics.cooccurrence(obs, PLACES), "effort": metrics.effort_atlas(obs), "effectiveness": metrics.rule_effectiveness(obs)}))
    names = spark.range(1).select(F.explode(F.array(*map(F.lit, REPORTS))).alias("name"))
    manifest = names.join(grouped_digest(rows, ["name"], "row"), "name", "left")
    manifest = manifest.select(F.lit(snapshot_id).alias("source_snapshot_id"), "name", F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"), F.coalesce("digest", F.lit(EMPTY)).alias("digest"))
    flags = metrics.limitation_flags(obs).select(F.array_sort(F.array_compact(F.array(*(F.when(F.col(k), text) for k, text in LIMITATIONS.items())))).alias("limitations"))
    count = obs.agg(F.count(F.lit(1)).alias("observation_count"))
    run = hashes_of(manifest, "source_snapshot_id")
    for part in (flags, count):  # one row each
        run = run.withColumn("__one", F.lit(1)).join(part.withColumn("__one", F.lit(1)), "__one").drop("__one")
    run = cut(run.withColumn("run_id", analysis_id()).withColumn("output_hash", analysis_hash()).select("run_id", "source_snapshot_id", "observation_count", "limitations", "output_hash"))
    run_id = F.lit(run.first()["run_id"]).alias("run_id")
    return rows.select(run_id, "*"), manifest.select(run_id, "*"), run


def faults(rows: DataFrame, keys: list[str], **found: Column) -> DataFrame:
    """(keys, fault) for each named condition that holds for a row; unknown is no fault."""
    named = [F.when(F.coalesce(c, F.lit(False)), F.lit(text.replace("_", " "))) for text, c in found.items()]
    return rows.select(*keys, F.explode(F.array_compact(F.array(*named))).alias("fault"))


def verify_analytics(rows: DataFrame, manifest: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, name, fault) of runs as ``analysis`` makes them: a report or a run missing, other rows than the manifest's
    digest or count, another snapshot than the run's, an identity or output hash that doesn't follow from the manifest.
    ``name`` is null for the run itself. Repeated manifest lines are faults too."""
    c, key = F.col, ["run_id", "name"]
    actual = grouped_digest(rows, key, "row").select(*key, c("row_count").alias("found"), c("digest").alias("actual"))
    wanted = runs.select("run_id", c("source_snapshot_id").alias("of_run"), F.explode(F.array(*map(F.lit, REPORTS))).alias("name"))
    lines = manifest.groupBy(*key).agg(F.count(F.lit(1)).alias("lines"), *(F.max(x).alias(x) for x in ("source_snapshot_id", "row_count", "digest")))
    each = wanted.join(lines, key, "full_outer").join(actual, key, "full_outer")
    listed = c("digest").isNotNull()
    each = faults(each, key, run_missing=c("of_run").isNull(), report_missing=~listed, report_repeated=c("lines") > 1,
                  report_hash=listed & (c("digest") != F.coalesce("actual", F.lit(EMPTY))), row_count=c("row_count") != F.coalesce("found", F.lit(0)),
                  report_snapshot=~c("source_snapshot_id").eqNullSafe(c("of_run")) & listed & c("of_run").isNotNull())
    whole = runs.join(hashes_of(manifest, "run_id"), "run_id", "left").withColumn("hashes", F.coalesce("hashes", F.lit(""))).withColumn("name", F.lit(None).cast("string"))
    return each.unionByName(faults(whole, key, run_identity=c("run_id") != analysis_id(), output_hash=c("output_hash") != analysis_hash()))


COUNTED = ("candidate_count", "compiled_count", "promotion_count", "fixtures_passed", "fixtures_failed")


def compilation_hash() -> Column:
    return sha(json_of(**{c: F.col(c) for c in ("run_id", "source_snapshot_id", "file_count", "files_digest", *COUNTED)}))


def compilation(documents: DataFrame, files: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The manifest lines (file, hash) of compiled files, and the compilation: one row with run, counts, the digest of all
    lines, the regression results' counts, an identity and the output hash. Without candidates there is no compilation."""
    lines = cut(files.select("file", sha(F.col("body")).alias("hash")))
    count = lambda s: F.count_if(F.col("state") == s)
    totals = documents.groupBy("run_id", "source_snapshot_id").agg(F.count(F.lit(1)).alias("candidate_count"), count("compiled_candidate").alias("compiled_count"), count("promotion_eligible").alias("promotion_count"))
    tested = results.agg(F.count_if("passed").alias("fixtures_passed"), F.count_if(~F.col("passed")).alias("fixtures_failed"))
    digest = tree_digest(lines.select(F.concat_ws("=", "file", "hash").alias("line")), "line").select(F.col("row_count").alias("file_count"), F.col("digest").alias("files_digest"))
    for part in (tested, digest):  # one row each
        totals = totals.withColumn("__one", F.lit(1)).join(part.withColumn("__one", F.lit(1)), "__one").drop("__one")
    out = totals.withColumn("compilation_id", F.concat(F.lit("co_"), sha(json_of(run_id=F.col("run_id"), files=F.col("files_digest")))))
    return lines, cut(out.withColumn("output_hash", compilation_hash()))


def verify_compilation(files: DataFrame, lines: DataFrame, compiled: DataFrame) -> DataFrame:
    """(file, fault) of one compilation: files missing, unlisted, listed twice or of another hash; and with a null file a
    digest, count, identity or output hash that doesn't follow, or regression tests that failed."""
    c = F.col
    listed = lines.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.max("hash").alias("hash"))
    there = files.groupBy("file").agg(F.min(sha(c("body"))).alias("least"), F.max(sha(c("body"))).alias("most"))
    both = listed.join(there, "file", "full_outer")
    each = faults(both, ["file"], file_missing=c("most").isNull(), file_unlisted=c("hash").isNull(), listed_repeatedly=c("lines") > 1, file_hash=(c("hash") != c("least")) | (c("hash") != c("most")))
    digest = tree_digest(lines.select(F.concat_ws("=", "file", "hash").alias("line")), "line").select(c("row_count").alias("found"), c("digest").alias("actual"), F.lit(1).alias("__one"))
    whole = compiled.withColumn("__one", F.lit(1)).join(digest, "__one").withColumn("file", F.lit(None).cast("string"))
    named = F.concat(F.lit("co_"), sha(json_of(run_id=c("run_id"), files=c("files_digest"))))
    return each.unionByName(faults(whole, ["file"], files_digest=c("files_digest") != c("actual"), file_count=c("file_count") != c("found"), compilation_identity=c("compilation_id") != named,
                                   output_hash=c("output_hash") != compilation_hash(), regression_failed=c("fixtures_failed") > 0))


def effectiveness_id() -> Column:
    return F.concat(F.lit("er_"), sha(json_of(pack_id=F.col("pack_id"), outcomes=F.col("outcome_hash"), report=F.col("report_hash"))))


def outcome_texts(outcomes: DataFrame) -> DataFrame:
    """(pack_id, row) of outcomes without the time at which they were seen: the same outcome seen later is the same."""
    return outcomes.select("pack_id", row_text(outcomes.drop("observed_at")).alias("row"))


def effectiveness_reports(outcomes: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (pack_id, row) of the rule reports of all packs, and per pack (report_id, pack_id, observation_count,
    outcome_hash, report_hash), whose identity covers both digests."""
    rows = cut(rules.select("pack_id", row_text(rules).alias("row")))
    seen = grouped_digest(outcome_texts(outcomes), ["pack_id"], "row").select("pack_id", F.col("row_count").alias("observation_count"), F.col("digest").alias("outcome_hash"))
    made = grouped_digest(rows, ["pack_id"], "row").select("pack_id", F.col("digest").alias("report_hash"))
    manifest = seen.join(made, "pack_id").withColumn("report_id", effectiveness_id())
    return rows, cut(manifest.select("report_id", "pack_id", "observation_count", "outcome_hash", "report_hash"))


def verify_effectiveness(rows: DataFrame, manifest: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(pack_id, fault) of effectiveness reports: missing or unlisted, of another hash, of other outcomes or another number
    of them than are stored, or with an identity that doesn't follow."""
    c = F.col
    made = grouped_digest(rows, ["pack_id"], "row").select("pack_id", c("digest").alias("actual"))
    seen = grouped_digest(outcome_texts(outcomes), ["pack_id"], "row").select("pack_id", c("row_count").alias("found"), c("digest").alias("stored"))
    each = manifest.join(made, "pack_id", "full_outer").join(seen, "pack_id", "full_outer")
    listed = c("report_id").isNotNull()
    return faults(each, ["pack_id"], report_unlisted=~listed, report_missing=listed & c("actual").isNull(), report_hash=c("report_hash") != c("actual"),
                  outcome_lineage=listed & ~c("outcome_hash").eqNullSafe(c("stored")), observation_count=c("observation_count") != F.coalesce("found", F.lit(0)),
                  report_identity=c("report_id") != effectiveness_id())
