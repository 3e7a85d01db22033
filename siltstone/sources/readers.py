"""Readers with declared schemas: events, bundles, ledgers, reports and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import schemas


def events(spark: SparkSession, path: str) -> DataFrame:
    """JSON events, one document per file; what doesn't parse is a row with only ``malformed`` set."""
    raw = spark.read.option("wholetext", "true").text(path)
    return raw.select(F.from_json("value", schemas.ENVELOPE.replace("\n", " ")).alias("e"), F.get_json_object("value", "$.payload").alias("raw_payload"), F.try_parse_json("value").isNull().alias("malformed")).select("e.*", "raw_payload", "malformed")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSONL table (ledger, corrections, outcomes); blank lines are skipped."""
    raw = spark.read.text(path).where(F.trim("value") != "")
    return raw.select(F.from_json("value", schema.replace("\n", " ")).alias("x")).select("x.*")


def bundles(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("wholetext", "true").text(path)
    return raw.select(F.from_json("value", schemas.FINDING_BUNDLE.replace("\n", " ")).alias("b"), F.col("value").alias("document")).select("b.*", "document")


def report_rows(spark: SparkSession, path: str, row_schema: str) -> DataFrame:
    """The rows of a report document with its snapshot's id."""
    raw = spark.read.option("wholetext", "true").text(path)
    doc = F.from_json("value", f"source_snapshot_id string, rows array<struct<{row_schema}>>")
    return raw.select(doc.alias("d")).select("d.source_snapshot_id", F.explode("d.rows").alias("r")).select("source_snapshot_id", "r.*")


def manifest_parquet(spark: SparkSession, files: list[str], schema) -> DataFrame:
    """Exactly the listed Parquet files, with the declared schema; directory names are never read as columns."""
    return spark.read.schema(schema).parquet(*files)


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """Archives with their members' count of problems, checked per file."""
    from siltstone.operators.publish import verify_archive

    def run(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "problems": [verify_archive(bytes(c)) for c in pdf["content"]]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, problems array<string>")
