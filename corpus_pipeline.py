"""A corpus pipeline of five operators, each stage over all that the one before has kept.

``run`` applies the stages to the documents table; the result of each but the last is written as Parquet to the shared
checkpoint folder and read again. Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``, whatever further columns there are. An empty table gives an empty one in every stage,
and texts are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import bpe, decontaminate, linededup, neardup, toxicity
from siltstone.llm.common import rewritten, table
from siltstone.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not call toxic; it is fitted on the labelled ones among them.

    Null and empty texts stay, also if no row has a label; a null id has none. Repeated rows stay or go together.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("toxic = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; documents that have no word left by that go.

    Null and empty texts stay as they are. Of equal texts the one with the smallest id stays (null first); rows equal in
    id and text are one document and all stay. ``n_chars`` of a shortened text is counted anew.
    """
    found = linededup.deduplicate(docs)
    left = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    found = found.where((F.col("n_deleted") == 0) | left)
    return found.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles that agree to 0.8): the one with the smallest id.

    Null and empty texts are one group; of repeated rows one stays; rows with a null id stay.
    """
    return neardup.deduplicate(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Null and empty texts contain none, and an empty benchmark is in none. Repeated rows stay or go together; rows with
    a null id stay only if no such row contains an item.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number, and a digest of the text that they decode to, instead of the text.

    A null or empty text has no tokens; repeated rows give repeated rows.
    """
    out = bpe.encode(docs, tokenizer_path())
    return out.select(*(c for c in docs.columns if c != "text"), F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", tokenize),
]

#: Models, near-duplicate groups and tokens are not expressible in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = rewritten(docs)
    return docs
