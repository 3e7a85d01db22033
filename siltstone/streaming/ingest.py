"""Streaming ingestion with what is known of each record, and event-time windows.

Every batch of the stream is judged by a window and a join, natively: the deliveries of a record meet what earlier
batches have left in the store, whether the record was accepted and which replacement holds. A batch reads only what
batches before it wrote and writes its own folders anew, so one that is replayed after a failure has the effect of one
run. What is known only grows (accepted stays, the greatest replacement holds), so its rows need no order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltstone.session import written

KNOWN = "record_id string, accepted boolean, superseded_by string"


def judged(deliveries: DataFrame, known: DataFrame) -> DataFrame:
    """``deliveries`` that have a record id, with head (one row of each record: its first event, else a correction), event
    (the record has one here), was and before (what ``known`` says of it), accepted and superseded_by (what holds now).

    A record's first event is its smallest delivery, null before all. A correction that comes before its record waits, and
    takes effect with the record; of several the greatest replacement holds, as in the batch overlay. None replaces itself.
    """
    c, record = F.col, Window.partitionBy("record_id")
    correction = c("kind") == "correction"
    order = record.orderBy(correction, "delivery")
    named = F.max(F.when(correction & (c("replacement") != c("record_id")), c("replacement"))).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = deliveries.where("record_id is not null").withColumns({"head": F.row_number().over(order) == 1, "event": ~F.first(correction).over(order), "named": named})
    before = known.groupBy("record_id").agg(F.bool_or("accepted").alias("was"), F.max("superseded_by").alias("before"))
    rows = rows.join(before, "record_id", "left").withColumn("was", F.coalesce("was", F.lit(False)))
    return rows.withColumns({"accepted": c("was") | c("event"), "superseded_by": F.greatest("before", "named")}).drop("named")


def marked(rows: DataFrame) -> dict[str, DataFrame]:
    """What a batch puts into the store's folders, from ``judged`` rows: an entry (record_id, delivery, kind, disposition,
    superseded_by) per delivery in the ledger, accepted records, overlay, and what is known of records that changed."""
    c, none = F.col, F.lit(None).cast("string")
    entry = lambda delivery, kind, disposition, by: ("record_id", delivery.cast("long").alias("delivery"), kind.alias("kind"), disposition.alias("disposition"), by.alias("superseded_by"))
    correction, event = c("kind") == "correction", F.lit("event")
    new = c("head") & ~correction & ~c("was")
    disposition = F.when(correction, "recorded").when(new, "accepted").otherwise("duplicate")
    now = rows.where("head")
    replaced = now.where("accepted and superseded_by is not null and (not was or not superseded_by <=> before)")
    changed = now.where("accepted != was or not superseded_by <=> before")
    return {
        "ledger": rows.select(*entry(c("delivery"), F.when(correction, c("kind")).otherwise(event), disposition, F.when(correction, c("replacement")))),
        "records": rows.where(new).select(*entry(c("delivery"), event, F.lit("accepted"), none)),
        "overlay": replaced.select(*entry(none, F.lit("overlay"), F.lit("superseded"), c("superseded_by"))),
        "known": changed.select("record_id", "accepted", "superseded_by"),
    }


def ingest_stream(spark: SparkSession, source: str, schema, store: str, id_column: str = "record_id", files_per_batch: int = 8, stored: DataFrame | None = None) -> StreamingQuery:
    """Ingest all files of ``source`` that aren't yet. Every delivery gets a row in ``store``/ledger; accepted records go
    to ``store``/records, what supersedes a record to ``store``/overlay (the greatest replacement holds), and what the
    next batches need to know of the records to ``store``/known.

    ``schema`` has ``delivery`` and the id; ``kind`` and ``replacement``, if there, make a row a correction of its record.
    ``stored``: record_id and superseded_by of records that the store has from before the stream's first batch.
    """
    names = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fieldNames()
    none = F.lit(None).cast("string")

    def write(batch: DataFrame, number: int) -> None:
        put = lambda rows, folder, n: rows.write.mode("overwrite").parquet(f"{store}/{folder}/n={n}")
        if number == 0:
            first = batch.sparkSession.range(0).select(F.lit("").alias("record_id"), none.alias("superseded_by")) if stored is None else stored
            put(first.select("record_id", F.lit(True).alias("accepted"), "superseded_by"), "known", -1)
        known = batch.sparkSession.read.schema(f"{KNOWN}, n long").parquet(f"{store}/known").where(F.col("n") < number)
        batch = batch.withColumns({"delivery": F.col("delivery").cast("long"), "kind": F.coalesce("kind", F.lit("event"))})
        parts = marked(written(judged(batch, known)))
        nameless = batch.where("record_id is null").select("record_id", "delivery", "kind", F.lit("quarantined").alias("disposition"), none.alias("superseded_by"))
        put(parts.pop("known"), "known", number)
        for folder, rows in (parts | {"ledger": parts["ledger"].unionByName(nameless)}).items():
            put(rows.withColumnRenamed("record_id", id_column), folder, number)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source).withColumnRenamed(id_column, "record_id")
    for name in ("kind", "replacement"):
        if name not in names:
            stream = stream.withColumn(name, none)
    return stream.select("record_id", "delivery", "kind", "replacement").writeStream.foreachBatch(write).option("checkpointLocation", f"{store}/checkpoint").trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per type and tumbling window of event time, with a watermark for late ones."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", length), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
