"""Continuous ingest: the landing folder as a stream.

The jobs are those of the batch plans; only the trigger differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import point_store, station_json


def document_stream(spark: SparkSession, landing: str, files_per_trigger: int = 1000) -> DataFrame:
    """Station documents as they land, one per line."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(landing)
    return station_json.parse_documents(lines, "value")


def hourly_stream(spark: SparkSession, landing: str, store: str, checkpoint: str, late: str = "40 days",
                  available_now: bool = True, label: str = "end") -> StreamingQuery:
    """Hourly means of the stream, as points of a store of their own.

    State is the hours' sums and the points seen, both kept until the watermark, ``late`` behind the
    latest observation, passes them. A document that lands again counts once, and a late one inside
    the watermark mends its hours; what is later is dropped. Every batch upserts the hours
    that changed, so the store holds what a batch job over all documents would give. Of points that
    differ under one key the first to land counts: rewrites belong to :func:`ingest_stream`.
    """
    points = station_json.station_points(document_stream(spark, landing))
    # a watermark needs an instant; the session's zone does not matter, as both casts pass through it
    timed = points.withColumn("instant", F.convert_timezone(F.lit("UTC"), F.current_timezone(), "ts").cast("timestamp")).withWatermark("instant", late)
    once = timed.dropDuplicates(["source", "station_id", "field", "instant"])
    hours = once.groupBy("source", "station_id", "field", F.window("instant", "1 hour").alias("hour")).agg(
        F.avg("value").alias("value"))
    local = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(f"hour.{label}").cast("timestamp_ntz"))
    rows = hours.select("source", "station_id", F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"),
                        local.alias("ts"), "field", "value")

    def upsert(batch: DataFrame, number: int) -> None:
        # the number of the batch orders its hours among those of other batches, also when it is replayed
        stamp = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(number))
        point_store.write_points(batch, store, stamp)

    writer = rows.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def ingest_stream(spark: SparkSession, landing: str, store: str, checkpoint: str,
                  available_now: bool = True) -> StreamingQuery:
    """Upsert landed documents into the store, batch by batch.

    Later batches win; a batch replayed after a failure writes the same values again.
    """
    points = station_json.station_points(document_stream(spark, landing))

    def upsert(batch: DataFrame, number: int) -> None:
        point_store.write_points(batch, store, F.localtimestamp())

    writer = points.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
