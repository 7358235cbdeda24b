"""Continuous Silver cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans import silver
from tidemark.schemas import BRONZE_EVENTS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def bronze_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BRONZE_EVENTS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def silver_stream(
    bronze: DataFrame, date: str | None = None, as_of: str | None = None, delay: str = "2 days", spread: int = 16
) -> DataFrame:
    """The Silver chain on a stream. The first copy of an event that arrives wins.

    The watermark runs on the time of arrival (the batch's own time, which a repeated batch keeps), not on the event's:
    an event that is days behind the others is written like any other. Seen ids are kept for ``delay`` after their
    arrival, so the state is bounded by the traffic of that time; a copy that arrives later still is written
    again and left to the daily batch. A stream has no reduction before its shuffle, so copies of an
    event are first thinned out in ``spread`` groups by their origin; at most ``spread`` copies
    of an id then meet. ``spread=1`` saves that step where ids do not repeat much.
    """
    arrived = silver.stateless(bronze, as_of).withColumn("_arrived", F.current_timestamp())
    valid = arrived.withWatermark("_arrived", delay)
    if spread > 1:
        origin = F.pmod(F.xxhash64("_source_file", "_ingested_at"), F.lit(spread))
        thinned = valid.withColumn("_origin", origin).dropDuplicatesWithinWatermark(["event_id", "_origin"])
        valid = thinned.drop("_origin")
    return silver.enrich(valid.dropDuplicatesWithinWatermark(["event_id"]).drop("_arrived"), date, as_of)


def stream_silver(
    bronze: DataFrame,
    out: str,
    checkpoint: str,
    date: str | None = None,
    as_of: str | None = None,
    delay: str = "2 days",
    drain: bool = False,
) -> StreamingQuery:
    """Continuous Silver job; the ids seen are kept in RocksDB on the executors' disks and in the checkpoint.

    Without ``date``, rows are filed under the day on which their batch ran. No event is dropped for being late.
    The state store is set for this query only: a query copies the session's settings when it starts.
    """
    conf, setting = bronze.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(setting)
    conf.set(setting, ROCKSDB)
    writer = (
        silver_stream(bronze, date, as_of, delay)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .partitionBy("_processing_date", "event_date", "event_type")
    )
    try:
        return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime="1 minute")).start()
    finally:
        conf.set(setting, before)
