"""Continuous raw landing of JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import values as V
from tidemark.functions import times
from tidemark.schemas import EVENT_MESSAGE


def message_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files, one message per line, oldest file first. ``files_per_batch`` bounds a batch of a backlog."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("value", F.col("_metadata.file_path").alias("_source_file"))


def message_topic(spark: SparkSession, servers: str, topic: str, offsets_per_batch: int | None = None) -> DataFrame:
    """A Kafka topic from its earliest offset. Needs Spark's Kafka package on the cluster."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if offsets_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_batch)
    place = F.concat(
        F.lit("kafka/"), F.col("topic"), F.lit("/partition="), F.col("partition"), F.lit("/offset="), F.col("offset")
    )
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        place.alias("_source_file"),
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
    )


def decode(messages: DataFrame, as_of: str | None = None) -> DataFrame:
    """Message fields and ingest stamps. ``_quality`` is ``bad`` for text that is not JSON.

    JSON that is not an object keeps its text in ``_raw``, and so does undecodable text.
    """
    readable = F.try_parse_json("value").isNotNull()
    is_object = F.ltrim("value").startswith("{")
    fields = F.from_json("value", EVENT_MESSAGE, {"mode": "PERMISSIVE"})
    taken = times.moment(as_of)
    return (
        messages.withColumns(
            {
                "_fields": F.when(readable & is_object, fields),
                "_raw": F.when(~(readable & is_object), F.col("value")),
                "_quality": F.when(readable, "ok").otherwise("bad"),
                "_ingested_at": F.date_format(taken, "yyyy-MM-dd'T'HH:mm:ssXXX"),
                "date": F.date_format(taken, "yyyy-MM-dd"),
            }
        )
        .select("_fields.*", *[c for c in messages.columns if c != "value"], "_raw", "_ingested_at", "_quality", "date")
    )


def stream_bronze(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    as_of: str | None = None,
    rows_per_file: int = V.LANDING_ROWS_PER_FILE["messages"],
    drain: bool = False,
) -> StreamingQuery:
    """Land messages as Parquet, readable ones under ``_quality=ok``, the others under ``_quality=bad``.

    One pass, one sink: the checkpoint commits a batch after its files are written, and a restart
    continues there. ``drain`` works off what is there and stops.
    """
    writer = (
        decode(messages, as_of)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("_quality", "date")
    )
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{V.LANDING_FLUSH_SECONDS} seconds").start()
