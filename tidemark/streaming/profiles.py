"""Continuous upsert: a log of batches with the latest row per key on read.

Rewriting the whole target for each small batch would cost the size of the target. Each batch
is one folder instead, overwritten as a whole when Spark repeats the batch; readers take
the newest row per key, and ``compact`` folds the log into a new base from time to time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from tidemark.operators.dedup import first_by


def stream_upsert(changes: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Write each batch of changes to its own folder of the log."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")

    writer = changes.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime="1 minute")).start()


def read_upserted(spark: SparkSession, path: str, schema: StructType, key: str, order_col: str, base: DataFrame | None = None) -> DataFrame:
    """The upserted table: newest row per key; on equal order the earlier batch stays.

    The same as one ``merge.upsert_newer`` per batch, in order: a key whose first row has no order value (in the base
    or in the batch that brought it) is never replaced. Rows are reduced per key and batch first.
    """
    log = spark.read.schema(StructType([*schema.fields, StructField("_batch", LongType())])).parquet(path)
    if base is not None:
        log = log.unionByName(base.withColumn("_batch", F.lit(-1).cast("bigint")))
    newest = F.col(order_col).desc_nulls_last()
    per_batch = first_by(log, [key, "_batch"], [newest])
    entered = per_batch.withColumn("_entered", F.min("_batch").over(Window.partitionBy(key)))
    fixed = ((F.col("_batch") == F.col("_entered")) & F.col(order_col).isNull()).cast("int").desc()
    return first_by(entered, key, [fixed, newest, F.col("_batch").asc()]).drop("_batch", "_entered")


def compact(spark: SparkSession, path: str, schema: StructType, key: str, order_col: str, out: str, base: DataFrame | None = None) -> None:
    """Write the current state as a new base. The caller then starts a new log next to it."""
    read_upserted(spark, path, schema, key, order_col, base).write.mode("overwrite").parquet(out)
