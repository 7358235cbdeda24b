"""Bronze reads, raw landing and landed API pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import values as V
from tidemark.functions import times
from tidemark.schemas import BRONZE_EVENTS


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Raw events with the declared schema; columns a file lacks are null, others are not read."""
    return spark.read.schema(BRONZE_EVENTS).parquet(path)


def land_raw(df: DataFrame, path: str, date: str | Column, rows_per_file: int = V.LANDING_ROWS_PER_FILE["messages"]) -> None:
    """Append raw records under ``date=YYYY-MM-DD``. Files appear only when the job commits.

    No shuffle: each task writes its own rows, at most ``rows_per_file`` to a file.
    """
    day = F.lit(date) if isinstance(date, str) else date
    (
        df.withColumn("date", day)
        .write.mode("append")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "snappy")
        .partitionBy("date")
        .parquet(path)
    )


def stamp_bronze(
    df: DataFrame, topic: str | Column, partition: Column, offset: Column, as_of: str | Column | None = None
) -> DataFrame:
    """Lineage of a message: where it came from and when it was taken in."""
    topic = F.lit(topic) if isinstance(topic, str) else topic
    taken = as_of if isinstance(as_of, Column) else times.moment(as_of)
    return df.withColumns(
        {
            "_ingested_at": F.date_format(taken, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
            "_kafka_partition": partition,
            "_kafka_offset": offset,
            "_kafka_topic": topic,
            "_source_file": F.concat(
                F.lit("kafka/"), topic, F.lit("/partition="), partition.cast("string"),
                F.lit("/offset="), offset.cast("string"),
            ),
        }
    )


def explode_api_pages(pages: DataFrame, data_path: str = "data", body: str = "body") -> DataFrame:
    """Records of landed response pages as ``record`` (JSON text), from a dotted path.

    A top-level array is itself the record list; a page without a list there gives no rows and is
    reported by ``unreadable_pages``.
    """
    items = F.try_variant_get(_page_records(data_path, body), "$", "array<variant>")
    return pages.withColumn("_item", F.explode(items)).withColumn("record", F.to_json("_item")).drop("_item", body)


def _page_records(data_path: str, body: str) -> Column:
    page = F.try_parse_json(F.col(body))
    return F.when(F.ltrim(F.col(body)).startswith("["), page).otherwise(F.try_variant_get(page, f"$.{data_path}", "variant"))


def unreadable_pages(pages: DataFrame, data_path: str = "data", body: str = "body") -> DataFrame:
    """Pages that ``explode_api_pages`` has no records of, other than by an empty list, with a ``reason``.

    ``no body`` (null), ``not json``, ``no records`` (the path is missing or null) or ``not a list``. The body stays, for repair.
    """
    found = _page_records(data_path, body)
    reason = (
        F.when(F.col(body).isNull(), "no body")
        .when(F.try_parse_json(F.col(body)).isNull(), "not json")
        .when(found.isNull() | F.is_variant_null(found), "no records")
        .when(F.try_variant_get(found, "$", "array<variant>").isNull(), "not a list")
    )
    return pages.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def page_cursors(pages: DataFrame, cursor_path: str = "meta.next_cursor", body: str = "body") -> DataFrame:
    """The next cursor each page announces, null on the last page."""
    return pages.withColumn("next_cursor", F.get_json_object(F.col(body), f"$.{cursor_path}")).drop(body)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every data file below ``path``; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return listed.load(path).select("path", "length")


def landing_volume(
    spark: SparkSession, path: str, min_files: int = V.LANDING_MIN_FILES, min_bytes: int = V.LANDING_MIN_BYTES
) -> DataFrame:
    """File count and bytes below a prefix, and whether both reach their minimum."""
    sized = landed_files(spark, path).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )
    return sized.withColumn("passed", (F.col("files") >= min_files) & (F.col("bytes") >= min_bytes))
