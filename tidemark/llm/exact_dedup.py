"""Exact deduplication as a stateful stream.

A stream over the files keeps one state row per digest of the normalised text, on disk (RocksDB, backed by the
checkpoint) and without expiry: the digest, how many rows had it, and of the row that stays its length, stable
identifier and content locator (file and row in the file). Rows are reduced per task before they meet the state, so
one text in a third of all rows costs one state update per task. A later run over new files goes on from the
same checkpoint. Afterwards every hit (a row whose digest has another row) is compared byte by byte with the text that
the locator names; texts that differ under one digest are grouped anew by their full bytes.

Defined results: null is the empty text; a null id is the largest; of repeated rows the first by locator stays; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import text_of, written
from tidemark.session import scratch

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A store per partition: without this, each sets 4 MB aside for its manifest alone.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def normalised() -> Column:
    return F.regexp_replace(text_of(), r"[\x20\x09-\x0D]", "")


def digest_of(norm: Column) -> Column:
    return F.sha2(norm, 256)


def located(rows: DataFrame, digest=digest_of) -> DataFrame:
    """doc_id, norm, digest, and ``rank``: the greatest in a group is the row that stays. ``~doc_id`` falls as the id
    rises; the locator breaks ties."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), (-F.col("_metadata.row_index")).alias("back"))
    rank = F.struct(F.char_length(text_of()).alias("points"), F.col("doc_id").isNotNull().alias("has_id"), F.bitwise_not("doc_id").alias("neg_id"), at.alias("at"))
    out = rows.select("doc_id", normalised().alias("norm"), rank.alias("rank"))
    return out.withColumn("digest", digest(F.col("norm")))


def run_stream(spark: SparkSession, path: str, state: str, out: str, digest=digest_of) -> None:
    """Drain the files of ``path`` that the checkpoint ``state`` has not seen; append changed state rows below ``out``."""
    schema = spark.read.parquet(path).schema
    session = spark.newSession()  # its settings are not those of other streams
    for key, value in STATE_CONF.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    # As a pattern, the path may name a folder or a single file; a stream takes a plain path for a folder.
    rows = located(session.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]"), digest)
    kept = rows.groupBy("digest").agg(F.max("rank").alias("keep"), F.count("*").alias("group_size"))

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")  # a repeated batch replaces itself

    query = kept.writeStream.outputMode("update").option("checkpointLocation", state).foreachBatch(land)
    query.trigger(availableNow=True).start().awaitTermination()


def states(spark: SparkSession, out: str) -> DataFrame:
    """The newest state row of each digest: the counts only grow."""
    schema = "digest string, keep struct<points:int,has_id:boolean,neg_id:bigint,at:struct<file:string,back:bigint>>, group_size long, batch int"
    rows = spark.read.schema(schema).parquet(out)
    return rows.groupBy("digest").agg(F.max("keep").alias("keep"), F.max("group_size").alias("group_size"))


def resolve(spark: SparkSession, path: str, kept: DataFrame, digest=digest_of) -> DataFrame:
    """Every row of ``path`` with the row that stays of its group, after the byte check."""
    rows = located(spark.read.parquet(path), digest)
    alone = kept.select("digest", "keep", "group_size")
    joined = rows.drop("norm").join(alone, "digest")
    # The byte check reads the texts of groups with more than one row only.
    several = kept.where("group_size > 1").select("digest", "keep")
    members = written(rows.join(several, "digest"), "members")
    holders = members.where("rank = keep").select("digest", F.col("norm").alias("held"))
    hits = members.where("rank <> keep").select("digest", "norm", "rank")
    differ = hits.join(holders, "digest").where("norm <> held").select("digest").distinct()
    collided = written(differ, "collided")
    out = ["doc_id", "digest", "rank", "keep", "group_size"]
    if collided.isEmpty():
        return joined.select(*out)
    clashing = rows.join(collided, "digest", "left_semi")
    groups = clashing.groupBy("digest", "norm").agg(F.max("rank").alias("keep"), F.count("*").alias("group_size"))
    anew = clashing.join(groups, ["digest", "norm"])
    return joined.join(collided, "digest", "left_anti").select(*out).unionByName(anew.select(*out))


def dedup(spark: SparkSession, path: str, digest=digest_of) -> DataFrame:
    """doc_id, digest, rank, keep, group_size of every row below ``path``."""
    state, out = scratch(spark, "dedup-state"), scratch(spark, "dedup-out")
    if spark.read.parquet(path).isEmpty():
        return located(spark.read.parquet(path), digest).select("doc_id", "digest", "rank", F.col("rank").alias("keep"), F.lit(1).cast("long").alias("group_size"))
    run_stream(spark, path, state, out, digest)
    return resolve(spark, path, states(spark, out), digest)


def op10_exact_dedup(spark: SparkSession, path: str) -> DataFrame:
    keep_id = F.when(F.col("keep.has_id"), F.bitwise_not("keep.neg_id"))
    return dedup(spark, path).select(
        "doc_id", keep_id.alias("keep_id"), "group_size", (F.col("rank") == F.col("keep")).alias("kept"), F.col("digest").alias("text_sha256")
    )


OP10_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[ \\t-\\r]', '', 'g') AS norm FROM documents),
g AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
    first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
