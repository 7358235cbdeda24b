"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read by the next.

Every stage works on all that its predecessor kept. The first four return the columns of ``documents``; the last adds
each row's shard and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, jaccard_join, mixing, sharding, toxicity
from tidemark.llm.common import read, written
from tidemark.llm.queries import texts_prepared

#: Learned grammars, alignments and similarity joins are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar scores at 0.5 or more go."""
    model = toxicity.fit(docs, read(texts_prepared(spark), sf_dir, "labels"))
    return named(toxicity.score(numbered(docs), model).where("score < 0.5"), docs)


#: The columns that stages read. All others get numbers for names inside a stage, so none can clash with its own.
READ = ("doc_id", "text", "source")


def numbered(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`").alias(c if c in READ else f"_column{i}") for i, c in enumerate(docs.columns)])


def named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from rows that ``numbered`` its columns."""
    return rows.select(*[F.col(c if c in READ else f"_column{i}").alias(c) for i, c in enumerate(docs.columns)])


def keyed(docs: DataFrame) -> DataFrame:
    """``docs``, its columns numbered, with a unique ``_row``, written: ids can be null or repeated."""
    return written(numbered(docs).withColumn("_row", F.monotonically_increasing_id()), "keyed")


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by five-word shingles at 80 % Jaccard or more, one row with the smallest id stays.

    Null ids come last. Rows without words are similar to none and stay.
    """
    rows = keyed(docs)
    found = jaccard_join.join(rows.select(F.col("_row").alias("doc_id"), "text"), words=5, percent=80)
    found = found.select(F.col("doc_id").alias("_row"), "component_id").join(rows.select("_row", "doc_id"), "_row")
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("first"))
    return rows.join(written(first.select("first._row"), "similar"), "_row", "left_semi").transform(named, docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage that aligns to a benchmark item go."""
    rows = keyed(docs)
    hits = decontamination.contaminated(rows.select(F.col("_row").alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    hits = written(hits.select(F.col("doc_id").alias("_row")).distinct(), "leaks")
    return rows.join(hits, "_row", "left_anti").transform(named, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to their weights; a document can be taken up to three times."""
    rows = numbered(docs)
    return named(mixing.draw(mixing.plan(rows), rows.columns), docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of equal numbers of rows, with places."""
    return sharding.shard_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", one_of_similar),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources", mix_sources),
    ("sharding", place_in_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(texts_prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
