"""What several corpus operators share: reading, the word pattern, written intermediates, link components."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cleaned, scratch

#: A word, in all contracts: a run without the six ASCII white-space bytes. ``bytes.split()`` cuts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str | Column = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def md5_hex(*parts: str | Column) -> Column:
    return F.md5(F.concat_ws(":", *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts]))


def hash64(data: bytes) -> int:
    """A fixed 64-bit hash, for the few values that the driver hashes."""
    return int.from_bytes(hashlib.md5(data).digest()[:8], "big")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, and survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, label: str) -> DataFrame:
    """``written``, and the shuffle files of the writing go at its end instead of staying until the driver collects garbage."""
    with cleaned(df.sparkSession):
        return written(df, label)


def wrapped(df: DataFrame) -> DataFrame:
    """All columns in one struct ``row``, so that working columns cannot clash with any of them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unwrapped(df: DataFrame, columns: list[str], **new: str | Column) -> DataFrame:
    """The columns of ``row`` without those that ``new`` replaces, then the new ones."""
    kept = [F.col(f"row.`{c}`").alias(c) for c in columns if c not in new]
    return df.select(*kept, *[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in new.items()])


def _joined(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on a long, by its text: both sides get a shuffle of their own right below the join, and only then
    does AQE split a hot key. A right side that kept the partitioning of its aggregation would not be split."""
    text = F.col(key).cast("string")
    return left.withColumn("_key", text).join(right.withColumn("_key", text).drop(key), "_key").drop("_key")


def _stars(links: DataFrame) -> bool:
    """Whether distinct links (a, b), b < a, are stars: a node that links to a smaller one has no other link."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("up")).unionByName(links.select(F.col("b").alias("id"), F.lit(0).alias("up")))
    return ends.groupBy("id").agg(F.max("up").alias("up"), F.count("*").alias("n")).where("up = 1 and n > 1").count() == 0


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of (a, b) links of longs: (id, component), the smallest id reachable.

    Star contraction: every node links its larger neighbours to its smallest, then its smaller ones to it
    (alternating large and small stars), until all links are stars; links that come as stars cost no round. A round costs
    two aggregations over the remaining links, hot nodes are only ever minimised over, never gathered; each round is written.
    Nodes without links are not returned; null ids are no nodes.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    edges = settled(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(rounds):
        if _stars(edges):
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: a's larger neighbours, to a's smallest.
        large = _joined(both.where("b > a"), least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: a's smaller neighbours and a itself, to the smallest of them.
        small_min = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _joined(large, small_min, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = settled(small.unionByName(small_min.select("a", F.col("m").alias("b"))).distinct(), "links")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
