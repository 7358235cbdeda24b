"""Order within a key: next value, previous value, rank, version intervals. The scans spread hot keys, see ``scans``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import scans


def with_next(df: DataFrame, key: str, ts: str, out: str) -> DataFrame:
    """Add the ``ts`` of the next row of the same key, null on the last row. Rows without a time come first."""
    return scans.neighbour(df, key, [ts], {out: ts}, forward=True)


def with_previous(df: DataFrame, key: str, ts: str, value: str, out: str) -> DataFrame:
    """Add ``value`` of the previous row of the same key, null on the first row."""
    return scans.neighbour(df, key, [ts], {out: value}, forward=False)


def with_rank(df: DataFrame, key: str, ts: str, row_id: str, out: str) -> DataFrame:
    """Add the row number within the key by ``ts``; rows of equal ``ts`` are ordered by the MD5 of ``row_id``."""
    return scans.rank(df, key, [ts, F.md5(F.col(row_id).cast("string")).alias("_md5")], out)


def scd2_intervals(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Version intervals: ``valid_from``, ``valid_to`` (start of the next version) and ``is_current``."""
    timed = with_next(df.withColumn("valid_from", F.col(ts)), key, "valid_from", "valid_to")
    return timed.withColumn("is_current", F.col("valid_to").isNull())


def drop_unchanged(df: DataFrame, key: str, ts: str, content: str) -> DataFrame:
    """Keep a version only where ``content`` differs from the version before it."""
    compared = with_previous(df, key, ts, content, "_previous")
    changed = ~F.col("_previous").eqNullSafe(F.col(content))
    return compared.filter(F.col("_previous").isNull() | changed).drop("_previous")


def current_rows(df: DataFrame) -> DataFrame:
    return df.filter("is_current")


def order_rank(df: DataFrame, customer: str = "customer_id", ts: str = "order_date", order_id: str = "order_id") -> DataFrame:
    return with_rank(df, customer, ts, order_id, "order_rank")


def first_order_flag(ranked: DataFrame) -> DataFrame:
    return ranked.withColumn("is_first_order", F.col("order_rank") == 1)
