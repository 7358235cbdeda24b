"""Joins of facts with lookups, row expansion and referential checks.

No side is broadcast by hint unless its size is fixed; Spark broadcasts by measured size,
and AQE splits a hot join key. Rows whose key is null would all hash to one task, so
``lookup`` spreads them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import values as V
from tidemark.functions import text
from tidemark.operators.dedup import dedup_latest

_SPREAD = 1024


def lookup(left: DataFrame, right: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join on ``key``, one right row per key at most.

    Left rows with a null key match nothing; they get a filler key from a hash of ``spread_by``, with a
    prefix of its own, so that they spread over the tasks. The prefixed key also gives both
    sides a shuffle of their own right below the join, and only such a join is split by
    AQE where a key is hot; a right side that kept the partitioning of its deduplication would not be.
    """
    real = F.concat(F.lit("="), F.col(key).cast("string"))
    filler = F.concat(F.lit("~"), F.pmod(F.xxhash64(spread_by), F.lit(_SPREAD)).cast("string"))
    found = right.filter(F.col(key).isNotNull()).withColumn("_key", real).drop(key)
    return left.withColumn("_key", F.coalesce(real, filler)).join(found, "_key", "left").drop("_key")


def session_starts(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Last-touch session attributes: the latest ``session_start`` of each session."""
    starts = events.filter((F.col("event_type") == "session_start") & F.col("session_id").isNotNull())
    slim = starts.select("session_id", "event_ts", "event_id", *columns)
    return dedup_latest(slim, "session_id", ["event_ts", "event_id"], ties=()).drop("event_ts", "event_id")


def attribute_orders(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders with the attributes of their session. Every order appears exactly once."""
    sessions = session_starts(events, ["country_code", "device_type", "referrer_channel", "user_id"])
    return lookup(orders, sessions, "session_id", spread_by="order_id")


def lookup_keys(
    fact: DataFrame, dim: DataFrame, on: str, key: str, unknown: str | int = V.UNKNOWN_KEY, *, spread_by: str
) -> DataFrame:
    """Add the dimension columns; the surrogate key is the unknown member where nothing matches.

    ``spread_by`` is a column that differs between facts with a null key (see ``lookup``).
    """
    joined = lookup(fact, dim, on, spread_by)
    return joined.withColumn(key, F.coalesce(F.col(key), F.lit(unknown)))


def expand_by_series(df: DataFrame, n: int, keep: Column | None = None, out: str = "n") -> DataFrame:
    """Each row ``n`` times with ordinals 1..n; ``keep`` selects the ordinals that stay."""
    rows = df.withColumn(out, F.explode(F.sequence(F.lit(1), F.lit(n))))
    return rows if keep is None else rows.filter(keep)


def explode_lines(orders: DataFrame) -> DataFrame:
    items = orders.select("order_id", F.explode("line_items").alias("item")).select("order_id", "item.*")
    return items.withColumn("item_revenue_eur", F.col("quantity") * F.col("unit_price_eur"))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent, with the number of child rows. Null keys are not orphans.

    Children are counted and parents made distinct before the join, so a hot key is one row on each side.
    """
    known = parent.select(F.col(parent_key or key).alias(key)).distinct()
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("child_rows"))
    return used.join(known, key, "left_anti")


def line_revenue(lines: DataFrame) -> DataFrame:
    gross = F.col("quantity") * F.col("unit_price_eur")
    return lines.withColumns({"gross_revenue_eur": gross, "net_revenue_eur": gross - F.col("discount_eur")})


def line_key(order_id: str = "order_id", line_id: str = "line_item_id") -> Column:
    return text.surrogate_key(order_id, line_id)
