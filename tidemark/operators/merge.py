"""Upserts and incremental reads. State and targets are ordinary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import values as V
from tidemark.operators.dedup import dedup_latest, first_by


def upsert_newer(target: DataFrame, source: DataFrame, key: str, order_col: str) -> DataFrame:
    """Insert new keys; replace a target row only by a source row that is strictly newer.

    A target row without an order value is never replaced, since no comparison with it
    holds. Ties keep the target. Of source rows with one key the newest counts. Rows without a key match
    nothing and are all kept. Only target rows whose key is in the source are compared; the others, found by
    a join with the distinct keys that AQE broadcasts if they are few, are passed on unsorted.
    """
    keys = source.filter(F.col(key).isNotNull()).select(key).distinct()
    touched = target.join(keys, key, "left_semi")
    rest = target.join(keys, key, "left_anti").unionByName(source.filter(F.col(key).isNull()), allowMissingColumns=True)
    both = touched.withColumn("_old", F.lit(1)).unionByName(
        source.filter(F.col(key).isNotNull()).withColumn("_old", F.lit(0)), allowMissingColumns=True
    )
    pinned = ((F.col("_old") == 1) & F.col(order_col).isNull()).cast("int").desc()
    order = [pinned, F.col(order_col).desc_nulls_last(), F.col("_old").desc()]
    return rest.unionByName(first_by(both, key, order).drop("_old"))


def upsert(target: DataFrame, source: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """Last run wins: source rows replace target rows of the same key, new columns are added.

    Of source rows with one key the greatest by ``order_col`` stays (without one, or on ties, the first by the other
    columns), so a key is unique afterwards if it is in the target. Rows without a key match nothing and are all kept.
    """
    kept = target.join(source.select(key).distinct(), key, "left_anti")
    single = dedup_latest(source.filter(F.col(key).isNotNull()), key, order_col or [])
    fresh = single.unionByName(source.filter(F.col(key).isNull()))
    return kept.unionByName(fresh, allowMissingColumns=True)


def batch_max(df: DataFrame, cursor: str) -> DataFrame:
    return df.agg(F.max(cursor).alias("batch_max"))


def _stored_mark(state: DataFrame, name: str) -> DataFrame:
    row = state.filter(F.col("collection_name") == name)
    return row.agg(F.coalesce(F.max("last_sync_at"), F.lit(V.FIRST_MARK).cast("timestamp")).alias("mark"))


def read_increment(
    source: DataFrame, state: DataFrame, name: str, cursor: str = "updated_at", strict: bool = False
) -> DataFrame:
    """Rows at or above the stored mark of ``name`` (strictly above with ``strict``).

    The mark is a scalar subquery, so nothing is collected and the bound is applied in the scan's filter.
    """
    mark = _stored_mark(state, name).scalar()
    return source.filter(F.col(cursor) > mark if strict else F.col(cursor) >= mark)


def advance_mark(state: DataFrame, name: str, batch: DataFrame, cursor: str = "updated_at") -> DataFrame:
    """State after a batch: the mark of ``name`` moves forward only, and only if rows were read."""
    seen = batch.groupBy(F.lit(name).alias("collection_name")).agg(F.max(cursor).alias("last_sync_at"))
    both = state.unionByName(seen.filter(F.col("last_sync_at").isNotNull()))
    return both.groupBy("collection_name").agg(F.max("last_sync_at").alias("last_sync_at"))


def append_dedup(history: DataFrame, batch: DataFrame, key: str, cursor: str) -> tuple[DataFrame, DataFrame]:
    """Raw history with the batch appended, and the latest row per key as a view on it."""
    grown = history.unionByName(batch, allowMissingColumns=True)
    return grown, dedup_latest(grown, key, cursor)


def lookback(df: DataFrame, col: str, as_of: str, days: int = V.LOOKBACK_DAYS) -> DataFrame:
    """Rows of the last ``days`` days. The bound is a literal, so it reaches the scan."""
    return df.filter(F.col(col) >= F.date_sub(F.lit(as_of).cast("date"), days))


def remerge_late(target: DataFrame, rows: DataFrame, key: str, date_col: str, as_of: str, days: int = V.LOOKBACK_DAYS) -> DataFrame:
    """Fold a trailing window of recomputed rows into the target, so that late rows are picked up."""
    return upsert(target, lookback(rows, date_col, as_of, days), key)
