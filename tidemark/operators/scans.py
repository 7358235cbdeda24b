"""Scans along an order within a key, at any skew.

A window by key alone puts all rows of a key into one task. Here rows are range-sorted by key, order and a tie-breaker
of their own, so that a hot key, and even one moment of it, is spread over as many partitions as it needs. A scan then runs in
two steps: a window inside each partition and key, and a prefix over partitions. Only a key at the
lower or upper end of a partition can reach into another one, so the prefix holds at most two rows per partition (the count,
first and last values of that end), and its broadcast is bounded by the number of partitions, not by the data.

The sorted rows are written once: range bounds come from a sample, and a second run could cut elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidemark.session import written

_OWN = ("_key", "_at", "_part")


def _group() -> WindowSpec:
    return Window.partitionBy("_part", "_key").orderBy("_at")


def _parts() -> WindowSpec:
    return Window.partitionBy("_key").orderBy("_part")


def _before() -> WindowSpec:
    return _parts().rowsBetween(Window.unboundedPreceding, -1)


def ordered(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """The rows written in ranges of key and order, nulls first; null keys are one key.

    Rows that tie stand in an order of their content; equal rows are told apart by a number, so that even they spread.
    """
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    place = F.struct(*order, F.xxhash64(*hashable).alias("_hash"), F.monotonically_increasing_id().alias("_n"))
    # The prefix keeps a null key apart from the empty text.
    placed = df.withColumns({"_key": F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")), "_at": place})
    return written(placed.repartitionByRange("_key", "_at").withColumn("_part", F.spark_partition_id()), "ordered")


def ends(rows: DataFrame, **values: Column) -> DataFrame:
    """(_part, _key, values) of the first and the last key of each partition: the only ones that may go on in another."""
    limits = rows.groupBy("_part").agg(F.min("_key").alias("_low"), F.max("_key").alias("_high"))
    reaching = rows.join(F.broadcast(limits), "_part").where("_key = _low OR _key = _high")
    return reaching.groupBy("_part", "_key").agg(*[v.alias(n) for n, v in values.items()])


def joined(rows: DataFrame, prefix: DataFrame) -> DataFrame:
    """Rows with what the prefix says of their partition and key; null inside, where nothing reaches over."""
    return rows.join(F.broadcast(prefix), ["_part", "_key"], "left")


def _finished(rows: DataFrame, *more: str) -> DataFrame:
    return rows.drop(*_OWN, *more)


def neighbour(df: DataFrame, key: str, order: Sequence[str | Column], values: dict[str, str | Column], forward: bool) -> DataFrame:
    """Add ``values`` (new name to column) of the next or previous row of the key, null where there is none."""
    rows = ordered(df, key, order)
    value = F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in values.items()])
    inside = (F.lead if forward else F.lag)(value).over(_group())
    # What the neighbour in the next partition shows first, or the one in the previous partition last.
    edge = ends(rows, _edge=F.min_by(value, F.col("_at")) if forward else F.max_by(value, F.col("_at")))
    over = edge.select("_part", "_key", (F.lead if forward else F.lag)("_edge").over(_parts()).alias("_over"))
    found = joined(rows.withColumn("_inside", inside), over).withColumn("_found", F.coalesce("_inside", "_over"))
    return _finished(found.withColumns({n: F.col(f"_found.`{n}`") for n in values}), "_inside", "_over", "_found")


def rank(df: DataFrame, key: str, order: Sequence[str | Column], out: str) -> DataFrame:
    """Add the row number within the key."""
    rows = ordered(df, key, order)
    before = ends(rows, _n=F.count("*")).select("_part", "_key", F.sum("_n").over(_before()).alias("_earlier"))
    numbered = joined(rows.withColumn("_nth", F.row_number().over(_group())), before)
    return _finished(numbered.withColumn(out, F.col("_nth") + F.coalesce("_earlier", F.lit(0))), "_nth", "_earlier")


def carried(df: DataFrame, key: str, order: Sequence[str | Column], values: dict[str, str | Column]) -> DataFrame:
    """Add the last value that is not null, up to the row itself, of each of ``values`` (new name to column)."""
    rows = ordered(df, key, order)
    columns = {n: F.col(v) if isinstance(v, str) else v for n, v in values.items()}
    run = _group().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # max_by skips rows whose place is null, and a place is null here where the value is.
    edge = ends(rows, **{f"_last_{n}": F.max_by(c, F.when(c.isNotNull(), F.col("_at"))) for n, c in columns.items()})
    before = edge.select("_part", "_key", *[F.last(f"_last_{n}", ignorenulls=True).over(_before()).alias(f"_over_{n}") for n in columns])
    inside = rows.withColumns({f"_in_{n}": F.last(c, ignorenulls=True).over(run) for n, c in columns.items()})
    filled = joined(inside, before).withColumns({n: F.coalesce(f"_in_{n}", f"_over_{n}") for n in columns})
    return _finished(filled, *[f"_in_{n}" for n in columns], *[f"_over_{n}" for n in columns])
