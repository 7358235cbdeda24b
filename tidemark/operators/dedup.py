"""One row per key.

All forms keep one row per key, so Spark reduces each key inside every map
task before the shuffle (a window group limit for ``row_number() = 1``, a partial
aggregate for ``dropDuplicates``). A key with a third of all rows then sends at most
one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType
from pyspark.sql.window import Window


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _orderable(kind: DataType) -> bool:
    """Maps and variants have no order, nor has anything that holds one."""
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return kind.typeName() not in ("map", "variant")


def _ties(df: DataFrame, used: set[str], ties: Sequence[str] | None) -> list[Column]:
    """Columns compared when the order columns tie, so that repeated runs keep the same row.

    ``None`` takes every other column that can be ordered. A caller that names a few leaves the
    rest free for column pruning.
    """
    if ties is not None:
        return [F.col(f"`{c}`").asc_nulls_last() for c in ties if c not in used]
    return [
        F.col(f"`{f.name}`").asc_nulls_last()
        for f in df.schema.fields
        if f.name not in used and _orderable(f.dataType)
    ]


def first_by(df: DataFrame, key: str | Sequence[str], order: Sequence[Column], ties: Sequence[Column] = ()) -> DataFrame:
    best = Window.partitionBy(*_names(key)).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank")


def dedup_first(df: DataFrame, key: str | Sequence[str], order: str, ties: Sequence[str] | None = None) -> DataFrame:
    """First write wins: earliest ``order``, nulls last."""
    return first_by(df, key, [F.col(order).asc_nulls_last()], _ties(df, {order, *_names(key)}, ties))


def dedup_latest(
    df: DataFrame, key: str | Sequence[str], order: str | Sequence[str], ties: Sequence[str] | None = None
) -> DataFrame:
    """Latest version wins: greatest ``order``, nulls last."""
    keys, orders = _names(key), _names(order)
    return first_by(df, keys, [F.col(o).desc_nulls_last() for o in orders], _ties(df, {*orders, *keys}, ties))


def dedup_any(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return df.dropDuplicates(_names(key))
