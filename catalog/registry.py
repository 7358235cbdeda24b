from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.views_sql import with_views
from tidemark.session import pin, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DATE = "2024-01-29"
AS_OF = "2024-01-30 00:00:00"


def plain(df: DataFrame) -> DataFrame:
    """Dates, times and arrays as text, so that both engines show them alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def fixed(c, digits: int):
    """A float rounded half up by its decimal form; sums of floats differ in their last bits otherwise."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(28,8)"), digits).cast("double")


def fix(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: fixed(c, n) for c, n in digits.items()})


def prepared(spark: SparkSession) -> SparkSession:
    """A pinned session; one on a local master that names no shared folder gets a temporary one."""
    if not shared_folder(spark) and spark.sparkContext.master.startswith("local["):
        spark.conf.set("tidemark.scratch.dir", tempfile.mkdtemp(prefix="tidemark-"))
    return pin(spark)


def query(name: str, sql: str | None = None):
    """Register a query and its SQL. View names in the SQL are filled in by ``with_views``."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(prepared(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register
