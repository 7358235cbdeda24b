"""Session helpers. A cluster brings its own session; these only pin what results and speed depend on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_PINNED = {
    # Every parse and every date cut is in UTC.
    "spark.sql.session.timeZone": "UTC",
    # HotSpot never compiles a method of more than 8000 bytes. A wide projection in one generated
    # method would run interpreted, about four times slower; with this limit Spark splits it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, memory: str = "20g", folder: str | None = None
) -> SparkSession:
    """A session for tests and the benchmark on one machine.

    Joins are broadcast by the size AQE measures at run time only, never by an estimate made from
    compressed file sizes. ``folder`` takes written intermediates.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if folder:
        spark.conf.set("tidemark.scratch.dir", folder)
    return pin(spark)


def pin(spark: SparkSession) -> SparkSession:
    for key, value in _PINNED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that driver and executors share: the cluster's, or the one a test or bench session set."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tidemark.scratch.dir", None)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder for written intermediates, under the shared folder. Raises where none is named:
    on a cluster a machine-local folder would lose what other executors wrote."""
    shared = shared_folder(spark)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of the writes in it go at the end of each, instead of staying until the driver collects garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, and safe from lost executors."""
    path = scratch(df.sparkSession, label)
    with cleaned(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
