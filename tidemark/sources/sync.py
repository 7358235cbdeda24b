"""Synced collections: which streams exist, their key and cursor, and one sync run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import values as V
from tidemark.operators import documents, merge
from tidemark.operators.dedup import dedup_latest
from tidemark.schemas import SYNC_STATE
from tidemark.sources import bronze

STREAMS = {**V.PROFILE_STREAMS, **V.CRM_STREAMS}


def sync_stream(name: str, history: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append a batch of a declared stream; returns the raw history and its latest rows."""
    key, cursor = STREAMS[name]
    return merge.append_dedup(history, batch, key, cursor)


def extract_increment(source: DataFrame, state: DataFrame, name: str, mode: str = "files", as_of: str | None = None) -> DataFrame:
    """Changed documents of a collection since its mark, hashed, flattened and stamped."""
    _, cursor = STREAMS[name]
    return documents.extract_documents(merge.read_increment(source, state, name, cursor), name, mode, as_of)


def oldest_first(df: DataFrame, cursor: str) -> DataFrame:
    """Changes in the order they happened, for a consumer that needs that order."""
    return df.orderBy(cursor)


def page_rows(pages: DataFrame, schema: T.StructType | str, data_path: str = "data") -> DataFrame:
    """Typed rows of landed response pages."""
    records = bronze.explode_api_pages(pages.select("body"), data_path)
    return records.select(F.from_json("record", schema).alias("r")).select("r.*")


def _paths(spark: SparkSession, folder: str):
    Path = spark._jvm.org.apache.hadoop.fs.Path
    return Path, Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())


def _committed(spark: SparkSession, folder: str) -> list[str]:
    Path, fs = _paths(spark, folder)
    return sorted(s.getPath().getName() for s in fs.globStatus(Path(folder, "run=*")) or [])


def read_history(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """All rows of a stream's committed runs, or None before the first."""
    folder = f"{root}/{name}"
    if not _committed(spark, folder):
        return None
    return spark.read.option("mergeSchema", True).parquet(f"{folder}/run=*/rows")


def read_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The mark of a stream, from its last committed run."""
    folder = f"{root}/{name}"
    runs = _committed(spark, folder)
    return spark.read.schema(SYNC_STATE).parquet(f"{folder}/{runs[-1]}/mark") if runs else spark.createDataFrame([], SYNC_STATE)


def latest_rows(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The latest version of each key of a stream that has run."""
    key, cursor = STREAMS[name]
    return dedup_latest(read_history(spark, root, name), key, cursor)


def run_stream(name: str, source: DataFrame, root: str) -> str:
    """Take in what changed in ``source`` since the last run; returns the run's folder.

    Rows and the new mark are written beside each other to a hidden folder and become visible by one rename. A run that
    dies at any point before it leaves neither, so the next one takes the same rows; one that dies after it is
    done. Rows at the mark are read again, since more of them can have come, and those that are stored (same key and
    cursor) are left out. Rows without a cursor cannot be placed and are never taken. One run of a stream at a time: a
    second one fails when it finds its number taken.
    """
    key, cursor = STREAMS[name]
    spark, folder = source.sparkSession, f"{root}/{name}"
    state, stored = read_state(spark, root, name), read_history(spark, root, name)
    batch = merge.read_increment(source, state, name, cursor)
    if stored is not None:
        # Only rows at the mark can be stored already; the bound reaches the scan of the history.
        known = merge.read_increment(stored, state, name, cursor).select(F.col(key).alias("_key"), F.col(cursor).alias("_at"))
        batch = batch.join(known, F.col(key).eqNullSafe(F.col("_key")) & (F.col(cursor) == F.col("_at")), "left_anti")
    runs = _committed(spark, folder)
    target = f"run={int(runs[-1].split('=')[1]) + 1 if runs else 1:08d}"
    Path, fs = _paths(spark, folder)
    hidden = f"{folder}/.run-{uuid.uuid4().hex}"
    try:
        batch.write.parquet(f"{hidden}/rows")
        taken = spark.read.schema(batch.schema).parquet(f"{hidden}/rows")
        merge.advance_mark(state, name, taken, cursor).coalesce(1).write.parquet(f"{hidden}/mark")
        _commit(fs, Path(hidden), Path(folder, target))
    except BaseException:
        fs.delete(Path(hidden), True)
        raise
    return f"{folder}/{target}"


def _commit(fs, hidden, target) -> None:
    if fs.exists(target) or not fs.rename(hidden, target):
        raise OSError(f"cannot commit {target}")
