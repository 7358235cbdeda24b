"""Table writes. All are safe to repeat.

A day or table is replaced by writing a new folder beside it and switching the two once the write succeeded: a failed
run leaves the old rows readable, and so does an audit of the new folder that raises. Readers that list files see the old or the new rows, or for the moment between
two renames (not atomic on an object store) no folder; what a crash leaves there starts with a dot and is not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.dedup import dedup_latest
from tidemark.session import cleaned, written

#: Rows of a day that one task of a merge writes, about.
_PIECE = 1_000_000


def _switch(spark: SparkSession, folder: str, write: Callable[[str], None], audit: Callable[[str], None] | None = None) -> None:
    """``write`` to a hidden folder beside ``folder``, ``audit`` what was written, then put it in its place."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    target = Path(folder)
    tag = uuid.uuid4().hex
    fresh, stale = (Path(target.getParent(), f".{kind}-{target.getName()}-{tag}") for kind in ("new", "old"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        with cleaned(spark):
            write(fresh.toString())
        if audit:
            audit(fresh.toString())
    except BaseException:
        fs.delete(fresh, True)
        raise
    if fs.exists(target) and not fs.rename(target, stale):
        raise OSError(f"cannot move {folder} aside")
    if not fs.rename(fresh, target):
        fs.rename(stale, target)
        raise OSError(f"cannot put the new rows at {folder}")
    fs.delete(stale, True)
    spark.catalog.refreshByPath(folder)


def write_replace(
    df: DataFrame,
    path: str,
    date: str,
    files: int | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
    audit: Callable[[DataFrame], None] | None = None,
) -> None:
    """Replace exactly the rows of one processing day.

    ``watch`` may observe the rows as they are written. ``audit`` gets the written rows before anybody else can
    read them; if it raises, the day stays as it was.

    The day is the leading folder and is overwritten as a whole, so a smaller rerun leaves no
    stale files. Rows are gathered by event date and type before writing: by default AQE
    sizes the write tasks and splits the large types; ``files`` is the largest number of files of a date and type
    instead: a hash of the event cuts a type into as many pieces, and each piece is written by one task. The number
    of tasks goes with the session's shuffle partitions, so that what one task reads does not grow with the table.
    """
    spread = ["event_date", "event_type"]
    if files is None:
        laid_out = df.hint("rebalance", *spread)
    else:
        laid_out = df.repartition(*spread, F.pmod(F.xxhash64("event_id"), F.lit(files)))
    laid_out = watch(laid_out) if watch else laid_out
    days = laid_out.drop("_processing_date").write.partitionBy(*spread)

    def audited(fresh: str) -> None:
        audit(df.sparkSession.read.schema(df.schema).parquet(fresh))

    _switch(df.sparkSession, f"{path}/_processing_date={date}", days.parquet, audited if audit else None)


def _folder_name(day: str, value) -> str:
    return f"{day}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def read_days(spark: SparkSession, path: str, day: str) -> DataFrame | None:
    """A table of day folders, or None if it has none yet."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, f"{day}=*"))
    return spark.read.parquet(path).withColumn(day, F.col(day).cast("date")) if found else None


def _once_per_key(rows: DataFrame, key: str) -> tuple[DataFrame, bool]:
    """``rows`` (read from files) with one row per key, the first by the other columns, and whether any had to go.

    Hashes of the keys show which may repeat; only rows with such a hash are ordered.
    """
    hashed = rows.withColumn("_hash", F.when(F.col(key).isNotNull(), F.xxhash64(key)))
    many = hashed.filter("_hash IS NOT NULL").groupBy("_hash").agg(F.count("*").alias("n")).filter("n > 1").select("_hash")
    many = written(many, "repeated")
    if many.isEmpty():
        return rows, False
    first = written(dedup_latest(hashed.join(many, "_hash", "left_semi").select(*rows.columns), key, []), "first")
    return hashed.join(many, "_hash", "left_anti").select(*rows.columns).unionByName(first), True


def _per_day(rows: DataFrame, day: str) -> dict:
    """Rows per day; days, not rows, go to the driver."""
    return {r[0]: r[1] for r in rows.groupBy(day).agg(F.count("*").alias("n")).collect()}


def _folded(stored: DataFrame, fresh: DataFrame, moved: DataFrame, key: str, day: str, counts: dict) -> DataFrame:
    """Stored rows whose key is neither fresh in their day nor ``moved`` away from it, and all fresh rows.

    All meet in the one shuffle that lays the days out: a day is cut by key into pieces of ``_PIECE`` rows, and within
    a piece a key's fresh row or its mark comes before the stored one. Rows without a key hide nothing.
    """
    spark, columns = fresh.sparkSession, stored.columns
    keyed, content = F.col(key).isNotNull(), F.xxhash64(*[F.col(f"`{f.name}`") for f in fresh.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()])
    both = stored.withColumn("_age", F.when(keyed, 1).otherwise(0)).unionByName(fresh.withColumn("_age", F.lit(0)), allowMissingColumns=True)
    new = [c for c in both.columns if c not in columns and c != "_age"]
    both = both.withColumn("_mark", F.lit(False)).unionByName(moved.withColumns({"_age": F.lit(0), "_mark": F.lit(True)}), allowMissingColumns=True)
    pieces = [(d, n // _PIECE + 1) for d, n in counts.items()]
    cuts = spark.createDataFrame(pieces, f"_day {both.schema[day].dataType.simpleString()}, _cuts bigint")
    # Rows without a key are spread by their content.
    both = both.withColumn("_id", F.when(keyed, F.xxhash64(key)).otherwise(content))
    both = both.join(F.broadcast(cuts), F.col(day).eqNullSafe(F.col("_day")), "left")
    laid = both.withColumn("_piece", F.pmod("_id", "_cuts")).drop("_day", "_cuts").repartition(day, "_piece")
    seen = Window.partitionBy(day, "_piece", "_id", key).orderBy("_age")
    return laid.withColumn("_place", F.rank().over(seen)).filter("_place = 1 AND NOT _mark").select(key, *[c for c in columns if c != key], *new)


def merge_days(rows: DataFrame, path: str, key: str, day: str, audit: Callable[[DataFrame], None] | None = None) -> list:
    """Fold ``rows`` into a table of day folders by a unique ``key``; returns the days that were rewritten.

    A row takes the place of the stored one with its key, also if that stands in another day. To find it, only the
    key column of the table is read; only the days that gain or lose rows are read whole and written, in one job and
    with one shuffle of whole rows. The first merge lays its rows out by day where they are written.
    Of rows with one key the first by the other columns counts; rows without a key match nothing and are added, so
    give none if the merge is to be repeatable.

    ``audit`` gets the rewritten days before anybody can read them. Then the days are switched one by one, those that
    gain rows first: a crash in between leaves a moved row twice, never lost, and the repeated merge removes it from
    every day but its own.
    """
    spark = rows.sparkSession
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    tag = uuid.uuid4().hex
    hidden, first, taken = (f"{path}/.{kind}-{tag}" for kind in ("merge", "first", "increment"))
    stored = read_days(spark, path, day)
    if stored is not None and (missing := set(stored.columns) - set(rows.columns)):
        raise ValueError(f"the stored table has columns that the rows lack: {sorted(missing)}")
    try:
        if stored is None:
            with cleaned(spark):
                rows.hint("rebalance", day).write.partitionBy(day).parquet(first)
            increment = spark.read.schema(rows.schema).parquet(first).select(*rows.columns)
        else:
            with cleaned(spark):
                rows.write.parquet(taken)
            increment = spark.read.schema(rows.schema).parquet(taken)
        fresh, repeated = _once_per_key(increment, key)
        counts = _per_day(fresh, day)
        gained, lost = list(counts), []
        merged = fresh
        if stored is not None:
            places = stored.select(key, day).join(fresh.select(key, F.col(day).alias("_to")), key)
            moved = written(places.filter(~F.col(day).eqNullSafe(F.col("_to"))).select(key, day), "moved")
            lost = [d for d in _per_day(moved, day) if d not in counts]
            named = [d for d in (*gained, *lost) if d is not None]
            touched = F.col(day).isin(named) if named else F.lit(False)
            touched = touched | F.col(day).isNull() if None in gained or None in lost else touched
            for d, n in _per_day(stored.filter(touched), day).items():
                counts[d] = counts.get(d, 0) + n
            merged = _folded(stored.filter(touched), fresh, moved, key, day, counts)
        if not gained and not lost:
            return []
        if stored is None and not repeated:
            hidden, first = first, hidden
        else:
            laid = merged if stored is not None else merged.hint("rebalance", day)
            with cleaned(spark):
                laid.write.partitionBy(day).parquet(hidden)
        if audit:
            audit(spark.read.schema(merged.schema).parquet(hidden))
        for value in (*gained, *lost):
            name = _folder_name(day, value)
            new, target, old = Path(hidden, name), Path(path, name), Path(hidden, f".old-{name}")
            stands = fs.exists(target)
            if stands:
                _move(fs, target, old)
            # A day whose last rows moved to other days has no new folder.
            if fs.exists(new):
                try:
                    _move(fs, new, target)
                except BaseException:
                    if stands:
                        _move(fs, old, target)
                    raise
    finally:
        for folder in (hidden, first, taken):
            fs.delete(Path(folder), True)
    spark.catalog.refreshByPath(path)
    return [*gained, *lost]


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"cannot move {source} to {target}")


def publish_gold(df: DataFrame, path: str, date: str) -> None:
    """Replace one report day; other days stay. An empty result leaves an empty day, not the rows of an earlier run."""
    _switch(df.sparkSession, f"{path}/report_date={date}", df.drop("report_date").write.parquet)


def read_day(spark: SparkSession, path: str, date: str) -> DataFrame:
    """One report day of a published table, from its own folder."""
    day = spark.read.option("basePath", path).parquet(f"{path}/report_date={date}")
    return day.withColumn("report_date", F.col("report_date").cast("string"))


def publish_table(
    df: DataFrame, path: str, watch: Callable[[DataFrame], DataFrame] | None = None, audit: Callable[[DataFrame], None] | None = None
) -> None:
    """Replace a whole table; ``watch`` and ``audit`` as in ``write_replace``."""
    def audited(fresh: str) -> None:
        audit(df.sparkSession.read.schema(df.schema).parquet(fresh))

    rows = watch(df) if watch else df
    _switch(df.sparkSession, path, rows.write.parquet, audited if audit else None)


def publish_staging(df: DataFrame, root: str, name: str, jdbc: dict | None = None) -> None:
    """Full overwrite of ``STG_<NAME>``: a folder, or a warehouse table with ``jdbc`` options."""
    table = f"STG_{name.upper()}"
    if jdbc:
        df.write.format("jdbc").options(**jdbc, dbtable=table).mode("overwrite").save()
    else:
        _switch(df.sparkSession, f"{root}/{table}", df.write.parquet)


def write_checked(checked: DataFrame, path: str) -> None:
    """Rows with their ``violations`` in one pass and one write, under ``_verdict=valid`` and ``_verdict=quarantine``."""
    verdict = F.when(F.col("violations").isNull(), "valid").otherwise("quarantine")
    checked.withColumn("_verdict", verdict).write.mode("overwrite").partitionBy("_verdict").parquet(path)


def write_clustered(df: DataFrame, path: str, cols: Sequence[str], spread_by: str, files: int | None = None) -> None:
    """Range-ordered files, so that file statistics prune scans on ``cols``.

    Ranges are cut on ``cols`` and then on a hash of ``spread_by``: one value that holds a third of
    the rows is cut into several files instead of one.
    """
    keys = [*[F.col(c) for c in cols], F.xxhash64(spread_by)]
    ranged = df.repartitionByRange(*keys) if files is None else df.repartitionByRange(files, *keys)
    ranged.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)
