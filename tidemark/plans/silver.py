from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import values as V
from tidemark.functions import money, times, web
from tidemark.operators import dedup, events, quality
from tidemark.sources import bronze, sinks


def stateless(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Row-local part before deduplication; the same on a batch and on a stream."""
    return (
        df.transform(events.normalise_case)
        .transform(events.parse_timestamps)
        .transform(lambda d: events.filter_valid(d, as_of))
    )


def unique(valid: DataFrame) -> DataFrame:
    return dedup.dedup_first(valid, "event_id", "_ingested_at", ties=("event_ts", "event_type", "_source_file"))


def enrich(df: DataFrame, date: str | None, as_of: str | None = None) -> DataFrame:
    """Row-local part after deduplication."""
    return (
        df.transform(events.parse_urls)
        .transform(events.anonymise_ip)
        .transform(events.parse_revenue)
        .transform(lambda d: events.add_metadata(d, date, as_of=as_of))
    )


def silver_events(df: DataFrame, date: str, as_of: str | None = None) -> DataFrame:
    """Bronze events to Silver: clean, validate, first write per ``event_id``, enrich."""
    return enrich(unique(stateless(df, as_of)), date, as_of)


#: All that the reduced chain's output depends on, so that copies which tie give the same row.
LITE_TIES = (
    "_source_file", "event_timestamp", "event_type", "session_id", "user_id", "anonymous_id", "country_code", "device_type",
    "ip_address", "revenue",
)


def silver_events_lite(df: DataFrame, date: str, as_of: str | None = None) -> DataFrame:
    """Reduced chain: ISO times only, eight event types, no time window, one copy of an event, the same on each run."""
    cased = events.normalise_case(df).withColumn("event_ts", times.iso_timestamp(F.col("event_timestamp")))
    kept = (
        cased.withColumn("event_date", F.to_date("event_ts"))
        .filter(F.col("event_id").isNotNull() & F.col("event_type").isin(V.LITE_EVENT_TYPES))
        .filter(F.coalesce("user_id", "anonymous_id").isNotNull())
    )
    slim = dedup.dedup_first(kept, "event_id", "_ingested_at", ties=LITE_TIES).withColumns(
        {
            "ip_anonymized": web.mask_ip(F.col("ip_address")),
            "revenue_eur": money.revenue(F.col("revenue")),
        }
    )
    flagged = slim.withColumn("has_revenue", F.col("revenue_eur") > 0).drop("ip_address", "revenue")
    return events.add_metadata(flagged, date, version=None, as_of=as_of)


def run(
    spark: SparkSession,
    source: str,
    target: str,
    date: str,
    as_of: str | None = None,
    files: int | None = None,
    suite: Sequence | None = None,
) -> dict:
    """Daily Silver job: one read, one write, and a ``suite`` between writing and publishing.

    The row counts and the suite's row-level counters are observed on the way; unique keys are counted on the written
    key columns. If a critical check fails the job raises, the day stays as it was, and what was written goes. Otherwise
    ``checks`` holds the suite's results. (``bronze_count`` is taken before a shuffle: a task that is repeated after
    a loss can count twice there.)
    """
    seen, kept, watch = Observation("bronze"), Observation("silver"), quality.Watch(suite or ())
    checks: list[dict] = []
    raw = bronze.read_bronze(spark, source).observe(seen, F.count(F.lit(1)).alias("rows"))

    def watched(rows: DataFrame) -> DataFrame:
        return watch.on(rows.observe(kept, F.count(F.lit(1)).alias("rows")))

    def audit(written: DataFrame) -> None:
        checks.extend(r.asDict() for r in quality.audit(written, suite, watch))

    sinks.write_replace(silver_events(raw, date, as_of), target, date, files, watched, audit if suite else None)
    n_in, n_out = seen.get["rows"], kept.get["rows"]
    dropped = n_in - n_out
    return {
        "bronze_count": n_in,
        "silver_count": n_out,
        "dropped_count": dropped,
        "drop_pct": round(100 * dropped / max(n_in, 1), 1),
        "checks": checks,
    }
