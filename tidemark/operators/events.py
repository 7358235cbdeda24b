"""Clickstream cleaning steps, Bronze to Silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import values as V
from tidemark.functions import money, text, times, web

_LOWERED = ("event_type", "device_type", "os", "browser")
_UPPERED = ("country_code",)


def normalise_case(df: DataFrame) -> DataFrame:
    fixed = {c: text.lowered(F.col(c)) for c in _LOWERED if c in df.columns}
    fixed |= {c: text.uppered(F.col(c)) for c in _UPPERED if c in df.columns}
    return df.withColumns(fixed)


def parse_timestamps(df: DataFrame) -> DataFrame:
    stamped = df.withColumn("event_ts", times.event_timestamp(F.col("event_timestamp")))
    return stamped.withColumn("event_date", F.to_date("event_ts"))


def validity_rules(as_of: str | None = None) -> dict[str, Column]:
    """Rule name to a condition that is true, never null, for a good event."""
    ts = F.col("event_ts")
    rules = {
        "missing_event_id": F.length("event_id") > 0,
        "unreadable_timestamp": ts.isNotNull(),
        "unknown_event_type": F.col("event_type").isin(V.EVENT_TYPES),
        "no_visitor": F.coalesce("user_id", "anonymous_id").isNotNull(),
        "before_first_day": ts.isNull() | (ts >= F.lit(V.EARLIEST_EVENT).cast("timestamp")),
        "in_the_future": ts.isNull() | (ts <= times.moment(as_of)),
    }
    return {name: F.coalesce(ok, F.lit(False)) for name, ok in rules.items()}


def filter_valid(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Keep rows that meet all validity rules.

    Written as plain comparisons, cheap ones first: the id test reaches the Parquet scan, and the
    time range alone also drops unreadable times, so the parse is not repeated per rule.
    """
    first, last = F.lit(V.EARLIEST_EVENT).cast("timestamp"), times.moment(as_of)
    return df.filter(
        (F.col("event_id") != "")
        & F.coalesce("user_id", "anonymous_id").isNotNull()
        & F.col("event_type").isin(V.EVENT_TYPES)
        & F.col("event_ts").between(first, last)
    )


def audit_rejections(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rows rejected per rule, all rules in one pass; a row may break several."""
    rules = validity_rules(as_of)
    counted = df.agg(F.count("*").alias("_rows"), *[F.count_if(~ok).alias(n) for n, ok in rules.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in rules)
    return counted.select("_rows", F.expr(f"stack({len(rules)}, {pairs}) AS (rule, rejected)")).select(
        "rule", "rejected", F.col("_rows").alias("checked")
    )


def run_metrics(before: DataFrame, after: DataFrame) -> DataFrame:
    """Input, output, dropped rows and drop share of a step, as one row."""
    sizes = before.agg(F.count("*").alias("n_in"), F.lit(0).cast("bigint").alias("n_out")).unionAll(
        after.agg(F.lit(0).cast("bigint"), F.count("*"))
    )
    totals = sizes.agg(F.sum("n_in").alias("input_rows"), F.sum("n_out").alias("output_rows"))
    dropped = F.col("input_rows") - F.col("output_rows")
    return totals.withColumn("dropped_rows", dropped).withColumn(
        "drop_pct", F.round(100 * F.col("dropped_rows") / F.greatest("input_rows", F.lit(1)), 1)
    )


def parse_urls(df: DataFrame) -> DataFrame:
    page, referrer = F.col("page_url"), F.coalesce(F.col("referrer_url"), F.lit(""))
    hosts = df.withColumns(
        {"page_domain": web.url_host(page), "page_path": web.url_path(page), "referrer_domain": web.url_host(referrer)}
    )
    channel = web.referrer_channel(F.col("referrer_domain"), F.col("page_domain"))
    return hosts.withColumn("referrer_channel", channel)


def anonymise_ip(df: DataFrame) -> DataFrame:
    return df.withColumn("ip_anonymized", web.mask_ip(F.col("ip_address"))).drop("ip_address")


def parse_revenue(df: DataFrame) -> DataFrame:
    priced = df.withColumn("revenue_eur", money.revenue(F.col("revenue"))).drop("revenue")
    return priced.withColumn("has_revenue", F.col("revenue_eur") > 0)


def add_metadata(
    df: DataFrame, date: str | None, version: str | None = V.SILVER_VERSION, as_of: str | None = None
) -> DataFrame:
    """Without a date the day of processing is taken, in a stream that of each batch."""
    moment = times.moment(as_of)
    stamps = {"_silver_processed_at": moment, "_processing_date": F.lit(date) if date else F.date_format(moment, "yyyy-MM-dd")}
    if version is not None:
        stamps["_silver_version"] = F.lit(version)
    return df.withColumns(stamps)
