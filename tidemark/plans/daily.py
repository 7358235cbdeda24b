"""One day's work in dependency order. Scheduling and retries belong to the caller."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.plans import gold, models, silver
from tidemark.sources import bronze, sinks
from tidemark.sources import silver as silver_source


@dataclass(frozen=True)
class Paths:
    bronze_events: str
    silver_events: str
    silver_orders: str
    gold: str
    #: Where staging and marts go, and the raw tables that they are made of; without them a day ends after Gold.
    models: str | None = None
    raw: models.Raw | None = None


class LandingTooSmall(RuntimeError):
    """The day's landing is below its expected volume."""


class GateFailed(RuntimeError):
    """The daily quality gate returned failing rows."""


def run_day(
    spark: SparkSession,
    paths: Paths,
    date: str,
    as_of: str | None = None,
    min_files: int | None = None,
    min_bytes: int | None = None,
    min_orders: int | None = None,
    suite: Sequence | None = None,
) -> DataFrame:
    """Landing check, Silver with its suite, quality gate, Gold, then staging, marts and model tests. Returns the row
    counts of the Gold tables; the results of the model tests are written to ``_checks`` beside the models.

    Silver is published only if the critical checks of ``suite`` (by default the Silver contract) hold.
    """
    limits = {k: v for k, v in {"min_files": min_files, "min_bytes": min_bytes}.items() if v is not None}
    landing = bronze.landing_volume(spark, paths.bronze_events, **limits).first()
    if not landing["passed"]:
        raise LandingTooSmall(f"{landing['files']} files, {landing['bytes']} bytes for {date}")
    silver.run(spark, paths.bronze_events, paths.silver_events, date, as_of, suite=quality.silver_suite(as_of) if suite is None else suite)
    events = silver_source.read_silver_events(spark, paths.silver_events, date)
    orders = silver_source.read_silver_orders(spark, paths.silver_orders, date)
    gate = quality.quality_gate(events, orders, date, *([min_orders] if min_orders is not None else []))
    failing = gate.take(3)  # the gate has three checks
    if failing:
        raise GateFailed(", ".join(f"{r['check_name']}={r['failing_rows']}" for r in failing))
    counts = gold.run(spark, paths.silver_events, paths.silver_orders, paths.gold, date, as_of)
    if paths.models and paths.raw:
        report = models.run(spark, paths.raw, paths.silver_events, paths.models, date, as_of)
        sinks.publish_gold(report.withColumn("report_date", F.lit(date)), f"{paths.models}/_checks", date)
    return counts
