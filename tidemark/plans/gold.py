from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import aggregates as agg
from tidemark.sources import silver, sinks

_NEEDED = [
    "event_id", "event_type", "event_ts", "session_id", "user_id", "country_code", "device_type",
    "referrer_channel", "page_path", "has_revenue", "properties",
]


def gold_tables(events: DataFrame, orders: DataFrame, date: str, as_of: str | None = None) -> dict[str, DataFrame]:
    return {
        "gold_daily_sales": agg.daily_sales(events, orders, date, as_of),
        "gold_funnel_metrics": agg.funnel_metrics(events, date, as_of),
        "gold_product_performance": agg.product_performance(events, orders, date, as_of),
        "gold_session_stats": agg.session_stats(events, date, as_of),
    }


def run(spark: SparkSession, events_path: str, orders_path: str, out: str, date: str, as_of: str | None = None) -> DataFrame:
    """Daily Gold job: each table is computed once, published, and counted from what was written.

    Only the columns the four tables use are kept, on memory and disk, so a lost executor costs a re-read, not the job.
    """
    events = silver.read_silver_events(spark, events_path, date).select(*_NEEDED).persist(StorageLevel.MEMORY_AND_DISK)
    orders = silver.read_silver_orders(spark, orders_path, date)
    try:
        for name, table in gold_tables(events, orders, date, as_of).items():
            sinks.publish_gold(table, f"{out}/{name}", date)
            sinks.publish_staging(sinks.read_day(spark, f"{out}/{name}", date), f"{out}/staging", name)
    finally:
        events.unpersist()
    names = ["gold_daily_sales", "gold_funnel_metrics", "gold_product_performance", "gold_session_stats"]
    return agg.gold_counts({n: sinks.read_day(spark, f"{out}/{n}", date) for n in names})
