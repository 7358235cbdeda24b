"""Gold aggregates.

Every aggregate is partial before its shuffle, including the distinct counts, so a hot
country, session or product arrives as a few rows per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import values as V
from tidemark.functions import money, text, times
from tidemark.operators import joins, quantiles
from tidemark.session import written


def _flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def stamp_gold(df: DataFrame, date: str, as_of: str | None = None) -> DataFrame:
    return df.withColumns({"report_date": F.lit(date), "_gold_processed_at": times.moment(as_of)})


def daily_sales(events: DataFrame, orders: DataFrame, date: str, as_of: str | None = None, exact_median: bool = True) -> DataFrame:
    """Order value and buyer mix by country, device and channel of the order's session.

    The median is exact in groups of any size, for one more read of the attributed orders, which are written for it.
    Without ``exact_median`` it has a rank error of at most 1 in ``MEDIAN_ACCURACY`` rows and costs nothing.
    """
    groups, first, amount = ["country_code", "device_type", "referrer_channel"], F.col("is_first_order"), F.col("revenue_eur")
    attributed = joins.attribute_orders(orders.select("order_id", "session_id", "revenue_eur", "is_first_order"), events)
    if exact_median:
        attributed = written(attributed.drop("session_id"), "attributed-orders")
    median = F.percentile_approx(amount, 0.5, V.MEDIAN_ACCURACY)
    sales = attributed.groupBy(*groups).agg(
        F.count("order_id").alias("total_orders"),
        F.count_distinct("user_id").alias("unique_buyers"),
        F.sum(amount).alias("total_revenue_eur"),
        F.avg(amount).alias("avg_order_value_eur"),
        *([] if exact_median else [median.alias("median_order_value_eur")]),
        F.sum(_flag(first)).alias("new_customer_orders"),
        F.sum(_flag(~first)).alias("returning_customer_orders"),
    )
    if exact_median:
        medians = quantiles.exact_quantile(attributed, groups, "revenue_eur", "median_order_value_eur")
        same = [sales[g].eqNullSafe(medians[g]) for g in groups]
        sales = sales.join(medians, same, "left").select(*[sales[c] for c in sales.columns], "median_order_value_eur")
    rated = sales.withColumn("new_customer_rate", money.share(F.col("new_customer_orders"), F.col("total_orders")))
    return stamp_gold(rated, date, as_of)


def session_funnel(events: DataFrame) -> DataFrame:
    """One row per session with a 0/1 flag for each funnel step it reached."""
    step = F.col("event_type")
    return (
        events.filter(step.isin(V.FUNNEL_STEPS))
        .groupBy("session_id", "country_code", "device_type")
        .agg(*[F.max(_flag(step == s)).alias(f"reached_{s}") for s in V.FUNNEL_STEPS])
    )


def funnel_metrics(events: DataFrame, date: str, as_of: str | None = None) -> DataFrame:
    """Sessions per funnel step and step-to-step rates by country and device."""
    view, cart, checkout, purchase = [f"sessions_{s}" for s in V.FUNNEL_STEPS]
    steps = [F.sum(f"reached_{s}").alias(f"sessions_{s}") for s in V.FUNNEL_STEPS]
    counted = (
        session_funnel(events)
        .groupBy("country_code", "device_type")
        .agg(F.count("session_id").alias("total_sessions"), *steps)
    )
    rates = {
        "view_to_cart_rate": (cart, view),
        "cart_to_checkout_rate": (checkout, cart),
        "checkout_to_purchase_rate": (purchase, checkout),
        "overall_conversion_rate": (purchase, "total_sessions"),
    }
    rated = counted.withColumns({name: money.share(F.col(a), F.col(b)) for name, (a, b) in rates.items()})
    return stamp_gold(rated, date, as_of)


def product_engagement(events: DataFrame) -> DataFrame:
    """Views, cart additions and distinct viewers per product named in the event payload."""
    view, cart = V.FUNNEL_STEPS[:2]
    kind = F.col("event_type")
    named = events.filter(kind.isin(view, cart)).select(
        kind, "user_id", text.json_field(F.col("properties"), "product_id").alias("product_id")
    )
    return (
        named.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count_if(kind == view).alias("views"),
            F.count_if(kind == cart).alias("add_to_cart_events"),
            F.count_distinct(F.when(kind == view, F.col("user_id"))).alias("unique_viewers"),
        )
    )


def product_revenue(orders: DataFrame) -> DataFrame:
    return (
        joins.explode_lines(orders)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units_sold"), F.sum("item_revenue_eur").alias("product_revenue_eur"))
    )


def product_performance(events: DataFrame, orders: DataFrame, date: str, as_of: str | None = None) -> DataFrame:
    """Engagement with revenue. Products sold without any view or cart event are not listed."""
    both = product_engagement(events).join(product_revenue(orders), "product_id", "left")
    rated = both.withColumns(
        {
            "add_to_cart_rate": money.share(F.col("add_to_cart_events"), F.col("views")),
            "purchase_rate": money.share(F.col("units_sold"), F.col("unique_viewers")),
        }
    )
    return stamp_gold(rated, date, as_of)


def first_channel(events: DataFrame) -> DataFrame:
    """Give all events of a session the channel of its first event.

    Session firsts come from a partial aggregate and are joined back, so no session is gathered in a window.
    """
    firsts = (
        events.filter(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(F.min_by("referrer_channel", F.struct("event_ts", "event_id")).alias("_channel"))
    )
    joined = joins.lookup(events, firsts, "session_id", spread_by="event_id")
    return joined.withColumn("referrer_channel", F.coalesce("_channel", "referrer_channel")).drop("_channel")


def session_rollup(events: DataFrame, one_channel: bool = False) -> DataFrame:
    """Start, end, depth, duration and bounce flag of each session.

    A visit that changes channel counts once per channel; ``one_channel`` keeps it whole.
    """
    source = first_channel(events) if one_channel else events
    rolled = source.groupBy("session_id", "country_code", "device_type", "referrer_channel").agg(
        F.min("event_ts").alias("session_start"),
        F.max("event_ts").alias("session_end"),
        F.count("*").alias("event_count"),
        F.count_distinct("page_path").alias("unique_pages"),
        F.max(_flag(F.col("has_revenue"))).alias("has_purchase"),
    )
    seconds = F.unix_timestamp("session_end") - F.unix_timestamp("session_start")
    return rolled.withColumn("duration_s", seconds).withColumn(
        "is_bounce", (F.col("unique_pages") == 1) & (F.col("duration_s") < V.BOUNCE_SECONDS)
    )


def session_stats(events: DataFrame, date: str, as_of: str | None = None, one_channel: bool = False) -> DataFrame:
    means = {
        "avg_session_duration_s": "duration_s",
        "avg_pages_per_session": "unique_pages",
        "avg_events_per_session": "event_count",
    }
    stats = (
        session_rollup(events, one_channel)
        .groupBy("country_code", "device_type", "referrer_channel")
        .agg(
            F.count("session_id").alias("total_sessions"),
            *[F.avg(c).alias(name) for name, c in means.items()],
            F.avg(F.col("is_bounce").cast("int")).alias("bounce_rate"),
            F.sum("has_purchase").alias("sessions_with_purchase"),
        )
    )
    return stamp_gold(stats, date, as_of)


def event_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_type", "country_code", "device_type").agg(
        F.count("*").alias("event_count"),
        F.sum("revenue_eur").alias("total_revenue_eur"),
        F.count_distinct("user_id").alias("unique_users"),
    )


def top_events(summary: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent groups; equal counts are ordered by the group itself."""
    return summary.orderBy(F.col("event_count").desc(), "event_type", "country_code", "device_type").limit(n)


def gold_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table, as one job."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
