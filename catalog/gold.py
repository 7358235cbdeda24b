"""Gold aggregates: D1, E1-E8, E11, B33, B34, I13."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views
from catalog.events import silver_events
from catalog.registry import AS_OF, DATE, fix, query
from catalog.views_sql import day, fixed, rate, ts
from tidemark.operators import aggregates, joins
from tidemark.plans import gold

STAMP = "'2024-01-29' AS report_date"


def unstamped(df):
    return df.drop("_gold_processed_at")


@query(
    "d1_attribution",
    f"""SELECT o.order_id, o.session_id, {day('o.order_date')} AS order_date, o.revenue_eur, o.is_first_order,
      s.country_code, s.device_type, s.referrer_channel, s.user_id
    FROM silver_orders o LEFT JOIN session_starts s ON o.session_id = s.session_id""",
)
def _(spark, sf):
    orders = views.silver_orders(spark, sf).drop("line_items")
    return joins.attribute_orders(orders, silver_events(spark, sf))


SALES_SQL = f"""
SELECT country_code, device_type, referrer_channel, total_orders, unique_buyers, {fixed('revenue', 2)} AS total_revenue_eur,
  {fixed('revenue / total_orders', 4)} AS avg_order_value_eur, median_order_value_eur, new_customer_orders, returning_customer_orders,
  {rate('new_customer_orders', 'total_orders')} AS new_customer_rate, {STAMP}
FROM (SELECT s.country_code, s.device_type, s.referrer_channel, count(*) AS total_orders, count(DISTINCT s.user_id) AS unique_buyers,
    sum(o.revenue_eur) AS revenue, quantile_disc(o.revenue_eur, 0.5) AS median_order_value_eur,
    count(*) FILTER (o.is_first_order) AS new_customer_orders, count(*) FILTER (NOT o.is_first_order) AS returning_customer_orders
  FROM silver_orders o LEFT JOIN session_starts s ON o.session_id = s.session_id
  GROUP BY s.country_code, s.device_type, s.referrer_channel)
"""


@query("e1_daily_sales", SALES_SQL)
def _(spark, sf):
    sales = aggregates.daily_sales(silver_events(spark, sf), views.silver_orders(spark, sf), DATE, AS_OF)
    return unstamped(fix(sales, total_revenue_eur=2, avg_order_value_eur=4))


SESSION_FUNNEL_SQL = """
SELECT session_id, country_code, device_type,
  CAST(bool_or(event_type = 'product_view') AS INTEGER) AS reached_product_view,
  CAST(bool_or(event_type = 'add_to_cart') AS INTEGER) AS reached_add_to_cart,
  CAST(bool_or(event_type = 'checkout_start') AS INTEGER) AS reached_checkout_start,
  CAST(bool_or(event_type = 'purchase') AS INTEGER) AS reached_purchase
FROM silver_events WHERE event_type IN ('product_view', 'add_to_cart', 'checkout_start', 'purchase')
GROUP BY session_id, country_code, device_type
"""


@query("e2_session_funnel", SESSION_FUNNEL_SQL)
def _(spark, sf):
    return aggregates.session_funnel(silver_events(spark, sf))


FUNNEL_SQL = f"""
SELECT country_code, device_type, total_sessions, v AS sessions_product_view, c AS sessions_add_to_cart, k AS sessions_checkout_start,
  p AS sessions_purchase, {rate('c', 'v')} AS view_to_cart_rate, {rate('k', 'c')} AS cart_to_checkout_rate,
  {rate('p', 'k')} AS checkout_to_purchase_rate, {rate('p', 'total_sessions')} AS overall_conversion_rate, {STAMP}
FROM (SELECT country_code, device_type, count(session_id) AS total_sessions, CAST(sum(reached_product_view) AS BIGINT) AS v,
    CAST(sum(reached_add_to_cart) AS BIGINT) AS c, CAST(sum(reached_checkout_start) AS BIGINT) AS k,
    CAST(sum(reached_purchase) AS BIGINT) AS p FROM ({SESSION_FUNNEL_SQL}) GROUP BY country_code, device_type)
"""


def funnel(spark, sf):
    return unstamped(aggregates.funnel_metrics(silver_events(spark, sf), DATE, AS_OF))


query("e3_funnel", FUNNEL_SQL)(funnel)

ENGAGEMENT_SQL = """
SELECT product_id, count(*) FILTER (event_type = 'product_view') AS views,
  count(*) FILTER (event_type = 'add_to_cart') AS add_to_cart_events,
  count(DISTINCT CASE WHEN event_type = 'product_view' THEN user_id END) AS unique_viewers
FROM (SELECT *, json_extract_string(properties, '$.product_id') AS product_id FROM silver_events)
WHERE product_id IS NOT NULL AND event_type IN ('product_view', 'add_to_cart') GROUP BY product_id
"""
REVENUE_SQL = f"""
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold, {fixed('sum(quantity * unit_price_eur)', 2)} AS product_revenue_eur
FROM silver_order_lines GROUP BY product_id
"""


@query("e4_engagement", ENGAGEMENT_SQL)
def _(spark, sf):
    return aggregates.product_engagement(silver_events(spark, sf))


@query("b33_explode_lines", "SELECT order_id, product_id, quantity, unit_price_eur, quantity * unit_price_eur AS item_revenue_eur FROM silver_order_lines")
def _(spark, sf):
    return joins.explode_lines(views.silver_orders(spark, sf))


@query("e5_product_revenue", REVENUE_SQL)
def _(spark, sf):
    return fix(aggregates.product_revenue(views.silver_orders(spark, sf)), product_revenue_eur=2)


@query(
    "e6_product_performance",
    f"""SELECT product_id, views, add_to_cart_events, unique_viewers, units_sold, product_revenue_eur,
      {rate('add_to_cart_events', 'views')} AS add_to_cart_rate, {rate('units_sold', 'unique_viewers')} AS purchase_rate, {STAMP}
    FROM ({ENGAGEMENT_SQL}) LEFT JOIN ({REVENUE_SQL}) USING (product_id)""",
)
def _(spark, sf):
    out = aggregates.product_performance(silver_events(spark, sf), views.silver_orders(spark, sf), DATE, AS_OF)
    return unstamped(fix(out, product_revenue_eur=2))


@query(
    "e7_session_rollup",
    f"""SELECT session_id, country_code, device_type, referrer_channel, {ts('session_start')} AS session_start,
      {ts('session_end')} AS session_end, event_count, unique_pages, has_purchase, duration_s, is_bounce FROM session_rolls""",
)
def _(spark, sf):
    return aggregates.session_rollup(silver_events(spark, sf))


def stats_sql(source: str) -> str:
    return f"""SELECT country_code, device_type, referrer_channel, count(session_id) AS total_sessions,
      {fixed('avg(duration_s)', 4)} AS avg_session_duration_s, {fixed('avg(unique_pages)', 4)} AS avg_pages_per_session,
      {fixed('avg(event_count)', 4)} AS avg_events_per_session, {fixed('avg(CAST(is_bounce AS INTEGER))', 4)} AS bounce_rate,
      CAST(sum(has_purchase) AS BIGINT) AS sessions_with_purchase, {STAMP} FROM {source} GROUP BY country_code, device_type, referrer_channel"""


def _stats(df):
    return unstamped(
        fix(df, avg_session_duration_s=4, avg_pages_per_session=4, avg_events_per_session=4, bounce_rate=4)
    )


@query("e8_session_stats", stats_sql("session_rolls"))
def _(spark, sf):
    return _stats(aggregates.session_stats(silver_events(spark, sf), DATE, AS_OF))


ONE_CHANNEL_SQL = """(SELECT session_id, country_code, device_type, referrer_channel, count(*) AS event_count,
    count(DISTINCT page_path) AS unique_pages, CAST(max(CASE WHEN has_revenue THEN 1 ELSE 0 END) AS INTEGER) AS has_purchase,
    CAST(floor(epoch(max(event_ts))) - floor(epoch(min(event_ts))) AS BIGINT) AS duration_s,
    count(DISTINCT page_path) = 1 AND floor(epoch(max(event_ts))) - floor(epoch(min(event_ts))) < 30 AS is_bounce
  FROM (SELECT * REPLACE (CASE WHEN session_id IS NULL THEN referrer_channel ELSE first_value(referrer_channel) OVER
      (PARTITION BY session_id ORDER BY event_ts, event_id) END AS referrer_channel) FROM silver_events)
  GROUP BY session_id, country_code, device_type, referrer_channel)"""


@query("e8_session_stats_one_channel", stats_sql(ONE_CHANNEL_SQL))
def _(spark, sf):
    return _stats(aggregates.session_stats(silver_events(spark, sf), DATE, AS_OF, one_channel=True))


@query(
    "e11_counts",
    f"""SELECT 'gold_daily_sales' AS table_name, count(*) AS row_count FROM ({SALES_SQL})
    UNION ALL SELECT 'gold_funnel_metrics', count(*) FROM ({FUNNEL_SQL})
    UNION ALL SELECT 'gold_product_performance', count(*) FROM ({ENGAGEMENT_SQL})
    UNION ALL SELECT 'gold_session_stats', count(*) FROM ({stats_sql('session_rolls')})""",
)
def _(spark, sf):
    return aggregates.gold_counts(gold.gold_tables(silver_events(spark, sf), views.silver_orders(spark, sf), DATE, AS_OF))


@query(
    "b34_stamp_gold",
    f"SELECT order_id, {STAMP}, '2024-01-30 00:00:00.000000' AS _gold_processed_at FROM silver_orders",
)
def _(spark, sf):
    return aggregates.stamp_gold(views.silver_orders(spark, sf).select("order_id"), DATE, AS_OF).select(
        "order_id", "report_date", "_gold_processed_at"
    )
