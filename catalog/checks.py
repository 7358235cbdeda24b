"""Quality checks: J2-J13, H1. Inputs hold both passing and failing rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import stars, views
from catalog.events import silver_events, valid_events
from catalog.registry import AS_OF, query
from catalog.views_sql import fixed
from tidemark import values as V
from tidemark.operators import events, joins, quality
from tidemark.plans import dimensions
from tidemark.session import written


def checks_sql(*parts: tuple) -> str:
    """Result rows from (check, column, severity, failing, total, mostly, source) parts."""
    rows = "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "check", '{col}' AS "column", '{sev}' AS severity, CAST({bad} AS BIGINT) AS failing,
        CAST({n} AS BIGINT) AS total, {mostly} AS mostly FROM {src}"""
        for c, col, sev, bad, n, mostly, src in parts
    )
    return f"""SELECT "check", "column", severity, failing, total, {fixed('failing / nullif(total, 0)', 6)} AS ratio,
      failing <= total * (1 - CAST(mostly AS DECIMAL(9,6))) AS passed FROM ({rows})"""


def null_part(col: str, src: str, mostly: float = 1.0, sev: str = "warning") -> tuple:
    return ("not_null", col, sev, f"count(*) FILTER ({col} IS NULL)", "count(*)", mostly, src)


def value_part(check: str, col: str, bad: str, src: str, mostly: float = 1.0, sev: str = "warning") -> tuple:
    return (check, col, sev, f"count(*) FILTER ({col} IS NOT NULL AND {bad})", f"count({col})", mostly, src)


def unique_part(col: str, src: str, sev: str = "warning") -> tuple:
    grouped = f"(SELECT {col}, count(*) AS n FROM {src} WHERE {col} IS NOT NULL GROUP BY {col})"
    return ("unique", col, sev, "coalesce(sum(n) FILTER (n > 1), 0)", "coalesce(sum(n), 0)", 1.0, grouped)


def reference_part(col: str, src: str, parent: str, pcol: str) -> tuple:
    bad = f"count(*) FILTER ({col} IS NOT NULL AND {col} NOT IN (SELECT {pcol} FROM {parent} WHERE {pcol} IS NOT NULL))"
    return ("relationship", col, "warning", bad, f"count({col})", 1.0, src)


def listed(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _cased(spark, sf):
    return events.normalise_case(views.bronze_events(spark, sf))


@query("j2_not_null", checks_sql(null_part("session_id", "bronze_events", 0.999), null_part("user_id", "bronze_events", sev="critical")))
def _(spark, sf):
    suite = [quality.expect_not_null("session_id", 0.999), quality.expect_not_null("user_id", severity="critical")]
    return quality.run_suite(views.bronze_events(spark, sf), suite)


@query("j3_unique", checks_sql(unique_part("event_id", "valid_events", "critical")))
def _(spark, sf):
    return quality.run_suite(valid_events(spark, sf), [quality.expect_unique("event_id", severity="critical")])


@query(
    "j4_in_set",
    checks_sql(
        value_part("in_set", "event_type", f"event_type NOT IN {listed(V.EVENT_TYPES)}", "cased_events", 0.95),
        value_part("in_set", "country_code", "country_code NOT IN ('FR', 'DE')", "cased_events"),
    ),
)
def _(spark, sf):
    suite = [quality.expect_in_set("event_type", V.EVENT_TYPES, 0.95), quality.expect_in_set("country_code", ["FR", "DE"])]
    return quality.run_suite(_cased(spark, sf), suite)


@query("j5_length", checks_sql(value_part("length", "country_code", "length(country_code) <> 2", "bronze_events", 0.99)))
def _(spark, sf):
    return quality.run_suite(views.bronze_events(spark, sf), [quality.expect_length("country_code", 2, 0.99)])


@query("j6_regex", checks_sql(value_part("regex", "country_code", "NOT regexp_matches(country_code, '^[A-Z]{2}$')", "bronze_events", 0.99)))
def _(spark, sf):
    return quality.run_suite(views.bronze_events(spark, sf), [quality.expect_regex("country_code", r"^[A-Z]{2}$", 0.99)])


@query(
    "j7_between",
    checks_sql(
        value_part("between", "revenue_eur", "(revenue_eur < 0 OR revenue_eur > 25)", "silver_events", 0.9),
        value_part("between", "event_date", "event_date < DATE '2024-01-05'", "silver_events"),
    ),
)
def _(spark, sf):
    suite = [
        quality.expect_between("revenue_eur", 0.0, 25.0, 0.9),
        quality.expect_between("event_date", F.lit("2024-01-05").cast("date")),
    ]
    return quality.run_suite(silver_events(spark, sf), suite)


@query(
    "j8_row_count",
    checks_sql(
        ("row_count", "*", "warning", "count(*) NOT BETWEEN 100 AND 100000000", "1", 1.0, "bronze_events"),
        ("row_count", "*", "critical", "count(*) NOT BETWEEN 500000000 AND 5000000000", "1", 1.0, "bronze_events"),
    ),
)
def _(spark, sf):
    suite = [quality.expect_row_count(100, 100_000_000), quality.expect_row_count(severity="critical")]
    return quality.run_suite(views.bronze_events(spark, sf), suite)


@query(
    "j9_fresh",
    checks_sql(
        ("fresh", "event_ts", "warning", "max(event_ts) < TIMESTAMP '2024-01-30 01:00:00'", "1", 1.0, "silver_events"),
        ("fresh", "event_ts", "critical", "max(event_ts) < TIMESTAMP '2024-01-29 19:00:00'", "1", 1.0, "silver_events"),
    ),
)
def _(spark, sf):
    return quality.run_suite(silver_events(spark, sf), quality.expect_source_fresh("event_ts", "2024-01-30 07:00:00"))


@query(
    "j10_is_true",
    checks_sql(
        ("is_true", "net <= gross", "warning", "count(*) FILTER (net > gross)", "count(*)", 1.0,
         "(SELECT quantity * unit_price_eur AS gross, quantity * unit_price_eur - discount_eur AS net FROM raw_lines)"),
        ("is_true", "net < gross", "warning", "count(*) FILTER (net >= gross)", "count(*)", 1.0,
         "(SELECT quantity * unit_price_eur AS gross, quantity * unit_price_eur - discount_eur AS net FROM raw_lines)"),
    ),
)
def _(spark, sf):
    gross, net = F.col("gross_revenue_eur"), F.col("net_revenue_eur")
    suite = [quality.expect_true("net <= gross", net <= gross), quality.expect_true("net < gross", net < gross)]
    return quality.run_suite(joins.line_revenue(views.raw_lines(spark, sf)), suite)


@query("j11_relationship", checks_sql(reference_part("customer_id", "raw_orders", "raw_accounts", "account_id")))
def _(spark, sf):
    accounts = views.raw_accounts(spark, sf)
    return quality.run_suite(views.raw_orders(spark, sf), [quality.expect_relationship("customer_id", accounts, "account_id")])


def _column_parts(names: list[str]) -> list[tuple]:
    rows = [("column_exists", c, "warning", "0", "1", 1.0, "(SELECT 1)") for c in names]
    return [*rows, ("column_set", "*", "warning", "0", str(len(names)), 1.0, "(SELECT 1)")]


SILVER = "silver_events"


#: The Silver contract's results in SQL.
SILVER_SUITE_SQL = checks_sql(
    *_column_parts(V.SILVER_COLUMNS),
    *[null_part(c, SILVER, sev="critical") for c in ("event_id", "event_type", "event_ts", "event_date")],
    null_part("session_id", SILVER, 0.999),
    unique_part("event_id", SILVER, "critical"),
    value_part("in_set", "event_type", f"event_type NOT IN {listed(V.EVENT_TYPES)}", SILVER, sev="critical"),
    value_part("length", "country_code", "length(country_code) <> 2", SILVER, 0.99),
    value_part("regex", "country_code", "NOT regexp_matches(country_code, '^[A-Z]{2}$')", SILVER, 0.99),
    value_part("in_set", "device_type", "device_type NOT IN ('desktop', 'mobile', 'tablet')", SILVER, 0.995),
    value_part("between", "revenue_eur", "revenue_eur NOT BETWEEN 0 AND 50000", SILVER, 0.9999),
    null_part("revenue_eur", SILVER),
    value_part("in_set", "referrer_channel", f"referrer_channel NOT IN {listed(V.CHANNELS)}", SILVER, 0.999),
    ("row_count", "*", "warning", "count(*) NOT BETWEEN 500000000 AND 5000000000", "1", 1.0, SILVER),
    ("fresh", "_silver_processed_at", "warning", "0", "1", 1.0, "(SELECT 1)"),
)


@query("j12_silver_suite", SILVER_SUITE_SQL)
def _(spark, sf):
    return quality.run_suite(_stored(silver_events(spark, sf)), quality.silver_suite("2024-01-30 06:00:00"))


def _stored(df: DataFrame) -> DataFrame:
    """The table as a suite meets it, written: each check reads its columns and nothing is computed again."""
    return written(df, "checked")


def _stacked(*parts: tuple[str, DataFrame, list]) -> DataFrame:
    results = [quality.run_suite(_stored(df), suite).withColumn("table_name", F.lit(name)) for name, df, suite in parts]
    return reduce(DataFrame.unionByName, results)


def _tables_sql(**tables: list[tuple]) -> str:
    return "\nUNION ALL ".join(f"SELECT *, '{n}' AS table_name FROM ({checks_sql(*parts)})" for n, parts in tables.items())


STATUSES = f"order_status NOT IN {listed(V.ORDER_STATUSES)}"


MODEL_SUITES_SQL = _tables_sql(
    stg_orders=[
        unique_part("order_id", "stg_orders"),
        *[null_part(c, "stg_orders") for c in ("order_id", "customer_id", "revenue_eur", "order_date")],
        value_part("between", "revenue_eur", "revenue_eur NOT BETWEEN 0 AND 100000", "stg_orders"),
        value_part("in_set", "order_status", STATUSES, "stg_orders"),
    ],
    stg_customers=[
        unique_part("customer_id", "stg_customers"),
        *[null_part(c, "stg_customers") for c in ("customer_id", "email_hashed", "country_code")],
        value_part("length", "country_code", "length(country_code) <> 2", "stg_customers"),
    ],
    stg_profiles=[
        unique_part("user_id", "stg_profiles"),
        *[null_part(c, "stg_profiles") for c in ("user_id", "country_code", "customer_segment", "predicted_churn_score", "ltv_estimate_eur")],
        value_part("in_set", "country_code", f"country_code NOT IN {listed(V.PROFILE_COUNTRIES)}", "stg_profiles"),
        value_part("in_set", "customer_segment", f"customer_segment NOT IN {listed(V.PROFILE_SEGMENTS)}", "stg_profiles"),
    ],
)


@query("j12_model_suites", MODEL_SUITES_SQL)
def _(spark, sf):
    from tidemark.plans import staging

    return _stacked(
        ("stg_orders", stars.stg_orders(spark, sf), quality.stg_orders_suite()),
        ("stg_customers", staging.stg_customers(views.raw_accounts(spark, sf)), quality.stg_customers_suite()),
        ("stg_profiles", stars.profiles(spark, sf), quality.profiles_suite()),
    )


DIMENSION_SUITES_SQL = _tables_sql(
    dim_customers_scd2=[
        unique_part("customer_sk", "customer_history"),
        *[null_part(c, "customer_history") for c in ("customer_sk", "customer_id", "is_current")],
        value_part("in_set", "customer_segment", f"customer_segment NOT IN {listed(V.CUSTOMER_SEGMENTS)}", "customer_history"),
        value_part("in_set", "loyalty_tier", f"loyalty_tier NOT IN {listed(V.LOYALTY_TIERS)}", "customer_history"),
        *[("has_values", c, "warning", f"CAST(count({c}) = 0 AS INTEGER)", "1", 1.0, "customer_history") for c in ("loyalty_tier", "phone_hash")],
    ],
    dim_customers=[
        unique_part("customer_sk", "dim_customers_now"),
        unique_part("user_id", "dim_customers_now"),
        *[null_part(c, "dim_customers_now") for c in ("customer_sk", "user_id", "churn_risk", "country_code")],
        value_part("in_set", "churn_risk", f"churn_risk NOT IN {listed(V.CHURN_BANDS)}", "dim_customers_now"),
    ],
    dim_products=[
        unique_part("product_sk", "product_history"),
        *[null_part(c, "product_history") for c in ("product_sk", "product_id", "category_l1", "is_current")],
    ],
)


@query("j12_dimension_suites", DIMENSION_SUITES_SQL)
def _(spark, sf):
    return _stacked(
        ("dim_customers_scd2", stars.customers_scd2(spark, sf), quality.dim_customers_scd2_suite()),
        ("dim_customers", stars.customers_now(spark, sf), quality.dim_customers_suite()),
        ("dim_products", stars.products_scd2(spark, sf), quality.dim_products_suite()),
    )


@query(
    "j12_calendar_suite",
    _tables_sql(
        dim_time=[
            unique_part("time_sk", "calendar"),
            unique_part("calendar_date", "calendar"),
            *[null_part(c, "calendar") for c in ("time_sk", "calendar_date")],
            value_part("in_set", "commercial_period", f"commercial_period NOT IN {listed([V.COMMERCIAL_DEFAULT, *V.COMMERCIAL_PERIODS])}", "calendar"),
            ("relationship", "order_date", "warning", "count(*) FILTER (order_date NOT IN (SELECT calendar_date FROM calendar))", "count(*)", 1.0, "silver_orders"),
        ]
    ),
)
def _(spark, sf):
    """The calendar itself, and that every order's date is one of its days."""
    calendar = dimensions.dim_time(spark)
    known = quality.expect_relationship("order_date", calendar, "calendar_date")
    return _stacked(("dim_time", calendar, quality.dim_time_suite())).unionByName(
        quality.run_suite(views.silver_orders(spark, sf), [known]).withColumn("table_name", F.lit("dim_time"))
    )


FACT_SUITES_SQL = _tables_sql(
    fact_order_lines=[
        unique_part("order_line_id", "fact_lines"),
        *[null_part(c, "fact_lines") for c in ("order_line_id", "customer_sk", "product_sk", "time_sk", "gross_revenue_eur")],
        value_part("between", "gross_revenue_eur", "gross_revenue_eur < 0", "fact_lines"),
        ("is_true", "net_revenue_eur <= gross_revenue_eur", "warning", "count(*) FILTER (net_revenue_eur > gross_revenue_eur)",
         "count(*)", 1.0, "fact_lines"),
        value_part("in_set", "order_status", STATUSES, "fact_lines"),
        value_part("in_set", "referrer_channel", f"referrer_channel NOT IN {listed([*V.CHANNELS, 'unknown'])}", "fact_lines"),
    ],
    fact_orders=[
        unique_part("order_sk", "fact_heads"),
        *[null_part(c, "fact_heads") for c in ("order_sk", "customer_sk", "time_sk", "net_revenue_eur")],
        reference_part("customer_sk", "fact_heads", "dim_customers_now", "customer_sk"),
        reference_part("time_sk", "fact_heads", "calendar", "time_sk"),
        value_part("in_set", "payment_method", f"payment_method NOT IN {listed(V.PAYMENT_METHODS)}", "fact_heads"),
    ],
)


@query("j12_fact_suites", FACT_SUITES_SQL)
def _(spark, sf):
    heads = quality.fact_orders_suite(_stored(stars.customers_now(spark, sf)), dimensions.dim_time(spark))
    return _stacked(
        ("fact_order_lines", stars.fact_lines(spark, sf).select(*quality.FACT_LINES_READ), quality.fact_lines_suite()),
        ("fact_orders", stars.fact_heads(spark, sf).select(*quality.FACT_ORDERS_READ), heads),
    )


@query(
    "h1_quality_gate",
    """SELECT 'clickstream_null_event_id' AS check_name, count(*) AS failing_rows FROM timed_events
      WHERE event_date = DATE '2024-01-15' AND event_id IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'orders_negative_revenue', count(*) FROM silver_orders
      WHERE order_date = DATE '2024-01-15' AND revenue_eur - 50000 < 0 HAVING count(*) > 0
    UNION ALL SELECT 'daily_order_volume_too_low', 1 FROM silver_orders WHERE order_date = DATE '2024-01-15' HAVING count(*) < 1000000""",
)
def _(spark, sf):
    parsed = events.parse_timestamps(_cased(spark, sf))
    orders = views.silver_orders(spark, sf).withColumn("revenue_eur", F.col("revenue_eur") - 50000)
    return quality.quality_gate(parsed, orders, "2024-01-15", min_orders=1_000_000)


@query(
    "h1_quality_gate_pass",
    """SELECT 'clickstream_null_event_id' AS check_name, count(*) AS failing_rows FROM silver_events
      WHERE event_date = DATE '2024-01-15' AND event_id IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'orders_negative_revenue', count(*) FROM silver_orders
      WHERE order_date = DATE '2024-01-15' AND revenue_eur < 0 HAVING count(*) > 0
    UNION ALL SELECT 'daily_order_volume_too_low', 1 FROM silver_orders WHERE order_date = DATE '2024-01-15' HAVING count(*) < 1""",
)
def _(spark, sf):
    return quality.quality_gate(silver_events(spark, sf), views.silver_orders(spark, sf), "2024-01-15", min_orders=1)
