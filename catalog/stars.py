"""Staging and star schema: B10-B15, B20-B30, C4-C7, C9, D3-D7, F2-F5, I1-I10."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views
from catalog.events import silver_events
from catalog.registry import AS_OF, fix, query
from catalog.views_sql import day, fixed, ts
from tidemark.functions import money, text, times
from tidemark.operators import dedup, documents, history, joins, merge
from tidemark.plans import dimensions, facts, staging
from tidemark.session import scratch, written
from tidemark.sources import sinks

FACT_AS_OF = "2024-01-30"


def stg_orders(spark, sf):
    return staging.stg_orders(views.raw_orders(spark, sf))


def profiles(spark, sf):
    extracted = documents.extract_documents(views.raw_profiles(spark, sf), "profiles", "files", AS_OF)
    return staging.stg_profiles(extracted)


def customers_now(spark, sf):
    return dimensions.dim_customers(profiles(spark, sf), AS_OF)


def account_versions(spark, sf):
    return staging.stage_account_versions(views.raw_accounts(spark, sf))


def profile_versions(spark, sf):
    return staging.stage_profile_versions(views.profile_log(spark, sf))


def customer_logs(spark, sf):
    return dimensions.with_profile_history(account_versions(spark, sf), profile_versions(spark, sf))


def customers_scd2(spark, sf):
    return dimensions.dim_customers_scd2(customer_logs(spark, sf))


def products_scd2(spark, sf):
    return dimensions.dim_products_scd2(views.raw_products(spark, sf))


def line_dimensions(spark, sf):
    """What the line fact joins, with the columns that it reads."""
    customers = dimensions.dim_customers_scd2(customer_logs(spark, sf), columns=facts.BUYERS)
    products = dimensions.dim_products_scd2(views.raw_products(spark, sf), columns=facts.GOODS)
    return customers, products, dimensions.dim_time(spark), silver_events(spark, sf)


def fact_lines(spark, sf, as_of=None):
    return facts.fact_order_lines(views.raw_lines(spark, sf), stg_orders(spark, sf), *line_dimensions(spark, sf), as_of)


def fact_heads(spark, sf):
    return facts.fact_orders(customers_now(spark, sf), views.order_heads(spark, sf))


# --- column rules ---------------------------------------------------------


@query(
    "b10_status",
    """SELECT order_id, order_status AS raw_status, CASE lower(order_status) WHEN 'paid' THEN 'confirmed' WHEN 'confirmed' THEN 'confirmed'
      WHEN 'validé' THEN 'confirmed' WHEN 'shipped' THEN 'shipped' WHEN 'expédié' THEN 'shipped' WHEN 'versandt' THEN 'shipped'
      WHEN 'delivered' THEN 'delivered' WHEN 'livré' THEN 'delivered' WHEN 'geliefert' THEN 'delivered' WHEN 'cancelled' THEN 'cancelled'
      WHEN 'annulé' THEN 'cancelled' WHEN 'storniert' THEN 'cancelled' WHEN 'refunded' THEN 'refunded' WHEN 'remboursé' THEN 'refunded'
      WHEN 'zurückerstattet' THEN 'refunded' ELSE 'pending' END AS order_status FROM raw_orders""",
)
def _(spark, sf):
    raw = views.raw_orders(spark, sf)
    return raw.select(
        "order_id", F.col("order_status").alias("raw_status"), text.order_status(F.col("order_status")).alias("order_status")
    )


@query(
    "b11_order_money",
    """SELECT order_id, coalesce(revenue_eur, 0) AS revenue_eur, coalesce(shipping_cost_eur, 0) AS shipping_cost_eur,
      coalesce(discount_eur, 0) AS discount_eur, coalesce(tax_eur, 0) AS tax_eur,
      coalesce(revenue_eur, 0) + coalesce(shipping_cost_eur, 0) - coalesce(discount_eur, 0) AS total_charged_eur FROM raw_orders""",
)
def _(spark, sf):
    return staging.order_money(views.raw_orders(spark, sf)).select(
        "order_id", "revenue_eur", "shipping_cost_eur", "discount_eur", "tax_eur", "total_charged_eur"
    )


@query(
    "b12_defaults",
    """SELECT order_id, coalesce(customer_id, anonymous_customer_id) AS customer_id,
      upper(coalesce(shipping_country_code, 'XX')) AS shipping_country_code, lower(coalesce(payment_method, 'unknown')) AS payment_method
    FROM raw_orders""",
)
def _(spark, sf):
    raw = staging.apply_defaults(views.raw_orders(spark, sf), {"payment_method": "unknown"})
    return raw.select(
        "order_id",
        F.coalesce("customer_id", "anonymous_customer_id").alias("customer_id"),
        staging.country("shipping_country_code").alias("shipping_country_code"),
        F.lower("payment_method").alias("payment_method"),
    )


@query(
    "b13_casts",
    f"""SELECT order_id, {day('TRY_CAST(order_date AS DATE)')} AS order_date, {ts('TRY_CAST(confirmed_at AS TIMESTAMP)')} AS confirmed_at,
      {ts('TRY_CAST(cancelled_at AS TIMESTAMP)')} AS cancelled_at, is_first_order = 'true' AS is_first_order FROM raw_orders""",
)
def _(spark, sf):
    spec = {"order_date": "date", "confirmed_at": "timestamp_ntz", "cancelled_at": "timestamp_ntz", "is_first_order": "boolean"}
    return staging.cast_columns(views.raw_orders(spark, sf), spec).select("order_id", *spec)


@query("b14_hash_email", "SELECT account_id, v, sha256(lower(trim(email))) AS email_hashed FROM raw_accounts")
def _(spark, sf):
    return views.raw_accounts(spark, sf).select("account_id", "v", text.hash_email(F.col("email")).alias("email_hashed"))


@query(
    "b21_surrogate_key",
    """SELECT account_id, v, md5(account_id) AS single_key, md5(coalesce(account_id, '_dbt_utils_surrogate_key_null_') || '-' || v || '-'
      || coalesce(billing_country_code, '_dbt_utils_surrogate_key_null_')) AS joint_key FROM raw_accounts""",
)
def _(spark, sf):
    return views.raw_accounts(spark, sf).select(
        "account_id",
        "v",
        text.surrogate_key("account_id").alias("single_key"),
        text.surrogate_key("account_id", "v", "billing_country_code").alias("joint_key"),
    )


@query(
    "b22_row_hash",
    """SELECT account_id, v, md5(coalesce(email, '') || '||' || coalesce(billing_country_code, '') || '||' || coalesce(customer_segment__c, ''))
      AS row_hash FROM raw_accounts""",
)
def _(spark, sf):
    return views.raw_accounts(spark, sf).select(
        "account_id", "v", text.row_hash("email", "billing_country_code", "customer_segment__c").alias("row_hash")
    )


@query(
    "b23_churn_risk",
    """SELECT user_id, predicted_churn_score, CASE WHEN predicted_churn_score >= 0.7 THEN 'high' WHEN predicted_churn_score >= 0.4 THEN 'medium'
      ELSE 'low' END AS churn_risk, ltv_estimate_eur >= 1000 AS is_high_value FROM stg_profiles""",
)
def _(spark, sf):
    return profiles(spark, sf).select(
        "user_id",
        "predicted_churn_score",
        money.churn_risk(F.col("predicted_churn_score")).alias("churn_risk"),
        money.is_high_value(F.col("ltv_estimate_eur")).alias("is_high_value"),
    )


@query(
    "b25_days_since",
    "SELECT user_id, CAST(date_diff('day', CAST(last_active_at AS DATE), DATE '2024-01-30') AS INTEGER) AS days_since_last_active FROM stg_profiles",
)
def _(spark, sf):
    return profiles(spark, sf).select(
        "user_id", times.days_since(F.col("last_active_at"), AS_OF).alias("days_since_last_active")
    )


@query(
    "b26_gross_margin",
    f"""SELECT product_sku, {ts('pim_updated_at')} AS pim_updated_at, CASE WHEN base_price_eur <> 0 THEN
      {fixed('(base_price_eur - cost_price_eur) / base_price_eur', 4)} END AS gross_margin_rate,
      product_description IS NOT NULL AND brand IS NOT NULL AS is_catalog_complete FROM raw_products""",
)
def _(spark, sf):
    out = dimensions.catalog_complete(dimensions.gross_margin(views.raw_products(spark, sf)))
    return out.select("product_sku", "pim_updated_at", "gross_margin_rate", "is_catalog_complete")


@query(
    "b28_line_revenue",
    f"""SELECT order_id, line_item_id, {fixed('quantity * unit_price_eur', 2)} AS gross_revenue_eur,
      {fixed('quantity * unit_price_eur - discount_eur', 2)} AS net_revenue_eur FROM raw_lines""",
)
def _(spark, sf):
    lines = joins.line_revenue(views.raw_lines(spark, sf))
    return fix(lines.select("order_id", "line_item_id", "gross_revenue_eur", "net_revenue_eur"), gross_revenue_eur=2, net_revenue_eur=2)


@query(
    "b29_order_amounts",
    """SELECT order_id, CAST(round(CAST(gross_revenue_eur AS DECIMAL(18,2)) * CAST(discount_rate AS DECIMAL(5,4)), 2) AS DOUBLE) AS discount_eur,
      CAST(round(CAST(gross_revenue_eur AS DECIMAL(18,2)) * CAST(1 - discount_rate AS DECIMAL(5,4)), 2) AS DOUBLE) AS net_revenue_eur,
      CAST(round(CAST(gross_revenue_eur AS DECIMAL(18,2)) * CAST(0.2 AS DECIMAL(5,4)), 2) AS DOUBLE) AS tax_eur FROM order_heads""",
)
def _(spark, sf):
    return facts.order_amounts(views.order_heads(spark, sf)).select("order_id", "discount_eur", "net_revenue_eur", "tax_eur")


@query(
    "b30_date_key",
    f"SELECT order_id, {day('order_date')} AS order_date, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS time_sk FROM silver_orders",
)
def _(spark, sf):
    return views.silver_orders(spark, sf).select("order_id", "order_date", times.date_key(F.col("order_date")).alias("time_sk"))


# --- filters --------------------------------------------------------------


@query(
    "c4_filter_orders",
    """SELECT order_id, order_date, payment_method, revenue_eur FROM raw_orders WHERE order_id IS NOT NULL
      AND TRY_CAST(order_date AS DATE) >= DATE '2020-01-01' AND coalesce(lower(payment_method), '') <> 'test' AND coalesce(revenue_eur, 0) >= 0""",
)
def _(spark, sf):
    typed = staging.cast_columns(views.raw_orders(spark, sf), {"order_date": "date"})
    return staging.filter_orders(typed).select("order_id", "order_date", "payment_method", "revenue_eur")


@query(
    "c5_filter_accounts",
    "SELECT account_id, v, customer_segment__c FROM raw_accounts WHERE NOT is_deleted AND lower(coalesce(customer_segment__c, '')) <> 'internal'",
)
def _(spark, sf):
    return staging.filter_accounts(views.raw_accounts(spark, sf)).select("account_id", "v", "customer_segment__c")


@query("c6_null_keys", "SELECT product_id, product_sku FROM raw_products WHERE product_id IS NOT NULL")
def _(spark, sf):
    return staging.drop_null_keys(views.raw_products(spark, sf), "product_id").select("product_id", "product_sku")


@query(
    "c7_lookback",
    f"SELECT order_id, {day('order_date')} AS order_date FROM silver_orders WHERE order_date >= DATE '2024-01-30' - 3",
)
def _(spark, sf):
    return merge.lookback(views.silver_orders(spark, sf), "order_date", FACT_AS_OF).select("order_id", "order_date")


@query("c9_current_rows", "SELECT customer_id, customer_sk, city FROM customer_history WHERE is_current")
def _(spark, sf):
    return history.current_rows(customers_scd2(spark, sf)).select("customer_id", "customer_sk", "city")


# --- joins ----------------------------------------------------------------


@query(
    "d4_lookup_keys",
    """SELECT o.order_id, o.customer_id, coalesce(c.customer_sk, '-1') AS customer_sk FROM stg_orders o
    LEFT JOIN (SELECT * FROM customer_history WHERE is_current) c ON o.customer_id = c.customer_id""",
)
def _(spark, sf):
    orders = stg_orders(spark, sf).select("order_id", "customer_id")
    keys = history.current_rows(customers_scd2(spark, sf)).select("customer_id", "customer_sk")
    return joins.lookup_keys(orders, keys, "customer_id", "customer_sk", spread_by="order_id")


@query(
    "d6_expand",
    """SELECT user_id, customer_segment, n FROM (SELECT *, CAST(unnest(range(1, 6)) AS INTEGER) AS n FROM stg_profiles)
    WHERE n <= CASE customer_segment WHEN 'VIP' THEN 5 WHEN 'Loyal' THEN 4 WHEN 'New' THEN 2 ELSE 1 END""",
)
def _(spark, sf):
    allowed = F.expr("CASE customer_segment WHEN 'VIP' THEN 5 WHEN 'Loyal' THEN 4 WHEN 'New' THEN 2 ELSE 1 END")
    people = profiles(spark, sf).select("user_id", "customer_segment")
    return joins.expand_by_series(people, 5, keep=F.col("n") <= allowed)


@query(
    "d7_orphans",
    """SELECT customer_id, count(*) AS child_rows FROM raw_orders WHERE customer_id IS NOT NULL
      AND customer_id NOT IN (SELECT account_id FROM raw_accounts WHERE account_id IS NOT NULL) GROUP BY customer_id""",
)
def _(spark, sf):
    return joins.orphans(views.raw_orders(spark, sf), views.raw_accounts(spark, sf), "customer_id", "account_id")


# --- windows --------------------------------------------------------------


@query(
    "f2_dedup_latest",
    """SELECT account_id, v, system_modstamp FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY system_modstamp DESC NULLS LAST) AS rn
      FROM raw_accounts WHERE account_id IS NOT NULL) WHERE rn = 1""",
)
def _(spark, sf):
    return dedup.dedup_latest(staging.drop_null_keys(views.raw_accounts(spark, sf), "account_id"), "account_id", "system_modstamp").select(
        "account_id", "v", "system_modstamp"
    )


@query(
    "f3_scd2",
    f"""SELECT account_id, v, {ts('m')} AS valid_from, {ts('lead(m) OVER (PARTITION BY account_id ORDER BY m)')} AS valid_to,
      lead(m) OVER (PARTITION BY account_id ORDER BY m) IS NULL AS is_current
    FROM (SELECT *, CAST(system_modstamp AS TIMESTAMP) AS m FROM raw_accounts WHERE account_id IS NOT NULL)""",
)
def _(spark, sf):
    timed = staging.cast_columns(staging.drop_null_keys(views.raw_accounts(spark, sf), "account_id"), {"system_modstamp": "timestamp"})
    return history.scd2_intervals(timed, "account_id", "system_modstamp").select(
        "account_id", "v", "valid_from", "valid_to", "is_current"
    )


@query(
    "f4_order_rank",
    """SELECT order_id, user_id, rk AS order_rank, rk = 1 AS is_first_order FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY order_date, md5(order_id)) AS rk FROM order_heads)""",
)
def _(spark, sf):
    ranked = history.order_rank(views.order_heads(spark, sf), "user_id")
    return history.first_order_flag(ranked).select("order_id", "user_id", "order_rank", "is_first_order")


# --- modelled tables ------------------------------------------------------


@query(
    "i1_stg_orders",
    f"""SELECT * REPLACE ({day('order_date')} AS order_date, {ts('confirmed_at')} AS confirmed_at, {ts('shipped_at')} AS shipped_at,
      {ts('delivered_at')} AS delivered_at, {ts('cancelled_at')} AS cancelled_at) FROM stg_orders""",
)
def _(spark, sf):
    return stg_orders(spark, sf)


@query(
    "i2_stg_customers",
    f"""SELECT * REPLACE ({day('acquisition_date')} AS acquisition_date, {ts('crm_created_at')} AS crm_created_at,
      {ts('crm_updated_at')} AS crm_updated_at) FROM stg_customers""",
)
def _(spark, sf):
    return staging.stg_customers(views.raw_accounts(spark, sf))


PROFILE_TIMES = f"""{day('acquisition_date')} AS acquisition_date, {ts('last_active_at')} AS last_active_at, {ts('extracted_at')} AS extracted_at"""


@query("i3_stg_profiles", f"SELECT * REPLACE ({PROFILE_TIMES}) FROM stg_profiles")
def _(spark, sf):
    return profiles(spark, sf)


@query(
    "i4_dim_time",
    f"""SELECT c.* REPLACE ({day('c.calendar_date')} AS calendar_date), coalesce(o.orders, 0) AS orders FROM calendar c
    LEFT JOIN (SELECT order_date, count(*) AS orders FROM silver_orders GROUP BY order_date) o ON c.calendar_date = o.order_date""",
)
def _(spark, sf):
    daily = views.silver_orders(spark, sf).groupBy(F.col("order_date").alias("calendar_date")).agg(F.count("*").alias("orders"))
    return dimensions.dim_time(spark).join(daily, "calendar_date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query(
    "i5_relative_flags",
    f"""SELECT o.order_id, {day('d')} AS calendar_date, d = DATE '2024-01-27' AS is_today, d = DATE '2024-01-26' AS is_yesterday,
      d >= DATE '2024-01-21' AS is_last_7d, d >= DATE '2023-12-29' AS is_last_30d, d >= DATE '2023-10-30' AS is_last_90d,
      year(d) = 2024 AS is_current_year FROM (SELECT order_id, order_date AS d FROM silver_orders) o""",
)
def _(spark, sf):
    flags = dimensions.relative_flags(dimensions.dim_time(spark), "2024-01-27")
    orders = views.silver_orders(spark, sf).select("order_id", F.col("order_date").alias("calendar_date"))
    return orders.join(F.broadcast(flags), "calendar_date").select(
        "order_id", "calendar_date", *[c for c in flags.columns if c.startswith("is_") and c not in ("is_weekend", "is_weekday", "is_public_holiday_fr")]
    )


HISTORY_TIMES = f"{ts('valid_from')} AS valid_from, {ts('valid_to')} AS valid_to"


@query("i6_dim_customers_scd2", f"SELECT * REPLACE ({day('acquisition_date')} AS acquisition_date, {HISTORY_TIMES}) FROM customer_history")
def _(spark, sf):
    """The first version of every account is the existing dimension; all versions arrive after it."""
    first = staging.stage_account_versions(views.raw_accounts(spark, sf).filter("v = 0"))
    existing = dimensions.dim_customers_scd2(dimensions.with_profile_history(first, profile_versions(spark, sf)))
    return dimensions.dim_customers_scd2(customer_logs(spark, sf), existing=existing)


@query("i6_refreshed_customers", f"SELECT * REPLACE ({day('acquisition_date')} AS acquisition_date, {HISTORY_TIMES}) FROM customer_history")
def _(spark, sf):
    """The dimension before the accounts' second and third versions and before the second of the profiles; then only
    the customers of the new versions are made again."""
    accounts, profiles = account_versions(spark, sf), profile_versions(spark, sf)
    then = F.lit("2024-01-04 12:00:00").cast("timestamp_ntz")
    old, log = accounts.filter(F.col("crm_updated_at") < then), profiles.filter(F.col("changed_at") < then)
    existing = written(dimensions.dim_customers_scd2(dimensions.with_profile_history(old, log)), "customers")
    late = accounts.filter(F.col("crm_updated_at") >= then).select("customer_id").union(profiles.filter(F.col("changed_at") >= then).select("customer_id"))
    return dimensions.refresh_customers(existing, accounts, profiles, late)


@query("i7_dim_customers", f"SELECT * REPLACE ({PROFILE_TIMES}) FROM dim_customers_now")
def _(spark, sf):
    return customers_now(spark, sf)


@query("i8_dim_products", f"SELECT * REPLACE ({day('launch_date')} AS launch_date, {HISTORY_TIMES}) FROM product_history")
def _(spark, sf):
    return products_scd2(spark, sf)


LINE_FIXED = f"{day('order_date')} AS order_date, {fixed('gross_revenue_eur', 2)} AS gross_revenue_eur, {fixed('net_revenue_eur', 2)} AS net_revenue_eur"


@query("i9_fact_lines", f"SELECT * REPLACE ({LINE_FIXED}) FROM fact_lines")
def _(spark, sf):
    return fix(fact_lines(spark, sf), gross_revenue_eur=2, net_revenue_eur=2)


@query(
    "i9_fact_lines_window",
    f"""SELECT * REPLACE ({day('f.order_date')} AS order_date, {fixed('f.gross_revenue_eur', 2)} AS gross_revenue_eur,
      {fixed('f.net_revenue_eur', 2)} AS net_revenue_eur, CASE WHEN s.session_id IS NULL THEN 'unknown' ELSE f.referrer_channel END AS referrer_channel,
      CASE WHEN s.session_id IS NULL THEN 'unknown' ELSE f.device_type END AS device_type,
      CASE WHEN s.session_id IS NOT NULL THEN f.utm_source END AS utm_source, CASE WHEN s.session_id IS NOT NULL THEN f.utm_medium END AS utm_medium,
      CASE WHEN s.session_id IS NOT NULL THEN f.utm_campaign END AS utm_campaign)
    FROM fact_lines f SEMI JOIN (SELECT order_id, line_item_id FROM raw_lines WHERE order_date >= DATE '2024-01-27') l
      ON f.order_id = l.order_id AND f.line_item_id = l.line_item_id
    LEFT JOIN (SELECT session_id FROM session_starts WHERE event_date >= DATE '2024-01-27') s ON f.session_id = s.session_id
    WHERE f.order_date >= DATE '2024-01-27'""".replace("SELECT *", "SELECT f.*", 1),
)
def _(spark, sf):
    """The incremental form: a trailing window of lines, orders and session starts."""
    return fix(fact_lines(spark, sf, FACT_AS_OF), gross_revenue_eur=2, net_revenue_eur=2)


@query("i9_stored_fact", f"SELECT * REPLACE ({LINE_FIXED}) FROM fact_lines")
def _(spark, sf):
    """The fact merged by month. First come two thirds of the orders, some of them under another date than they have later;
    then the late ones, and those that move, with all their lines."""
    path, number = scratch(spark, "fact"), F.substring("order_id", 3, 20).cast("bigint")
    orders, lines = stg_orders(spark, sf), views.raw_lines(spark, sf)
    dims = line_dimensions(spark, sf)
    late, moves = number % 3 == 0, number % 7 == 1
    early = orders.withColumn("order_date", F.when(moves, F.date_add("order_date", 40)).otherwise(F.col("order_date")))
    facts.merge_order_lines(path, lines.filter(~late), early.filter(~late), *dims, by_month=True)
    facts.merge_order_lines(path, lines.filter(late | moves), orders.filter(late | moves), *dims, by_month=True)
    return fix(sinks.read_days(spark, path, "order_month").drop("order_month"), gross_revenue_eur=2, net_revenue_eur=2)


@query(
    "i10_fact_orders",
    f"SELECT * REPLACE ({day('order_date')} AS order_date) FROM fact_heads",
)
def _(spark, sf):
    return fact_heads(spark, sf)
