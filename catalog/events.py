"""Clickstream cleaning: B1-B9, C1-C3, C8, F1, F6, I11, I12, E9, G1."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views
from catalog.registry import AS_OF, DATE, fix, query
from catalog.views_sql import day, fixed, ts
from tidemark.functions import text
from tidemark.operators import aggregates, contract, dedup, events
from tidemark.plans import silver
from tidemark.session import scratch
from tidemark.sources import sinks

SILVER_SQL_COLUMNS = f"""event_id, session_id, user_id, anonymous_id, event_type, {ts('event_ts')} AS event_ts,
  {day('event_date')} AS event_date, page_url, referrer_url, page_domain, page_path, referrer_domain, referrer_channel,
  device_type, os, browser, country_code, ip_anonymized, properties, revenue_eur, has_revenue, event_timestamp, _ingested_at, _source_file,
  {ts('_silver_processed_at')} AS _silver_processed_at, _silver_version, _processing_date"""


def valid_events(spark, sf):
    return silver.stateless(views.bronze_events(spark, sf), AS_OF)


def silver_events(spark, sf):
    return silver.silver_events(views.bronze_events(spark, sf), DATE, AS_OF)


@query("b1_normalise_case", "SELECT event_id, _source_file, event_type, device_type, os, browser, country_code FROM cased_events")
def _(spark, sf):
    return events.normalise_case(views.bronze_events(spark, sf)).select(
        "event_id", "_source_file", "event_type", "device_type", "os", "browser", "country_code"
    )


@query(
    "b2_parse_timestamps",
    f"SELECT event_id, event_timestamp, {ts('event_ts')} AS event_ts, {day('event_date')} AS event_date FROM timed_events",
)
def _(spark, sf):
    return events.parse_timestamps(views.bronze_events(spark, sf)).select(
        "event_id", "event_timestamp", "event_ts", "event_date"
    )


@query(
    "b4_parse_urls",
    r"""SELECT event_id, page_url, referrer_url, page_domain, page_path, referrer_domain, CASE
      WHEN referrer_domain = '' THEN 'direct' WHEN regexp_matches(referrer_domain, 'google|bing|yahoo|duckduckgo') THEN 'organic_search'
      WHEN regexp_matches(referrer_domain, 'facebook|instagram|twitter|tiktok|linkedin') THEN 'social'
      WHEN referrer_domain = page_domain THEN 'internal' ELSE 'referral' END AS referrer_channel
    FROM (SELECT *, regexp_extract(page_url, '^(https?://)?([^/?#]+)', 2) AS page_domain,
      regexp_extract(page_url, '^(https?://)?[^/?#]+(/[^?#]*)', 2) AS page_path,
      regexp_extract(coalesce(referrer_url, ''), '^(https?://)?([^/?#]+)', 2) AS referrer_domain FROM bronze_events)""",
)
def _(spark, sf):
    return events.parse_urls(views.bronze_events(spark, sf)).select(
        "event_id", "page_url", "referrer_url", "page_domain", "page_path", "referrer_domain", "referrer_channel"
    )


@query(
    "b6_anonymise_ip",
    r"""SELECT event_id, CASE WHEN ip_address LIKE '%.%.%.%' THEN regexp_extract(ip_address, '^(\d+\.\d+\.\d+)\.', 1) || '.0'
      WHEN ip_address = '2001:db8:85a3:0:0:8a2e:370:7334' THEN '2001:db8:85a3:0:0:0:0:0'
      WHEN ip_address LIKE '2001:db8::%' THEN '2001:db8:0:0:0:0:0:0' END AS ip_anonymized FROM bronze_events""",
)
def _(spark, sf):
    return events.anonymise_ip(views.bronze_events(spark, sf)).select("event_id", "ip_anonymized")


@query(
    "b7_parse_revenue",
    r"""SELECT event_id, revenue_eur, revenue_eur > 0 AS has_revenue FROM (SELECT event_id, CASE WHEN revenue IS NULL THEN 0.0::DOUBLE
      ELSE TRY_CAST(replace(regexp_extract(revenue, '\d+[.,]\d+'), ',', '.') AS DOUBLE) END AS revenue_eur FROM bronze_events)""",
)
def _(spark, sf):
    return events.parse_revenue(views.bronze_events(spark, sf)).select("event_id", "revenue_eur", "has_revenue")


@query(
    "b9_add_metadata",
    "SELECT event_id, '2024-01-30 00:00:00.000000' AS _silver_processed_at, '2.4.1' AS _silver_version, '2024-01-29' AS _processing_date FROM bronze_events",
)
def _(spark, sf):
    return events.add_metadata(views.bronze_events(spark, sf), DATE, as_of=AS_OF).select(
        "event_id", "_silver_processed_at", "_silver_version", "_processing_date"
    )


@query("c1_filter_valid", f"SELECT event_id, event_type, _source_file, {ts('event_ts')} AS event_ts FROM valid_events")
def _(spark, sf):
    return valid_events(spark, sf).select("event_id", "event_type", "_source_file", "event_ts")


@query(
    "c2_audit",
    """WITH bad AS (SELECT event_id IS NULL OR event_id = '' AS a, event_ts IS NULL AS b,
      event_type NOT IN ('product_view','add_to_cart','checkout_start','purchase','session_start') AS c,
      user_id IS NULL AND anonymous_id IS NULL AS d, event_ts < TIMESTAMP '2020-01-01' AS e, event_ts > TIMESTAMP '2024-01-30' AS f
      FROM timed_events)
    SELECT 'missing_event_id' AS rule, count(*) FILTER (a) AS rejected, count(*) AS checked FROM bad
    UNION ALL SELECT 'unreadable_timestamp', count(*) FILTER (b), count(*) FROM bad
    UNION ALL SELECT 'unknown_event_type', count(*) FILTER (c), count(*) FROM bad
    UNION ALL SELECT 'no_visitor', count(*) FILTER (d), count(*) FROM bad
    UNION ALL SELECT 'before_first_day', count(*) FILTER (e), count(*) FROM bad
    UNION ALL SELECT 'in_the_future', count(*) FILTER (f), count(*) FROM bad""",
)
def _(spark, sf):
    cased = events.normalise_case(views.bronze_events(spark, sf))
    return events.audit_rejections(events.parse_timestamps(cased), AS_OF)


@query(
    "c3_run_metrics",
    f"""SELECT i AS input_rows, o AS output_rows, i - o AS dropped_rows, {fixed('100.0::DOUBLE * (i - o) / greatest(i, 1)', 1)} AS drop_pct
    FROM (SELECT (SELECT count(*) FROM bronze_events) AS i, (SELECT count(*) FROM silver_events) AS o)""",
)
def _(spark, sf):
    bronze = views.bronze_events(spark, sf)
    return events.run_metrics(bronze, silver.silver_events(bronze, DATE, AS_OF))


@query("f1_dedup_first", "SELECT event_id, session_id, event_type, _ingested_at, _source_file FROM unique_events")
def _(spark, sf):
    return silver.unique(valid_events(spark, sf)).select(
        "event_id", "session_id", "event_type", "_ingested_at", "_source_file"
    )


@query("f6_dedup_any", f"SELECT DISTINCT event_id, session_id, event_type, {ts('event_ts')} AS event_ts FROM valid_events")
def _(spark, sf):
    return dedup.dedup_any(valid_events(spark, sf), "event_id").select("event_id", "session_id", "event_type", "event_ts")


@query("i11_silver", f"SELECT {SILVER_SQL_COLUMNS} FROM silver_events")
def _(spark, sf):
    return silver_events(spark, sf)


LITE_SQL = r"""
SELECT event_id, session_id, user_id, anonymous_id, event_type, country_code, device_type,
  CASE WHEN event_timestamp LIKE '____-__-__T%' THEN event_ts END AS event_ts,
  CASE WHEN event_timestamp LIKE '____-__-__T%' THEN event_date END AS event_date,
  CASE WHEN ip_address LIKE '%.%.%.%' THEN regexp_extract(ip_address, '^(\d+\.\d+\.\d+)\.', 1) || '.0'
      WHEN ip_address = '2001:db8:85a3:0:0:8a2e:370:7334' THEN '2001:db8:85a3:0:0:0:0:0'
      WHEN ip_address LIKE '2001:db8::%' THEN '2001:db8:0:0:0:0:0:0' END AS ip_anonymized,
  CASE WHEN revenue IS NULL THEN 0.0::DOUBLE ELSE TRY_CAST(replace(regexp_extract(revenue, '\d+[.,]\d+'), ',', '.') AS DOUBLE) END AS revenue_eur
FROM timed_events WHERE event_id IS NOT NULL AND (user_id IS NOT NULL OR anonymous_id IS NOT NULL)
  AND event_type IN ('page_view','product_view','add_to_cart','remove_from_cart','checkout_start','purchase','search','session_start')
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _ingested_at NULLS LAST, _source_file NULLS LAST, event_timestamp NULLS LAST,
  event_type NULLS LAST, session_id NULLS LAST, user_id NULLS LAST, anonymous_id NULLS LAST, country_code NULLS LAST, device_type NULLS LAST,
  ip_address NULLS LAST, revenue NULLS LAST) = 1
"""


def lite_events(spark, sf):
    """The reduced chain keeps all rows with an empty id as one event, their first by the named order."""
    return silver.silver_events_lite(views.bronze_events(spark, sf), DATE, AS_OF)


@query(
    "i12_silver_lite",
    f"""SELECT event_id, session_id, user_id, anonymous_id, event_type, country_code, device_type, {ts('event_ts')} AS event_ts,
      {day('event_date')} AS event_date, ip_anonymized, revenue_eur, revenue_eur > 0 AS has_revenue, '2024-01-29' AS _processing_date
    FROM ({LITE_SQL})""",
)
def _(spark, sf):
    return lite_events(spark, sf).select(
        "event_id", "session_id", "user_id", "anonymous_id", "event_type", "country_code", "device_type", "event_ts", "event_date",
        "ip_anonymized", "revenue_eur", "has_revenue", "_processing_date",
    )


SUMMARY_SQL = f"""SELECT event_type, country_code, device_type, count(*) AS event_count,
  {fixed('sum(revenue_eur)', 2)} AS total_revenue_eur, count(DISTINCT user_id) AS unique_users
FROM ({LITE_SQL}) GROUP BY event_type, country_code, device_type"""


@query("e9_event_summary", SUMMARY_SQL)
def _(spark, sf):
    return fix(aggregates.event_summary(lite_events(spark, sf)), total_revenue_eur=2)


@query("g1_top_events", f"{SUMMARY_SQL} ORDER BY event_count DESC, event_type, country_code, device_type LIMIT 20")
def _(spark, sf):
    return fix(aggregates.top_events(aggregates.event_summary(lite_events(spark, sf))), total_revenue_eur=2)


@query(
    "b31_json_field",
    """SELECT event_id, _source_file, json_extract_string(properties, '$.product_id') AS product_id,
      json_extract_string(properties, '$.utm_source') AS utm_source, json_extract_string(properties, '$.utm_medium') AS utm_medium,
      json_extract_string(properties, '$.utm_campaign') AS utm_campaign FROM bronze_events""",
)
def _(spark, sf):
    names = ["product_id", "utm_source", "utm_medium", "utm_campaign"]
    raw = views.bronze_events(spark, sf)
    return raw.select("event_id", "_source_file", *[text.json_field(F.col("properties"), n).alias(n) for n in names])


def contract_messages(spark, sf):
    """Bronze events as messages: some ids in UUID form, some sessions empty, some URLs too long."""
    hexed = "md5(coalesce(event_id, ''))"
    uuid = f"concat_ws('-', substr({hexed}, 1, 8), substr({hexed}, 9, 4), concat('4', substr({hexed}, 14, 3)), concat('a', substr({hexed}, 18, 3)), substr({hexed}, 21, 12))"
    cased = events.normalise_case(views.bronze_events(spark, sf))
    return cased.withColumns(
        {
            "message_id": F.expr(f"if(substr({hexed}, 1, 1) = '0', event_id, if(event_id IS NULL, NULL, {uuid}))"),
            "session_id": F.expr(f"if(substr({hexed}, 2, 1) = '0', '', session_id)"),
            "page_url": F.expr(f"if(substr({hexed}, 3, 1) = '0', concat(page_url, repeat('x', 2048)), page_url)"),
            "country_code": F.expr(f"if(substr({hexed}, 4, 1) = '0', lower(country_code), country_code)"),
            "device_type": F.expr(f"if(substr({hexed}, 5, 1) = '0', 'watch', device_type)"),
        }
    ).selectExpr("event_id AS source_id", "* EXCEPT (event_id, message_id)", "message_id AS event_id")


CONTRACT_SQL = r"""
SELECT source_id, _source_file, concat_ws(',',
  CASE WHEN event_id IS NULL THEN 'event_id:required' END, CASE WHEN event_type IS NULL THEN 'event_type:required' END,
  CASE WHEN event_timestamp IS NULL THEN 'event_timestamp:required' END,
  CASE WHEN NOT regexp_full_match(event_id, '[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}') THEN 'event_id:pattern' END,
  CASE WHEN NOT regexp_full_match(country_code, '[A-Z]{2}') THEN 'country_code:pattern' END,
  CASE WHEN event_type NOT IN ('page_view','product_view','add_to_cart','remove_from_cart','checkout_start','checkout_complete',
    'purchase','search','wishlist_add','promo_click','session_start','session_end') THEN 'event_type:enum' END,
  CASE WHEN device_type NOT IN ('desktop','mobile','tablet') THEN 'device_type:enum' END,
  CASE WHEN length(session_id) < 1 THEN 'session_id:minLength' END,
  CASE WHEN length(page_url) > 2048 THEN 'page_url:maxLength' END, CASE WHEN length(referrer_url) > 2048 THEN 'referrer_url:maxLength' END,
  CASE WHEN user_id IS NULL AND anonymous_id IS NULL THEN 'visitor:anyOf' END) AS violations
FROM (SELECT * REPLACE (
    CASE WHEN h[1] = '0' OR event_id IS NULL THEN event_id
      ELSE h[1:8] || '-' || h[9:12] || '-4' || h[14:16] || '-a' || h[18:20] || '-' || h[21:32] END AS event_id,
    CASE WHEN h[2] = '0' THEN '' ELSE session_id END AS session_id,
    CASE WHEN h[3] = '0' THEN page_url || repeat('x', 2048) ELSE page_url END AS page_url,
    CASE WHEN h[4] = '0' THEN lower(country_code) ELSE country_code END AS country_code,
    CASE WHEN h[5] = '0' THEN 'watch' ELSE device_type END AS device_type), event_id AS source_id
  FROM (SELECT *, md5(coalesce(event_id, '')) AS h FROM cased_events))
"""


def checked_messages(spark, sf, verdict: str):
    """One pass over the messages and one write; each reader takes its part."""
    path = scratch(spark, "checked")
    sinks.write_checked(contract.with_violations(contract_messages(spark, sf)), path)
    return spark.read.parquet(path).filter(F.col("_verdict") == verdict)


@query("c8_contract_quarantine", f"SELECT * FROM ({CONTRACT_SQL}) WHERE violations <> ''")
def _(spark, sf):
    return checked_messages(spark, sf, "quarantine").select("source_id", "_source_file", F.array_join("violations", ",").alias("violations"))


@query("c8_contract_valid", f"SELECT source_id, _source_file FROM ({CONTRACT_SQL}) WHERE violations = ''")
def _(spark, sf):
    return checked_messages(spark, sf, "valid").select("source_id", "_source_file")
