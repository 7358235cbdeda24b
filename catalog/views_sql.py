"""The views of ``views.py`` in DuckDB SQL, and the Silver tables computed from them in plain SQL."""

from __future__ import annotations

import re

from catalog.views import ORDER_SHIFT_DAYS

AS_OF = "TIMESTAMP '2024-01-30 00:00:00'"
DATE = "'2024-01-29'"

VIEWS: dict[str, str] = {}

VIEWS["bronze_events"] = r"""
SELECT
  CASE WHEN event_id % 101 = 7 THEN NULL WHEN event_id % 103 = 9 THEN '' ELSE 'evt-' || event_id END AS event_id,
  CASE WHEN event_id % 1009 <> 5 THEN 's-' || user_id || '-' || strftime(ts, '%Y-%m-%d') END AS session_id,
  CASE WHEN event_id % 13 <> 0 THEN 'u-' || user_id END AS user_id,
  CASE WHEN event_id % 5 <> 0 THEN 'a-' || user_id END AS anonymous_id,
  CASE WHEN event_id % 97 = 0 THEN 'heartbeat' WHEN event_id % 7 = 0 THEN upper(kind)
       WHEN event_id % 7 = 1 THEN '  ' || kind || ' ' ELSE kind END AS event_type,
  CASE WHEN event_id % 89 = 3 THEN '2019-06-01T00:00:00Z' ELSE CASE event_id % 11
       WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')
       WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')
       WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
       WHEN 3 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
       WHEN 4 THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR)
       WHEN 5 THEN strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%g+0200')
       WHEN 6 THEN 'not-a-date'
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END END AS event_timestamp,
  CASE WHEN event_id % 61 = 0 THEN NULL ELSE CASE event_id % 4
       WHEN 0 THEN 'https://shop.example.com/products/' || (event_id % 200) || '?ref=home'
       WHEN 1 THEN 'http://shop.example.com/products/' || (event_id % 200) || '#top'
       WHEN 2 THEN 'shop.example.com/cart' ELSE 'https://sub.shop.example.co.uk' END END AS page_url,
  CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'https://www.google.com/search?q=shoes'
       WHEN 3 THEN 'https://m.facebook.com/' WHEN 4 THEN 'https://shop.example.com/home'
       ELSE 'https://partner.example.org/a' END AS referrer_url,
  CASE user_id % 3 WHEN 0 THEN 'Desktop' WHEN 1 THEN ' mobile' ELSE 'TABLET ' END AS device_type,
  CASE user_id % 4 WHEN 0 THEN 'macOS' WHEN 1 THEN 'Windows ' WHEN 2 THEN 'iOS' ELSE 'android' END AS os,
  CASE user_id % 3 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' ELSE ' firefox' END AS browser,
  CASE user_id % 5 WHEN 0 THEN 'fr' WHEN 1 THEN 'DE ' WHEN 2 THEN ' es' WHEN 3 THEN 'GB' ELSE 'it' END AS country_code,
  CASE WHEN event_id % 19 = 4 THEN 'unknown' ELSE CASE event_id % 6
       WHEN 3 THEN '2001:db8:85a3:0:0:8a2e:370:7334' WHEN 4 THEN '2001:db8::' || (event_id % 9)
       WHEN 5 THEN NULL ELSE '192.168.' || (event_id % 250) || '.' || (event_id % 255) END END AS ip_address,
  CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN '{"k": 1}'
       ELSE '{"product_id": "p-' || (event_id % 200) || '", "utm_source": "src' || (user_id % 3)
            || '", "utm_medium": "cpc", "utm_campaign": "c' || (event_id % 10) || '"}' END AS properties,
  CASE WHEN kind <> 'purchase' AND event_id % 17 <> 0 THEN NULL
       WHEN event_id % 43 = 1 THEN '' WHEN event_id % 47 = 1 THEN 'n/a'
       ELSE CASE event_id % 6 WHEN 0 THEN amount WHEN 1 THEN '€ ' || replace(amount, '.', ',')
         WHEN 2 THEN 'USD ' || amount WHEN 3 THEN '£' || amount WHEN 4 THEN amount || ' EUR' ELSE '$' || amount END END AS revenue,
  CASE WHEN copy = 1 AND event_id % 20 = 0 THEN NULL
       ELSE strftime(ts + INTERVAL 1 HOUR + copy * INTERVAL 10 MINUTE, '%Y-%m-%dT%H:%M:%SZ') END AS _ingested_at,
  (CASE WHEN copy = 0 THEN 'landing/part-' ELSE 'replay/part-' END) || (event_id % 16) AS _source_file
FROM (
  SELECT *, printf('%.2f', value) AS amount,
    CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
      WHEN 'error' THEN 'checkout_start' WHEN 'signup' THEN 'session_start' ELSE event_type END AS kind,
    unnest(range(0, CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END)) AS copy
  FROM events)
"""

VIEWS["cased_events"] = r"""
SELECT * REPLACE (lower(trim(event_type)) AS event_type, lower(trim(device_type)) AS device_type,
  lower(trim(os)) AS os, lower(trim(browser)) AS browser, upper(trim(country_code)) AS country_code)
FROM bronze_events
"""

VIEWS["timed_events"] = r"""
SELECT *, CAST(event_ts AS DATE) AS event_date FROM (
  SELECT *, CASE
    WHEN regexp_full_match(event_timestamp, '\d{13}') THEN make_timestamp(CAST(event_timestamp AS BIGINT) * 1000)
    WHEN regexp_full_match(event_timestamp, '\d{10}') THEN make_timestamp(CAST(event_timestamp AS BIGINT) * 1000000)
    WHEN event_timestamp LIKE '____-__-__T%' THEN
      CAST(regexp_extract(event_timestamp, '^([0-9T:.-]{19}(\.\d+)?)', 1) AS TIMESTAMP)
      - INTERVAL 1 MINUTE * CASE WHEN regexp_matches(event_timestamp, '[+]\d\d:?\d\d$') THEN
          CAST(regexp_extract(event_timestamp, '[+](\d\d):?(\d\d)$', 1) AS INTEGER) * 60
          + CAST(regexp_extract(event_timestamp, '[+](\d\d):?(\d\d)$', 2) AS INTEGER) ELSE 0 END
    END AS event_ts
  FROM cased_events)
"""

VIEWS["valid_events"] = f"""
SELECT * FROM timed_events
WHERE event_id IS NOT NULL AND event_id <> '' AND event_ts IS NOT NULL
  AND event_type IN ('page_view','product_view','add_to_cart','remove_from_cart','checkout_start','checkout_complete',
    'purchase','search','wishlist_add','promo_click','session_start','session_end')
  AND (user_id IS NOT NULL OR anonymous_id IS NOT NULL)
  AND event_ts >= TIMESTAMP '2020-01-01' AND event_ts <= {AS_OF}
"""

VIEWS["unique_events"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY _ingested_at ASC NULLS LAST) AS rn FROM valid_events)
WHERE rn = 1
"""

VIEWS["masked_events"] = r"""
SELECT *, CASE WHEN regexp_full_match(ip_address, '\d{1,3}(\.\d{1,3}){3}') THEN
      regexp_extract(ip_address, '^(\d+\.\d+\.\d+)\.', 1) || '.0'
    WHEN ip_address LIKE '%:%' AND len(head) + len(tail) <= 8 THEN
      array_to_string(list_slice(list_concat(head, list_transform(range(0, 8 - len(head) - len(tail)), lambda x: '0'), tail), 1, 3), ':')
      || ':0:0:0:0:0' END AS ip_anonymized
FROM (SELECT *, list_filter(string_split(string_split(ip_address, '::')[1], ':'), lambda x: x <> '') AS head,
       list_filter(string_split(coalesce(string_split(ip_address, '::')[2], ''), ':'), lambda x: x <> '') AS tail
     FROM unique_events)
"""

VIEWS["silver_events"] = f"""
SELECT event_id, session_id, user_id, anonymous_id, event_type, event_timestamp, event_ts, event_date, page_url, referrer_url,
  device_type, os, browser, country_code, properties, _ingested_at, _source_file, page_domain, page_path, referrer_domain,
  CASE WHEN referrer_domain = '' THEN 'direct' WHEN regexp_matches(referrer_domain, 'google|bing|yahoo|duckduckgo') THEN 'organic_search'
    WHEN regexp_matches(referrer_domain, 'facebook|instagram|twitter|tiktok|linkedin') THEN 'social'
    WHEN referrer_domain = page_domain THEN 'internal' ELSE 'referral' END AS referrer_channel,
  ip_anonymized, revenue_eur, revenue_eur > 0 AS has_revenue, {AS_OF} AS _silver_processed_at, '2.4.1' AS _silver_version,
  {DATE} AS _processing_date
FROM (SELECT *,
    regexp_extract(page_url, '^(https?://)?([^/?#]+)', 2) AS page_domain,
    regexp_extract(page_url, '^(https?://)?[^/?#]+(/[^?#]*)', 2) AS page_path,
    regexp_extract(coalesce(referrer_url, ''), '^(https?://)?([^/?#]+)', 2) AS referrer_domain,
    CASE WHEN revenue IS NULL THEN 0.0::DOUBLE ELSE
      TRY_CAST(replace(regexp_replace(revenue, '[€$£ ]|EUR|USD|GBP', '', 'g'), ',', '.') AS DOUBLE) END AS revenue_eur
  FROM masked_events)
"""

VIEWS["session_starts"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT session_id, country_code, device_type, referrer_channel, user_id, properties, event_date,
    row_number() OVER (PARTITION BY session_id ORDER BY event_ts DESC, event_id DESC) AS rn
  FROM silver_events WHERE event_type = 'session_start' AND session_id IS NOT NULL)
WHERE rn = 1
"""

VIEWS["silver_orders"] = """
SELECT 'o-' || o_orderkey AS order_id,
  CASE WHEN o_orderkey % 7 <> 0 THEN 's-' || (o_custkey % 150) || '-' || (DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER)) END AS session_id,
  DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS order_date,
  o_totalprice AS revenue_eur, o_orderkey % 3 = 0 AS is_first_order, o_orderkey, o_custkey
FROM orders
"""

VIEWS["silver_order_lines"] = """
SELECT order_id, 'p-' || ((o_orderkey * 7 + i * 31) % 220) AS product_id,
  CAST(1 + (o_orderkey + i) % 5 AS INTEGER) AS quantity,
  CAST(1 + (o_custkey * 13 + i * 7) % 5000 AS DOUBLE) / 4 AS unit_price_eur
FROM (SELECT *, unnest(range(1, 2 + o_orderkey % 4)) AS i FROM silver_orders)
"""

VIEWS["raw_orders"] = f"""
SELECT CASE WHEN k % 101 <> 3 THEN 'o-' || k END AS order_id,
  CASE WHEN k % 11 <> 0 THEN 'c-' || o_custkey END AS customer_id,
  CASE WHEN k % 11 <> 0 OR k % 121 = 0 THEN 'anon-' || o_custkey ELSE 'c-' || o_custkey END AS anonymous_customer_id,
  CASE WHEN k % 7 <> 0 THEN 's-' || (o_custkey % 150) || '-' || (DATE '2024-01-01' + CAST(k % 30 AS INTEGER)) END AS session_id,
  CASE WHEN k % 107 = 1 THEN NULL WHEN k % 109 = 1 THEN 'n/a' ELSE CAST(placed AS VARCHAR) END AS order_date,
  CASE WHEN k % 113 = 1 THEN 'soon' ELSE (placed + 1) || ' 08:30:00' END AS confirmed_at,
  (placed + 2) || ' 09:00:00' AS shipped_at,
  (placed + 5) || ' 18:45:00' AS delivered_at,
  CASE WHEN k % 23 = 0 THEN (placed + 3) || ' 00:00:00' END AS cancelled_at,
  CASE WHEN k % 31 = 0 THEN 'on hold' WHEN k % 37 = 2 THEN NULL
    WHEN k % 23 = 0 THEN ['Cancelled', 'ANNULÉ', 'storniert'][k % 3 + 1]
    WHEN k % 29 = 0 THEN ['refunded', 'Remboursé', 'zurückerstattet'][k % 3 + 1]
    WHEN o_orderstatus = 'F' THEN ['Delivered', 'livré', 'geliefert'][k % 3 + 1]
    WHEN o_orderstatus = 'O' THEN ['paid', 'VALIDÉ', 'Confirmed'][k % 3 + 1]
    ELSE ['shipped', 'expédié', 'versandt'][k % 3 + 1] END AS order_status,
  CASE WHEN k % 37 = 0 THEN NULL WHEN k % 41 = 0 THEN -o_totalprice ELSE o_totalprice END AS revenue_eur,
  CASE WHEN k % 6 <> 0 THEN CAST(k % 10 AS DOUBLE) * 1.5 END AS shipping_cost_eur,
  CASE WHEN k % 8 <> 0 THEN CAST(k % 5 AS DOUBLE) * 2 END AS discount_eur,
  CAST(k % 100 AS DOUBLE) / 4 AS tax_eur,
  CASE WHEN k % 53 = 0 THEN 'TEST' ELSE ['Card', 'PayPal', 'bank_transfer', 'apple_pay', NULL][k % 5 + 1] END AS payment_method,
  'psp-' || (k % 4) AS payment_provider, 'EUR' AS currency_code,
  CASE WHEN k % 13 <> 0 THEN ['fr', 'DE', 'es'][k % 3 + 1] END AS shipping_country_code,
  'City ' || (o_custkey % 90) AS shipping_city,
  CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END AS is_first_order,
  ['storefront_fr', 'storefront_de', 'storefront_es'][k % 3 + 1] AS source_system,
  placed || ' 23:00:00' AS _silver_processed_at, placed || ' 07:15:00' AS created_at
FROM (SELECT *, o_orderkey AS k, CAST(o_orderdate AS DATE) + {ORDER_SHIFT_DAYS} AS placed FROM orders)
"""

VIEWS["raw_lines"] = f"""
SELECT 'o-' || l_orderkey AS order_id,
  l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_shipdate AS DATE) AS line_item_id,
  'p-' || l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
  CAST(floor(l_extendedprice * 100::DOUBLE / l_quantity) AS DOUBLE) / 100 AS unit_price_eur,
  CAST(floor(l_extendedprice * l_discount * 100::DOUBLE) AS DOUBLE) / 100 AS discount_eur,
  CAST(l_shipdate AS DATE) + {ORDER_SHIFT_DAYS} AS order_date
FROM lineitem
"""

VIEWS["raw_accounts"] = """
SELECT CASE WHEN k % 97 <> 5 THEN 'c-' || k END AS account_id, ' User' || k || '@Example.COM ' AS email,
  ' First' || (k % 50) || ' ' AS first_name, 'Last' || (k % 70) AS last_name,
  ['fr', 'DE', 'es', NULL, 'gb', 'it'][c_nationkey % 6 + 1] AS billing_country_code,
  'City ' || (k % 40) || (CASE WHEN v >= 1 THEN ' North' ELSE '' END) AS billing_city,
  CAST(10000 + k AS VARCHAR) AS billing_postal_code, '+' || (30 + c_nationkey) AS phone_country_code,
  CASE WHEN k % 31 = 0 THEN 'Internal' WHEN k % 17 = 0 THEN NULL
    ELSE ['high_value', 'mid', 'low', 'churned'][k % 4 + 1] END AS customer_segment__c,
  CASE WHEN k % 9 <> 0 THEN ['ads', 'email', 'organic'][k % 3 + 1] END AS acquisition_channel__c,
  CASE WHEN k % 43 = 0 THEN 'unknown' ELSE CAST(DATE '2021-01-01' + CAST(k % 900 AS INTEGER) AS VARCHAR) END AS acquisition_date__c,
  (DATE '2021-01-01' + CAST(k % 900 AS INTEGER)) || ' 10:00:00' AS created_date,
  (DATE '2024-01-01' + CAST(k % 5 + v * 4 AS INTEGER)) || ' 0' || v || ':30:00' AS system_modstamp,
  k % 41 = 0 AND v = (CASE WHEN k % 10 = 0 THEN 2 ELSE 0 END) AS is_deleted, v
FROM (SELECT *, c_custkey AS k, CAST(unnest(range(0, CASE WHEN c_custkey % 10 = 0 THEN 3 ELSE 1 END)) AS INTEGER) AS v FROM customer)
"""

VIEWS["raw_profiles"] = """
SELECT 'm-' || k AS _id, CASE WHEN k % 89 <> 1 THEN 'u-' || k END AS user_id, 'user' || k || '@example.com' AS email,
  'First' || (k % 50) AS first_name, 'Last' || (k % 70) AS last_name,
  CASE WHEN k % 21 <> 0 THEN ['fr', 'DE', 'es', 'GB'][c_nationkey % 4 + 1] END AS country_code, 'City ' || (k % 40) AS city,
  ['VIP', 'Loyal', 'New', 'Lapsed', 'At-Risk'][k % 5 + 1] AS customer_segment,
  ['gold', 'silver', 'bronze', NULL][k % 4 + 1] AS loyalty_tier, 'channel' || (k % 3) AS acquisition_channel,
  CAST(DATE '2021-01-01' + CAST(k % 900 AS INTEGER) AS VARCHAR) AS acquisition_date, 'cat' || (k % 6) AS preferred_category,
  ['desktop', 'mobile', 'tablet'][k % 3 + 1] AS preferred_device,
  CASE WHEN k % 19 = 0 THEN NULL WHEN k % 23 = 1 THEN 'n/a' ELSE printf('%.2f', c_acctbal) END AS ltv_estimate_eur,
  CASE WHEN k % 27 <> 0 THEN printf('%.2f', CAST(k % 100 AS DOUBLE) / 100) END AS predicted_churn_score,
  CASE WHEN k % 16 <> 0 THEN CAST(k % 101 AS VARCHAR) END AS profile_completeness_pct,
  (DATE '2023-01-01' + CAST(k % 390 AS INTEGER)) || ' 12:00:00' AS last_active_at,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 7 = 0 THEN '' ELSE '+33' || (600000000 + k) END AS phone,
  CASE WHEN k % 5 <> 0 THEN k || ' Main Street' END AS address,
  k % 2 = 0 AS consent_email, k % 3 = 0 AS consent_sms, 't' || (k % 4) AS tag,
  CAST(DATE '2024-01-01' + CAST(k % 28 AS INTEGER) AS TIMESTAMP) + INTERVAL 1 HOUR * (k % 24) AS updated_at,
  CAST(DATE '2021-01-01' + CAST(k % 900 AS INTEGER) AS TIMESTAMP) AS created_at,
  CASE WHEN k % 3 = 0 THEN CAST(36 + k % 12 AS INTEGER) END AS shoe_size,
  CASE WHEN k % 4 = 0 THEN k % 8 = 0 END AS newsletter, k, c_acctbal
FROM (SELECT *, c_custkey AS k FROM customer)
"""

VIEWS["raw_products"] = """
SELECT CASE WHEN k % 101 <> 7 THEN 'p-' || k END AS product_id, 'SKU-' || k AS product_sku, p_name AS product_name,
  CASE WHEN k % 9 <> 0 THEN 'About ' || p_name END AS product_description, lower(p_type) AS category_l1,
  'size-' || (p_size % 5) AS category_l2, 'size-' || p_size AS category_l3,
  CASE WHEN k % 13 <> 0 THEN p_brand END AS brand, 'sup-' || (k % 100) AS supplier_id,
  CASE WHEN k % 17 = 0 THEN 0::DOUBLE ELSE p_retailprice + CAST(v * 10 AS DOUBLE) END AS base_price_eur,
  CAST(floor(p_retailprice * 60::DOUBLE) AS DOUBLE) / 100 AS cost_price_eur, CAST(p_size AS DOUBLE) / 8 AS weight_kg,
  k % 10 = 0 AS is_digital, k % 12 <> 0 AS is_active,
  ['in_stock', 'low_stock', 'out_of_stock'][(k + v) % 3 + 1] AS stock_status,
  DATE '2022-01-01' + CAST(k % 700 AS INTEGER) AS launch_date,
  CAST(DATE '2024-01-01' + CAST(k % 20 + v * 7 AS INTEGER) AS TIMESTAMP) AS pim_updated_at
FROM (SELECT *, p_partkey AS k, unnest(range(0, CASE WHEN p_partkey % 4 = 0 THEN 2 ELSE 1 END)) AS v FROM part)
"""

VIEWS["order_heads"] = f"""
SELECT 'o-' || o_orderkey AS order_id, CASE WHEN o_orderkey % 53 <> 2 THEN 'u-' || o_custkey END AS user_id, CAST(o_orderdate AS DATE) + {ORDER_SHIFT_DAYS} AS order_date,
  o_totalprice AS gross_revenue_eur, CAST(o_orderkey % 15 AS DOUBLE) / 100 AS discount_rate,
  ['card', 'paypal', 'bank_transfer', 'apple_pay'][o_orderkey % 4 + 1] AS payment_method
FROM orders
"""

VIEWS["stg_orders"] = """
SELECT order_id, coalesce(customer_id, anonymous_customer_id) AS customer_id, session_id,
  TRY_CAST(order_date AS DATE) AS order_date, TRY_CAST(confirmed_at AS TIMESTAMP) AS confirmed_at,
  TRY_CAST(shipped_at AS TIMESTAMP) AS shipped_at, TRY_CAST(delivered_at AS TIMESTAMP) AS delivered_at,
  TRY_CAST(cancelled_at AS TIMESTAMP) AS cancelled_at,
  CASE WHEN lower(order_status) IN ('paid', 'confirmed', 'validé') THEN 'confirmed'
    WHEN lower(order_status) IN ('shipped', 'expédié', 'versandt') THEN 'shipped'
    WHEN lower(order_status) IN ('delivered', 'livré', 'geliefert') THEN 'delivered'
    WHEN lower(order_status) IN ('cancelled', 'annulé', 'storniert') THEN 'cancelled'
    WHEN lower(order_status) IN ('refunded', 'remboursé', 'zurückerstattet') THEN 'refunded' ELSE 'pending' END AS order_status,
  coalesce(revenue_eur, 0) AS revenue_eur, coalesce(shipping_cost_eur, 0) AS shipping_cost_eur,
  coalesce(discount_eur, 0) AS discount_eur, coalesce(tax_eur, 0) AS tax_eur,
  coalesce(revenue_eur, 0) + coalesce(shipping_cost_eur, 0) - coalesce(discount_eur, 0) AS total_charged_eur,
  lower(coalesce(payment_method, 'unknown')) AS payment_method, payment_provider, currency_code,
  upper(coalesce(shipping_country_code, 'XX')) AS shipping_country_code, shipping_city,
  is_first_order = 'true' AS is_first_order, source_system, _silver_processed_at, created_at
FROM raw_orders
WHERE order_id IS NOT NULL AND TRY_CAST(order_date AS DATE) >= DATE '2020-01-01'
  AND coalesce(lower(payment_method), '') <> 'test' AND coalesce(revenue_eur, 0) >= 0
"""

VIEWS["staged_accounts"] = """
SELECT account_id AS customer_id, sha256(lower(trim(email))) AS email_hashed, trim(first_name) AS first_name,
  trim(last_name) AS last_name, upper(coalesce(billing_country_code, 'XX')) AS country_code, billing_city AS city,
  billing_postal_code AS postal_code, phone_country_code, coalesce(customer_segment__c, 'unknown') AS customer_segment,
  coalesce(acquisition_channel__c, 'unknown') AS acquisition_channel, TRY_CAST(acquisition_date__c AS DATE) AS acquisition_date,
  account_id AS salesforce_account_id, CAST(created_date AS TIMESTAMP) AS crm_created_at,
  CAST(system_modstamp AS TIMESTAMP) AS crm_updated_at, v, is_deleted, customer_segment__c
FROM raw_accounts WHERE account_id IS NOT NULL
"""

VIEWS["stg_customers"] = """
SELECT * EXCLUDE (rn, v, is_deleted, customer_segment__c) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY crm_updated_at DESC NULLS LAST) AS rn FROM staged_accounts)
WHERE rn = 1 AND NOT is_deleted AND lower(coalesce(customer_segment__c, '')) <> 'internal'
"""

VIEWS["stg_profiles"] = f"""
SELECT _id AS profile_id, user_id, first_name, last_name, upper(coalesce(country_code, 'XX')) AS country_code, city,
  customer_segment, loyalty_tier, acquisition_channel, TRY_CAST(acquisition_date AS DATE) AS acquisition_date,
  preferred_category, preferred_device, coalesce(TRY_CAST(ltv_estimate_eur AS DOUBLE), 0) AS ltv_estimate_eur,
  coalesce(TRY_CAST(predicted_churn_score AS DOUBLE), 0.5::DOUBLE) AS predicted_churn_score,
  coalesce(TRY_CAST(profile_completeness_pct AS INTEGER), 0) AS profile_completeness_pct,
  TRY_CAST(last_active_at AS TIMESTAMP) AS last_active_at, {AS_OF} AS extracted_at, 'files' AS _storage_mode
FROM raw_profiles WHERE user_id IS NOT NULL
"""

VIEWS["dim_customers_now"] = """
SELECT md5(user_id) AS customer_sk, * EXCLUDE (profile_id, _storage_mode),
  CASE WHEN predicted_churn_score >= 0.7 THEN 'high' WHEN predicted_churn_score >= 0.4 THEN 'medium' ELSE 'low' END AS churn_risk,
  ltv_estimate_eur >= 1000 AS is_high_value,
  CAST(date_diff('day', CAST(last_active_at AS DATE), DATE '2024-01-30') AS INTEGER) AS days_since_last_active
FROM stg_profiles
"""

VIEWS["profile_log"] = """
SELECT CASE WHEN k % 89 <> 1 THEN 'c-' || k END AS customer_id,
  CASE WHEN k % 71 = 0 THEN 'platinum' ELSE ['gold', 'silver', 'bronze', NULL][(k + v) % 4 + 1] END AS loyalty_tier,
  CASE WHEN k % 11 <> 0 THEN sha256('+33' || (600000000 + k + CASE WHEN v = 2 THEN 1 ELSE 0 END)) END AS phone_hash,
  CAST((DATE '2023-12-28' + CAST(k % 9 + v * 3 AS INTEGER)) || ' 0' || v || ':30:00' AS TIMESTAMP) AS changed_at
FROM (SELECT c_custkey AS k, CAST(unnest(range(0, c_custkey % 3 + 1)) AS INTEGER) AS v FROM customer)
"""

VIEWS["customer_versions"] = """
SELECT customer_id, a.email_hashed, a.first_name, a.last_name, a.country_code, a.city, a.customer_segment, p.loyalty_tier, p.phone_hash,
  a.acquisition_channel, a.acquisition_date,
  md5(a.email_hashed || '||' || a.first_name || '||' || a.last_name || '||' || a.country_code || '||' || a.city || '||' || a.customer_segment
      || '||' || coalesce(p.loyalty_tier, '') || '||' || coalesce(p.phone_hash, '')) AS row_hash, moment AS valid_from, a.has_left
FROM (SELECT customer_id, moment, src, last_value(account IGNORE NULLS) OVER before AS a, last_value(profile IGNORE NULLS) OVER before AS p
  FROM (SELECT customer_id, crm_updated_at AS moment, 0 AS src,
      {'email_hashed': email_hashed, 'first_name': first_name, 'last_name': last_name, 'country_code': country_code, 'city': city,
       'customer_segment': customer_segment, 'acquisition_channel': acquisition_channel, 'acquisition_date': acquisition_date,
       'has_left': is_deleted OR lower(coalesce(customer_segment__c, '')) = 'internal'} AS account, NULL AS profile FROM staged_accounts
    UNION ALL SELECT customer_id, changed_at, 1, NULL, {'loyalty_tier': loyalty_tier, 'phone_hash': phone_hash} FROM profile_log WHERE customer_id IS NOT NULL)
  WINDOW before AS (PARTITION BY customer_id ORDER BY moment, src ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE a IS NOT NULL QUALIFY row_number() OVER (PARTITION BY customer_id, moment ORDER BY src DESC) = 1
"""

VIEWS["customer_history"] = """
SELECT * EXCLUDE (has_left) FROM (
  SELECT * EXCLUDE (before, state), md5(customer_id || '-' || row_hash || '-' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) AS customer_sk,
    lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to,
    lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) IS NULL AS is_current
  FROM (SELECT *, lag(state) OVER (PARTITION BY customer_id ORDER BY valid_from) AS before
    FROM (SELECT *, CASE WHEN has_left THEN 'left' ELSE row_hash END AS state FROM customer_versions))
  WHERE before IS NULL OR before <> state)
WHERE NOT has_left
"""

VIEWS["product_history"] = """
SELECT * EXCLUDE (pim_updated_at),
  CASE WHEN base_price_eur <> 0 THEN
    CAST(round(CAST((base_price_eur - cost_price_eur) / base_price_eur AS DECIMAL(28,8)), 4) AS DOUBLE) END AS gross_margin_rate,
  product_name IS NOT NULL AND product_description IS NOT NULL AND category_l1 IS NOT NULL AND brand IS NOT NULL AS is_catalog_complete,
  md5(product_id || '-' || strftime(pim_updated_at, '%Y-%m-%d %H:%M:%S')) AS product_sk, pim_updated_at AS valid_from,
  lead(pim_updated_at) OVER (PARTITION BY product_id ORDER BY pim_updated_at) AS valid_to,
  lead(pim_updated_at) OVER (PARTITION BY product_id ORDER BY pim_updated_at) IS NULL AS is_current
FROM raw_products WHERE product_id IS NOT NULL
"""

VIEWS["calendar"] = r"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_sk, d AS calendar_date, CAST(year(d) AS INTEGER) AS year_num,
  CAST(quarter(d) AS INTEGER) AS quarter_num, CAST(month(d) AS INTEGER) AS month_num, strftime(d, '%B') AS month_name,
  strftime(d, '%b') AS month_name_short, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  CAST(dayofweek(d) AS INTEGER) AS day_of_week, CAST(dayofyear(d) AS INTEGER) AS day_of_year, strftime(d, '%A') AS day_name,
  strftime(d, '%a') AS day_name_short, CAST(day(d) AS INTEGER) AS day_of_month, strftime(d, '%Y-%m') AS year_month,
  'Q' || quarter(d) || '-' || year(d) AS year_quarter, dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday,
  strftime(d, '%m-%d') IN ('01-01', '05-01', '05-08', '07-14', '08-15', '11-01', '11-11', '12-25') AS is_public_holiday_fr,
  CASE WHEN strftime(d, '%m-%d') BETWEEN '11-25' AND '11-30' THEN 'black_friday_week'
    WHEN strftime(d, '%m-%d') BETWEEN '12-10' AND '12-31' THEN 'christmas_peak'
    WHEN strftime(d, '%m-%d') BETWEEN '01-08' AND '01-18' THEN 'winter_sales'
    WHEN strftime(d, '%m-%d') BETWEEN '06-25' AND '07-10' THEN 'summer_sales' ELSE 'standard' END AS commercial_period
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
"""

VIEWS["session_rolls"] = """
SELECT session_id, country_code, device_type, referrer_channel, min(event_ts) AS session_start, max(event_ts) AS session_end,
  count(*) AS event_count, count(DISTINCT page_path) AS unique_pages,
  CAST(max(CASE WHEN has_revenue THEN 1 ELSE 0 END) AS INTEGER) AS has_purchase,
  CAST(floor(epoch(max(event_ts))) - floor(epoch(min(event_ts))) AS BIGINT) AS duration_s,
  count(DISTINCT page_path) = 1 AND floor(epoch(max(event_ts))) - floor(epoch(min(event_ts))) < 30 AS is_bounce
FROM silver_events GROUP BY session_id, country_code, device_type, referrer_channel
"""

VIEWS["fact_lines"] = """
SELECT md5(l.order_id || '-' || l.line_item_id) AS order_line_id, l.order_id, l.line_item_id, l.product_id, o.customer_id, o.session_id,
  o.order_date, coalesce(c.customer_sk, '-1') AS customer_sk, coalesce(p.product_sk, '-1') AS product_sk,
  coalesce(t.time_sk, -1) AS time_sk, p.product_name, p.category_l1, p.category_l2, p.brand, l.quantity, l.unit_price_eur,
  l.quantity * l.unit_price_eur AS gross_revenue_eur, l.discount_eur,
  l.quantity * l.unit_price_eur - l.discount_eur AS net_revenue_eur, o.shipping_cost_eur, o.tax_eur, o.order_status, o.payment_method,
  o.is_first_order, o.shipping_country_code AS country_code, coalesce(s.referrer_channel, 'unknown') AS referrer_channel,
  coalesce(s.device_type, 'unknown') AS device_type, json_extract_string(s.properties, '$.utm_source') AS utm_source,
  json_extract_string(s.properties, '$.utm_medium') AS utm_medium, json_extract_string(s.properties, '$.utm_campaign') AS utm_campaign,
  o.created_at AS order_created_at
FROM raw_lines l JOIN stg_orders o ON l.order_id = o.order_id
LEFT JOIN (SELECT * FROM customer_history WHERE is_current) c ON o.customer_id = c.customer_id
LEFT JOIN (SELECT * FROM product_history WHERE is_current) p ON l.product_id = p.product_id
LEFT JOIN calendar t ON o.order_date = t.calendar_date
LEFT JOIN session_starts s ON o.session_id = s.session_id
"""

VIEWS["fact_heads"] = """
SELECT md5(order_id) AS order_sk, order_id, customer_sk, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS time_sk, order_date,
  country_code, customer_segment, acquisition_channel, payment_method, gross_revenue_eur,
  CAST(round(CAST(gross_revenue_eur AS DECIMAL(18,2)) * CAST(discount_rate AS DECIMAL(5,4)), 2) AS DOUBLE) AS discount_eur,
  CAST(round(CAST(gross_revenue_eur AS DECIMAL(18,2)) * CAST(1 - discount_rate AS DECIMAL(5,4)), 2) AS DOUBLE) AS net_revenue_eur,
  CAST(round(CAST(gross_revenue_eur AS DECIMAL(18,2)) * CAST(0.2 AS DECIMAL(5,4)), 2) AS DOUBLE) AS tax_eur,
  rk = 1 AS is_first_order, rk AS order_rank
FROM (SELECT o.*, c.customer_sk, c.country_code, c.customer_segment, c.acquisition_channel,
    row_number() OVER (PARTITION BY o.user_id ORDER BY o.order_date, md5(o.order_id)) AS rk
  FROM order_heads o JOIN dim_customers_now c ON o.user_id = c.user_id)
"""


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [name for name in VIEWS if name in words]


def with_views(body: str) -> str:
    """The query with all views it uses, directly or not, as leading CTEs in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for inner in _needs(VIEWS[name]):
            if inner != name:
                add(inner)
        if name not in ordered:
            ordered.append(name)

    for name in _needs(body):
        add(name)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in ordered)
    body = body.strip()
    # A body that starts with its own WITH joins the list.
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def day(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


def rate(part: str, whole: str) -> str:
    """part / whole to 4 decimals, half up, in integers; null for a zero whole."""
    return f"CASE WHEN {whole} <> 0 THEN CAST((20000 * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / 10000 END"


def fixed(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"
