"""Views that give the driver's tables the shape the operators read.

Each view is row-local (no grouping, no join), keeps every row, and puts every kind of good
and bad value into it by arithmetic on the row's own key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_SHIFT_DAYS = 9101  # moves 1995-01-01 to 2019-12-02, so that a few orders precede 2020


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def bronze_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    shaped = e.selectExpr(
        "*",
        """CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
            WHEN 'error' THEN 'checkout_start' WHEN 'signup' THEN 'session_start' ELSE event_type END AS kind""",
        "format_string('%.2f', value) AS amount",
        "explode(sequence(0, if(event_id % 10 = 0, 1, 0))) AS copy",
    )
    return shaped.selectExpr(
        "CASE WHEN event_id % 101 = 7 THEN NULL WHEN event_id % 103 = 9 THEN '' ELSE concat('evt-', event_id) END AS event_id",
        "CASE WHEN event_id % 1009 <> 5 THEN concat('s-', user_id, '-', date_format(ts, 'yyyy-MM-dd')) END AS session_id",
        "CASE WHEN event_id % 13 <> 0 THEN concat('u-', user_id) END AS user_id",
        "CASE WHEN event_id % 5 <> 0 THEN concat('a-', user_id) END AS anonymous_id",
        """CASE WHEN event_id % 97 = 0 THEN 'heartbeat'
            ELSE CASE event_id % 7 WHEN 0 THEN upper(kind) WHEN 1 THEN concat('  ', kind, ' ') ELSE kind END
           END AS event_type""",
        """CASE WHEN event_id % 89 = 3 THEN '2019-06-01T00:00:00Z'
            ELSE CASE event_id % 11
              WHEN 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
              WHEN 1 THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '+00:00')
              WHEN 2 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
              WHEN 3 THEN cast(unix_millis(ts) AS string)
              WHEN 4 THEN cast(unix_seconds(ts) AS string)
              WHEN 5 THEN concat(date_format(ts + INTERVAL 2 HOURS, "yyyy-MM-dd'T'HH:mm:ss.SSS"), '+0200')
              WHEN 6 THEN 'not-a-date'
              ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'") END
           END AS event_timestamp""",
        """CASE WHEN event_id % 61 = 0 THEN NULL
            ELSE CASE event_id % 4
              WHEN 0 THEN concat('https://shop.example.com/products/', event_id % 200, '?ref=home')
              WHEN 1 THEN concat('http://shop.example.com/products/', event_id % 200, '#top')
              WHEN 2 THEN 'shop.example.com/cart'
              ELSE 'https://sub.shop.example.co.uk' END
           END AS page_url""",
        """CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'https://www.google.com/search?q=shoes'
            WHEN 3 THEN 'https://m.facebook.com/' WHEN 4 THEN 'https://shop.example.com/home'
            ELSE 'https://partner.example.org/a' END AS referrer_url""",
        "CASE user_id % 3 WHEN 0 THEN 'Desktop' WHEN 1 THEN ' mobile' ELSE 'TABLET ' END AS device_type",
        "CASE user_id % 4 WHEN 0 THEN 'macOS' WHEN 1 THEN 'Windows ' WHEN 2 THEN 'iOS' ELSE 'android' END AS os",
        "CASE user_id % 3 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' ELSE ' firefox' END AS browser",
        "CASE user_id % 5 WHEN 0 THEN 'fr' WHEN 1 THEN 'DE ' WHEN 2 THEN ' es' WHEN 3 THEN 'GB' ELSE 'it' END AS country_code",
        """CASE WHEN event_id % 19 = 4 THEN 'unknown'
            ELSE CASE event_id % 6
              WHEN 3 THEN '2001:db8:85a3:0:0:8a2e:370:7334' WHEN 4 THEN concat('2001:db8::', event_id % 9)
              WHEN 5 THEN NULL
              ELSE concat('192.168.', event_id % 250, '.', event_id % 255) END
           END AS ip_address""",
        """CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN '{"k": 1}'
            ELSE concat('{"product_id": "p-', event_id % 200, '", "utm_source": "src', user_id % 3,
                        '", "utm_medium": "cpc", "utm_campaign": "c', event_id % 10, '"}') END AS properties""",
        """CASE WHEN kind <> 'purchase' AND event_id % 17 <> 0 THEN NULL
            WHEN event_id % 43 = 1 THEN '' WHEN event_id % 47 = 1 THEN 'n/a'
            ELSE CASE event_id % 6 WHEN 0 THEN amount WHEN 1 THEN concat('€ ', translate(amount, '.', ','))
              WHEN 2 THEN concat('USD ', amount) WHEN 3 THEN concat('£', amount)
              WHEN 4 THEN concat(amount, ' EUR') ELSE concat('$', amount) END
           END AS revenue""",
        """CASE WHEN copy = 1 AND event_id % 20 = 0 THEN NULL
            ELSE date_format(ts + INTERVAL 1 HOUR + copy * INTERVAL 10 MINUTES, "yyyy-MM-dd'T'HH:mm:ss'Z'")
           END AS _ingested_at""",
        "concat(if(copy = 0, 'landing/part-', 'replay/part-'), event_id % 16) AS _source_file",
    )


def silver_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "concat('o-', o_orderkey) AS order_id",
        """CASE WHEN o_orderkey % 7 <> 0
            THEN concat('s-', o_custkey % 150, '-', date_add(DATE'2024-01-01', cast(o_orderkey % 30 AS int))) END AS session_id""",
        "date_add(DATE'2024-01-01', cast(o_orderkey % 30 AS int)) AS order_date",
        "o_totalprice AS revenue_eur",
        "o_orderkey % 3 = 0 AS is_first_order",
        """transform(sequence(1, cast(1 + o_orderkey % 4 AS int)), i -> named_struct(
            'product_id', concat('p-', (o_orderkey * 7 + i * 31) % 220),
            'quantity', cast(1 + (o_orderkey + i) % 5 AS int),
            'unit_price_eur', (1 + (o_custkey * 13 + i * 7) % 5000) / 4.0D)) AS line_items""",
    )


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").selectExpr(
        "*", f"date_add(cast(o_orderdate AS date), {ORDER_SHIFT_DAYS}) AS placed", "o_orderkey AS k"
    )
    return o.selectExpr(
        "CASE WHEN k % 101 <> 3 THEN concat('o-', k) END AS order_id",
        "CASE WHEN k % 11 <> 0 THEN concat('c-', o_custkey) END AS customer_id",
        "CASE WHEN k % 11 <> 0 OR k % 121 = 0 THEN concat('anon-', o_custkey) ELSE concat('c-', o_custkey) END AS anonymous_customer_id",
        "CASE WHEN k % 7 <> 0 THEN concat('s-', o_custkey % 150, '-', date_add(DATE'2024-01-01', cast(k % 30 AS int))) END AS session_id",
        "CASE WHEN k % 107 = 1 THEN NULL WHEN k % 109 = 1 THEN 'n/a' ELSE cast(placed AS string) END AS order_date",
        "CASE WHEN k % 113 = 1 THEN 'soon' ELSE concat(date_add(placed, 1), ' 08:30:00') END AS confirmed_at",
        "concat(date_add(placed, 2), ' 09:00:00') AS shipped_at",
        "concat(date_add(placed, 5), ' 18:45:00') AS delivered_at",
        "CASE WHEN k % 23 = 0 THEN concat(date_add(placed, 3), ' 00:00:00') END AS cancelled_at",
        """CASE WHEN k % 31 = 0 THEN 'on hold' WHEN k % 37 = 2 THEN NULL
            WHEN k % 23 = 0 THEN element_at(array('Cancelled', 'ANNULÉ', 'storniert'), cast(k % 3 + 1 AS int))
            WHEN k % 29 = 0 THEN element_at(array('refunded', 'Remboursé', 'zurückerstattet'), cast(k % 3 + 1 AS int))
            WHEN o_orderstatus = 'F' THEN element_at(array('Delivered', 'livré', 'geliefert'), cast(k % 3 + 1 AS int))
            WHEN o_orderstatus = 'O' THEN element_at(array('paid', 'VALIDÉ', 'Confirmed'), cast(k % 3 + 1 AS int))
            ELSE element_at(array('shipped', 'expédié', 'versandt'), cast(k % 3 + 1 AS int)) END AS order_status""",
        "CASE WHEN k % 37 = 0 THEN NULL WHEN k % 41 = 0 THEN -o_totalprice ELSE o_totalprice END AS revenue_eur",
        "CASE WHEN k % 6 <> 0 THEN (k % 10) * 1.5D END AS shipping_cost_eur",
        "CASE WHEN k % 8 <> 0 THEN (k % 5) * 2.0D END AS discount_eur",
        "(k % 100) / 4.0D AS tax_eur",
        """CASE WHEN k % 53 = 0 THEN 'TEST'
            ELSE element_at(array('Card', 'PayPal', 'bank_transfer', 'apple_pay', NULL), cast(k % 5 + 1 AS int)) END AS payment_method""",
        "concat('psp-', k % 4) AS payment_provider",
        "'EUR' AS currency_code",
        "CASE WHEN k % 13 <> 0 THEN element_at(array('fr', 'DE', 'es'), cast(k % 3 + 1 AS int)) END AS shipping_country_code",
        "concat('City ', o_custkey % 90) AS shipping_city",
        "CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END AS is_first_order",
        "element_at(array('storefront_fr', 'storefront_de', 'storefront_es'), cast(k % 3 + 1 AS int)) AS source_system",
        "concat(placed, ' 23:00:00') AS _silver_processed_at",
        "concat(placed, ' 07:15:00') AS created_at",
    )


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "concat('o-', l_orderkey) AS order_id",
        "concat_ws('-', l_linenumber, l_partkey, l_suppkey, cast(l_shipdate AS date)) AS line_item_id",
        "concat('p-', l_partkey) AS product_id",
        "cast(l_quantity AS int) AS quantity",
        "cast(floor(l_extendedprice * 100D / l_quantity) AS bigint) / 100D AS unit_price_eur",
        "cast(floor(l_extendedprice * l_discount * 100D) AS bigint) / 100D AS discount_eur",
        f"date_add(cast(l_shipdate AS date), {ORDER_SHIFT_DAYS}) AS order_date",
    )


def raw_accounts(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").selectExpr(
        "*", "c_custkey AS k", "explode(sequence(0, if(c_custkey % 10 = 0, 2, 0))) AS v"
    )
    return c.selectExpr(
        "CASE WHEN k % 97 <> 5 THEN concat('c-', k) END AS account_id",
        "concat(' User', k, '@Example.COM ') AS email",
        "concat(' First', k % 50, ' ') AS first_name",
        "concat('Last', k % 70) AS last_name",
        "element_at(array('fr', 'DE', 'es', NULL, 'gb', 'it'), cast(c_nationkey % 6 + 1 AS int)) AS billing_country_code",
        "concat('City ', k % 40, if(v >= 1, ' North', '')) AS billing_city",
        "cast(10000 + k AS string) AS billing_postal_code",
        "concat('+', 30 + c_nationkey) AS phone_country_code",
        """CASE WHEN k % 31 = 0 THEN 'Internal' WHEN k % 17 = 0 THEN NULL
            ELSE element_at(array('high_value', 'mid', 'low', 'churned'), cast(k % 4 + 1 AS int)) END AS customer_segment__c""",
        "CASE WHEN k % 9 <> 0 THEN element_at(array('ads', 'email', 'organic'), cast(k % 3 + 1 AS int)) END AS acquisition_channel__c",
        "CASE WHEN k % 43 = 0 THEN 'unknown' ELSE cast(date_add(DATE'2021-01-01', cast(k % 900 AS int)) AS string) END AS acquisition_date__c",
        "concat(date_add(DATE'2021-01-01', cast(k % 900 AS int)), ' 10:00:00') AS created_date",
        "concat(date_add(DATE'2024-01-01', cast(k % 5 + v * 4 AS int)), ' 0', v, ':30:00') AS system_modstamp",
        "k % 41 = 0 AND v = if(k % 10 = 0, 2, 0) AS is_deleted",
        "v",
    )


def raw_profiles(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").selectExpr("*", "c_custkey AS k")
    return c.selectExpr(
        "concat('m-', k) AS _id",
        "CASE WHEN k % 89 <> 1 THEN concat('u-', k) END AS user_id",
        "concat('user', k, '@example.com') AS email",
        "concat('First', k % 50) AS first_name",
        "concat('Last', k % 70) AS last_name",
        "CASE WHEN k % 21 <> 0 THEN element_at(array('fr', 'DE', 'es', 'GB'), cast(c_nationkey % 4 + 1 AS int)) END AS country_code",
        "concat('City ', k % 40) AS city",
        "element_at(array('VIP', 'Loyal', 'New', 'Lapsed', 'At-Risk'), cast(k % 5 + 1 AS int)) AS customer_segment",
        "element_at(array('gold', 'silver', 'bronze', NULL), cast(k % 4 + 1 AS int)) AS loyalty_tier",
        "concat('channel', k % 3) AS acquisition_channel",
        "cast(date_add(DATE'2021-01-01', cast(k % 900 AS int)) AS string) AS acquisition_date",
        "concat('cat', k % 6) AS preferred_category",
        "element_at(array('desktop', 'mobile', 'tablet'), cast(k % 3 + 1 AS int)) AS preferred_device",
        "CASE WHEN k % 19 = 0 THEN NULL WHEN k % 23 = 1 THEN 'n/a' ELSE format_string('%.2f', c_acctbal) END AS ltv_estimate_eur",
        "CASE WHEN k % 27 <> 0 THEN format_string('%.2f', (k % 100) / 100D) END AS predicted_churn_score",
        "CASE WHEN k % 16 <> 0 THEN cast(k % 101 AS string) END AS profile_completeness_pct",
        "concat(date_add(DATE'2023-01-01', cast(k % 390 AS int)), ' 12:00:00') AS last_active_at",
        "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 7 = 0 THEN '' ELSE concat('+33', 600000000 + k) END AS phone",
        "CASE WHEN k % 5 <> 0 THEN concat(k, ' Main Street') END AS address",
        "named_struct('email', k % 2 = 0, 'sms', k % 3 = 0) AS consents",
        "array(concat('t', k % 4), 'all') AS tags",
        "cast(date_add(DATE'2024-01-01', cast(k % 28 AS int)) AS timestamp) + make_interval(0, 0, 0, 0, cast(k % 24 AS int)) AS updated_at",
        "cast(date_add(DATE'2021-01-01', cast(k % 900 AS int)) AS timestamp) AS created_at",
        "CASE WHEN k % 3 = 0 THEN cast(36 + k % 12 AS int) END AS shoe_size",
        "CASE WHEN k % 4 = 0 THEN k % 8 = 0 END AS newsletter",
    )


def profile_log(spark: SparkSession, sf: str) -> DataFrame:
    """Extracted profile documents as they changed, one to three versions a customer, some at the moment of an account's version."""
    c = table(spark, sf, "customer").selectExpr("c_custkey AS k", "explode(sequence(0, cast(c_custkey % 3 AS int))) AS v")
    return c.selectExpr(
        "CASE WHEN k % 89 <> 1 THEN concat('c-', k) END AS customer_id",
        "CASE WHEN k % 71 = 0 THEN 'platinum' ELSE element_at(array('Gold ', 'silver', 'bronze', NULL), cast((k + v) % 4 + 1 AS int)) END AS loyalty_tier",
        "CASE WHEN k % 11 <> 0 THEN sha2(concat('+33', 600000000 + k + if(v = 2, 1, 0)), 256) END AS phone_hash",
        "concat(date_add(DATE'2023-12-28', cast(k % 9 + v * 3 AS int)), ' 0', v, ':30:00') AS updated_at",
    )


def raw_products(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").selectExpr(
        "*", "p_partkey AS k", "explode(sequence(0, if(p_partkey % 4 = 0, 1, 0))) AS v"
    )
    return p.selectExpr(
        "CASE WHEN k % 101 <> 7 THEN concat('p-', k) END AS product_id",
        "concat('SKU-', k) AS product_sku",
        "p_name AS product_name",
        "CASE WHEN k % 9 <> 0 THEN concat('About ', p_name) END AS product_description",
        "lower(p_type) AS category_l1",
        "concat('size-', p_size % 5) AS category_l2",
        "concat('size-', p_size) AS category_l3",
        "CASE WHEN k % 13 <> 0 THEN p_brand END AS brand",
        "concat('sup-', k % 100) AS supplier_id",
        "CASE WHEN k % 17 = 0 THEN 0D ELSE p_retailprice + v * 10D END AS base_price_eur",
        "cast(floor(p_retailprice * 60D) AS bigint) / 100D AS cost_price_eur",
        "p_size / 8D AS weight_kg",
        "k % 10 = 0 AS is_digital",
        "k % 12 <> 0 AS is_active",
        "element_at(array('in_stock', 'low_stock', 'out_of_stock'), cast((k + v) % 3 + 1 AS int)) AS stock_status",
        "date_add(DATE'2022-01-01', cast(k % 700 AS int)) AS launch_date",
        "cast(date_add(DATE'2024-01-01', cast(k % 20 + v * 7 AS int)) AS timestamp) AS pim_updated_at",
    )


def order_heads(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a gross amount and a discount rate, for the order-grain fact."""
    return table(spark, sf, "orders").selectExpr(
        "concat('o-', o_orderkey) AS order_id",
        "CASE WHEN o_orderkey % 53 <> 2 THEN concat('u-', o_custkey) END AS user_id",
        f"date_add(cast(o_orderdate AS date), {ORDER_SHIFT_DAYS}) AS order_date",
        "o_totalprice AS gross_revenue_eur",
        "(o_orderkey % 15) / 100D AS discount_rate",
        "element_at(array('card', 'paypal', 'bank_transfer', 'apple_pay'), cast(o_orderkey % 4 + 1 AS int)) AS payment_method",
    )


PAGE_SIZE = 50


def api_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Response pages of 50 records, some broken, some without a list. A page is a fixed key range, so its list is bounded."""
    records = table(spark, sf, "part").selectExpr(
        f"p_partkey div {PAGE_SIZE} AS page", "named_struct('sku', p_partkey, 'name', p_name, 'price', p_retailprice) AS r"
    )
    pages = records.groupBy("page").agg(F.sort_array(F.collect_list("r")).alias("data"))
    cursor = "CASE WHEN page % 7 <> 6 THEN concat('cur-', page + 1) END"
    return pages.selectExpr(
        "page",
        f"""CASE WHEN page % 11 = 10 THEN concat('{{broken ', to_json(data))
             WHEN page % 13 = 12 THEN to_json(named_struct('data', data[0], 'meta', named_struct('next_cursor', {cursor})))
             WHEN page % 5 = 4 THEN to_json(data)
             WHEN page % 5 = 3 THEN to_json(named_struct('items', data, 'meta', named_struct('next_cursor', {cursor})))
             ELSE to_json(named_struct('data', data, 'meta', named_struct('next_cursor', {cursor}))) END AS body""",
    )
