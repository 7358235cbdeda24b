"""Upserts, incremental reads, documents, API pages: A10, A11, B15-B19, D8, D9, E10, G3, K1-K3, K8."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views
from catalog.registry import AS_OF, query
from catalog.views_sql import day, ts
from tidemark import values as V
from tidemark.operators import documents, merge
from tidemark.schemas import SYNC_STATE
from tidemark.sources import bronze, sync


def target_rows(spark, sf):
    return views.raw_profiles(spark, sf).selectExpr(
        "_id", "city", "CASE WHEN cast(substr(_id, 3) AS bigint) % 37 <> 0 THEN updated_at END AS updated_at"
    )


def source_rows(spark, sf):
    """Older, equal and newer copies of the target's rows, some without a time, and some new keys."""
    return views.raw_profiles(spark, sf).selectExpr("*", "cast(substr(_id, 3) AS bigint) AS k").selectExpr(
        "if(k % 4 = 0, concat('n-', k), _id) AS _id",
        "concat('Moved ', k) AS city",
        "CASE WHEN k % 41 <> 0 THEN updated_at + make_interval(0, 0, 0, cast(k % 3 - 1 AS int)) END AS updated_at",
    )


CHANGE_SQL = """
WITH target AS (SELECT _id, city, CASE WHEN k % 37 <> 0 THEN updated_at END AS updated_at FROM raw_profiles),
source AS (SELECT CASE WHEN k % 4 = 0 THEN 'n-' || k ELSE _id END AS _id, 'Moved ' || k AS city,
    CASE WHEN k % 41 <> 0 THEN updated_at + INTERVAL 1 DAY * (k % 3 - 1) END AS updated_at FROM raw_profiles)
"""


@query(
    "d8_upsert_newer",
    CHANGE_SQL
    + f"""SELECT coalesce(t._id, s._id) AS _id, CASE WHEN t._id IS NULL OR s.updated_at > t.updated_at THEN s.city ELSE t.city END AS city,
      {ts('CASE WHEN t._id IS NULL OR s.updated_at > t.updated_at THEN s.updated_at ELSE t.updated_at END')} AS updated_at
    FROM target t FULL JOIN source s ON t._id = s._id""",
)
def _(spark, sf):
    return merge.upsert_newer(target_rows(spark, sf), source_rows(spark, sf), "_id", "updated_at")


@query(
    "d9_upsert",
    CHANGE_SQL
    + f"""SELECT coalesce(s._id, t._id) AS _id, CASE WHEN s._id IS NULL THEN t.city ELSE s.city END AS city,
      {ts('CASE WHEN s._id IS NULL THEN t.updated_at ELSE s.updated_at END')} AS updated_at,
      CASE WHEN s._id IS NOT NULL THEN length(s.city) END AS city_length FROM target t FULL JOIN source s ON t._id = s._id""",
)
def _(spark, sf):
    wider = source_rows(spark, sf).withColumn("city_length", F.length("city").cast("bigint"))
    return merge.upsert(target_rows(spark, sf), wider, "_id")


@query(
    "k8_remerge_late",
    f"""SELECT order_id, {day('order_date')} AS order_date, revenue_eur + CASE WHEN order_date >= DATE '2024-01-27' THEN 1 ELSE 0 END AS revenue_eur
    FROM silver_orders""",
)
def _(spark, sf):
    orders = views.silver_orders(spark, sf).select("order_id", "order_date", "revenue_eur")
    redone = orders.withColumn("revenue_eur", F.col("revenue_eur") + 1)
    return merge.remerge_late(orders, redone, "order_id", "order_date", "2024-01-30")


def sync_state(spark, sf):
    """State after a first load that ended in the middle of the data's time span."""
    profiles = views.raw_profiles(spark, sf)
    loaded = profiles.filter(F.col("updated_at") < F.lit("2024-01-15").cast("timestamp"))
    empty = spark.createDataFrame([], SYNC_STATE)
    return merge.advance_mark(empty, "profiles", loaded)


MARK_SQL = "(SELECT max(updated_at) FROM raw_profiles WHERE updated_at < TIMESTAMP '2024-01-15')"


@query("k2_mark", f"SELECT 'profiles' AS collection_name, {ts('max(updated_at)')} AS last_sync_at FROM raw_profiles")
def _(spark, sf):
    return merge.advance_mark(sync_state(spark, sf), "profiles", views.raw_profiles(spark, sf))


@query("k1_increment", f"SELECT _id, {ts('updated_at')} AS updated_at FROM raw_profiles WHERE updated_at >= {MARK_SQL}")
def _(spark, sf):
    out = merge.read_increment(views.raw_profiles(spark, sf), sync_state(spark, sf), "profiles")
    return out.select("_id", "updated_at")


@query("k1_increment_strict", f"SELECT _id, {ts('updated_at')} AS updated_at FROM raw_profiles WHERE updated_at > {MARK_SQL}")
def _(spark, sf):
    out = merge.read_increment(views.raw_profiles(spark, sf), sync_state(spark, sf), "profiles", strict=True)
    return out.select("_id", "updated_at")


@query(
    "k3_append_dedup",
    f"""SELECT _id, city, {ts('updated_at')} AS updated_at FROM (
      SELECT *, row_number() OVER (PARTITION BY _id ORDER BY updated_at DESC NULLS LAST, city) AS rn FROM (
        SELECT _id, city, updated_at FROM raw_profiles UNION ALL
        SELECT _id, 'Moved ' || k, updated_at + INTERVAL 1 DAY * (k % 3 - 1) FROM raw_profiles)) WHERE rn = 1""",
)
def _(spark, sf):
    old = views.raw_profiles(spark, sf).select("_id", "city", "updated_at")
    batch = views.raw_profiles(spark, sf).selectExpr(
        "_id", "concat('Moved ', substr(_id, 3)) AS city",
        "updated_at + make_interval(0, 0, 0, cast(cast(substr(_id, 3) AS bigint) % 3 - 1 AS int)) AS updated_at",
    )
    _, latest = sync.sync_stream("profiles", old, batch)
    return latest


@query("e10_batch_max", f"SELECT {ts('max(updated_at)')} AS batch_max FROM raw_profiles")
def _(spark, sf):
    return merge.batch_max(views.raw_profiles(spark, sf), "updated_at")


@query("g3_oldest_first", f"SELECT _id, {ts('updated_at')} AS updated_at FROM raw_profiles ORDER BY updated_at")
def _(spark, sf):
    return sync.oldest_first(views.raw_profiles(spark, sf).select("_id", "updated_at"), "updated_at")


HASHES = """CASE WHEN phone <> '' THEN sha256(phone) END AS phone_hash, CASE WHEN address <> '' THEN sha256(address) END AS address_hash"""


@query("b15_hash_pii", f"SELECT _id, {HASHES} FROM raw_profiles")
def _(spark, sf):
    return documents.hash_pii(views.raw_profiles(spark, sf).select("_id", *V.PII_FIELDS))


NESTED = """'{"email":' || consent_email || ',"sms":' || consent_sms || '}' AS consents, '["' || tag || '","all"]' AS tags"""
UPDATED = "strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%f') AS updated_at"


@query("b16_flatten_nested", f"SELECT _id, {NESTED}, {UPDATED} FROM raw_profiles")
def _(spark, sf):
    return documents.flatten_nested(views.raw_profiles(spark, sf).select("_id", "consents", "tags", "updated_at"))


EXTRA = """CASE WHEN shoe_size IS NOT NULL AND newsletter IS NOT NULL THEN '{"shoe_size":' || shoe_size || ',"newsletter":' || newsletter || '}'
  WHEN shoe_size IS NOT NULL THEN '{"shoe_size":' || shoe_size || '}' WHEN newsletter IS NOT NULL THEN '{"newsletter":' || newsletter || '}' END AS _extra"""


@query("b17_pack_extra", f"SELECT _id, user_id, {EXTRA} FROM raw_profiles")
def _(spark, sf):
    narrow = views.raw_profiles(spark, sf).select("_id", "user_id", "shoe_size", "newsletter")
    return documents.pack_extra(narrow, ["_id", "user_id"])


@query(
    "b18_extract",
    f"""SELECT _id, 'profiles' AS _collection, '2024-01-30 00:00:00.000000' AS _extracted_at, 'files' AS _storage_mode, user_id, email,
      first_name, last_name, country_code, city, customer_segment, loyalty_tier, acquisition_channel, acquisition_date, preferred_category,
      preferred_device, ltv_estimate_eur, predicted_churn_score, profile_completeness_pct, last_active_at, {HASHES}, {NESTED},
      {UPDATED}, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS created_at, {EXTRA} FROM raw_profiles""",
)
def _(spark, sf):
    return documents.extract_documents(views.raw_profiles(spark, sf), "profiles", "files", AS_OF)


@query(
    "k1_extract_increment",
    f"SELECT _id, {HASHES}, {EXTRA} FROM raw_profiles WHERE updated_at >= {MARK_SQL}",
)
def _(spark, sf):
    out = sync.extract_increment(views.raw_profiles(spark, sf), sync_state(spark, sf), "profiles", as_of=AS_OF)
    return out.select("_id", "phone_hash", "address_hash", "_extra")


@query(
    "b19_stamp_bronze",
    """SELECT event_id, '2024-01-30T00:00:00.000000Z' AS _ingested_at, CAST(event_id % 16 AS BIGINT) AS _kafka_partition, event_id AS _kafka_offset,
      'clicks' AS _kafka_topic, 'kafka/clicks/partition=' || (event_id % 16) || '/offset=' || event_id AS _source_file FROM events""",
)
def _(spark, sf):
    ids = views.table(spark, sf, "events").select("event_id")
    return bronze.stamp_bronze(ids, "clicks", F.col("event_id") % 16, F.col("event_id"), AS_OF)


@query(
    "a10_pages",
    """SELECT p_partkey // 50 AS page, p_partkey AS sku, p_name AS name, p_retailprice AS price FROM part
    WHERE (p_partkey // 50) % 5 <> 3 AND (p_partkey // 50) % 11 <> 10 AND (p_partkey // 50) % 13 <> 12""",
)
def _(spark, sf):
    records = bronze.explode_api_pages(views.api_pages(spark, sf), "data")
    return records.select(
        "page",
        F.get_json_object("record", "$.sku").cast("bigint").alias("sku"),
        F.get_json_object("record", "$.name").alias("name"),
        F.get_json_object("record", "$.price").cast("double").alias("price"),
    )


@query(
    "a10_bad_pages",
    """SELECT DISTINCT page, CASE WHEN page % 11 = 10 THEN 'not json' WHEN page % 13 = 12 THEN 'not a list' ELSE 'no records' END AS reason
    FROM (SELECT p_partkey // 50 AS page FROM part) WHERE page % 11 = 10 OR page % 13 = 12 OR page % 5 = 3""",
)
def _(spark, sf):
    return bronze.unreadable_pages(views.api_pages(spark, sf), "data").select("page", "reason")


@query(
    "a11_cursors",
    """SELECT page, CASE WHEN page % 11 <> 10 AND (page % 13 = 12 OR page % 5 <> 4) AND page % 7 <> 6 THEN 'cur-' || (page + 1) END AS next_cursor
    FROM (SELECT DISTINCT p_partkey // 50 AS page FROM part)""",
)
def _(spark, sf):
    return bronze.page_cursors(views.api_pages(spark, sf))
