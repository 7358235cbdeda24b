"""Written tables read back: A1-A9, A12, A13, K4-K7, K9.

Each query writes under a fresh folder of the session's shared folder and returns what it reads from there.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import stars, views
from catalog.checks import DIMENSION_SUITES_SQL, FACT_SUITES_SQL, MODEL_SUITES_SQL, SILVER_SUITE_SQL
from catalog.events import SILVER_SQL_COLUMNS, silver_events
from catalog.gold import FUNNEL_SQL
from catalog.registry import AS_OF, DATE, query
from catalog.views_sql import day, ts
from tidemark.operators import aggregates, quality
from tidemark.plans import gold, models, silver
from tidemark.session import scratch
from tidemark.sources import bronze, sinks
from tidemark.sources import silver as silver_source
from tidemark.streaming import events as event_stream
from tidemark.streaming import landing, profiles

TOTALS = """count(*) AS n, count(DISTINCT event_id) AS ids"""


@query("a1_read_bronze", "SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS browser, revenue, _source_file FROM bronze_events")
def _(spark, sf):
    path = scratch(spark, "bronze")
    views.bronze_events(spark, sf).drop("browser").withColumn("unknown", F.lit(1)).write.parquet(path)
    return bronze.read_bronze(spark, path).select("event_id", "event_type", "browser", "revenue", "_source_file")


@query(
    "a2_silver_day",
    f"""SELECT event_id, event_type, {day('event_date')} AS event_date, '2024-01-29' AS _processing_date FROM silver_events""",
)
def _(spark, sf):
    """Two processing days on disk; only one is read."""
    path = scratch(spark, "silver")
    table = silver_events(spark, sf)
    sinks.write_replace(table, path, DATE)
    sinks.write_replace(table, path, "2024-01-28")
    return silver_source.read_silver_events(spark, path, DATE).select("event_id", "event_type", "event_date", "_processing_date")


@query(
    "a3_orders_day",
    f"SELECT order_id, session_id, {day('order_date')} AS order_date, revenue_eur, is_first_order FROM silver_orders WHERE order_date = DATE '2024-01-15'",
)
def _(spark, sf):
    path = scratch(spark, "orders")
    views.silver_orders(spark, sf).write.partitionBy("order_date").parquet(path)
    return silver_source.read_silver_orders(spark, path, "2024-01-15").drop("line_items")


@query(
    "a4_write_replace",
    f"""SELECT event_type, {day('event_date')} AS event_date, {TOTALS} FROM silver_events WHERE has_revenue GROUP BY event_type, event_date""",
)
def _(spark, sf):
    """The smaller second run replaces the first; nothing stale is left."""
    path = scratch(spark, "silver")
    table = silver_events(spark, sf)
    sinks.write_replace(table, path, DATE)
    sinks.write_replace(table.filter("has_revenue"), path, DATE)
    back = silver_source.read_silver_events(spark, path, DATE)
    return back.groupBy("event_type", "event_date").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


@query("a5_file_count", f"SELECT true AS within_bound, {TOTALS} FROM silver_events")
def _(spark, sf):
    """At most one file per write task and (date, type)."""
    path = scratch(spark, "silver")
    sinks.write_replace(silver_events(spark, sf), path, DATE, files=4)
    back = silver_source.read_silver_events(spark, path, DATE).withColumn("file", F.col("_metadata.file_path"))
    per_folder = back.groupBy("event_date", "event_type").agg(
        F.count_distinct("file").alias("files"), F.count("*").alias("rows"), F.count_distinct("event_id").alias("folder_ids")
    )
    return per_folder.agg(
        F.bool_and(F.col("files") <= 4).alias("within_bound"), F.sum("rows").alias("n"), F.sum("folder_ids").alias("ids")
    )


@query("a6_publish_gold", f"{FUNNEL_SQL} UNION ALL SELECT * REPLACE ('2024-01-28' AS report_date) FROM ({FUNNEL_SQL})")
def _(spark, sf):
    """Two report days, one of them published twice."""
    path = scratch(spark, "gold")
    events = silver_events(spark, sf)
    for date in ("2024-01-28", DATE, DATE):
        sinks.publish_gold(aggregates.funnel_metrics(events, date, AS_OF), path, date)
    days = [sinks.read_day(spark, path, d) for d in ("2024-01-28", DATE)]
    return days[0].unionByName(days[1]).drop("_gold_processed_at")


@query("a7_publish_staging", FUNNEL_SQL)
def _(spark, sf):
    root = scratch(spark, "staging")
    table = aggregates.funnel_metrics(silver_events(spark, sf), DATE, AS_OF)
    for _ in range(2):
        sinks.publish_staging(table, root, "gold_funnel_metrics")
    return spark.read.parquet(f"{root}/STG_GOLD_FUNNEL_METRICS").drop("_gold_processed_at")


def landed(spark, sf, rows_per_file=100_000):
    """Bronze events landed by the day they were taken in."""
    path = scratch(spark, "landing")
    raw = views.bronze_events(spark, sf)
    day_taken = F.coalesce(F.substring("_ingested_at", 1, 10), F.lit("unknown"))
    bronze.land_raw(raw, path, day_taken, rows_per_file)
    return path


LANDED_SQL = "(SELECT *, coalesce(_ingested_at[1:10], 'unknown') AS date FROM bronze_events)"


@query("a8_land_raw", f"SELECT date, {TOTALS} FROM {LANDED_SQL} GROUP BY date")
def _(spark, sf):
    back = spark.read.parquet(landed(spark, sf)).withColumn("date", F.col("date").cast("string"))
    return back.groupBy("date").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


@query("a9_file_size", "SELECT true AS within_bound, count(*) AS n FROM bronze_events")
def _(spark, sf):
    back = spark.read.parquet(landed(spark, sf, rows_per_file=50)).select(F.col("_metadata.file_path").alias("file"))
    per_file = back.groupBy("file").agg(F.count("*").alias("rows"))
    return per_file.agg(F.bool_and(F.col("rows") <= 50).alias("within_bound"), F.sum("rows").alias("n"))


@query("a12_volume", f"SELECT count(DISTINCT date) AS days, true AS passed, false AS passed_default FROM {LANDED_SQL}")
def _(spark, sf):
    path = landed(spark, sf)
    files = bronze.landed_files(spark, path)
    days = files.agg(F.count_distinct(F.regexp_extract("path", "date=([^/]+)/", 1)).alias("days"))
    small = bronze.landing_volume(spark, path, min_files=10, min_bytes=1000).select("passed")
    full = bronze.landing_volume(spark, path).select(F.col("passed").alias("passed_default"))
    return days.select("days", small.scalar().alias("passed"), full.scalar().alias("passed_default"))


@query(
    "a13_write_clustered",
    f"SELECT order_id, {day('order_date')} AS order_date, shipping_country_code, revenue_eur FROM stg_orders WHERE order_date BETWEEN DATE '2022-01-01' AND DATE '2022-06-30'",
)
def _(spark, sf):
    path = scratch(spark, "clustered")
    orders = stars.stg_orders(spark, sf).select("order_id", "order_date", "shipping_country_code", "revenue_eur")
    sinks.write_clustered(orders, path, ["order_date", "shipping_country_code"], "order_id", files=8)
    return spark.read.parquet(path).filter(F.col("order_date").between("2022-01-01", "2022-06-30"))


@query(
    "i11_silver_job",
    "SELECT (SELECT count(*) FROM bronze_events) AS bronze_count, (SELECT count(*) FROM silver_events) AS silver_count, count(*) AS written, count(DISTINCT event_id) AS ids FROM silver_events",
)
def _(spark, sf):
    """The whole job: one read, one write, counts observed on the way."""
    source, target = scratch(spark, "bronze"), scratch(spark, "silver")
    views.bronze_events(spark, sf).write.parquet(source)
    counts = silver.run(spark, source, target, DATE, AS_OF)
    back = silver_source.read_silver_events(spark, target, DATE)
    return back.agg(
        F.lit(counts["bronze_count"]).cast("bigint").alias("bronze_count"),
        F.lit(counts["silver_count"]).cast("bigint").alias("silver_count"),
        F.count("*").alias("written"),
        F.count_distinct("event_id").alias("ids"),
    )


@query("a4_audited_publish", SILVER_SUITE_SQL)
def _(spark, sf):
    """Write, audit, publish: the suite's counters ride on the write, its results decide whether the day is switched."""
    source, target = scratch(spark, "bronze"), scratch(spark, "silver")
    views.bronze_events(spark, sf).write.parquet(source)
    report = silver.run(spark, source, target, DATE, AS_OF, suite=quality.silver_suite("2024-01-30 06:00:00"))
    rows = [tuple(r[c] for c in quality.RESULT) for r in report["checks"]]
    published = silver_source.read_silver_events(spark, target, DATE).count()
    if published != report["silver_count"]:
        raise AssertionError(f"{published} rows published, {report['silver_count']} written")
    return spark.createDataFrame(rows, "check string, column string, severity string, failing bigint, total bigint, ratio double, passed boolean")


def raw_tables(spark, sf) -> models.Raw:
    """The raw tables as they land, in folders."""
    makers = {
        "orders": views.raw_orders, "lines": views.raw_lines, "accounts": views.raw_accounts, "profiles": views.raw_profiles,
        "profile_log": views.profile_log, "products": views.raw_products, "order_heads": views.order_heads,
    }
    folders = {name: scratch(spark, f"raw-{name}") for name in makers}
    for name, make in makers.items():
        make(spark, sf).write.parquet(folders[name])
    return models.Raw(**folders)


@query(
    "i14_model_run",
    f"""SELECT * FROM (({MODEL_SUITES_SQL}) UNION ALL ({DIMENSION_SUITES_SQL}) UNION ALL ({FACT_SUITES_SQL}))""",
)
def _(spark, sf):
    """The second half of a day, from landed raw tables to published marts: what its tests say."""
    events, out = scratch(spark, "silver"), scratch(spark, "models")
    sinks.write_replace(silver_events(spark, sf), events, DATE)
    report = models.run(spark, raw_tables(spark, sf), events, out, DATE, AS_OF)
    return report.filter("table_name <> 'dim_time'")


@query(
    "i13_gold_job",
    """WITH day_events AS (SELECT * FROM silver_events),
    sales AS (SELECT DISTINCT s.country_code, s.device_type, s.referrer_channel FROM (SELECT * FROM silver_orders WHERE order_date = DATE '2024-01-29') o
      LEFT JOIN session_starts s ON o.session_id = s.session_id)
    SELECT 'gold_daily_sales' AS table_name, count(*) AS row_count FROM sales
    UNION ALL SELECT 'gold_funnel_metrics', count(*) FROM (SELECT DISTINCT country_code, device_type FROM day_events
      WHERE event_type IN ('product_view', 'add_to_cart', 'checkout_start', 'purchase'))
    UNION ALL SELECT 'gold_product_performance', count(DISTINCT json_extract_string(properties, '$.product_id')) FROM day_events
      WHERE event_type IN ('product_view', 'add_to_cart')
    UNION ALL SELECT 'gold_session_stats', count(*) FROM (SELECT DISTINCT country_code, device_type, referrer_channel FROM day_events)""",
)
def _(spark, sf):
    events, orders, out = scratch(spark, "silver"), scratch(spark, "orders"), scratch(spark, "gold")
    sinks.write_replace(silver_events(spark, sf), events, DATE)
    views.silver_orders(spark, sf).write.parquet(orders)
    return gold.run(spark, events, orders, out, DATE, AS_OF)


# --- streams --------------------------------------------------------------


_LOT = "substr(md5(concat_ws('|', event_id, event_timestamp)), 1, 2)"  # decides which lines are broken or bare text
BROKEN = f"{_LOT} < '08'"
BARE = f"{_LOT} BETWEEN '08' AND '0f'"


def message_lines(spark, sf) -> str:
    """Bronze events as JSON lines in several files, with broken and non-object lines between them."""
    path = scratch(spark, "messages")
    raw = views.bronze_events(spark, sf).drop("_ingested_at", "_source_file")
    good = F.to_json(F.struct(*[F.col(c) for c in raw.columns]))
    line = F.when(F.expr(BROKEN), F.concat(F.lit("{broken "), good)).when(F.expr(BARE), F.lit('"just text"')).otherwise(good)
    raw.select(line.alias("value")).repartition(6).write.text(path)
    return path


def land_messages(spark, sf):
    """Drain a backlog in bounded batches, then once more: the second run finds nothing new."""
    source, out, checkpoint = message_lines(spark, sf), scratch(spark, "landed"), scratch(spark, "checkpoint")
    for _ in range(2):
        messages = landing.message_files(spark, source, files_per_batch=2)
        landing.stream_bronze(messages, out, checkpoint, AS_OF, drain=True).awaitTermination()
    return spark.read.parquet(out)


@query(
    "k4_stream_bronze",
    f"""SELECT event_id, user_id, event_type, event_timestamp, page_url, properties, revenue, CAST(NULL AS VARCHAR) AS _raw,
      '2024-01-30T00:00:00Z' AS _ingested_at FROM bronze_events WHERE NOT ({BROKEN}) AND NOT ({BARE})
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, '"just text"', '2024-01-30T00:00:00Z' FROM bronze_events WHERE {BARE}""",
)
def _(spark, sf):
    good = land_messages(spark, sf).filter("_quality = 'ok'")
    return good.select(
        "event_id", "user_id", "event_type", "event_timestamp", "page_url", "properties", "revenue", "_raw", "_ingested_at"
    )


@query("k5_undecodable", f"SELECT event_id, event_type, event_timestamp FROM bronze_events WHERE {BROKEN}")
def _(spark, sf):
    """Broken lines keep their whole text; what they hold is read back from it."""
    bad = land_messages(spark, sf).filter("_quality = 'bad'").select(F.expr("substr(_raw, length('{broken ') + 1)").alias("text"))
    return bad.select(*[F.get_json_object("text", f"$.{c}").alias(c) for c in ("event_id", "event_type", "event_timestamp")])


@query(
    "k6_stream_silver",
    f"""SELECT event_id, session_id, event_type, {ts('event_ts')} AS event_ts, country_code, ip_anonymized, referrer_channel, revenue_eur FROM silver_events""",
)
def _(spark, sf):
    """At the default delay the streamed table equals the batch table, late events included; a restart adds nothing."""
    source, out, checkpoint = scratch(spark, "bronze"), scratch(spark, "silver"), scratch(spark, "checkpoint")
    views.bronze_events(spark, sf).write.parquet(source)
    for _ in range(2):
        feed = event_stream.bronze_stream(spark, source, files_per_batch=1)
        event_stream.stream_silver(feed, out, checkpoint, DATE, AS_OF, drain=True).awaitTermination()
    return spark.read.parquet(out).select(
        "event_id", "session_id", "event_type", "event_ts", "country_code", "ip_anonymized", "referrer_channel", "revenue_eur"
    )


@query(
    "k7_stream_upsert",
    f"""SELECT _id, city, {ts('updated_at')} AS updated_at FROM (
      SELECT *, row_number() OVER (PARTITION BY _id ORDER BY updated_at DESC, moved) AS rn FROM (
        SELECT _id, city, updated_at, 0 AS moved FROM raw_profiles UNION ALL
        SELECT _id, 'Moved ' || k, updated_at + INTERVAL 1 DAY * (k % 3 - 1), 1 FROM raw_profiles)) WHERE rn = 1""",
)
def _(spark, sf):
    """A base table and a stream of older, equal and newer changes."""
    source, log, checkpoint = scratch(spark, "changes"), scratch(spark, "log"), scratch(spark, "checkpoint")
    base = views.raw_profiles(spark, sf).select("_id", "city", "updated_at")
    changed = views.raw_profiles(spark, sf).selectExpr(
        "_id", "concat('Moved ', substr(_id, 3)) AS city",
        "updated_at + make_interval(0, 0, 0, cast(cast(substr(_id, 3) AS bigint) % 3 - 1 AS int)) AS updated_at",
    )
    changed.repartition(4).write.parquet(source)
    feed = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 2).parquet(source)
    profiles.stream_upsert(feed, log, checkpoint, drain=True).awaitTermination()
    return profiles.read_upserted(spark, log, base.schema, "_id", "updated_at", base)
