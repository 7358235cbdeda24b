from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF
from tidemark.operators import documents, merge, quality
from tidemark.plans import daily, dimensions, gold, silver, staging
from tidemark.sources import bronze as bronze_source
from tidemark.sources import silver as silver_source
from tidemark.sources import sinks
from tidemark.streaming import events as event_stream
from tidemark.streaming import landing, profiles

DATE = "2024-01-15"


def test_rerun_replaces_only_its_day(spark, bronze, tmp_path):
    path = str(tmp_path / "silver")
    big = silver.silver_events(bronze(*[{"event_id": f"e{i}", "event_timestamp": f"2024-01-{10 + i % 5}T00:00:00Z"} for i in range(20)]), DATE, AS_OF)
    for date in ("2024-01-14", DATE):
        sinks.write_replace(big, path, date)
    sinks.write_replace(big.filter("event_id = 'e1'"), path, DATE)
    assert silver_source.read_silver_events(spark, path, DATE).count() == 1
    assert silver_source.read_silver_events(spark, path, "2024-01-14").count() == 20
    assert all(f"_processing_date={DATE}/" in f for f in silver_source.read_silver_events(spark, path, DATE).inputFiles())


def test_silver_job_counts(spark, bronze, tmp_path):
    source, target = str(tmp_path / "b"), str(tmp_path / "s")
    bronze({}, {"event_id": None}, {"event_id": "e2"}, {"event_id": "e2"}).write.parquet(source)
    counts = silver.run(spark, source, target, DATE, AS_OF)
    assert (counts["bronze_count"], counts["silver_count"], counts["drop_pct"]) == (4, 2, 50.0)


def test_day_is_published_only_after_its_audit(spark, bronze, tmp_path):
    source, target = str(tmp_path / "b"), str(tmp_path / "s")
    suite = quality.silver_suite(AS_OF, 1, 10)
    bronze({}, {"event_id": None}, {"event_id": "e2"}, {"event_id": "e2"}).write.parquet(source)
    report = silver.run(spark, source, target, DATE, AS_OF, suite=suite)
    assert (report["bronze_count"], report["silver_count"]) == (4, 2)
    written = silver_source.read_silver_events(spark, target, DATE)
    direct = quality.run_suite(written, suite).collect()
    assert sorted(map(tuple, direct)) == sorted(tuple(r.values()) for r in report["checks"])

    # Wrong rows come in for the same day: the job raises, yesterday's rows stay, nothing else is left behind.
    bronze({"event_id": "e9", "country_code": "PRT"}).write.mode("overwrite").parquet(source)
    strict = [*suite, quality.expect_length("country_code", 2, severity="critical")]
    with pytest.raises(quality.QualityError, match=r"length\(country_code\)") as raised:
        silver.run(spark, source, target, DATE, AS_OF, suite=strict)
    assert any(r["check"] == "length" and r["failing"] == 1 for r in raised.value.results)
    assert {r.event_id for r in silver_source.read_silver_events(spark, target, DATE).collect()} == {"e1", "e2"}
    assert os.listdir(target) == [f"_processing_date={DATE}"]
    # Without rows the audit still runs.
    bronze({"event_id": None}).write.mode("overwrite").parquet(source)
    empty = silver.run(spark, source, target, "2024-01-14", AS_OF, suite=[quality.expect_row_count(1, 10), quality.expect_not_null("event_id")])
    assert [(r["check"], r["failing"], r["total"], r["passed"]) for r in empty["checks"]] == [("row_count", 1, 1, False), ("not_null", 0, 0, True)]


def test_audit_finds_a_duplicated_event(spark, bronze, tmp_path):
    target = str(tmp_path / "s")
    suite = quality.silver_suite(AS_OF, 1, 10)
    good = silver.silver_events(bronze({}, {"event_id": "e2"}), DATE, AS_OF)
    for rows, fails in ((good, False), (good.unionByName(good.filter("event_id = 'e2'")), True)):
        watch = quality.Watch(suite)
        write = lambda: sinks.write_replace(rows, target, DATE, watch=watch.on, audit=lambda w: quality.audit(w, suite, watch))  # noqa: B023, E731
        if fails:
            with pytest.raises(quality.QualityError, match=r"unique\(event_id\)"):
                write()
        else:
            write()
    assert silver_source.read_silver_events(spark, target, DATE).count() == 2


def test_gold_days_and_counts(spark, bronze, tmp_path):
    events, orders, out = (str(tmp_path / n) for n in ("e", "o", "g"))
    sinks.write_replace(silver.silver_events(bronze({"event_type": "product_view"}, {"event_id": "e2", "event_type": "session_start"}), DATE, AS_OF), events, DATE)
    spark.createDataFrame(
        [("o1", "visit-7", dt.date(2024, 1, 15), 10.0, True, [("lamp-31", 2, 5.0)])],
        "order_id string, session_id string, order_date date, revenue_eur double, is_first_order boolean, "
        "line_items array<struct<product_id string, quantity int, unit_price_eur double>>",
    ).write.parquet(orders)
    for _ in range(2):
        counts = {r.table_name: r.row_count for r in gold.run(spark, events, orders, out, DATE, AS_OF).collect()}
    assert counts == dict.fromkeys(["gold_daily_sales", "gold_funnel_metrics", "gold_product_performance", "gold_session_stats"], 1)
    sales = sinks.read_day(spark, f"{out}/gold_daily_sales", DATE).first()
    assert (sales.country_code, sales.total_orders, sales.new_customer_rate) == ("PT", 1, 1.0)
    assert os.path.isdir(f"{out}/staging/STG_GOLD_DAILY_SALES")
    sinks.publish_gold(sinks.read_day(spark, f"{out}/gold_daily_sales", DATE).filter("false"), f"{out}/gold_daily_sales", DATE)
    assert sinks.read_day(spark, f"{out}/gold_daily_sales", DATE).count() == 0


def test_whole_day_stops_on_small_landing_and_failing_gate(spark, bronze, tmp_path):
    paths = daily.Paths(*(str(tmp_path / n) for n in ("b", "s", "o", "g")))
    bronze({"event_type": "product_view"}).write.parquet(paths.bronze_events)
    spark.createDataFrame(
        [("o1", None, dt.date(2024, 1, 15), 10.0, True, [])],
        "order_id string, session_id string, order_date date, revenue_eur double, is_first_order boolean, "
        "line_items array<struct<product_id string, quantity int, unit_price_eur double>>",
    ).write.parquet(paths.silver_orders)
    with pytest.raises(daily.LandingTooSmall):
        daily.run_day(spark, paths, DATE, AS_OF)
    with pytest.raises(daily.GateFailed, match="daily_order_volume_too_low"):
        daily.run_day(spark, paths, DATE, AS_OF, min_files=1, min_bytes=1)
    counts = daily.run_day(spark, paths, DATE, AS_OF, min_files=1, min_bytes=1, min_orders=1)
    assert counts.count() == 4


def test_landing_bounds_files_and_appends(spark, tmp_path):
    path = str(tmp_path / "land")
    for _ in range(2):
        bronze_source.land_raw(spark.range(100).coalesce(1), path, DATE, rows_per_file=30)
    files = bronze_source.landed_files(spark, path)
    assert files.count() == 8 and spark.read.parquet(path).count() == 200
    row = bronze_source.landing_volume(spark, path, 8, 1).first()
    assert row.passed and not bronze_source.landing_volume(spark, path, 9, 1).first().passed


def test_clustered_files_split_a_hot_value_and_prune(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 > 0, "FR").otherwise("DE").alias("country"))
    sinks.write_clustered(df, path, ["country"], "id", files=6)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.count_distinct("country").alias("c"))
    rows = per_file.collect()
    assert len(rows) == 6 and max(r.n for r in rows) < 3000 and sum(r.c for r in rows) <= 7


def test_api_pages(spark):
    pages = spark.createDataFrame(
        [(1, '{"data": [{"a": 1}, {"a": 2}], "meta": {"next_cursor": "c2"}}'), (2, '[{"a": 3}]'), (3, '{"other": []}'), (4, "broken"), (5, '{"data": []}')],
        "page int, body string",
    )
    got = bronze_source.explode_api_pages(pages).select("page", F.get_json_object("record", "$.a").alias("a")).collect()
    assert sorted((r.page, r.a) for r in got) == [(1, "1"), (1, "2"), (2, "3")]
    nested = spark.createDataFrame([(1, '{"x": {"y": [1, 2, 3]}}')], "page int, body string")
    assert bronze_source.explode_api_pages(nested, "x.y").count() == 3
    assert {r.page: r.next_cursor for r in bronze_source.page_cursors(pages).collect()} == {1: "c2", 2: None, 3: None, 4: None, 5: None}


def test_unreadable_pages_are_reported(spark):
    bodies = ['{"data": [{"a": 1}]}', "[]", '{"other": []}', "broken", None, '{"data": {"a": 1}}', '{"data": null}', "[broken", '{"data": []}', "7"]
    pages = spark.createDataFrame(list(enumerate(bodies)), "page int, body string")
    got = {r.page: (r.reason, r.body) for r in bronze_source.unreadable_pages(pages).collect()}
    reasons = {2: "no records", 3: "not json", 4: "no body", 5: "not a list", 6: "no records", 7: "not json", 9: "no records"}
    assert got == {page: (reason, bodies[page]) for page, reason in reasons.items()}


def test_a_failing_write_leaves_the_old_day(spark, bronze, tmp_path):
    path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    table = silver.silver_events(bronze({}, {"event_id": "e2"}), DATE, AS_OF)
    sinks.write_replace(table, path, DATE)
    sinks.publish_gold(table.select("event_id"), gold_path, DATE)
    broken = table.withColumn("os", F.raise_error(F.lit("no such row")).cast("string"))
    with pytest.raises(Exception, match="no such row"):
        sinks.write_replace(broken, path, DATE)
    with pytest.raises(Exception, match="no such row"):
        sinks.publish_gold(broken.select("os"), gold_path, DATE)
    assert silver_source.read_silver_events(spark, path, DATE).count() == 2 and sinks.read_day(spark, gold_path, DATE).count() == 2
    sinks.write_replace(table.filter("event_id = 'e2'"), path, DATE)
    assert [r.event_id for r in spark.read.parquet(path).collect()] == ["e2"]
    assert os.listdir(path) == [f"_processing_date={DATE}"] and os.listdir(gold_path) == [f"report_date={DATE}"]


def test_documents(spark):
    df = spark.createDataFrame(
        [("1", "u1", "+331", "", {"k": "v"}, ["a"], dt.datetime(2024, 1, 1), 5, None)],
        "_id string, user_id string, phone string, address string, consents map<string,string>, tags array<string>, updated_at timestamp, size int, nick string",
    )
    row = documents.extract_documents(df, "profiles", as_of=AS_OF).first()
    assert row.phone_hash and len(row.phone_hash) == 64 and row.address_hash is None
    assert (row.consents, row.tags, row._extra) == ('{"k":"v"}', '["a"]', '{"size":5}')
    assert row.updated_at == "2024-01-01T00:00:00.000000"
    assert not {"phone", "address", "size"} & set(row.asDict())


def test_calendar(spark):
    cal = dimensions.dim_time(spark)
    assert cal.count() == 4018
    quality.enforce(quality.run_suite(cal, quality.dim_time_suite()))
    day = {r.time_sk: r for r in cal.collect()}
    assert day[20240107].day_of_week == 0 and day[20240107].is_weekend and day[20240714].is_public_holiday_fr
    assert (day[20241126].commercial_period, day[20240630].commercial_period, day[20240301].commercial_period) == ("black_friday_week", "summer_sales", "standard")
    flags = dimensions.relative_flags(cal, "2024-03-10")
    assert flags.filter("is_today OR is_yesterday").count() == 2
    assert flags.filter("is_last_7d AND calendar_date <= '2024-03-10'").count() == 7


def test_customer_history_is_idempotent_and_closes_old_rows(spark):
    rows = [("c1", "Paris", dt.datetime(2024, 1, 1)), ("c1", "Lyon", dt.datetime(2024, 2, 1)), ("c2", "Rome", dt.datetime(2024, 1, 1))]
    schema = "customer_id string, city string, crm_updated_at timestamp"
    full = spark.createDataFrame(rows, schema).withColumns(
        {c: F.lit("x") for c in ("email_hashed", "first_name", "last_name", "country_code", "customer_segment", "acquisition_channel")}
    ).withColumn("acquisition_date", F.lit(None).cast("date"))
    old = dimensions.dim_customers_scd2(full.filter("city <> 'Lyon'"))
    new = dimensions.dim_customers_scd2(full.filter("city = 'Lyon'"), old)
    got = {(r.customer_id, r.city): (r.valid_to, r.is_current) for r in new.collect()}
    assert got == {("c1", "Paris"): (dt.datetime(2024, 2, 1), False), ("c1", "Lyon"): (None, True), ("c2", "Rome"): (None, True)}
    again = dimensions.dim_customers_scd2(full, new)
    assert again.select(new.columns).exceptAll(new).count() == 0 and again.count() == 3
    back = full.filter("city = 'Paris'").withColumn("crm_updated_at", F.lit("2024-04-01").cast("timestamp"))
    returned = dimensions.dim_customers_scd2(back, new)
    assert returned.count() == returned.select("customer_sk").distinct().count() == 4
    gone = full.filter("city = 'Lyon'").withColumns({"crm_updated_at": F.lit("2024-05-01").cast("timestamp"), "has_left": F.lit(True)})
    left = dimensions.dim_customers_scd2(gone, new)
    ends = {(r.customer_id, r.city): r.valid_to for r in left.collect()}
    assert ends == {("c1", "Paris"): dt.datetime(2024, 2, 1), ("c1", "Lyon"): dt.datetime(2024, 5, 1), ("c2", "Rome"): None}
    assert dimensions.dim_customers_scd2(full, left).select(left.columns).exceptAll(left).count() == 0
    same = full.filter("city = 'Lyon'").withColumn("crm_updated_at", F.lit("2024-03-01").cast("timestamp"))
    assert dimensions.dim_customers_scd2(same, new).count() == 3  # nothing changed, no new version


def test_staged_customers_use_the_latest_row(spark):
    cols = ["email", "first_name", "last_name", "billing_country_code", "billing_city", "billing_postal_code", "phone_country_code",
            "acquisition_channel__c", "acquisition_date__c", "created_date"]
    df = spark.createDataFrame(
        [("a", "2024-01-01", False, "mid"), ("a", "2024-01-02", True, "mid"), ("b", "2024-01-01", True, "mid"), ("b", "2024-01-02", False, None),
         ("c", "2024-01-01", False, "Internal"), (None, "2024-01-01", False, "mid")],
        "account_id string, system_modstamp string, is_deleted boolean, customer_segment__c string",
    ).withColumns({c: F.lit(None).cast("string") for c in cols})
    got = staging.stg_customers(df).collect()
    assert [(r.customer_id, r.customer_segment, r.country_code) for r in got] == [("b", "unknown", "XX")]


# --- streams --------------------------------------------------------------


def test_stream_landing_separates_bad_lines_and_restarts_cleanly(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "cp"))
    lines = ['{"event_id": "e1", "revenue": 5}', "{broken", '"text"', "42", '{"event_id": "e2"}']
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(source)

    def drain():
        landing.stream_bronze(landing.message_files(spark, source, 1), out, check, AS_OF, drain=True).awaitTermination()
        return spark.read.parquet(out)

    assert drain().groupBy("_quality").count().orderBy("_quality").collect() == [("bad", 1), ("ok", 4)]
    assert sorted(r._raw for r in drain().filter("_raw IS NOT NULL").collect()) == ['"text"', "42", "{broken"]
    spark.createDataFrame([('{"event_id": "e3"}',)], "value string").write.mode("append").text(source)
    got = drain()
    assert got.count() == 6 and sorted(r.event_id for r in got.filter("event_id IS NOT NULL").collect()) == ["e1", "e2", "e3"]


def test_stream_silver_equals_batch(spark, bronze, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows = [{"event_id": f"e{i % 30}", "event_timestamp": f"2024-01-15T10:{i % 30:02d}:00Z"} for i in range(60)] + [{"event_id": None}]
    bronze(*rows).repartition(4).write.parquet(source)
    for _ in range(2):
        event_stream.stream_silver(event_stream.bronze_stream(spark, source, 1), out, check, DATE, AS_OF, drain=True).awaitTermination()
    keep = ["event_id", "event_ts", "ip_anonymized", "revenue_eur"]
    batch = silver.silver_events(spark.read.parquet(source), DATE, AS_OF).select(keep)
    streamed = spark.read.parquet(out).select(keep)
    assert streamed.exceptAll(batch).count() == 0 and streamed.count() == batch.count() == 30


def test_stream_silver_keeps_a_first_copy_that_arrives_late(spark, bronze, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "cp"))
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def drain(*rows):
        bronze(*rows).coalesce(1).write.mode("append").parquet(source)
        event_stream.stream_silver(event_stream.bronze_stream(spark, source, 1), out, check, DATE, AS_OF, drain=True).awaitTermination()
        return sorted(r.event_id for r in spark.read.parquet(out).collect())

    late = {"event_id": "late", "event_timestamp": "2024-01-02T00:00:00Z"}
    assert drain({"event_id": "new", "event_timestamp": "2024-01-20T00:00:00Z"}) == ["new"]
    assert drain(late, {"event_id": "new2", "event_timestamp": "2024-01-21T00:00:00Z"}) == ["late", "new", "new2"]
    assert drain(late, {"event_id": "new", "event_timestamp": "2024-01-20T00:00:00Z"}) == ["late", "new", "new2"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_stream_upsert_equals_a_merge_per_batch(spark, tmp_path):
    source, log, check = (str(tmp_path / n) for n in ("in", "log", "cp"))
    schema = "_id string, v string, updated_at timestamp"
    at = lambda day: dt.datetime(2024, 1, day)
    target = base = spark.createDataFrame([("a", "base", at(2)), ("n", "base", None)], schema)
    batches = [[("c", "first", None), ("d", "first", at(3)), ("e", "none", None), ("e", "some", at(1))],
               [("c", "second", at(5)), ("d", "second", None), ("n", "new", at(9)), ("e", "late", at(4))],
               [("a", "new", at(4)), ("d", "third", at(3)), ("c", "third", at(9))]]
    for rows in batches:
        batch = spark.createDataFrame(rows, schema).coalesce(1)
        batch.write.mode("append").parquet(source)
        target = merge.upsert_newer(target, batch, "_id", "updated_at")
        feed = spark.readStream.schema(base.schema).parquet(source)
        profiles.stream_upsert(feed, log, check, drain=True).awaitTermination()
    got = profiles.read_upserted(spark, log, base.schema, "_id", "updated_at", base)
    assert {r._id: r.v for r in got.collect()} == {r._id: r.v for r in target.collect()} == {
        "a": "new", "n": "base", "c": "first", "d": "first", "e": "late"}


def test_stream_upsert_keeps_the_newest_and_survives_a_repeat(spark, tmp_path):
    source, log, check, base_out = (str(tmp_path / n) for n in ("in", "log", "cp", "base"))
    schema = "_id string, v string, updated_at timestamp"
    base = spark.createDataFrame([("a", "base", dt.datetime(2024, 1, 2)), ("b", "base", dt.datetime(2024, 1, 2)), ("n", "base", None)], schema)
    changes = [("a", "new", dt.datetime(2024, 1, 3)), ("b", "old", dt.datetime(2024, 1, 1)), ("b", "same", dt.datetime(2024, 1, 2)),
               ("c", "new", None), ("n", "new", dt.datetime(2024, 1, 9))]
    spark.createDataFrame(changes, schema).repartition(2).write.parquet(source)
    for _ in range(2):
        feed = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(source)
        profiles.stream_upsert(feed, log, check, drain=True).awaitTermination()
    want = {"a": "new", "b": "base", "c": "new", "n": "base"}
    got = profiles.read_upserted(spark, log, base.schema, "_id", "updated_at", base)
    assert {r._id: r.v for r in got.collect()} == want
    profiles.compact(spark, log, base.schema, "_id", "updated_at", base_out, base)
    assert {r._id: r.v for r in spark.read.parquet(base_out).collect()} == want


def test_files_cap_a_folder_not_the_tasks(spark, tmp_path):
    """Many dates and types with ``files=1``: one file each, and yet more than one task writes."""
    path = str(tmp_path / "silver")
    rows = spark.range(200).selectExpr("concat('e', id) AS event_id", "date_add(DATE'2024-01-01', cast(id % 20 AS int)) AS event_date", "concat('t', id % 2) AS event_type")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_replace(rows, path, DATE, files=1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    written = [r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()]
    folders = {f.rsplit("/", 1)[0] for f in written}
    assert len(written) == len(folders) == 20
    assert len({f.rsplit("/", 1)[1].split("-")[1] for f in written}) > 1
