from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF
from tidemark.operators import contract, quality
from tidemark.plans import silver


def verdicts(df, *checks):
    return [(r.failing, r.total, r.passed) for r in quality.run_suite(df, list(checks)).collect()]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", "FR", 1.0), ("b", "DE", -1.0), ("b", "fra", None), (None, None, 5.0)], "id string, country string, amount double"
    )


@pytest.mark.parametrize(
    "make, want",
    [
        (lambda: quality.expect_not_null("id"), (1, 4, False)),
        (lambda: quality.expect_not_null("id", mostly=0.75), (1, 4, True)),
        (lambda: quality.expect_not_null("id", mostly=0.76), (1, 4, False)),
        (lambda: quality.expect_unique("id"), (2, 3, False)),
        (lambda: quality.expect_unique("country"), (0, 3, True)),
        (lambda: quality.expect_in_set("country", ["FR", "DE"]), (1, 3, False)),
        (lambda: quality.expect_length("country", 2, mostly=0.6), (1, 3, True)),
        (lambda: quality.expect_regex("country", "^[A-Z]{2}$"), (1, 3, False)),
        (lambda: quality.expect_between("amount", 0, 10), (1, 3, False)),
        (lambda: quality.expect_between("amount", high=10), (0, 3, True)),
        (lambda: quality.expect_row_count(1, 10), (0, 1, True)),
        (lambda: quality.expect_row_count(5, 10), (1, 1, False)),
        (lambda: quality.expect_true("amount < 9", F.col("amount") < 9), (0, 4, True)),
        (lambda: quality.expect_true("amount < 5", F.col("amount") < 5), (1, 4, False)),
    ],
)
def test_each_check_passes_and_fails(table, make, want):
    assert verdicts(table, make()) == [want]


def test_columns_relationship_and_freshness(spark, table):
    parent = spark.createDataFrame([("a",)], "id string")
    assert verdicts(table, quality.expect_relationship("id", parent, "id")) == [(2, 3, False)]
    assert verdicts(table, quality.expect_relationship("id", table, "id")) == [(0, 3, True)]
    assert [p for *_, p in verdicts(table, quality.expect_columns(["id", "missing"]))] == [True, False, False]
    stamped = table.withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert verdicts(stamped, quality.expect_fresh("at", 8, "2024-01-01 08:00:00")) == [(0, 1, True)]
    assert verdicts(stamped, quality.expect_fresh("at", 8, "2024-01-01 08:00:01")) == [(1, 1, False)]
    assert verdicts(stamped.filter("false"), quality.expect_fresh("at", 8, "2024-01-01 08:00:00")) == [(1, 1, False)]
    for form in ("string", "timestamp_ntz"):
        other = stamped.selectExpr(f"cast(at as {form}) as at")
        assert verdicts(other, quality.expect_fresh("at", 8, "2024-01-01 08:00:00")) == [(0, 1, True)]


def test_row_checks_share_one_scan(table):
    plan = quality.run_suite(table, [quality.expect_not_null("id"), quality.expect_length("country", 2)])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_unique_keys_share_one_pass(spark):
    df = spark.createDataFrame([("a", "b:c", 1), ("a:b", "c", 1), ("a", None, 2), ("a", None, 2), ("x", "y", 3), ("x", "y", 3)], "p string, q string, n int")
    checks = [quality.expect_unique("p", "q"), quality.expect_unique("n"), quality.expect_unique("q", severity="critical")]
    assert verdicts(df, *checks) == [(2, 4, False), (6, 6, False), (2, 4, False)]
    plan = quality.run_suite(df, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    assert verdicts(df.filter("false"), *checks) == [(0, 0, True)] * 3


def test_silver_suite_on_good_and_broken_data(bronze):
    good = silver.silver_events(bronze({}, {"event_id": "e2"}), "2024-01-15", AS_OF)
    suite = quality.silver_suite(AS_OF, 1, 10)
    quality.enforce(quality.run_suite(good, suite))
    assert quality.run_suite(good, suite).filter("NOT passed").count() == 0
    with pytest.raises(quality.QualityError, match="unique"):
        quality.enforce(quality.run_suite(good.unionByName(good), suite))


def test_gate_lists_only_failing_checks(spark):
    events = spark.createDataFrame([(None, "2024-01-01"), ("e", "2024-01-01")], "event_id string, event_date string")
    orders = spark.createDataFrame([(-1.0, "2024-01-01"), (5.0, "2024-01-01"), (-1.0, "2024-01-02")], "revenue_eur double, order_date string")
    events = events.withColumn("event_date", F.to_date("event_date"))
    orders = orders.withColumn("order_date", F.to_date("order_date"))
    got = {r.check_name: r.failing_rows for r in quality.quality_gate(events, orders, "2024-01-01").collect()}
    assert got == {"clickstream_null_event_id": 1, "orders_negative_revenue": 1, "daily_order_volume_too_low": 1}
    clean = quality.quality_gate(events.filter("event_id = 'e'"), orders.filter("revenue_eur > 0"), "2024-01-01", min_orders=1)
    assert clean.count() == 0


UUID = "550e8400-e29b-41d4-a716-446655440000"


@pytest.mark.parametrize(
    "change, broken",
    [
        ({}, None),
        ({"event_id": "evt-1"}, ["event_id:pattern"]),
        ({"event_id": None}, ["event_id:required"]),
        ({"event_type": "x"}, ["event_type:enum"]),
        ({"event_timestamp": None}, ["event_timestamp:required"]),
        ({"device_type": "watch"}, ["device_type:enum"]),
        ({"device_type": None, "country_code": None, "session_id": None}, None),
        ({"country_code": "fr"}, ["country_code:pattern"]),
        ({"session_id": ""}, ["session_id:minLength"]),
        ({"page_url": "x" * 2049}, ["page_url:maxLength"]),
        ({"page_url": "x" * 2048}, None),
        ({"user_id": None}, ["visitor:anyOf"]),
        ({"user_id": None, "anonymous_id": "a"}, None),
        ({"event_type": None, "user_id": None}, ["event_type:required", "visitor:anyOf"]),
    ],
)
def test_contract_rules(bronze, change, broken):
    df = bronze({"event_id": UUID, **change})
    assert contract.with_violations(df).first().violations == broken
    valid, quarantine = contract.check_contract(df)
    assert (valid.count(), quarantine.count()) == ((1, 0) if broken is None else (0, 1))
