from __future__ import annotations

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import aggregates, dedup, joins, merge, quality
from tidemark.plans import dimensions, facts
from tidemark.schemas import SYNC_STATE

D = lambda n: dt.datetime(2024, 1, n)


def test_lookup_keeps_every_left_row_and_spreads_null_keys(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("k"), F.col("id").alias("row"))
    right = spark.createDataFrame([("0", "zero"), (None, "never")], "k string, name string")
    out = joins.lookup(left, right, "k", spread_by="row")
    assert out.count() == 3000
    assert [r.name for r in out.filter("name IS NOT NULL").collect()] == ["zero"]


def test_attribution_counts_each_order_once_with_the_latest_start(spark):
    events = spark.createDataFrame(
        [("e1", "s1", "session_start", D(1), "FR"), ("e2", "s1", "session_start", D(2), "DE"), ("e3", "s1", "purchase", D(3), "ES"),
         ("e4", None, "session_start", D(3), "IT")],
        "event_id string, session_id string, event_type string, event_ts timestamp, country_code string",
    ).withColumns({c: F.lit("x") for c in ("device_type", "referrer_channel", "user_id")})
    orders = spark.createDataFrame([("o1", "s1"), ("o2", None), ("o3", "s9")], "order_id string, session_id string")
    got = {r.order_id: r.country_code for r in joins.attribute_orders(orders, events).collect()}
    assert got == {"o1": "DE", "o2": None, "o3": None}


def test_lookup_keys_uses_the_unknown_member(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, id int")
    dim = spark.createDataFrame([("a", "sk-a")], "k string, sk string")
    assert sorted(r.sk for r in joins.lookup_keys(fact, dim, "k", "sk", spread_by="id").collect()) == ["-1", "-1", "sk-a"]


def test_orphans_and_expand(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert [(r.k, r.child_rows) for r in joins.orphans(child, parent, "k").collect()] == [("b", 2)]
    assert joins.expand_by_series(parent, 5, F.col("n") <= 3).count() == 3


def test_upsert_newer(spark):
    schema = "id string, v string, at timestamp"
    target = spark.createDataFrame([("a", "old", D(2)), ("b", "old", D(2)), ("c", "old", D(2)), ("n", "old", None)], schema)
    source = spark.createDataFrame(
        [("a", "new", D(3)), ("b", "new", D(2)), ("c", "new", D(1)), ("d", "new", None), ("n", "new", D(9)), ("a", "mid", D(2))], schema
    )
    once = merge.upsert_newer(target, source, "id", "at")
    assert {r.id: r.v for r in once.collect()} == {"a": "new", "b": "old", "c": "old", "d": "new", "n": "old"}
    twice = merge.upsert_newer(once, source, "id", "at")
    assert twice.exceptAll(once).count() == 0 and once.count() == twice.count()


def test_upsert_newer_sorts_touched_keys_only(spark):
    schema = "id string, v string, at timestamp"
    target = spark.createDataFrame([(f"k{i}", "old", D(2)) for i in range(500)] + [(None, "old", D(2))] * 2, schema)
    source = spark.createDataFrame([("k7", "new", D(3)), (None, "new", D(1))], schema)
    merged = merge.upsert_newer(target, source, "id", "at")
    assert merged.count() == 503 and merged.filter("v = 'new'").count() == 2
    seen = Observation("sorted")
    real = merge.first_by
    merge.first_by = lambda df, *rest: real(df.observe(seen, F.count(F.lit(1)).alias("rows")), *rest)
    try:
        merge.upsert_newer(target, source, "id", "at").write.format("noop").mode("overwrite").save()
    finally:
        merge.first_by = real
    assert seen.get["rows"] == 2


def test_upsert_last_run_wins_and_adds_columns(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    source = spark.createDataFrame([("b", 3, "x"), ("c", 4, "y")], "id string, v int, w string")
    once = merge.upsert(target, source, "id")
    assert sorted((r.id, r.v, r.w) for r in once.collect()) == [("a", 1, None), ("b", 3, "x"), ("c", 4, "y")]
    assert merge.upsert(once, source, "id").exceptAll(once).count() == 0
    twice = spark.createDataFrame([("b", 5), ("b", 9), (None, 1), (None, 1)], "id string, v int")
    assert sorted((r.id or "", r.v) for r in merge.upsert(target, twice, "id", "v").collect()) == [("", 1), ("", 1), ("a", 1), ("b", 9)]


def test_repeats_with_nested_maps(spark):
    df = spark.sql("SELECT 1 AS id, n AS at, struct(map('a', n)) AS s, array(map('b', n)) AS l FROM VALUES (1), (2) AS t(n)")
    assert [r["at"] for r in dedup.dedup_latest(df, "id", "at").collect()] == [2]


def test_marks(spark):
    empty = spark.createDataFrame([], SYNC_STATE)
    source = spark.createDataFrame([("a", D(1)), ("b", D(2)), ("c", D(2)), ("d", D(3))], "id string, updated_at timestamp")
    assert merge.read_increment(source, empty, "profiles").count() == 4
    state = merge.advance_mark(empty, "profiles", source.filter("id IN ('a', 'b')"))
    assert [(r.collection_name, r.last_sync_at) for r in state.collect()] == [("profiles", D(2))]
    # Rows that share the mark's time are read again by default, and left out on request.
    assert sorted(r.id for r in merge.read_increment(source, state, "profiles").collect()) == ["b", "c", "d"]
    assert [r.id for r in merge.read_increment(source, state, "profiles", strict=True).collect()] == ["d"]
    assert merge.advance_mark(state, "profiles", source.filter("id = 'none'")).collect() == state.collect()
    assert merge.advance_mark(state, "profiles", source.filter("id = 'a'")).collect() == state.collect()
    assert merge.read_increment(source, state, "consents").count() == 4


def test_funnel_steps_never_exceed_sessions_and_zero_gives_null(spark):
    rows = [(f"s{i % 7}", "FR", "desktop", t) for i, t in enumerate(["product_view", "add_to_cart", "search"] * 9)]
    events = spark.createDataFrame(rows, "session_id string, country_code string, device_type string, event_type string")
    row = aggregates.funnel_metrics(events, "2024-01-01").first()
    assert max(row.sessions_product_view, row.sessions_add_to_cart) <= row.total_sessions
    assert row.sessions_checkout_start == 0 and row.checkout_to_purchase_rate is None


def test_session_bounce_and_one_channel(spark):
    rows = [("s1", "e1", D(1), "organic_search", "/a"), ("s1", "e2", D(2), "internal", "/b"), ("s2", "e3", D(1), "direct", "/a")]
    events = spark.createDataFrame(
        rows, "session_id string, event_id string, event_ts timestamp, referrer_channel string, page_path string"
    ).withColumns({"country_code": F.lit("FR"), "device_type": F.lit("d"), "has_revenue": F.lit(False)})
    assert aggregates.session_rollup(events).count() == 3
    whole = {r.session_id: r for r in aggregates.session_rollup(events, one_channel=True).collect()}
    assert len(whole) == 2 and whole["s1"].referrer_channel == "organic_search" and whole["s1"].duration_s == 86400
    assert whole["s2"].is_bounce and not whole["s1"].is_bounce


def _line_fact(spark):
    """A line with a product and an order, one without either, and one without an order id."""
    lines = spark.createDataFrame(
        [("o1", "l1", "p1", 2, 5.0, 1.0), ("o1", "l2", "p9", 1, 3.0, 0.0), (None, "l3", "p1", 1, 3.0, 0.0), ("o9", "l4", "p1", 1, 3.0, 0.0)],
        "order_id string, line_item_id string, product_id string, quantity int, unit_price_eur double, discount_eur double",
    )
    orders = spark.createDataFrame(
        [("o1", "c1", None, "2024-01-02", "paid", "FR"), (None, "c1", None, "2024-01-02", "paid", "FR")],
        "order_id string, customer_id string, session_id string, d string, order_status string, shipping_country_code string",
    ).selectExpr(
        "*", "cast(d AS date) AS order_date", "1D AS shipping_cost_eur", "1D AS tax_eur", "'card' AS payment_method", "true AS is_first_order", "d AS created_at"
    )
    customers = spark.createDataFrame([("c1", "sk1", True)], "customer_id string, customer_sk string, is_current boolean")
    products = spark.createDataFrame(
        [("p1", "psk", "One", "a", "b", "x", True)],
        "product_id string, product_sk string, product_name string, category_l1 string, category_l2 string, brand string, is_current boolean",
    )
    events = spark.createDataFrame([], "event_id string, session_id string, event_type string, event_ts timestamp, referrer_channel string, device_type string, properties string")
    return facts.fact_order_lines(lines, orders, customers, products, dimensions.dim_time(spark), events)


def test_lines_meet_their_products_before_their_orders(spark):
    """Order columns are wide and belong to many lines: no shuffle of lines may come after the join with orders."""
    fact = _line_fact(spark)
    got = sorted((r.line_item_id, r.product_sk, r.product_name, r.order_status, r.net_revenue_eur) for r in fact.collect())
    assert got == [("l1", "psk", "One", "paid", 9.0), ("l2", "-1", None, "paid", 3.0)]
    joins_from_top = [line for line in fact._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
    assert "order_id" in joins_from_top[0]


def test_the_fact_suite_reads_only_its_columns(spark):
    fact = _line_fact(spark)
    whole, slim = (quality.run_suite(df, quality.fact_lines_suite()) for df in (fact, fact.select(*quality.FACT_LINES_READ)))
    assert sorted(map(str, whole.collect())) == sorted(map(str, slim.collect()))
