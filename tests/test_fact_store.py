"""The stored fact: increments, late and moved rows, repeats and failures, against one full build."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import quality
from tidemark.plans import facts
from tidemark.schemas import BRONZE_EVENTS
from tidemark.sources import sinks

SCHEMA = "id string, day date, amount int"
D = [dt.date(2024, 1, n) for n in range(1, 8)]


def stored(spark, path):
    return sorted(map(tuple, sinks.read_days(spark, path, "day").select("id", "day", "amount").collect()), key=str)


def merge(spark, path, rows, **more):
    return sinks.merge_days(spark.createDataFrame(rows, SCHEMA), path, "id", "day", **more)


def test_only_touched_days_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(spark, path, [("a", D[0], 1), ("b", D[0], 1), ("c", D[1], 1), ("d", D[2], 1), ("e", D[3], 1)])
    before = {d: os.listdir(f"{path}/{d}") for d in os.listdir(path)}
    # b changes, d moves to the fifth and empties its day, f is late, c stays where nothing happens.
    touched = merge(spark, path, [("b", D[0], 2), ("d", D[4], 2), ("f", D[0], 1)])
    assert sorted(touched) == [D[0], D[2], D[4]]
    assert stored(spark, path) == [("a", D[0], 1), ("b", D[0], 2), ("c", D[1], 1), ("d", D[4], 2), ("e", D[3], 1), ("f", D[0], 1)]
    assert sorted(os.listdir(path)) == [f"day={D[n]}" for n in (0, 1, 3, 4)]
    for n in (1, 3):
        assert os.listdir(f"{path}/day={D[n]}") == before[f"day={D[n]}"]


def test_repeats_ties_nulls_and_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert merge(spark, path, []) == [] and sinks.read_days(spark, path, "day") is None
    rows = [("a", D[0], 1), ("a", D[0], 1), ("b", None, 3), ("c", None, 4)]
    for _ in range(2):
        merge(spark, path, rows)
        assert stored(spark, path) == [("a", D[0], 1), ("b", None, 3), ("c", None, 4)]
    merge(spark, path, [("b", D[1], 3)])
    merge(spark, path, [("a", None, 1)])
    assert stored(spark, path) == [("a", None, 1), ("b", D[1], 3), ("c", None, 4)]
    assert merge(spark, path, []) == []
    with pytest.raises(ValueError, match="amount"):
        sinks.merge_days(spark.createDataFrame([("a", D[0])], "id string, day date"), path, "id", "day")


def test_failed_audit_and_crash_between_two_days(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge(spark, path, [("a", D[0], 1), ("b", D[1], 1)])

    def refuse(written):
        assert sorted(r.id for r in written.collect()) == ["a", "c"]
        raise quality.QualityError([])

    with pytest.raises(quality.QualityError):
        merge(spark, path, [("a", D[2], 1), ("c", D[2], 1)], audit=refuse)
    assert stored(spark, path) == [("a", D[0], 1), ("b", D[1], 1)] and len(os.listdir(path)) == 2

    moves, whole = [], sinks._move

    def dies(fs, source, target):
        moves.append(target)
        if len(moves) == fatal:
            raise OSError("lost")
        whole(fs, source, target)

    # The first day is put back, or one day is switched and the other not: no row is ever lost.
    monkeypatch.setattr(sinks, "_move", dies)
    for fatal in (1, 2, 3, 4):
        moves.clear()
        with pytest.raises(OSError, match="lost"):
            merge(spark, path, [("a", D[2], 2), ("b", D[1], 1), ("c", D[1], 1)])
        assert {r[0] for r in stored(spark, path)} >= {"a", "b"}
    monkeypatch.undo()
    merge(spark, path, [("a", D[2], 2), ("b", D[1], 1), ("c", D[1], 1)])
    assert stored(spark, path) == [("a", D[2], 2), ("b", D[1], 1), ("c", D[1], 1)]


def test_two_increments_equal_a_full_build(spark, tmp_path):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=n) for n in range(10)]
    order = (
        "order_id string, customer_id string, session_id string, order_date date, shipping_cost_eur double, tax_eur double, order_status string, "
        "payment_method string, is_first_order boolean, shipping_country_code string, created_at string"
    )
    heads = [(f"o{k}", f"c{k % 3}", None, days[k % 10], 1.0, 2.0, "confirmed", "card", False, "FR", None) for k in range(30)]
    items = [(f"o{k}", f"{n}", f"p{n}", 1 + n, 5.0, 0.5, days[k % 10]) for k in range(30) for n in range(1 + k % 3)]
    orders = spark.createDataFrame(heads, order)
    lines = spark.createDataFrame(items, "order_id string, line_item_id string, product_id string, quantity int, unit_price_eur double, discount_eur double, order_date date")
    customers = spark.createDataFrame([("c1", "k1", True)], "customer_id string, customer_sk string, is_current boolean")
    products = spark.createDataFrame([("p0", "s0", "n", "a", "b", "x", True)], "product_id string, product_sk string, product_name string, category_l1 string, category_l2 string, brand string, is_current boolean")
    calendar = spark.createDataFrame([(d, 20240100 + d.day) for d in days], "calendar_date date, time_sk int")
    events = spark.createDataFrame([], BRONZE_EVENTS).withColumns({"event_ts": F.lit(None).cast("timestamp"), "event_date": F.lit(None).cast("date"), "referrer_channel": F.lit("")})
    dims = (customers, products, calendar, events)
    path = str(tmp_path / "fact")
    number = F.substring("order_id", 2, 9).cast("int")

    # Until the eighth; two orders stand under a later date than they get.
    wrong = orders.withColumn("order_date", F.when(number.isin(17, 7), F.lit(days[6])).otherwise(F.col("order_date")))
    first = facts.merge_order_lines(path, lines.filter(F.col("order_date") <= str(days[7])).filter("NOT (order_id = 'o6' AND line_item_id = '0')"), wrong, *dims)
    assert days[8] not in first
    # The window of three days before the tenth brings the rest: new days, moved orders and their old day.
    second = facts.merge_order_lines(path, lines, orders, *dims, as_of=str(days[9]), days=3)
    assert days[0] not in second and {days[6], days[7], days[8], days[9]} <= set(second)
    want = facts.fact_order_lines(lines, orders, *dims)
    got = sinks.read_days(spark, path, "order_date").select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # A critical check on the rewritten days keeps all of them.
    suite = [quality.expect_between("quantity", 1, 2, severity="critical")]
    with pytest.raises(quality.QualityError):
        facts.merge_order_lines(path, lines, orders, *dims, as_of=str(days[9]), days=3, suite=suite)
    assert facts.merge_order_lines(path, lines, orders, *dims, as_of=str(days[9]), days=3, suite=[quality.expect_unique("order_line_id", severity="critical")])
    assert sorted(map(str, sinks.read_days(spark, path, "order_date").select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_unique_rows_are_not_ordered(spark, tmp_path, monkeypatch):
    def refuse(*_):
        raise AssertionError("whole rows were shuffled by key")

    path = str(tmp_path / "t")
    monkeypatch.setattr(sinks, "dedup_latest", refuse)
    merge(spark, path, [("a", D[0], 1), ("b", D[1], 1), (None, D[1], 2)])
    merge(spark, path, [("a", D[1], 3), ("c", D[0], 1)])
    assert stored(spark, path) == sorted([(None, D[1], 2), ("a", D[1], 3), ("b", D[1], 1), ("c", D[0], 1)], key=str)


def test_a_large_day_is_merged_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "_PIECE", 4, raising=False)
    monkeypatch.setattr(sinks, "dedup_latest", None)  # no key repeats
    path = str(tmp_path / "t")
    rows = [(f"k{i}", D[0], i) for i in range(40)] + [(None, D[0], 1), (None, D[0], 1)]
    merge(spark, path, rows)
    merge(spark, path, [("k3", D[0], 300), ("k4", D[1], 400), (None, D[0], 1)])
    expected = [(f"k{i}", D[0], i) for i in range(40) if i not in (3, 4)] + [("k3", D[0], 300), ("k4", D[1], 400)] + [(None, D[0], 1)] * 3
    assert stored(spark, path) == sorted(expected, key=str)


def shuffle_files(spark):
    return str(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()).count("/shuffle_")


def grown(spark, before):
    """Whether there are more shuffle files than before, after some time to remove them."""
    for _ in range(20):
        if shuffle_files(spark) <= before:
            return False
        time.sleep(0.25)
    return True


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    """Once, each write's stayed until the driver collected garbage: those of all writes of a run stood on disk at once."""
    rows = spark.range(1000).withColumn("k", F.col("id") % 7).repartition(3, "k")
    before = shuffle_files(spark)
    assert len(session.written(rows, "rows").collect()) == 1000
    sinks.publish_table(rows, str(tmp_path / "t"))
    assert not grown(spark, before)
    rows.collect()
    assert shuffle_files(spark) > before


def test_a_merge_leaves_no_increment(spark, tmp_path):
    shared = session.shared_folder(spark)
    left, path = set(os.listdir(shared)), str(tmp_path / "t")
    merge(spark, path, [("a", D[0], 1), ("b", D[1], 1)])
    merge(spark, path, [("a", D[1], 3), ("c", D[0], 1)])
    assert not [n for n in set(os.listdir(shared)) - left if n.startswith("increment")]
    assert sorted(n for n in os.listdir(path) if not n.startswith(("_", ".day"))) == [f"day={D[0]}", f"day={D[1]}"]


def test_order_columns_are_written_before_the_lines_are_shuffled(spark):
    order = (
        "order_id string, customer_id string, session_id string, order_date date, shipping_cost_eur double, tax_eur double, order_status string, "
        "payment_method string, is_first_order boolean, shipping_country_code string, created_at string"
    )
    orders = spark.createDataFrame([("o1", None, None, D[0], 1.0, 0.1, "paid", "card", True, "FR", None)], order)
    lines = spark.createDataFrame([("o1", "1", "p0", 2, 5.0, 0.5, D[0])], "order_id string, line_item_id string, product_id string, quantity int, unit_price_eur double, discount_eur double, order_date date")
    customers = spark.createDataFrame([("c1", "k1", True)], "customer_id string, customer_sk string, is_current boolean")
    products = spark.createDataFrame([("p0", "s0", "n", "a", "b", "x", True)], "product_id string, product_sk string, product_name string, category_l1 string, category_l2 string, brand string, is_current boolean")
    calendar = spark.createDataFrame([(D[0], 20240101)], "calendar_date date, time_sk int")
    events = spark.createDataFrame([], BRONZE_EVENTS).withColumns({"event_ts": F.lit(None).cast("timestamp"), "event_date": F.lit(None).cast("date"), "referrer_channel": F.lit("")})
    fact = facts.fact_order_lines(lines, orders, customers, products, calendar, events)
    assert any("order-heads" in f for f in fact.inputFiles())
    assert [(r.order_id, r.product_sk, r.customer_sk, r.time_sk) for r in fact.collect()] == [("o1", "s0", "-1", 20240101)]
