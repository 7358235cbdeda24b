"""The second half of a day: published marts, their tests, and what a failing one leaves behind."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from catalog import storage, views
from tests.conftest import AS_OF
from tidemark.operators import quality
from tidemark.plans import daily, models
from tidemark.sources import sinks

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DATE = "2024-01-15"
NAMES = ["stg_orders", "stg_customers", "stg_profiles", "dim_time", "dim_customers_scd2", "dim_customers", "dim_products", "fact_order_lines", "fact_orders"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_whole_day_with_models_is_repeatable(spark, tmp_path):
    folder = lambda name: str(tmp_path / name)
    views.bronze_events(spark, SF).write.parquet(folder("b"))
    views.silver_orders(spark, SF).selectExpr("*", "1 AS one").drop("one").write.parquet(folder("o"))
    paths = daily.Paths(folder("b"), folder("s"), folder("o"), folder("g"), folder("m"), storage.raw_tables(spark, SF))
    seen = []
    for _ in range(2):
        assert daily.run_day(spark, paths, DATE, AS_OF, min_files=1, min_bytes=1, min_orders=1).count() == 4
        seen.append({r.table_name: r.row_count for r in models.tables(spark, paths.models, NAMES).collect()})
        checks = sinks.read_day(spark, f"{paths.models}/_checks", DATE)
        assert {r.table_name for r in checks.collect()} == set(NAMES)
        assert models.failing(checks).filter("check = 'unique'").count() == 0
    assert seen[0] == seen[1] and all(seen[0].values())
    assert not [n for n in os.listdir(paths.models) if n.startswith(".")]


def test_table_with_a_failing_critical_check_is_not_published(spark, tmp_path):
    run = models.Models(spark, str(tmp_path))
    suite = [quality.expect_unique("k", severity="critical"), quality.expect_not_null("k")]
    rows = lambda *keys: spark.createDataFrame([(k, dt.date(2024, 1, 1)) for k in keys], "k string, day date")
    assert run.publish("t", rows("a", "b"), suite).count() == 2
    with pytest.raises(quality.QualityError, match=r"unique\(k\)"):
        run.publish("t", rows("a", "a"), suite)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    run.merge("f", rows("a", "b"), "k", "day", suite)
    with pytest.raises(quality.QualityError, match=r"between\(day\)"):
        run.merge("f", rows("c"), "k", "day", [quality.expect_between("day", "2025-01-01", severity="critical")])
    assert sorted(r.k for r in sinks.read_days(spark, str(tmp_path / "f"), "day").collect()) == ["a", "b"]
    assert [(r.table_name, r.check, r.passed) for r in run.report().collect()] == [("t", "not_null", True), ("t", "unique", True)] + [("f", "not_null", True), ("f", "unique", True)]
