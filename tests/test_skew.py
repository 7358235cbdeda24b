"""One key holds a third of all rows: nothing may gather it, and results stay whole."""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, dedup, joins, merge, quality

N = 60_000


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **conf):
    keys = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def events(spark):
    """A third of the events in one session, a third without any."""
    third = F.col("id") % 3
    return spark.range(0, N, 1, 8).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"),
        F.when(third == 0, "hot").when(third == 1, F.concat(F.lit("s"), F.col("id") % 500)).alias("session_id"),
        F.when(F.col("id") % 50 == 0, "session_start").otherwise("product_view").alias("event_type"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).alias("event_ts"),
        F.lit("FR").alias("country_code"), F.lit("desktop").alias("device_type"), F.lit("direct").alias("referrer_channel"),
        F.concat(F.lit("u"), F.col("id") % 100).alias("user_id"), F.lit("/p").alias("page_path"), F.lit(False).alias("has_revenue"),
    )


def shuffled_rows(spark, df) -> int:
    """Rows written by the shuffles of a query, from its metrics."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    total, stack = 0, [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            stack.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_copies_are_reduced_before_the_shuffle(spark):
    copies = spark.range(0, N, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("at")
    )
    for kept in (dedup.dedup_first(copies, "k", "at"), dedup.dedup_latest(copies, "k", "at"), dedup.dedup_any(copies, "k")):
        assert shuffled_rows(spark, kept) <= 2 * N / 3 + 8
    assert dedup.dedup_first(copies, "k", "at").filter("k = 'hot'").first().at == 0


def test_upsert_source_of_one_hot_key(spark):
    source = spark.range(0, N, 1, 8).selectExpr("if(id % 3 = 0, 'hot', cast(id AS string)) AS k", "cast(id AS timestamp) AS at")
    target = spark.createDataFrame([("hot", None), ("x", None)], "k string, at timestamp").filter("k = 'x'")
    merged = merge.upsert_newer(target, source, "k", "at")
    assert shuffled_rows(spark, merged) <= 2 * N / 3 + 20
    assert merged.count() == 2 * N // 3 + 2


def test_hot_join_key_is_split_and_every_row_stays(spark, events):
    orders = spark.range(0, N, 1, 8).select(
        F.concat(F.lit("o"), F.col("id")).alias("order_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("s"), F.col("id") % 500)).alias("session_id"),
    )
    small = dict(
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__shuffle__partitions="16",
    )
    with settings(spark, **small):
        joined = joins.attribute_orders(orders, events)
        assert "skew=true" in final_plan(joined)
        assert joined.count() == N
        assert joined.filter("session_id IS NULL AND country_code IS NOT NULL").count() == 0


def test_null_keys_spread_over_the_tasks(spark, events):
    orders = spark.range(0, N, 1, 8).select(F.col("id").alias("order_id"), F.lit(None).cast("string").alias("session_id"))
    with settings(
        spark,
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    ):
        joined = joins.lookup(orders, events.select("session_id", "user_id").filter("false"), "session_id", "order_id")
        sizes = [r["count"] for r in joined.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
    assert sum(sizes) == N and max(sizes) < N / 4


def test_aggregates_shuffle_groups_not_rows(spark, events):
    few = 20_000  # sessions, users and groups times map tasks, far below the number of events
    for table in (aggregates.session_funnel(events), aggregates.session_rollup(events), aggregates.event_summary(events.withColumn("revenue_eur", F.lit(1.0)))):
        assert shuffled_rows(spark, table) < few
    assert aggregates.session_rollup(events).agg(F.sum("event_count")).first()[0] == N


def test_unique_and_orphans_count_hot_keys_exactly(spark):
    child = spark.range(0, N, 1, 8).selectExpr("if(id % 3 = 0, 'hot', cast(id AS string)) AS k")
    row = quality.run_suite(child, [quality.expect_unique("k")]).first()
    assert (row.failing, row.total) == (N // 3, N)
    lost = joins.orphans(child, child.filter("k <> 'hot'"), "k").collect()
    assert [(r.k, r.child_rows) for r in lost] == [("hot", N // 3)]
