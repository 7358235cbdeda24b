"""Exact quantiles against the sorted list, above and below the size that a sketch holds exactly."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles


@pytest.mark.parametrize("accuracy", [10, 200, 100_000])
@pytest.mark.parametrize("q", [0.0, 0.5, 0.9, 1.0])
def test_quantile_is_exact_in_groups_of_any_size(spark, accuracy, q):
    rng = random.Random(accuracy)
    rows = []
    for _ in range(6000):
        country = rng.choice(["FR", "FR", "FR", None, "", "ties", "one"]) if rng.random() < 0.9 else f"c{rng.randrange(30)}"
        amount = {"ties": rng.choice([1.0, 2.0, 2.0, 2.0, 3.5]), "one": 7.0}.get(country, round(rng.lognormvariate(3, 1.5), rng.choice([0, 2, 6])) * rng.choice([1, -1]))
        rows.append((country, rng.choice(["a", None]), None if rng.random() < 0.1 else amount))
    rows += [("none", "a", None)] * 3
    df = spark.createDataFrame(rows, "country string, device string, amount double").repartition(5)
    got = {(r.country, r.device): r.m for r in quantiles.exact_quantile(df, ["country", "device"], "amount", "m", q, accuracy).collect()}
    want = {}
    for key in {r[:2] for r in rows}:
        values = sorted(r[2] for r in rows if r[:2] == key and r[2] is not None)
        want[key] = values[max(math.ceil(q * len(values)), 1) - 1] if values else None
    assert got == want


def test_bracket_that_misses_is_widened(spark, monkeypatch):
    df = spark.range(0, 5000, 1, 4).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    monkeypatch.setattr(quantiles, "_ERRORS", 0)  # a bracket of one approximate value
    for accuracy in (3, 7, 50):
        assert quantiles.exact_quantile(df, ["g"], "v", "m", 0.5, accuracy).first().m == 2499.0


def test_large_hot_group_equals_the_sorted_middle(spark):
    n = 300_001
    df = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("g"), ((F.col("id") * 7919) % 100_003 / 8).alias("v"))
    got = {r.g: r.m for r in quantiles.exact_quantile(df, ["g"], "v", "m", 0.5, 1000).collect()}
    values = {}
    for r in df.collect():
        values.setdefault(r.g, []).append(r.v)
    assert got == {g: sorted(v)[math.ceil(len(v) / 2) - 1] for g, v in values.items()}


def test_no_rows(spark):
    assert quantiles.exact_quantile(spark.createDataFrame([], "g string, v double"), ["g"], "v", "m").count() == 0
