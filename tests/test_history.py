from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.test_skew import settings
from tidemark.operators import history, scans

T0 = dt.datetime(2024, 1, 1)


def versions(seed: int, hot: bool) -> list[tuple]:
    """Keys with unique times; with ``hot`` one key holds half of the rows, many within one hour."""
    rng = random.Random(seed)
    rows, used = [], set()
    while len(rows) < 300:
        key = "hot" if hot and rng.random() < 0.5 else f"k{rng.randrange(20)}"
        moment = T0 + dt.timedelta(minutes=rng.choice([rng.randrange(90), rng.randrange(60 * 24 * 20)]), seconds=rng.randrange(60))
        if (key, moment) not in used:
            used.add((key, moment))
            rows.append((key, moment, rng.choice("abc")))
    return rows


def by_key(rows):
    out: dict[str, list] = {}
    for r in sorted(rows):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("seed, hot", [(1, False), (2, True), (3, True)])
def test_next_previous_and_intervals_match_brute_force(spark, seed, hot):
    rows = versions(seed, hot)
    df = spark.createDataFrame(rows, "k string, ts timestamp, v string").repartition(4)
    want_next, want_prev = {}, {}
    for key, group in by_key(rows).items():
        for i, (_, ts, _v) in enumerate(group):
            want_next[key, ts] = group[i + 1][1] if i + 1 < len(group) else None
            want_prev[key, ts] = group[i - 1][2] if i else None
    got = history.with_previous(history.with_next(df, "k", "ts", "nxt"), "k", "ts", "v", "prev").collect()
    assert {(r.k, r.ts): r.nxt for r in got} == want_next
    assert {(r.k, r.ts): r.prev for r in got} == want_prev
    spans = history.scd2_intervals(df, "k", "ts")
    assert spans.filter("is_current").groupBy("k").count().filter("count <> 1").count() == 0
    assert spans.filter("valid_to <= valid_from").count() == 0


def test_equal_times_keep_every_row(spark):
    df = spark.createDataFrame([("a", T0)] * 5 + [("a", T0 + dt.timedelta(days=1))], "k string, ts timestamp")
    out = [r.nxt for r in history.with_next(df, "k", "ts", "nxt").collect()]
    assert len(out) == 6 and out.count(None) == 1 and out.count(T0) == 4


def test_unchanged_versions_are_dropped_but_returns_stay(spark):
    rows = [("a", T0 + dt.timedelta(days=i), v) for i, v in enumerate("xxyyx")]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v string")
    kept = history.drop_unchanged(df, "k", "ts", "v").orderBy("ts").collect()
    assert [r.v for r in kept] == ["x", "y", "x"]


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_rank_matches_brute_force(spark, kind):
    rng = random.Random(7)
    rows = [
        (rng.choice(["hot", None]) if rng.random() < 0.6 else f"c{rng.randrange(9)}", T0 + dt.timedelta(hours=rng.randrange(24 * 6)), f"o{i}")
        for i in range(500)
    ]
    df = spark.createDataFrame(rows, "c string, t timestamp, o string").withColumn("t", F.col("t").cast(kind)).repartition(4)
    got = {(r.c, r.o): r.rk for r in history.with_rank(df, "c", "t", "o", "rk").collect()}
    ordered = df.withColumn("h", F.md5("o")).orderBy("c", "t", "h").collect()
    want, seen = {}, {}
    for r in ordered:
        seen[r.c] = seen.get(r.c, 0) + 1
        want[r.c, r.o] = seen[r.c]
    assert got == want


@pytest.mark.parametrize("partitions", [1, 3, 64])
def test_scans_match_brute_force_at_any_number_of_partitions(spark, partitions):
    rng = random.Random(partitions)
    rows = []
    for i in range(400):
        key = rng.choice(["hot", None, "", f"k{rng.randrange(40)}"])
        rows.append((key, rng.choice([None, T0, T0 + dt.timedelta(hours=rng.randrange(30))]), rng.choice([None, None, None, "a", "b"]), i))
    df = spark.createDataFrame(rows, "k string, t timestamp, v string, i int")
    order = ["t", "i"]
    with settings(spark, spark__sql__shuffle__partitions=str(partitions), spark__sql__adaptive__coalescePartitions__enabled="false"):
        got = {
            "carried": scans.carried(df, "k", order, {"x": "v", "y": F.col("i")}),
            "next": scans.neighbour(df, "k", order, {"x": "v", "y": "i"}, forward=True),
            "previous": scans.neighbour(df, "k", order, {"x": "v", "y": "i"}, forward=False),
            "rank": scans.rank(df, "k", order, "x").withColumn("y", F.lit(None)),
        }
        got = {n: {r.i: (r.x, r.y) for r in d.select("i", "x", "y").collect()} for n, d in got.items()}
    want = {n: {} for n in got}
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or T0, r[3]))
        held = None
        for n, (_, _, v, i) in enumerate(group):
            held = v if v is not None else held
            want["carried"][i] = (held, i)
            want["rank"][i] = (n + 1, None)
            want["next"][i] = (group[n + 1][2], group[n + 1][3]) if n + 1 < len(group) else (None, None)
            want["previous"][i] = (group[n - 1][2], group[n - 1][3]) if n else (None, None)
    assert got == want


@pytest.mark.parametrize("moment", ["CAST(NULL AS timestamp)", "TIMESTAMP'2024-01-01 00:00:00'"])
def test_a_third_of_the_rows_in_one_moment_of_a_key_is_spread(spark, moment):
    """No window group holds more than a small share of them, with equal rows too, and results stay whole."""
    n = 60_000
    df = spark.range(0, n, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 1000 AS string)) AS k", f"if(id % 3 = 0, {moment}, timestamp_seconds(id)) AS t", "if(id % 3 = 0, 0, id) AS i"
    )
    with settings(spark, spark__sql__shuffle__partitions="32", spark__sql__adaptive__coalescePartitions__enabled="false"):
        groups = scans.ordered(df, "k", ["t"]).groupBy("_part", "_key").count()
        assert groups.agg(F.max("count")).first()[0] < n / 8 and groups.agg(F.sum("count")).first()[0] == n
        ranked = history.with_rank(df, "k", "t", "i", "rk").filter("k = 'hot'")
        assert ranked.agg(F.count_distinct("rk"), F.min("rk"), F.max("rk")).first()[:] == (n // 3, 1, n // 3)
        nexts = history.with_next(df.withColumn("t", F.coalesce("t", F.lit(T0))), "k", "t", "nxt").filter("k = 'hot'")
        assert nexts.filter("nxt IS NULL").count() == 1 and nexts.count() == n // 3
        assert scans.ends(scans.ordered(df, "k", ["t"]), n=F.count("*")).count() <= 2 * 32


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, t timestamp, v string")
    assert history.with_next(df, "k", "t", "n").count() == history.with_rank(df, "k", "t", "v", "r").count() == scans.carried(df, "k", ["t"], {"x": "v"}).count() == 0
