"""Exact quantiles of groups of any size.

An approximate quantile with a proven rank error brackets the exact one: the values a few errors below and above it. Rows
below, at and above the bracket's ends are counted exactly, and only the few strictly inside (a share of the rows that the accuracy
sets) are ranked, by a scan that spreads hot groups. No group is gathered or sorted whole. Ties are harmless: a
value that many rows share is an end of the bracket, and ends are only counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import values as V
from tidemark.operators import scans
from tidemark.session import written

#: Rank errors between the approximate quantile and the ends of its bracket.
_ERRORS = 8


def _group_key(groups: Sequence[str]) -> Column:
    """The group as one text; nulls are values, and parts carry their lengths."""
    parts = [F.coalesce(F.concat(F.char_length(F.col(g).cast("string")).cast("string"), F.lit(":"), F.col(g).cast("string")), F.lit("-")) for g in groups]
    return F.concat(F.lit("="), *parts)


def _counted(rows: DataFrame, brackets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the bracket of their group, and the exact counts of each group, written."""
    # Both sides get a shuffle of their own unless AQE broadcasts the brackets, so a hot group is split.
    inside = rows.join(brackets, "_group")
    v = F.col("_value")
    counts = inside.groupBy("_group").agg(
        F.count_if(v < F.col("_low")).alias("_below"),
        F.count_if(v == F.col("_low")).alias("_at_low"),
        F.count_if(v <= F.col("_high")).alias("_to_high"),
        F.first("_low").alias("_low"), F.first("_high").alias("_high"), F.first("_k").alias("_k"),
        F.min("_value").alias("_least"), F.max("_value").alias("_most"),
    )
    return inside, written(counts, "quantile-counts")


def exact_quantile(df: DataFrame, groups: Sequence[str], value: str, out: str, q: float = 0.5, accuracy: int = V.MEDIAN_ACCURACY) -> DataFrame:
    """(groups, out): of the n values of a group that are not null the one with rank ceil(q * n), null if there are none.

    ``df`` should be cheap to read again: it is read once for the brackets, and again for groups too large for an exact sketch.
    """
    rows = df.select(*groups, F.col(value).alias("_value")).withColumn("_group", _group_key(groups))
    error = min(_ERRORS / accuracy, 1.0)
    points = F.percentile_approx("_value", F.array(*[F.lit(min(max(p, 0.0), 1.0)) for p in (q - error, q, q + error)]), accuracy)
    sketched = rows.groupBy(*groups, "_group").agg(F.count("_value").alias("_n"), points.alias("_points"))
    sketched = written(sketched.withColumn("_k", F.greatest(F.ceil(F.lit(q) * F.col("_n")), F.lit(1))), "quantiles")
    # Below this size the sketch keeps every value.
    large = sketched.filter(F.col("_n") > accuracy // 2).select("_group", "_k", F.col("_points")[0].alias("_low"), F.col("_points")[2].alias("_high"))
    if large.isEmpty():
        return sketched.select(*groups, F.col("_points")[1].alias(out))
    some = rows.select("_group", "_value").filter(F.col("_value").isNotNull())
    inside, counts = _counted(some, large)
    missed = (F.col("_k") <= F.col("_below")) | (F.col("_k") > F.col("_to_high"))
    if not counts.filter(missed).isEmpty():
        # The sketch promised more than it kept: those groups are ranked between their least and greatest value.
        wider = counts.select("_group", "_k", *[F.when(missed, F.col(w)).otherwise(F.col(n)).alias(n) for n, w in (("_low", "_least"), ("_high", "_most"))])
        inside, counts = _counted(some, wider)
    between = inside.filter((F.col("_value") > F.col("_low")) & (F.col("_value") < F.col("_high"))).select("_group", "_value")
    ranked = scans.rank(between, "_group", ["_value"], "_rank")
    wanted = counts.select("_group", (F.col("_k") - F.col("_below") - F.col("_at_low")).alias("_rank"))
    found = counts.join(ranked.join(wanted, ["_group", "_rank"]).select("_group", "_value"), "_group", "left")
    exact = F.when(F.col("_k") <= F.col("_below") + F.col("_at_low"), F.col("_low")).otherwise(F.coalesce("_value", "_high"))
    named = sketched.join(found.select("_group", exact.alias("_exact"), F.lit(True).alias("_large")), "_group", "left")
    return named.select(*groups, F.when(F.col("_large"), F.col("_exact")).otherwise(F.col("_points")[1]).alias(out))
