from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import values as V


def revenue(raw: Column) -> Column:
    """Nominal amount of a revenue text. Missing is 0.0; empty or unreadable text is null."""
    digits = F.translate(F.regexp_replace(raw, V.CURRENCY_MARKS, ""), ",", ".")
    return F.when(raw.isNull(), F.lit(0.0)).otherwise(digits.try_cast("double"))


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded ratio; null where the whole is zero."""
    return F.round(F.try_divide(part, whole), digits)


def or_zero(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def cents(c: Column) -> Column:
    """Exact money: two decimals, rounded half up."""
    return c.cast("decimal(18,2)")


def churn_risk(score: Column) -> Column:
    low, medium, high = V.CHURN_BANDS
    return F.when(score >= V.CHURN_HIGH, high).when(score >= V.CHURN_MEDIUM, medium).otherwise(low)


def is_high_value(ltv: Column) -> Column:
    return F.coalesce(ltv >= V.HIGH_VALUE_EUR, F.lit(False))


def gross_margin_rate(price: Column, cost: Column) -> Column:
    return share(price - cost, price)
