"""Message contract: declared rules as Columns, one pass, violating rows set aside."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import values as V


def event_contract() -> dict[str, Column]:
    """Rule name to a condition that is true when the rule is broken. Optional fields may be null."""
    broken: dict[str, Column] = {}
    for c in V.CONTRACT_REQUIRED:
        broken[f"{c}:required"] = F.col(c).isNull()
    for c, pattern in V.CONTRACT_PATTERNS.items():
        broken[f"{c}:pattern"] = ~F.col(c).rlike(pattern)
    for c, allowed in V.CONTRACT_ENUMS.items():
        broken[f"{c}:enum"] = ~F.col(c).isin(allowed)
    for c, n in V.CONTRACT_MIN_LENGTH.items():
        broken[f"{c}:minLength"] = F.char_length(c) < n
    for c, n in V.CONTRACT_MAX_LENGTH.items():
        broken[f"{c}:maxLength"] = F.char_length(c) > n
    broken["visitor:anyOf"] = F.coalesce(*V.CONTRACT_ANY_OF).isNull()
    return broken


def with_violations(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ``violations``: names of broken rules in rule order, null for a clean row."""
    rules = event_contract() if rules is None else rules
    names = F.concat_ws(",", *[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    return df.withColumn("violations", F.when(names != "", F.split(names, ",")))


def check_contract(df: DataFrame, rules: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split into valid rows and quarantined rows with their violations."""
    checked = with_violations(df, rules)
    valid = checked.filter(F.col("violations").isNull()).drop("violations")
    return valid, checked.filter(F.col("violations").isNotNull())


def personal_columns(df: DataFrame, banned: tuple[str, ...] = ("email", "email_raw", "ip_address", "phone", "address")) -> list[str]:
    """Raw personal columns a table still carries; marts and Silver must have none."""
    return [c for c in df.columns if c in banned]
