"""Quality checks as tidy rows.

A suite is a list of checks. Row-level checks of one table become counters of a single
aggregate, or ride on its write; all unique keys add one grouped pass, references one each. Result columns:
``check, column, severity, failing, total, ratio, passed``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tidemark import values as V
from tidemark.functions import times
from tidemark.operators.joins import orphans

RESULT = ["check", "column", "severity", "failing", "total", "ratio", "passed"]


@dataclass(frozen=True)
class Check:
    """A row-level check: ``fails`` marks bad rows, ``counts`` marks rows that take part."""

    name: str
    column: str
    fails: Column
    counts: Column = field(default_factory=lambda: F.lit(True))
    mostly: float = 1.0
    severity: str = "warning"


@dataclass(frozen=True)
class TableCheck:
    """A check on one table-wide value, computed in the same aggregate."""

    name: str
    column: str
    value: Column
    passes: Column
    severity: str = "warning"


@dataclass(frozen=True)
class Unique:
    columns: Sequence[str]
    severity: str = "warning"


@dataclass(frozen=True)
class Reference:
    column: str
    parent: DataFrame
    parent_column: str
    severity: str = "warning"


@dataclass(frozen=True)
class Columns:
    names: Sequence[str]
    severity: str = "warning"


def _value_check(name: str, column: str, fails: Column, mostly: float, severity: str) -> Check:
    """Value rules look at non-null values only."""
    return Check(name, column, F.coalesce(fails, F.lit(False)), F.col(column).isNotNull(), mostly, severity)


def expect_columns(names: Sequence[str], severity: str = "warning") -> Columns:
    return Columns(names, severity)


def expect_not_null(column: str, mostly: float = 1.0, severity: str = "warning") -> Check:
    return Check("not_null", column, F.col(column).isNull(), F.lit(True), mostly, severity)


def expect_unique(*columns: str, severity: str = "warning") -> Unique:
    return Unique(columns, severity)


def expect_in_set(column: str, allowed: Sequence, mostly: float = 1.0, severity: str = "warning") -> Check:
    return _value_check("in_set", column, ~F.col(column).isin(list(allowed)), mostly, severity)


def expect_length(column: str, n: int, mostly: float = 1.0, severity: str = "warning") -> Check:
    return _value_check("length", column, F.char_length(column) != n, mostly, severity)


def expect_regex(column: str, pattern: str, mostly: float = 1.0, severity: str = "warning") -> Check:
    return _value_check("regex", column, ~F.col(column).rlike(pattern), mostly, severity)


def expect_between(column: str, low=None, high=None, mostly: float = 1.0, severity: str = "warning") -> Check:
    """Inclusive range; an end left out is open."""
    c, outside = F.col(column), F.lit(False)
    if low is not None:
        outside = outside | (c < low)
    if high is not None:
        outside = outside | (c > high)
    return _value_check("between", column, outside, mostly, severity)


def expect_row_count(low: int = V.SILVER_MIN_ROWS, high: int = V.SILVER_MAX_ROWS, severity: str = "warning") -> TableCheck:
    n = F.count(F.lit(1))
    return TableCheck("row_count", "*", n, n.between(low, high), severity)


def expect_values(column: str, severity: str = "warning") -> TableCheck:
    """The column is not null on every row: checks that look at values would pass on nothing."""
    n = F.count(column)
    return TableCheck("has_values", column, n, n > 0, severity)


def expect_fresh(column: str, hours: int = V.FRESH_HOURS, as_of: str | None = None, severity: str = "warning") -> TableCheck:
    """The newest stamp is at most ``hours`` old; a table without stamps is stale. Stamps may be text or without a zone;
    text that is no time does not count."""
    newest = F.max(F.col(column).try_cast("timestamp")).cast("bigint")
    age = times.moment(as_of).cast("bigint") - newest
    return TableCheck("fresh", column, newest, F.coalesce(age <= hours * 3600, F.lit(False)), severity)


def expect_source_fresh(column: str, as_of: str | None = None) -> list[TableCheck]:
    """Two levels: a warning when the load is late, an error when it is very late."""
    return [
        expect_fresh(column, V.SOURCE_FRESH_WARN_HOURS, as_of, "warning"),
        expect_fresh(column, V.SOURCE_FRESH_ERROR_HOURS, as_of, "critical"),
    ]


def expect_true(name: str, holds: Column, mostly: float = 1.0, severity: str = "warning") -> Check:
    """An expression holds on every row where it is not null."""
    return Check("is_true", name, F.coalesce(~holds, F.lit(False)), F.lit(True), mostly, severity)


def expect_relationship(column: str, parent: DataFrame, parent_column: str, severity: str = "warning") -> Reference:
    return Reference(column, parent, parent_column, severity)


def _verdict(rows: DataFrame) -> DataFrame:
    """Failing share and verdict from counters."""
    ratio = F.round(F.try_divide(F.col("failing"), F.col("total")), 6)
    # Compared as counts: an exact product, no rounding at the threshold.
    allowed = F.col("total").cast("decimal(20,0)") * (F.lit(1).cast("decimal(9,6)") - F.col("mostly").cast("decimal(9,6)"))
    return rows.withColumn("ratio", ratio).withColumn("passed", F.col("failing") <= allowed).select(*RESULT)


def _row_counters(checks: Sequence[Check | TableCheck]) -> tuple[list[Column], Column]:
    """The counters of the checks as aggregates, and the result rows made of them."""
    counters, rows = [], []
    for i, c in enumerate(checks):
        head = [F.lit(c.name).alias("check"), F.lit(c.column).alias("column"), F.lit(c.severity).alias("severity")]
        if isinstance(c, Check):
            counters += [F.count_if(c.fails & c.counts).alias(f"f{i}"), F.count_if(c.counts).alias(f"t{i}")]
            tail = [F.col(f"f{i}").alias("failing"), F.col(f"t{i}").alias("total"), F.lit(float(c.mostly)).alias("mostly")]
        else:
            counters += [(~c.passes).cast("bigint").alias(f"f{i}")]
            tail = [F.col(f"f{i}").alias("failing"), F.lit(1).cast("bigint").alias("total"), F.lit(1.0).alias("mostly")]
        rows.append(F.struct(*head, *tail))
    return counters, F.array(*rows)


def _row_checks(one: DataFrame, rows: Column) -> DataFrame:
    """One result row per check, from the one row of counters."""
    return _verdict(one.select(F.explode(rows).alias("r")).select("r.*"))


class Watch:
    """The row-level checks of a suite as counters of an ``Observation``: they ride on a write and cost no pass.

    Observe right before the write: a task of a shuffle that runs twice would count twice, one that writes does not.
    """

    def __init__(self, suite: Sequence):
        self.checks = [c for c in suite if isinstance(c, (Check, TableCheck))]
        self.seen = Observation("suite")

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *_row_counters(self.checks)[0]) if self.checks else df

    def counters(self, spark: SparkSession) -> DataFrame:
        """The one row of counters, once the write is done."""
        seen = self.seen.get
        return spark.createDataFrame([tuple(seen.values())], ", ".join(f"{name} bigint" for name in seen))


def _identity(columns: Sequence[str]) -> Column:
    """A key as one text, null if a part is null: parts with their lengths, so that no two keys meet."""
    parts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.concat(F.char_length(p).cast("string"), F.lit(":"), p) for p in parts])


def _unique_checks(df: DataFrame, checks: Sequence[Unique]) -> DataFrame:
    """Rows whose non-null key occurs more than once, for all checks in one pass.

    Every row gives its keys, numbered by check; they are counted per key with a partial aggregate.
    """
    numbered = [F.struct(F.lit(i).alias("i"), _identity(c.columns).alias("key")) for i, c in enumerate(checks)]
    keys = df.select(F.explode(F.array(*numbered)).alias("k")).select("k.*").dropna().groupBy("i", "key").agg(F.count("*").alias("n"))
    totals = keys.groupBy().agg(
        *[F.coalesce(F.sum(F.when((F.col("i") == i) & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias(f"f{i}") for i in range(len(checks))],
        *[F.coalesce(F.sum(F.when(F.col("i") == i, F.col("n"))), F.lit(0)).alias(f"t{i}") for i in range(len(checks))],
    )
    rows = [
        F.struct(
            F.lit("unique").alias("check"), F.lit(",".join(c.columns)).alias("column"), F.lit(c.severity).alias("severity"),
            F.col(f"f{i}").alias("failing"), F.col(f"t{i}").alias("total"), F.lit(1.0).alias("mostly"),
        )
        for i, c in enumerate(checks)
    ]
    return _row_checks(totals, F.array(*rows))


def _reference_check(df: DataFrame, check: Reference) -> DataFrame:
    """Rows whose non-null key has no parent. Children are counted per key once, parents made distinct."""
    used = df.filter(F.col(check.column).isNotNull()).groupBy(check.column).agg(F.count("*").alias("n"))
    known = check.parent.select(F.col(check.parent_column).alias(check.column)).distinct().withColumn("_known", F.lit(True))
    totals = used.join(known, check.column, "left").agg(
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("failing"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    return _verdict(_labelled(totals, "relationship", check.column, check.severity))


def _column_checks(df: DataFrame, check: Columns) -> DataFrame:
    """Schema only: the rows are literals, no data is read."""
    names = df.columns
    rows = [("column_exists", c, check.severity, int(c not in names), 1, 1.0) for c in check.names]
    missing = sum(c not in names for c in check.names)
    rows.append(("column_set", "*", check.severity, missing, len(check.names), 1.0))
    made = df.sparkSession.createDataFrame(
        rows, "check string, column string, severity string, failing bigint, total bigint, mostly double"
    )
    return _verdict(made)


def _labelled(totals: DataFrame, name: str, column: str, severity: str) -> DataFrame:
    return totals.select(
        F.lit(name).alias("check"),
        F.lit(column).alias("column"),
        F.lit(severity).alias("severity"),
        "failing",
        "total",
        F.lit(1.0).alias("mostly"),
    )


def run_suite(df: DataFrame, suite: Sequence, watch: Watch | None = None) -> DataFrame:
    """Evaluate all checks of a table; one result row per check.

    With the ``watch`` of its write the row-level checks are counted already, and only key columns are read.
    """
    parts: list[DataFrame] = [_column_checks(df, c) for c in suite if isinstance(c, Columns)]
    plain = [c for c in suite if isinstance(c, (Check, TableCheck))]
    if plain:
        counters, rows = _row_counters(plain)
        parts.append(_row_checks(watch.counters(df.sparkSession) if watch else df.agg(*counters), rows))
    unique = [c for c in suite if isinstance(c, Unique)]
    if unique:
        parts.append(_unique_checks(df, unique))
    parts += [_reference_check(df, c) for c in suite if isinstance(c, Reference)]
    return reduce(DataFrame.unionByName, parts)


class QualityError(RuntimeError):
    """A critical check failed. ``results`` holds one row per check of the suite, as far as they were brought here."""

    def __init__(self, failed: Sequence[Row], results: Sequence[Row] = ()):
        super().__init__("critical checks failed: " + ", ".join(f"{r['check']}({r['column']})" for r in failed))
        self.results = list(results)


def enforce(results: DataFrame) -> DataFrame:
    """Raise if a critical check failed. Brings only the failed check names to the driver."""
    failed = results.filter((F.col("severity") == "critical") & ~F.col("passed")).select("check", "column").collect()
    if failed:
        raise QualityError(failed)
    return results


def audit(written: DataFrame, suite: Sequence, watch: Watch) -> list[Row]:
    """The suite's results on rows that a write was watched with; raises if a critical check failed.

    One row per check comes to the driver.
    """
    results = run_suite(written, suite, watch).collect()
    raise_failed(results)
    return results


def raise_failed(results: Sequence[Row]) -> None:
    failed = [r for r in results if r["severity"] == "critical" and not r["passed"]]
    if failed:
        raise QualityError(failed, results)


def silver_suite(as_of: str | None = None, min_rows: int = V.SILVER_MIN_ROWS, max_rows: int = V.SILVER_MAX_ROWS) -> list:
    """The contract of the Silver event table."""
    critical = "critical"
    return [
        expect_columns(V.SILVER_COLUMNS),
        *[expect_not_null(c, severity=critical) for c in ("event_id", "event_type", "event_ts", "event_date")],
        expect_not_null("session_id", mostly=0.999),
        expect_unique("event_id", severity=critical),
        expect_in_set("event_type", V.EVENT_TYPES, severity=critical),
        expect_length("country_code", 2, mostly=0.99),
        expect_regex("country_code", V.CONTRACT_PATTERNS["country_code"], mostly=0.99),
        expect_in_set("device_type", V.DEVICE_TYPES, mostly=0.995),
        expect_between("revenue_eur", 0.0, V.REVENUE_MAX_EUR, mostly=0.9999),
        expect_not_null("revenue_eur"),
        expect_in_set("referrer_channel", V.CHANNELS, mostly=0.999),
        expect_row_count(min_rows, max_rows),
        expect_fresh("_silver_processed_at", V.FRESH_HOURS, as_of),
    ]


def stg_orders_suite() -> list:
    return [
        expect_unique("order_id"),
        *[expect_not_null(c) for c in ("order_id", "customer_id", "revenue_eur", "order_date")],
        expect_between("revenue_eur", 0, V.ORDER_REVENUE_MAX_EUR),
        expect_in_set("order_status", V.ORDER_STATUSES),
    ]


def stg_customers_suite() -> list:
    return [
        expect_unique("customer_id"),
        *[expect_not_null(c) for c in ("customer_id", "email_hashed", "country_code")],
        expect_length("country_code", 2),
    ]


#: The columns that the suites of the facts read.
FACT_LINES_READ = (
    "order_line_id", "customer_sk", "product_sk", "time_sk", "gross_revenue_eur", "net_revenue_eur", "order_status", "referrer_channel",
)
FACT_ORDERS_READ = ("order_sk", "customer_sk", "time_sk", "net_revenue_eur", "payment_method")


def fact_lines_suite() -> list:
    return [
        expect_unique("order_line_id"),
        *[expect_not_null(c) for c in ("order_line_id", "customer_sk", "product_sk", "time_sk", "gross_revenue_eur")],
        expect_between("gross_revenue_eur", 0),
        expect_true("net_revenue_eur <= gross_revenue_eur", F.col("net_revenue_eur") <= F.col("gross_revenue_eur")),
        expect_in_set("order_status", V.ORDER_STATUSES),
        expect_in_set("referrer_channel", [*V.CHANNELS, "unknown"]),
    ]


def dim_customers_scd2_suite() -> list:
    return [
        expect_unique("customer_sk"),
        *[expect_not_null(c) for c in ("customer_sk", "customer_id", "is_current")],
        expect_in_set("customer_segment", V.CUSTOMER_SEGMENTS),
        expect_in_set("loyalty_tier", V.LOYALTY_TIERS),
        *[expect_values(c) for c in ("loyalty_tier", "phone_hash")],
    ]


def dim_products_suite() -> list:
    return [
        expect_unique("product_sk"),
        *[expect_not_null(c) for c in ("product_sk", "product_id", "category_l1", "is_current")],
    ]


def dim_time_suite() -> list:
    return [
        expect_unique("time_sk"),
        expect_unique("calendar_date"),
        *[expect_not_null(c) for c in ("time_sk", "calendar_date")],
        expect_in_set("commercial_period", [V.COMMERCIAL_DEFAULT, *V.COMMERCIAL_PERIODS]),
    ]


def profiles_suite() -> list:
    return [
        expect_unique("user_id"),
        *[
            expect_not_null(c)
            for c in ("user_id", "country_code", "customer_segment", "predicted_churn_score", "ltv_estimate_eur")
        ],
        expect_in_set("country_code", V.PROFILE_COUNTRIES),
        expect_in_set("customer_segment", V.PROFILE_SEGMENTS),
    ]


def dim_customers_suite() -> list:
    return [
        expect_unique("customer_sk"),
        expect_unique("user_id"),
        *[expect_not_null(c) for c in ("customer_sk", "user_id", "churn_risk", "country_code")],
        expect_in_set("churn_risk", V.CHURN_BANDS),
    ]


def fact_orders_suite(customers: DataFrame, calendar: DataFrame) -> list:
    return [
        expect_unique("order_sk"),
        *[expect_not_null(c) for c in ("order_sk", "customer_sk", "time_sk", "net_revenue_eur")],
        expect_relationship("customer_sk", customers, "customer_sk"),
        expect_relationship("time_sk", calendar, "time_sk"),
        expect_in_set("payment_method", V.PAYMENT_METHODS),
    ]


def quality_gate(events: DataFrame, orders: DataFrame, date: str, min_orders: int = V.LOW_ORDER_VOLUME) -> DataFrame:
    """Named daily checks with failing rows; only failing checks are returned."""
    day = F.lit(date).cast("date")
    from_events = events.filter(F.col("event_date") == day).agg(
        F.count_if(F.col("event_id").isNull()).alias("clickstream_null_event_id")
    )
    from_orders = orders.filter(F.col("order_date") == day).agg(
        F.count_if(F.col("revenue_eur") < 0).alias("orders_negative_revenue"),
        (F.count(F.lit(1)) < min_orders).cast("bigint").alias("daily_order_volume_too_low"),
    )
    rows = [
        part.unpivot([], part.columns, "check_name", "failing_rows") for part in (from_events, from_orders)
    ]
    return rows[0].unionByName(rows[1]).filter("failing_rows > 0")
