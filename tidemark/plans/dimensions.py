from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import values as V
from tidemark.functions import money, text, times
from tidemark.operators import history, scans
from tidemark.operators.dedup import first_by
from tidemark.plans.staging import drop_null_keys


def dim_time(spark: SparkSession, start: str = V.CALENDAR_START, end: str = V.CALENDAR_END) -> DataFrame:
    """One row per day, both ends included. Weekday 0 is Sunday."""
    d = F.col("calendar_date")
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    days = spark.range(1).select(F.explode(span).alias("calendar_date"))
    month_day = F.date_format(d, "MM-dd")
    weekday = F.dayofweek(d) - 1
    periods = list(V.COMMERCIAL_PERIODS.items())
    first_name, first_span = periods[0]
    period = reduce(
        lambda acc, kv: acc.when(month_day.between(*kv[1]), kv[0]),
        periods[1:],
        F.when(month_day.between(*first_span), first_name),
    )
    return days.select(
        times.date_key(d).alias("time_sk"),
        d,
        F.year(d).alias("year_num"),
        F.quarter(d).alias("quarter_num"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.weekofyear(d).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_name_short"),
        F.dayofmonth(d).alias("day_of_month"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.lit("Q"), F.quarter(d), F.lit("-"), F.year(d)).alias("year_quarter"),
        weekday.isin(0, 6).alias("is_weekend"),
        (~weekday.isin(0, 6)).alias("is_weekday"),
        month_day.isin(V.FRENCH_HOLIDAYS).alias("is_public_holiday_fr"),
        period.otherwise(V.COMMERCIAL_DEFAULT).alias("commercial_period"),
    ).orderBy("calendar_date")


def relative_flags(calendar: DataFrame, as_of: str | None = None) -> DataFrame:
    d, today = F.col("calendar_date"), times.day(as_of)
    flags = {
        "is_today": d == today,
        "is_yesterday": d == F.date_sub(today, 1),
        "is_current_year": F.year(d) == F.year(today),
    }
    flags |= {f"is_last_{n}d": d >= F.date_sub(today, n - 1) for n in (7, 30, 90)}
    return calendar.withColumns(flags)


_CUSTOMER_COLUMNS = [
    "customer_id", "email_hashed", "first_name", "last_name", "country_code", "city", "customer_segment",
    "loyalty_tier", "phone_hash", "acquisition_channel", "acquisition_date",
]


def customer_versions(staged: DataFrame, effective: str) -> DataFrame:
    """Tracked columns, content hash and effective time, and whether the customer left with this version.

    Columns the source lacks are null; without ``has_left`` nobody left.
    """
    lacking = [c for c in _CUSTOMER_COLUMNS if c not in staged.columns]
    full = staged.withColumns({c: F.lit(None).cast("string") for c in lacking}) if lacking else staged
    return full.select(
        *_CUSTOMER_COLUMNS,
        text.row_hash(*V.CUSTOMER_TRACKED).alias("row_hash"),
        F.col(effective).alias("valid_from"),
        (F.col("has_left") if "has_left" in staged.columns else F.lit(False)).alias("has_left"),
    )


def with_profile_history(staged: DataFrame, profiles: DataFrame, effective: str = "crm_updated_at", changed: str = "changed_at") -> DataFrame:
    """Account versions and profile versions as one history: a row for each time at which either changed, with the last
    version of both known then.

    A profile that is known before the account waits for it; a null in a version is its value. Of versions of
    one source with equal customer and time one counts, the last by its columns. The scan spreads a hot customer.
    """
    def single(df: DataFrame, source: int, name: str, at: str) -> DataFrame:
        columns = [c for c in df.columns if c not in ("customer_id", at)]
        last = first_by(df.filter(F.col("customer_id").isNotNull()), ["customer_id", at], [F.col(c).desc_nulls_last() for c in columns])
        return last.select("customer_id", F.col(at).alias(effective), F.lit(source).alias("_source"), F.struct(*columns).alias(name))

    taken = [c for c in profiles.columns if c not in ("customer_id", changed)]
    accounts = single(staged.drop(*taken), 0, "_account", effective)
    both = accounts.unionByName(single(profiles, 1, "_profile", changed), allowMissingColumns=True)
    known = scans.carried(both, "customer_id", [effective, "_source"], {"_account": "_account", "_profile": "_profile"})
    # Where both change at once, the second row knows both.
    last = first_by(known.filter(F.col("_account").isNotNull()), ["customer_id", effective], [F.col("_source").desc()])
    return last.select("customer_id", effective, "_account.*", *[F.col(f"_profile.`{c}`").alias(c) for c in taken])


def refresh_customers(existing: DataFrame, accounts: DataFrame, profiles: DataFrame, touched: DataFrame) -> DataFrame:
    """The dimension after new versions in either log: only the customers in ``touched`` are made again, from the
    whole logs, so that late versions of one source also reach the later intervals; all others are passed on."""
    keys = touched.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    mine = [df.join(keys, "customer_id", "left_semi") for df in (accounts, profiles)]
    return existing.join(keys, "customer_id", "left_anti").unionByName(dim_customers_scd2(with_profile_history(*mine)))


def dim_customers_scd2(
    staged: DataFrame, existing: DataFrame | None = None, effective: str = "crm_updated_at", columns: Sequence[str] | None = None
) -> DataFrame:
    """Type-2 customer dimension: old and new versions merged, unchanged ones dropped, intervals recomputed.

    A version with ``has_left`` closes the interval before it and opens none. Merging the same input twice changes
    nothing: rows of equal customer and time collapse first. The key holds the time, as content can come back.
    ``columns`` names those of the customer's columns that the caller reads; the others stay out of the sorts.
    """
    fresh = customer_versions(staged, effective).withColumn("_new", F.lit(1))
    if existing is not None:
        columns = [c for c in fresh.columns if c not in ("_new", "has_left", "valid_from")]
        # The end of a stored interval stands for a leaving, unless another version begins there.
        ends = F.array(F.struct("valid_from", F.lit(False).alias("has_left")), F.struct(F.col("valid_to").alias("valid_from"), F.lit(True).alias("has_left")))
        kept = existing.withColumn("_end", F.explode(ends)).filter("NOT _end.has_left OR _end.valid_from IS NOT NULL")
        fresh = kept.select(*columns, "_end.valid_from", "_end.has_left", F.lit(0).alias("_new")).unionByName(fresh)
    best = [F.col("_new").desc(), F.col("has_left"), F.col("row_hash")]
    single = first_by(fresh, ["customer_id", "valid_from"], best).drop("_new")
    if columns is not None:
        single = single.select(*[c for c in single.columns if c in {"customer_id", "valid_from", "has_left", "row_hash", *columns}])
    stated = single.withColumn("_state", F.when(F.col("has_left"), F.lit("")).otherwise(F.col("row_hash")))
    changed = history.drop_unchanged(stated, "customer_id", "valid_from", "_state").drop("_state")
    keyed = changed.withColumn("customer_sk", text.surrogate_key("customer_id", "row_hash", "valid_from"))
    return history.scd2_intervals(keyed, "customer_id", "valid_from").filter(~F.col("has_left")).drop("has_left")


def dim_customers(profiles: DataFrame, as_of: str | None = None) -> DataFrame:
    """Current customer state with churn band and value flag."""
    return profiles.withColumns(
        {
            "customer_sk": text.surrogate_key("user_id"),
            "churn_risk": money.churn_risk(F.col("predicted_churn_score")),
            "is_high_value": money.is_high_value(F.col("ltv_estimate_eur")),
            "days_since_last_active": times.days_since(F.col("last_active_at"), as_of),
        }
    ).drop("profile_id", "_storage_mode")


def gross_margin(df: DataFrame) -> DataFrame:
    rate = money.gross_margin_rate(F.col("base_price_eur"), F.col("cost_price_eur"))
    return df.withColumn("gross_margin_rate", rate)


def catalog_complete(df: DataFrame) -> DataFrame:
    described = [F.col(c).isNotNull() for c in ("product_name", "product_description", "category_l1", "brand")]
    return df.withColumn("is_catalog_complete", reduce(lambda a, b: a & b, described))


def dim_products_scd2(staged: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type-2 product dimension: one row per product and source version; repeats of a version are one.

    ``columns`` names those of the product's columns that the caller reads; the others stay out of the sort.
    """
    named = drop_null_keys(staged, "product_id")
    known = first_by(named, ["product_id", "pim_updated_at"], [F.col(c).asc_nulls_last() for c in named.columns])
    enriched = catalog_complete(gross_margin(known)).withColumn(
        "product_sk", text.surrogate_key("product_id", "pim_updated_at")
    )
    if columns is not None:
        enriched = enriched.select(*[c for c in enriched.columns if c in {"product_id", "pim_updated_at", *columns}])
    return history.scd2_intervals(enriched, "product_id", "pim_updated_at").drop("pim_updated_at")
