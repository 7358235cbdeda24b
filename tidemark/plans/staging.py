from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import values as V
from tidemark.functions import money, text
from tidemark.operators.dedup import dedup_latest


def cast_columns(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Typed columns; text that does not fit the type becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in spec.items()})


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def apply_defaults(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def order_money(df: DataFrame) -> DataFrame:
    """Amounts default to 0; the charged total is revenue plus shipping minus discount, without tax."""
    parts = ["revenue_eur", "shipping_cost_eur", "discount_eur", "tax_eur"]
    filled = df.withColumns({c: money.or_zero(F.col(c)) for c in parts})
    charged = F.col("revenue_eur") + F.col("shipping_cost_eur") - F.col("discount_eur")
    return filled.withColumn("total_charged_eur", charged)


def filter_orders(df: DataFrame) -> DataFrame:
    placed = F.col("order_id").isNotNull() & (F.col("order_date") >= F.lit(V.EARLIEST_ORDER).cast("date"))
    real = F.lower(F.coalesce(F.col("payment_method"), F.lit(""))) != "test"
    return df.filter(placed & real & (money.or_zero(F.col("revenue_eur")) >= 0))


def _is_customer() -> Column:
    segment = F.lower(F.coalesce(F.col("customer_segment__c"), F.lit("")))
    return ~F.col("is_deleted") & (segment != "internal")


def filter_accounts(df: DataFrame) -> DataFrame:
    return df.filter(_is_customer())


def country(c: str) -> Column:
    return F.upper(F.coalesce(F.col(c), F.lit("XX")))


def stg_orders(raw: DataFrame) -> DataFrame:
    moments = {c: "timestamp_ntz" for c in ("confirmed_at", "shipped_at", "delivered_at", "cancelled_at")}
    typed = cast_columns(raw, {"order_date": "date", "is_first_order": "boolean", **moments})
    kept = order_money(filter_orders(typed))
    return kept.withColumns(
        {
            "customer_id": F.coalesce("customer_id", "anonymous_customer_id"),
            "order_status": text.order_status(F.col("order_status")),
            "payment_method": F.lower(F.coalesce(F.col("payment_method"), F.lit("unknown"))),
            "shipping_country_code": country("shipping_country_code"),
        }
    ).drop("anonymous_customer_id")


def stage_accounts(raw: DataFrame, *more: str) -> DataFrame:
    """Column work for account rows, one row in and one row out. Raw e-mail is not carried on, ``more`` columns are."""
    typed = cast_columns(
        raw, {"acquisition_date__c": "date", "created_date": "timestamp_ntz", "system_modstamp": "timestamp_ntz"}
    )
    return typed.select(
        F.col("account_id").alias("customer_id"),
        text.hash_email(F.col("email")).alias("email_hashed"),
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        country("billing_country_code").alias("country_code"),
        F.col("billing_city").alias("city"),
        F.col("billing_postal_code").alias("postal_code"),
        "phone_country_code",
        F.coalesce("customer_segment__c", F.lit("unknown")).alias("customer_segment"),
        F.coalesce("acquisition_channel__c", F.lit("unknown")).alias("acquisition_channel"),
        F.col("acquisition_date__c").alias("acquisition_date"),
        F.col("account_id").alias("salesforce_account_id"),
        F.col("created_date").alias("crm_created_at"),
        F.col("system_modstamp").alias("crm_updated_at"),
        *more,
    )


def stage_account_versions(raw: DataFrame) -> DataFrame:
    """All versions of the accounts; ``has_left`` marks those in which the account is deleted or internal."""
    marked = drop_null_keys(raw, "account_id").withColumn("has_left", ~F.coalesce(_is_customer(), F.lit(False)))
    return stage_accounts(marked, "has_left")


def stage_profile_versions(log: DataFrame) -> DataFrame:
    """All versions of the profiles in a log of extracted documents: what the customer dimension takes from them."""
    typed = cast_columns(drop_null_keys(log, "customer_id"), {"updated_at": "timestamp_ntz"})
    return typed.select("customer_id", F.lower(F.trim("loyalty_tier")).alias("loyalty_tier"), "phone_hash", F.col("updated_at").alias("changed_at"))


def stg_customers(raw: DataFrame) -> DataFrame:
    """The latest version of each account, unless that version is deleted or internal."""
    latest = dedup_latest(drop_null_keys(raw, "account_id"), "account_id", "system_modstamp")
    return stage_accounts(filter_accounts(latest))


def profile_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "country_code": country("country_code"),
            "ltv_estimate_eur": money.or_zero(F.col("ltv_estimate_eur")),
            "predicted_churn_score": F.coalesce(
                F.col("predicted_churn_score").try_cast("double"), F.lit(V.CHURN_DEFAULT)
            ),
            "profile_completeness_pct": F.coalesce(F.col("profile_completeness_pct").try_cast("int"), F.lit(0)),
        }
    )


def stg_profiles(raw: DataFrame) -> DataFrame:
    """Typed profiles with defaults. Raw e-mail stays behind."""
    typed = cast_columns(
        drop_null_keys(raw, "user_id"),
        {"acquisition_date": "date", "last_active_at": "timestamp_ntz", "_extracted_at": "timestamp_ntz"},
    )
    return profile_defaults(typed).select(
        F.col("_id").alias("profile_id"),
        "user_id", "first_name", "last_name", "country_code", "city", "customer_segment", "loyalty_tier",
        "acquisition_channel", "acquisition_date", "preferred_category", "preferred_device", "ltv_estimate_eur",
        "predicted_churn_score", "profile_completeness_pct", "last_active_at",
        F.col("_extracted_at").alias("extracted_at"),
        "_storage_mode",
    )
