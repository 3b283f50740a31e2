"""Staging layer: typed, filtered, decoded views over the raw tables (lazy)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import rules as R
from riskloom.sources.schemas import INDICATOR_COLUMNS, RAW_CREDIT_COLUMNS


def keep_credit() -> Column:
    return (F.col("credit_limit") > 0) & F.col("age").between(R.AGE_MIN, R.AGE_MAX)


def keep_marketing() -> Column:
    return F.col("age").between(R.AGE_MIN, R.AGE_MAX)


def keep_macro() -> Column:
    return F.col("year").isNotNull() & F.col("year").between(R.MACRO_YEAR_MIN, R.MACRO_YEAR_MAX)


#: staging view -> (raw table, condition of its rows); the columns under check pass through as they are
VIEWS = {
    "stg_credit_default": ("raw_credit", keep_credit),
    "stg_bank_marketing": ("raw_marketing", keep_marketing),
    "stg_macro": ("raw_macro", keep_macro),
}


def stg_credit_default(raw: DataFrame) -> DataFrame:
    """Positive limit and age 18..100; education / marital decoded to labels."""
    decoded = {
        "education_level": R.decode("education_level", R.EDUCATION_LABELS).alias("education_level"),
        "marital_status": R.decode("marital_status", R.MARITAL_LABELS).alias("marital_status"),
        "is_default": F.col("is_default").cast("int").alias("is_default"),
    }
    return (raw.filter(keep_credit())
            .select(*[decoded.get(c, F.col(c)) for c in RAW_CREDIT_COLUMNS]))


def stg_bank_marketing(raw: DataFrame) -> DataFrame:
    """Age 18..100; yes/no flags to 1/0/NULL; contact columns renamed."""
    return raw.filter(keep_marketing()).select(
        "id", "age", "job", "marital", "education",
        R.yes_no_flag("has_credit_default").alias("has_credit_default"),
        "avg_yearly_balance",
        R.yes_no_flag("has_housing_loan").alias("has_housing_loan"),
        R.yes_no_flag("has_personal_loan").alias("has_personal_loan"),
        F.col("contact").alias("contact_type"),
        "month",
        F.col("contact_day_of_week").alias("day_of_week"),
        "call_duration_sec", "num_contacts_campaign", "days_since_prev_contact",
        "num_previous_contacts", "prev_campaign_outcome", "subscribed_term_deposit",
    )


def stg_macro(raw: DataFrame) -> DataFrame:
    """Integer year within 2000..2025; indicators rounded to 2 decimals."""
    y = F.col("year").cast("int")
    return (raw.filter(keep_macro())
            .select(y.alias("year"), "country_code",
                    *[R.round_std(F.col(c).cast("double"), 2).alias(c) for c in INDICATOR_COLUMNS]))
