"""Explicit schemas and column-name maps of the raw tables (never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from riskloom.functions.rules import PANEL_MONTHS_RAW_ORDER

# --- Fixed values: raw credit columns in their positional order X1..X23, Y.
CREDIT_POSITIONAL_NAMES = {
    "X1": "credit_limit",
    "X2": "gender",
    "X3": "education_level",
    "X4": "marital_status",
    "X5": "age",
    "X6": "pay_status_sep",
    "X7": "pay_status_aug",
    "X8": "pay_status_jul",
    "X9": "pay_status_jun",
    "X10": "pay_status_may",
    "X11": "pay_status_apr",
    "X12": "bill_amt_sep",
    "X13": "bill_amt_aug",
    "X14": "bill_amt_jul",
    "X15": "bill_amt_jun",
    "X16": "bill_amt_may",
    "X17": "bill_amt_apr",
    "X18": "pay_amt_sep",
    "X19": "pay_amt_aug",
    "X20": "pay_amt_jul",
    "X21": "pay_amt_jun",
    "X22": "pay_amt_may",
    "X23": "pay_amt_apr",
    "Y": "is_default",
}

# --- Fixed values: source names of the marketing columns -> raw table names.
MARKETING_RENAMES = {
    "default": "has_credit_default",
    "housing": "has_housing_loan",
    "loan": "has_personal_loan",
    "y": "subscribed_term_deposit",
    "duration": "call_duration_sec",
    "campaign": "num_contacts_campaign",
    "previous": "num_previous_contacts",
    "pdays": "days_since_prev_contact",
    "poutcome": "prev_campaign_outcome",
    "day_of_week": "contact_day_of_week",
    "balance": "avg_yearly_balance",
}

# --- Fixed values: macro indicator codes -> column names, and the default country.
INDICATORS = {
    "FB.AST.NPER.ZS": "npl_ratio_pct",
    "FD.AST.PRVT.GD.ZS": "credit_private_sector_gdp_pct",
    "FB.BNK.CAPA.ZS": "bank_capital_assets_ratio_pct",
    "NY.GDP.MKTP.KD.ZG": "gdp_growth_annual_pct",
    "FP.CPI.TOTL.ZG": "inflation_cpi_annual_pct",
}
INDICATOR_COLUMNS = tuple(INDICATORS.values())
DEFAULT_COUNTRY = "KEN"
RECENT_VALUES = 25

PAY_STATUS_COLS = tuple(f"pay_status_{m}" for m in PANEL_MONTHS_RAW_ORDER)
BILL_AMT_COLS = tuple(f"bill_amt_{m}" for m in PANEL_MONTHS_RAW_ORDER)
PAY_AMT_COLS = tuple(f"pay_amt_{m}" for m in PANEL_MONTHS_RAW_ORDER)

RAW_CREDIT_SCHEMA = StructType(
    [StructField("id", LongType(), False),
     StructField("credit_limit", LongType()),
     StructField("gender", LongType()),
     StructField("education_level", IntegerType()),
     StructField("marital_status", IntegerType()),
     StructField("age", LongType())]
    + [StructField(c, IntegerType()) for c in PAY_STATUS_COLS]
    + [StructField(c, LongType()) for c in BILL_AMT_COLS]
    + [StructField(c, LongType()) for c in PAY_AMT_COLS]
    + [StructField("is_default", IntegerType())]
)
RAW_CREDIT_COLUMNS = tuple(f.name for f in RAW_CREDIT_SCHEMA.fields)

RAW_MARKETING_SCHEMA = StructType([
    StructField("id", LongType(), False),
    StructField("age", LongType()),
    StructField("job", StringType()),
    StructField("marital", StringType()),
    StructField("education", StringType()),
    StructField("has_credit_default", StringType()),
    StructField("avg_yearly_balance", LongType()),
    StructField("has_housing_loan", StringType()),
    StructField("has_personal_loan", StringType()),
    StructField("contact", StringType()),
    StructField("contact_day_of_week", LongType()),
    StructField("month", StringType()),
    StructField("call_duration_sec", LongType()),
    StructField("num_contacts_campaign", LongType()),
    StructField("days_since_prev_contact", LongType()),
    StructField("num_previous_contacts", LongType()),
    StructField("prev_campaign_outcome", StringType()),
    StructField("subscribed_term_deposit", StringType()),
])
RAW_MARKETING_COLUMNS = tuple(f.name for f in RAW_MARKETING_SCHEMA.fields)

RAW_MACRO_SCHEMA = StructType(
    [StructField("year", IntegerType()), StructField("country_code", StringType())]
    + [StructField(c, DoubleType()) for c in INDICATOR_COLUMNS]
)
RAW_MACRO_COLUMNS = tuple(f.name for f in RAW_MACRO_SCHEMA.fields)

# Long form of the macro series: one row per (country, year, indicator).
MACRO_LONG_SCHEMA = StructType([
    StructField("country_code", StringType()),
    StructField("year", IntegerType()),
    StructField("indicator", StringType()),
    StructField("value", DoubleType()),
])
