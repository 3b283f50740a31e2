"""Intermediate layer: delinquency grading, segmentation and expected-loss inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import rules as R
from riskloom.sources.schemas import PAY_AMT_COLS, PAY_STATUS_COLS


def int_loan_delinquency(stg: DataFrame) -> DataFrame:
    """Worst delay over the six months -> DPD bucket and risk grade."""
    delay = R.worst_delay(PAY_STATUS_COLS)
    d = stg.withColumn("max_months_delayed", delay)
    total_paid = F.col(PAY_AMT_COLS[0])
    for c in PAY_AMT_COLS[1:]:
        total_paid = total_paid + F.col(c)  # NULL if any month is NULL
    return d.select(
        "id", "credit_limit", "age", "gender", "education_level", "marital_status", "is_default",
        "max_months_delayed",
        R.dpd_bucket("max_months_delayed").alias("dpd_bucket"),
        R.risk_grade("max_months_delayed").alias("risk_grade"),
        F.col("bill_amt_sep").alias("outstanding_balance"),
        total_paid.alias("total_payments_6m"),
    )


def int_portfolio_segments(delinquency: DataFrame) -> DataFrame:
    """Age band, size bucket, utilisation and NPL flag (gender, max delay dropped)."""
    return delinquency.select(
        "id", "credit_limit", "age", "education_level", "marital_status", "dpd_bucket",
        "risk_grade", "is_default", "outstanding_balance", "total_payments_6m",
        R.age_band("age").alias("age_band"),
        R.size_bucket("credit_limit").alias("credit_size_bucket"),
        R.utilisation_pct("outstanding_balance", "credit_limit").alias("utilisation_rate_pct"),
        R.npl_flag("dpd_bucket", "is_default").alias("is_npl"),
    )


def bucket_pd(segments: DataFrame) -> DataFrame:
    """Empirical PD per DPD bucket: mean default rate rounded to 4 decimals.

    At most five rows (the bucket rule has five outcomes); the mean comes
    from an exact integer sum so it does not depend on row order.
    """
    return segments.groupBy("dpd_bucket").agg(
        R.round_std(F.sum("is_default") / F.count("is_default"), 4).alias("empirical_pd"))


def int_ecl_inputs(segments: DataFrame, lgd: float = R.LGD_UNSECURED) -> DataFrame:
    """IFRS 9 stage, PD (rounded before use), LGD, EAD and ECL per loan.

    The PD table is a five-row aggregate, broadcast to a LEFT join: the loans
    are never shuffled; the aggregate side costs one tiny exchange.
    """
    pd_table = F.broadcast(bucket_pd(segments).withColumnRenamed("dpd_bucket", "_pd_bucket"))
    j = segments.join(pd_table, segments.dpd_bucket == pd_table._pd_bucket, "left")
    return j.select(
        *[segments[c] for c in segments.columns],
        F.col("empirical_pd"),
        R.ifrs9_stage(segments.dpd_bucket).alias("ifrs9_stage"),
        F.lit(float(lgd)).alias("lgd"),
        segments.outstanding_balance.alias("ead"),
        R.ecl_amount(F.col("empirical_pd"), F.lit(float(lgd)), segments.outstanding_balance).alias("ecl_amount"),
    )
