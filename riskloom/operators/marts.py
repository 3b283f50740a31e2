"""Mart layer: segment aggregates, NPL / ECL reporting, vintages, regulatory ratios.

Every mart groups into a bounded number of label combinations (at most
4 x 5 x 4 x 5 = 400), so the partial aggregate collapses each partition to
a few hundred rows before the single shuffle. Averages of values with fixed
decimals are taken from exact integer sums, so results do not depend on the
order rows are combined in. Marts are not sorted (sorting is a serving
concern; see ``serving``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import rules as R
from riskloom.functions.rules import PANEL_MONTHS
from riskloom.operators.reshape import months_long


def _npl(c: str) -> F.Column:
    """``c`` for non-performing loans, else 0."""
    return F.when(F.col("is_npl") == 1, F.col(c)).otherwise(F.lit(0))


def mart_portfolio_summary(segments: DataFrame) -> DataFrame:
    cnt = F.count(F.lit(1))
    return segments.groupBy("credit_size_bucket", "age_band", "education_level", "dpd_bucket").agg(
        cnt.alias("loan_count"),
        F.sum("credit_limit").alias("total_credit_limit"),
        R.round_std(R.long_avg("credit_limit"), 0).alias("avg_credit_limit"),
        F.sum("outstanding_balance").alias("total_outstanding"),
        R.round_std(R.long_avg("outstanding_balance"), 0).alias("avg_outstanding"),
        R.round_std(R.exact_avg("utilisation_rate_pct", 2), 2).alias("avg_utilisation_pct"),
        F.sum("is_default").alias("default_count"),
        F.sum("is_npl").alias("npl_count"),
        R.round_std(F.sum("is_default").cast("double") / cnt * 100.0, 2).alias("default_rate_pct"),
        R.round_std(F.sum("is_npl").cast("double") / cnt * 100.0, 2).alias("npl_rate_pct"),
    )


def mart_npl_analysis(ecl: DataFrame) -> DataFrame:
    """NPL view per bucket x stage x size x education.

    provision_coverage_pct = ALL expected loss / NPL-only exposure (the
    reference's definition here; the ECL mart uses NPL-only loss).
    """
    cnt = F.count(F.lit(1))
    npl_ead = F.sum(_npl("ead"))
    ecl_sum = R.exact_sum("ecl_amount", 2)
    return ecl.groupBy("dpd_bucket", "ifrs9_stage", "credit_size_bucket", "education_level").agg(
        cnt.alias("loan_count"),
        F.sum("is_npl").alias("npl_count"),
        R.round_std(F.sum("is_npl").cast("double") / cnt * 100.0, 2).alias("npl_rate_pct"),
        F.sum("ead").alias("total_ead"),
        npl_ead.alias("npl_outstanding"),
        R.round_std(ecl_sum, 0).alias("total_ecl_provision"),
        R.round_std(R.safe_ratio_pct(ecl_sum, npl_ead), 2).alias("provision_coverage_pct"),
        R.round_std(R.exact_avg("empirical_pd", 4) * 100.0, 2).alias("avg_pd_pct"),
        R.round_std(R.exact_avg("utilisation_rate_pct", 2), 2).alias("avg_utilisation_pct"),
    )


def mart_ecl_estimates(ecl: DataFrame) -> DataFrame:
    """Expected loss per stage x size; NPL coverage = NPL-only loss / NPL-only exposure."""
    ead_sum = F.sum("ead")
    ecl_sum = R.exact_sum("ecl_amount", 2)
    npl_ead = F.sum(_npl("ead"))
    npl_ecl = F.sum(R.scaled_long(_npl("ecl_amount"), 2)) / F.lit(100.0)
    return ecl.groupBy("ifrs9_stage", "credit_size_bucket").agg(
        F.count(F.lit(1)).alias("loan_count"),
        ead_sum.alias("total_ead"),
        R.round_std(ecl_sum, 0).alias("total_ecl"),
        R.round_std(R.exact_avg("empirical_pd", 4) * 100.0, 2).alias("avg_pd_pct"),
        R.round_std(R.exact_avg("lgd", 6) * 100.0, 2).alias("lgd_pct"),
        R.round_std(R.safe_ratio_pct(ecl_sum, ead_sum), 2).alias("ecl_rate_pct"),
        F.sum("is_npl").alias("npl_count"),
        R.round_std(R.safe_ratio_pct(npl_ecl, npl_ead), 2).alias("npl_provision_coverage_pct"),
    )


# --------------------------------------------------------------------------
# Vintage curves
# --------------------------------------------------------------------------

def vintage_unpivot(stg: DataFrame) -> DataFrame:
    """Client x month rows with the credit-size cohort (one scan, ``stack``)."""
    long = months_long(stg, ["id", "credit_limit", "is_default"])
    return long.withColumn("cohort", R.size_bucket("credit_limit"))


def _vintage_finish(g: DataFrame) -> DataFrame:
    n = F.col("loan_count")
    return g.select(
        "cohort", "month_num", "obs_month", "loan_count", "delinquent_count", "default_count",
        R.round_std(F.col("delinquent_count").cast("double") / n * 100.0, 2).alias("delinquency_rate_pct"),
        R.round_std(F.col("default_count").cast("double") / n * 100.0, 2).alias("default_rate_pct"),
        R.round_std(F.col("balance_sum") / F.col("balance_n"), 0).alias("avg_balance"),
    )


def mart_vintage_curves_direct(stg: DataFrame) -> DataFrame:
    """Literal form: unpivot, then aggregate per cohort x month with a distinct count.

    Kept as the check for ``mart_vintage_curves``; it shuffles 6N (cohort,
    month, id) rows for the distinct count.
    """
    long = vintage_unpivot(stg)
    g = long.groupBy("cohort", "month_num", "obs_month").agg(
        F.count_distinct("id").alias("loan_count"),
        F.sum(R.delinquent_flag("pay_status")).alias("delinquent_count"),
        F.sum("is_default").alias("default_count"),
        F.sum("balance").alias("balance_sum"),
        F.count("balance").alias("balance_n"),
    )
    return _vintage_finish(g)


def distinct_by_bitmap(df: DataFrame, keys: list[str], id_col: str, name: str) -> DataFrame:
    """Exact distinct whole-number ids per group, by bitmaps that add up.

    Every task sets one bit an id in bitmaps of 32,768 ids; the shuffle moves
    and merges bitmaps, not ids. Right for any long ids, and small for dense
    ones (4 KB for 32,768 ids); sparse ids cost up to 4 KB each. NULL ids do
    not count, as in COUNT(DISTINCT).
    """
    maps = df.groupBy(*keys, F.bitmap_bucket_number(id_col).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("_map"))
    return maps.groupBy(*keys).agg(F.sum(F.bitmap_count("_map")).alias(name))


def mart_vintage_curves(stg: DataFrame, dense_ids: bool = False) -> DataFrame:
    """Per cohort and observation month: distinct loans, delinquent / defaulted counts and rates.

    Scale form: the cohort depends only on the credit limit and every client
    appears once per month, so all per-month sums are per-cohort sums of that
    month's column, and distinct ids per cohort-month equal distinct ids per
    cohort. One pass aggregates the N client rows into four wide cohort rows
    (partial aggregation, no fan-out), the exact distinct count shuffles N
    (cohort, id) pairs once (nothing where ``stg`` is bucketed by id, bitmaps
    where ``dense_ids`` says that the ids are dense), and only the four-row
    result is unpivoted to 24.
    """
    cohort = R.size_bucket("credit_limit").alias("cohort")
    base = stg.select(cohort, "id", "is_default",
                      *[f"pay_status_{m}" for m in PANEL_MONTHS],
                      *[f"bill_amt_{m}" for m in PANEL_MONTHS])
    sums = [F.sum("is_default").alias("default_count")]
    for m in PANEL_MONTHS:
        sums += [F.sum(R.delinquent_flag(f"pay_status_{m}")).alias(f"delinquent_count_{m}"),
                 F.sum(f"bill_amt_{m}").alias(f"balance_sum_{m}"),
                 F.count(f"bill_amt_{m}").alias(f"balance_n_{m}")]
    wide = base.groupBy("cohort").agg(*sums)
    # Four cohort rows at most: bounded broadcast.
    ids = base.select("cohort", "id")
    distinct_ids = F.broadcast(distinct_by_bitmap(ids, ["cohort"], "id", "loan_count") if dense_ids else
                               ids.groupBy("cohort").agg(F.count_distinct("id").alias("loan_count")))
    wide = wide.join(distinct_ids, "cohort")
    g = months_long(wide, ["cohort", "loan_count", "default_count"],
                    {"delinquent_count": "delinquent_count_", "balance_sum": "balance_sum_",
                     "balance_n": "balance_n_"})
    return _vintage_finish(g)


# --------------------------------------------------------------------------
# Regulatory ratios
# --------------------------------------------------------------------------

def mart_regulatory_ratios(stg_macro: DataFrame) -> DataFrame:
    """Thresholds, status flags and year-on-year NPL change per country.

    Rows with neither NPL nor capital ratio are dropped first, so the LAG
    looks at the previous *retained* year. The window is partitioned by
    country (one small series each) instead of one global ordering.
    """
    kept = stg_macro.filter(F.col("npl_ratio_pct").isNotNull() | F.col("bank_capital_assets_ratio_pct").isNotNull())
    w = Window.partitionBy("country_code").orderBy("year")
    return kept.select(
        "year", "country_code", "npl_ratio_pct", "credit_private_sector_gdp_pct",
        "bank_capital_assets_ratio_pct", "gdp_growth_annual_pct", "inflation_cpi_annual_pct",
        F.lit(R.NPL_BREACH_PCT).alias("npl_warning_threshold_pct"),
        F.lit(R.MIN_CAPITAL_RATIO_PCT).alias("min_capital_ratio_pct"),
        F.lit(R.MIN_CORE_CAPITAL_PCT).alias("cbk_min_core_capital_pct"),
        R.npl_status("npl_ratio_pct").alias("npl_status"),
        R.capital_status("bank_capital_assets_ratio_pct").alias("capital_status"),
        R.gdp_status("gdp_growth_annual_pct").alias("gdp_status"),
        R.round_std(F.col("npl_ratio_pct") - F.lag("npl_ratio_pct").over(w), 2).alias("npl_yoy_change_pp"),
    )
