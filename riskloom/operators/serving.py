"""Serving layer: the report roll-ups, computed from the marts in Spark.

``page_portfolio`` and ``page_risk`` roll a mart (a few hundred rows at most,
whatever the loan count) up to all levels that a page shows, in one pass by
grouping sets; the job writes them once. Each ``dash_*`` function takes a page
or a mart and returns the small finished frame a report shows. Where
the display order matters a rank column is exposed, and the frame is sorted
by it as the last step. Shares of a total use a window over the roll-up,
which has at most one row per label (<= 5); no joins without keys. Rates
the reports rounded themselves use ``round_half_even`` (their rounding ran in
pandas, ties to even); values rounded in SQL models use ``round_std``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import rules as R


def _with_total_share(rollup: DataFrame, value: str, share: str) -> DataFrame:
    """Add ``share`` = value / total * 100 (2 dp) to a roll-up of at most a few label rows.

    The unpartitioned window only ever sees the bounded roll-up (one row per
    label), never loan rows.
    """
    total = F.sum(value).over(Window.partitionBy())
    return rollup.withColumn(share, R.round_std(R.nonzero_ratio_pct(F.col(value).cast("double"), total), 2))


# --------------------------------------------------------------------------
# Pages: every roll-up of a mart in one pass (grouping sets), written once
# --------------------------------------------------------------------------

def _levels(mart: DataFrame, keys: tuple[str, ...], *aggs) -> DataFrame:
    """(level, label, aggs...): ``mart`` rolled up by each key alone and as a whole (level 'total'), in one pass."""
    n = len(keys)
    rolled = mart.groupingSets([[k] for k in keys] + [[]], *keys).agg(F.grouping_id().alias("_g"), *aggs)
    # the bit of a key is 0 in the grouping set that holds it
    level, label = F.lit("total"), F.lit(None).cast("string")
    for i, k in enumerate(keys):
        here = F.col("_g") == (1 << n) - 1 - (1 << (n - 1 - i))
        level, label = F.when(here, F.lit(k)).otherwise(level), F.when(here, F.col(k)).otherwise(label)
    return rolled.select(level.alias("level"), label.alias("label"), *[c for c in rolled.columns if c not in (*keys, "_g")])


PORTFOLIO_LEVELS = ("dpd_bucket", "education_level", "credit_size_bucket", "age_band")


def page_portfolio(summary: DataFrame) -> DataFrame:
    """The portfolio summary by bucket, education, size, age band and as a whole: what page 1 shows."""
    return _levels(
        summary, PORTFOLIO_LEVELS,
        F.sum("loan_count").alias("loan_count"), F.sum("total_credit_limit").alias("total_credit_limit"),
        F.sum("npl_count").alias("npl_count"),
        R.exact_avg("avg_utilisation_pct", 2).alias("mean_utilisation_pct"))


def page_risk(npl: DataFrame, ecl: DataFrame) -> DataFrame:
    """The NPL mart by bucket and the ECL mart by stage, each also as a whole: what page 2 shows."""
    a = _levels(npl, ("dpd_bucket",), F.sum("loan_count").alias("loan_count"), F.sum("npl_count").alias("npl_count"),
                R.exact_avg("provision_coverage_pct", 2).alias("mean_coverage_pct"))
    b = _levels(ecl, ("ifrs9_stage",), F.sum("loan_count").alias("loan_count"),
                F.sum("total_ead").alias("total_ead"), F.sum("total_ecl").alias("total_ecl"))
    return a.withColumn("mart", F.lit("npl")).unionByName(b.withColumn("mart", F.lit("ecl")), allowMissingColumns=True)


def _level(page: DataFrame, level: str, mart: str | None = None) -> DataFrame:
    """The rows of one roll-up, its label under the key's name."""
    rows = page.filter(F.col("level") == level)
    return (rows.filter(F.col("mart") == mart) if mart else rows).withColumnRenamed("label", level)


# --------------------------------------------------------------------------
# Portfolio overview (from page_portfolio)
# --------------------------------------------------------------------------

def dash_portfolio_kpis(page: DataFrame) -> DataFrame:
    """Loans, exposure, unweighted mean of group utilisation (1 dp), NPL rate; zeros for an empty portfolio."""
    # an aggregate over the one 'total' row: an empty page has none and still gives a row
    zero = F.lit(0).cast("long")
    total = _level(page, "total").agg(*[F.coalesce(F.max(c), zero).alias(c) for c in ("loan_count", "total_credit_limit", "npl_count")],
                                      F.max("mean_utilisation_pct").alias("mean_utilisation_pct"))
    return total.select(
        F.col("loan_count").alias("total_loans"),
        F.col("total_credit_limit").alias("total_exposure"),
        R.round_half_even("mean_utilisation_pct", 1).alias("avg_utilisation_pct"),
        F.when(F.col("loan_count") > 0, R.round_half_even(F.col("npl_count") / F.col("loan_count") * 100.0, 2))
         .otherwise(F.lit(0.0)).alias("portfolio_npl_rate_pct"),
    )


def dash_by_dpd(page: DataFrame) -> DataFrame:
    g = _level(page, "dpd_bucket").select("dpd_bucket", "loan_count")
    return g.withColumn("bucket_rank", R.label_rank("dpd_bucket", R.DPD_BUCKETS)).orderBy("bucket_rank")


def dash_by_education(page: DataFrame) -> DataFrame:
    g = _level(page, "education_level").select("education_level", "loan_count")
    return _with_total_share(g, "loan_count", "share_pct").orderBy("education_level")


def dash_exposure_by_size(page: DataFrame) -> DataFrame:
    g = _level(page, "credit_size_bucket").select("credit_size_bucket", "total_credit_limit")
    return g.withColumn("size_rank", R.label_rank("credit_size_bucket", R.SIZE_BUCKETS)).orderBy("size_rank")


def dash_by_age_band(page: DataFrame) -> DataFrame:
    g = _level(page, "age_band").select("age_band", "loan_count")
    return g.withColumn("age_rank", R.label_rank("age_band", R.AGE_BANDS)).orderBy("age_rank")


# --------------------------------------------------------------------------
# Risk metrics (from page_risk)
# --------------------------------------------------------------------------

def dash_risk_kpis(page: DataFrame) -> DataFrame:
    """Portfolio NPL rate vs the 15 % threshold, NPL loans, total provision, ECL rate."""
    # the two 'total' rows side by side: each column is taken from its mart's row
    of = lambda mart, c, name: F.max(F.when(F.col("mart") == mart, F.col(c))).alias(name)
    j = _level(page, "total").agg(of("npl", "loan_count", "total_loans"), of("npl", "npl_count", "npl_loans"),
                                  of("ecl", "total_ecl", "total_ecl_provision"), of("ecl", "total_ead", "total_ead"))
    npl_rate = F.when(F.col("total_loans") > 0,
                      R.round_half_even(F.col("npl_loans") / F.col("total_loans") * 100.0, 2)).otherwise(F.lit(0.0))
    return j.select(
        "total_loans", "npl_loans", "total_ecl_provision", "total_ead",
        npl_rate.alias("portfolio_npl_rate_pct"),
        F.lit(R.NPL_BREACH_PCT).alias("npl_threshold_pct"),
        R.threshold_side(npl_rate).alias("npl_vs_threshold"),
        F.when(F.col("total_ead") > 0,
               R.round_half_even(F.col("total_ecl_provision") / F.col("total_ead") * 100.0, 2))
         .otherwise(F.lit(0.0)).alias("portfolio_ecl_rate_pct"),
    )


def dash_npl_by_dpd(page: DataFrame) -> DataFrame:
    g = _level(page, "dpd_bucket").select("dpd_bucket", "loan_count", "npl_count")
    return (g.withColumn("npl_rate", R.round_half_even(F.col("npl_count") / F.col("loan_count") * 100.0, 2))
            .withColumn("npl_threshold_pct", F.lit(R.NPL_BREACH_PCT))
            .withColumn("bucket_rank", R.label_rank("dpd_bucket", R.DPD_BUCKETS))
            .orderBy("bucket_rank"))


def dash_ecl_by_stage(page: DataFrame) -> DataFrame:
    """ECL rate per stage; a zero exposure gives 0 (negative exposure is not guarded)."""
    g = _level(page, "ifrs9_stage").select("ifrs9_stage", "total_ead", "total_ecl", "loan_count")
    return (g.withColumn("ecl_rate", R.round_half_even(R.nonzero_ratio_pct("total_ecl", "total_ead"), 2))
            .orderBy("ifrs9_stage"))


def dash_coverage_by_dpd(page: DataFrame) -> DataFrame:
    """Unweighted mean of group provision coverage per bucket (not re-weighted)."""
    g = _level(page, "dpd_bucket").select("dpd_bucket", F.col("mean_coverage_pct").alias("provision_coverage_pct"))
    return g.withColumn("bucket_rank", R.label_rank("dpd_bucket", R.DPD_BUCKETS)).orderBy("bucket_rank")


def dash_ead_share(page: DataFrame) -> DataFrame:
    g = _level(page, "ifrs9_stage").select("ifrs9_stage", "total_ead")
    return _with_total_share(g, "total_ead", "share_pct").orderBy("ifrs9_stage")


# --------------------------------------------------------------------------
# Vintage analysis (from the vintage mart)
# --------------------------------------------------------------------------

def _vintage_series(vintage: DataFrame, metric: str) -> DataFrame:
    return (vintage.select("cohort", "month_num", "obs_month", metric,
                           R.label_rank("cohort", R.SIZE_BUCKETS).alias("cohort_rank"))
            .orderBy("cohort_rank", "month_num"))


def dash_vintage_delinquency(vintage: DataFrame) -> DataFrame:
    return _vintage_series(vintage, "delinquency_rate_pct")


def dash_vintage_default(vintage: DataFrame) -> DataFrame:
    return _vintage_series(vintage, "default_rate_pct")


def dash_vintage_balance(vintage: DataFrame) -> DataFrame:
    return _vintage_series(vintage, "avg_balance")


def dash_vintage_heatmap(vintage: DataFrame) -> DataFrame:
    """Cohort x month delinquency-rate grid, months in observation order.

    Explicit pivot values (no discovery job); months with no data come out
    NULL, as cohorts with no rows are simply absent.
    """
    p = vintage.groupBy("cohort").pivot("obs_month", list(R.PANEL_MONTH_LABELS)).agg(F.max("delinquency_rate_pct"))
    return (p.withColumn("cohort_rank", R.label_rank("cohort", R.SIZE_BUCKETS))
            .select("cohort", "cohort_rank", *R.PANEL_MONTH_LABELS).orderBy("cohort_rank"))


# --------------------------------------------------------------------------
# Regulatory compliance (from the regulatory ratios mart)
# --------------------------------------------------------------------------

def dash_reg_latest(reg: DataFrame) -> DataFrame:
    """Per country: latest year with NPL, capital and growth values, and their status."""

    def latest(value: str, status: str, prefix: str):
        cond = F.col(value).isNotNull()
        return [
            F.max(F.when(cond, F.col("year"))).alias(f"{prefix}_year"),
            F.max_by(F.when(cond, F.col(value)), F.when(cond, F.col("year"))).alias(value),
            F.max_by(F.when(cond, F.col(status)), F.when(cond, F.col("year"))).alias(status),
        ]

    return reg.groupBy("country_code").agg(
        *latest("npl_ratio_pct", "npl_status", "npl"),
        *latest("bank_capital_assets_ratio_pct", "capital_status", "capital"),
        *latest("gdp_growth_annual_pct", "gdp_status", "gdp"),
    ).withColumnRenamed("npl_year", "data_year")


def dash_reg_npl_trend(reg: DataFrame) -> DataFrame:
    return (reg.dropna(subset=["npl_ratio_pct"])
            .select("country_code", "year", "npl_ratio_pct",
                    F.lit(R.NPL_BREACH_PCT).alias("warning_threshold_pct"),
                    F.lit(R.NPL_WATCH_PCT).alias("watch_level_pct"))
            .orderBy("country_code", "year"))


def dash_reg_capital_trend(reg: DataFrame) -> DataFrame:
    return (reg.dropna(subset=["bank_capital_assets_ratio_pct"])
            .select("country_code", "year", "bank_capital_assets_ratio_pct",
                    F.lit(R.MIN_CAPITAL_RATIO_PCT).alias("min_capital_ratio_pct"))
            .orderBy("country_code", "year"))


def dash_reg_credit_trend(reg: DataFrame) -> DataFrame:
    return (reg.dropna(subset=["credit_private_sector_gdp_pct"])
            .select("country_code", "year", "credit_private_sector_gdp_pct")
            .orderBy("country_code", "year"))


def dash_reg_growth_inflation(reg: DataFrame) -> DataFrame:
    return (reg.dropna(subset=["gdp_growth_annual_pct", "inflation_cpi_annual_pct"])
            .select("country_code", "year", "gdp_growth_annual_pct", "inflation_cpi_annual_pct")
            .orderBy("country_code", "year"))


# --- Fixed values: the display columns, in the reference's order.
HISTORY_COLUMNS = ("year", "npl_ratio_pct", "bank_capital_assets_ratio_pct",
                   "credit_private_sector_gdp_pct", "gdp_growth_annual_pct",
                   "npl_status", "capital_status", "gdp_status")


def dash_regulatory_history(reg: DataFrame) -> DataFrame:
    """Display columns (plus the country), newest year first."""
    return reg.select("country_code", *HISTORY_COLUMNS).orderBy(F.col("country_code"), F.col("year").desc())


# --------------------------------------------------------------------------
# Marts in their display order (the sort the stored models carried)
# --------------------------------------------------------------------------

def _stage_rank(c: str = "ifrs9_stage") -> F.Column:
    return R.label_rank(c, R.IFRS9_STAGES)


DISPLAY_ORDER = {
    "mart_portfolio_summary": lambda: [F.col("credit_size_bucket"), F.col("age_band")],
    "mart_npl_analysis": lambda: [R.label_rank("dpd_bucket", R.DPD_BUCKETS)],
    "mart_ecl_estimates": lambda: [_stage_rank(), F.col("credit_size_bucket")],
    "mart_vintage_curves": lambda: [F.col("cohort"), F.col("month_num")],
    "mart_regulatory_ratios": lambda: [F.col("country_code"), F.col("year")],
}


def in_display_order(name: str, mart: DataFrame) -> DataFrame:
    """A mart sorted for display, as the serving edge reads it (marts are stored unsorted).

    Label columns sort lexicographically where the reports did (size buckets:
    Large, Medium, Micro, Small); bucket and stage use their severity rank.
    """
    return mart.orderBy(*DISPLAY_ORDER[name]())
