"""Registry of named queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the test tables under ``sf_dir`` (whole tables) through
the lazy model graph in ``Layers``; nothing is precomputed or sampled.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import rules as R
from riskloom.operators import marts, quality, reshape, serving
from riskloom.plans.layers import Layers
from riskloom.session import checkpoint_dir
from riskloom.sources import footers, landed
from riskloom.sources import testtables as tt
from riskloom.sources.schemas import RAW_CREDIT_COLUMNS, RAW_MARKETING_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

LAYER_KEYS = (
    "raw_credit", "raw_marketing", "raw_indicator_recent", "raw_macro",
    "stg_credit_default", "stg_bank_marketing", "stg_macro",
    "int_loan_delinquency", "int_portfolio_segments", "bucket_pd", "int_ecl_inputs",
    "mart_portfolio_summary", "mart_npl_analysis", "mart_ecl_estimates",
    "mart_vintage_curves", "mart_regulatory_ratios", "page_portfolio", "page_risk",
)

# key -> (serving function, pages or marts it reads)
SERVING = {
    "dash_portfolio_kpis": (serving.dash_portfolio_kpis, ("page_portfolio",)),
    "dash_by_dpd": (serving.dash_by_dpd, ("page_portfolio",)),
    "dash_by_education": (serving.dash_by_education, ("page_portfolio",)),
    "dash_exposure_by_size": (serving.dash_exposure_by_size, ("page_portfolio",)),
    "dash_by_age_band": (serving.dash_by_age_band, ("page_portfolio",)),
    "dash_risk_kpis": (serving.dash_risk_kpis, ("page_risk",)),
    "dash_npl_by_dpd": (serving.dash_npl_by_dpd, ("page_risk",)),
    "dash_ecl_by_stage": (serving.dash_ecl_by_stage, ("page_risk",)),
    "dash_coverage_by_dpd": (serving.dash_coverage_by_dpd, ("page_risk",)),
    "dash_ead_share": (serving.dash_ead_share, ("page_risk",)),
    "dash_vintage_delinquency": (serving.dash_vintage_delinquency, ("mart_vintage_curves",)),
    "dash_vintage_default": (serving.dash_vintage_default, ("mart_vintage_curves",)),
    "dash_vintage_balance": (serving.dash_vintage_balance, ("mart_vintage_curves",)),
    "dash_vintage_heatmap": (serving.dash_vintage_heatmap, ("mart_vintage_curves",)),
    "dash_reg_latest": (serving.dash_reg_latest, ("mart_regulatory_ratios",)),
    "dash_reg_npl_trend": (serving.dash_reg_npl_trend, ("mart_regulatory_ratios",)),
    "dash_reg_capital_trend": (serving.dash_reg_capital_trend, ("mart_regulatory_ratios",)),
    "dash_reg_credit_trend": (serving.dash_reg_credit_trend, ("mart_regulatory_ratios",)),
    "dash_reg_growth_inflation": (serving.dash_reg_growth_inflation, ("mart_regulatory_ratios",)),
    "dash_regulatory_history": (serving.dash_regulatory_history, ("mart_regulatory_ratios",)),
}

MODEL_NAMES = tuple(sorted({c.model for c in quality.CHECKS}))


def models(layers: Layers) -> dict[str, DataFrame]:
    return {m: getattr(layers, m) for m in MODEL_NAMES}


# Models whose plan reads one expensive base twice: the expected-loss inputs
# read the segments twice (PD pass + join); the vintage mart reads the staged
# loans twice (wide sums + exact distinct ids). That base is written once.
ECL_CONSUMERS = {"mart_npl_analysis", "mart_ecl_estimates", "page_risk"}
VINTAGE_CONSUMERS = {"mart_vintage_curves"}


def _layers_for(spark: SparkSession, sf_dir: str, needs) -> Layers:
    needs, cut = set(needs), {}
    if "int_ecl_inputs" in needs:
        cut.update(dict.fromkeys(Layers.FOR_ECL))
    elif ECL_CONSUMERS & needs:
        cut.update(Layers.FOR_ECL_MARTS)
    if VINTAGE_CONSUMERS & needs:
        cut.update(Layers.FOR_VINTAGE)
    return Layers(spark, sf_dir, cut=cut)


def _layer(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(_layers_for(spark, sf_dir, [name]), name)
    return run


def _serving(fn, inputs) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lay = _layers_for(spark, sf_dir, inputs)
        return fn(*[getattr(lay, i) for i in inputs])
    return run


# --------------------------------------------------------------------------
# Source-shaping variants
# --------------------------------------------------------------------------

def raw_credit_rename(spark, sf_dir):
    """Positional names X1..X23, Y renamed to the business names."""
    positional = tt.credit_positional(Layers(spark, sf_dir).raw_credit)
    return reshape.rename_credit_positional(positional).select(*RAW_CREDIT_COLUMNS)


def raw_credit_concat(spark, sf_dir):
    """Features (from orders) and target (from line items) held apart, put together by the id.

    Orders without line items have no target and stay, with NULL.
    """
    lay = Layers(spark, sf_dir)
    features = tt.credit_positional(lay.raw_credit).drop("Y")
    joined = landed.join_by_id(features, tt.credit_targets(lay.table("lineitem")))
    return reshape.rename_credit_positional(joined).select(*RAW_CREDIT_COLUMNS)


def raw_credit_glued(spark, sf_dir):
    """Features and target landed as two folders without ids, glued row by row; ids 1..n in row order."""
    raw = Layers(spark, sf_dir, cut=("raw_credit",)).raw_credit
    folder = os.path.join(checkpoint_dir(spark), "riskloom-tables", f"landed-{uuid.uuid4().hex}")
    return landed.read_raw_credit_glued(spark, *tt.land_apart(raw, folder, spark.sparkContext.defaultParallelism))


def raw_marketing_rename(spark, sf_dir):
    """Source-style names normalised and renamed; the row key becomes the id."""
    source = tt.marketing_source_named(Layers(spark, sf_dir).raw_marketing)
    renamed = reshape.rename_marketing(source).withColumnRenamed("row_key", "id")
    return renamed.select(*RAW_MARKETING_COLUMNS)


def surrogate_id(spark, sf_dir):
    """Dense ids 1..n over the credit rows in source-id order."""
    raw = Layers(spark, sf_dir).raw_credit.withColumnRenamed("id", "source_id")
    return reshape.add_dense_id(raw, ["source_id"])


def macro_full_outer(spark, sf_dir):
    # five series filters over one written panel, not five panel derivations
    return reshape.full_outer_series(Layers(spark, sf_dir, cut=("macro_panel",)).raw_indicator_recent)


def raw_indicator_unpivot(spark, sf_dir):
    """Series held one column per year, transposed back to (year, value) rows (NULL cells kept)."""
    # the pivot looks for its years first: both passes read one written panel
    wide = tt.macro_wide_by_year(Layers(spark, sf_dir, cut=("macro_panel",)).macro_long)
    return reshape.unpivot_years(wide, ["country_code", "indicator"])


def raw_indicator_recent5(spark, sf_dir):
    """The most recent 5 years of each series, empty years counted: the cut of the load rule where it bites."""
    return reshape.recent_values(Layers(spark, sf_dir).macro_series, 5).filter(F.col("value").isNotNull())


def cohort_distinct_loans(spark, sf_dir):
    """Distinct loans per credit-size cohort, counted by bitmaps of the ids."""
    stg = Layers(spark, sf_dir).stg_credit_default
    return marts.distinct_by_bitmap(stg.select(R.size_bucket("credit_limit").alias("cohort"), "id"), ["cohort"], "id", "loan_count")


def raw_marketing_quarantine(spark, sf_dir):
    """Cells of landed contacts that do not fit their type, with the row's position in the landed files."""
    folder = os.path.join(checkpoint_dir(spark), "riskloom-tables", f"landed-{uuid.uuid4().hex}")
    path = tt.land_contacts(Layers(spark, sf_dir).table("customer"), f"{folder}/contacts", spark.sparkContext.defaultParallelism)
    _, rejected = landed.read_marketing_quarantined(spark, path, f"{folder}/split", fmt="csv")
    return rejected.select("position", "column_name", "raw_value", "reason")


# --------------------------------------------------------------------------
# Scalar-function keys: each applies one rule to a whole test table
# --------------------------------------------------------------------------

def _panel_delay(lineitem: DataFrame) -> F.Column:
    """A delay code per line item in -2..4, NULL for the largest quantities."""
    return F.when(F.col("l_quantity") > 49, F.lit(None).cast("int")).otherwise(F.col("l_linenumber") - 3)


def fn_worst_delay(spark, sf_dir):
    from riskloom.sources.schemas import PAY_STATUS_COLS
    raw = Layers(spark, sf_dir).raw_credit
    return raw.select("id", R.worst_delay(PAY_STATUS_COLS).alias("max_months_delayed"))


def _delay_groups(spark, sf_dir, **outputs):
    li = tt.read_table(spark, sf_dir, "lineitem")
    d = li.select(_panel_delay(li).alias("delay"))
    return d.groupBy("delay").agg(F.count(F.lit(1)).alias("n")).select(
        "delay", *[fn(F.col("delay")).alias(name) for name, fn in outputs.items()], "n")


def fn_dpd_bucket(spark, sf_dir):
    return _delay_groups(spark, sf_dir, dpd_bucket=R.dpd_bucket)


def fn_risk_grade(spark, sf_dir):
    return _delay_groups(spark, sf_dir, risk_grade=R.risk_grade)


def fn_ifrs9_stage(spark, sf_dir):
    return _delay_groups(spark, sf_dir, dpd_bucket=R.dpd_bucket,
                         ifrs9_stage=lambda d: R.ifrs9_stage(R.dpd_bucket(d)))


def fn_age_band(spark, sf_dir):
    c = tt.read_table(spark, sf_dir, "customer")
    age = (F.col("c_custkey") % 90 + 10).alias("age")
    return c.select(age).groupBy("age").agg(F.count(F.lit(1)).alias("n")).select(
        "age", R.age_band("age").alias("age_band"), "n")


def fn_size_bucket(spark, sf_dir):
    o = tt.read_table(spark, sf_dir, "orders")
    lim = (F.floor("o_totalprice") - tt.CREDIT_LIMIT_OFFSET).alias("credit_limit")
    return (o.select(lim).withColumn("credit_size_bucket", R.size_bucket("credit_limit"))
            .groupBy("credit_size_bucket").agg(F.count(F.lit(1)).alias("n"),
                                               F.min("credit_limit").alias("min_limit"),
                                               F.max("credit_limit").alias("max_limit")))


def fn_status_flags(spark, sf_dir):
    p = Layers(spark, sf_dir).macro_panel
    return p.select("country_code", "year",
                    R.npl_status("npl_ratio_pct").alias("npl_status"),
                    R.capital_status("bank_capital_assets_ratio_pct").alias("capital_status"),
                    R.gdp_status("gdp_growth_annual_pct").alias("gdp_status"))


def fn_decode(spark, sf_dir):
    o = tt.read_table(spark, sf_dir, "orders")
    edu = F.substring("o_orderpriority", 1, 1).cast("int")
    mar = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    g = o.select(edu.alias("education_code"), mar.alias("marital_code")) \
        .groupBy("education_code", "marital_code").agg(F.count(F.lit(1)).alias("n"))
    return g.select("education_code", R.decode("education_code", R.EDUCATION_LABELS).alias("education_level"),
                    "marital_code", R.decode("marital_code", R.MARITAL_LABELS).alias("marital_status"), "n")


def fn_yes_no(spark, sf_dir):
    m = Layers(spark, sf_dir).raw_marketing
    g = m.groupBy("has_credit_default", "has_housing_loan").agg(F.count(F.lit(1)).alias("n"))
    return g.select("has_credit_default", R.yes_no_flag("has_credit_default").alias("credit_default_flag"),
                    "has_housing_loan", R.yes_no_flag("has_housing_loan").alias("housing_loan_flag"), "n")


def fn_round(spark, sf_dir):
    li = tt.read_table(spark, sf_dir, "lineitem")
    x = ((F.col("l_extendedprice") - 50000.0) / 7.0).alias("x")
    v = li.select("l_orderkey", "l_linenumber", x)
    return v.select("l_orderkey", "l_linenumber", "x",
                    R.round_std("x", 0).alias("round_0"),
                    R.round_std("x", 2).alias("round_2"),
                    R.round_std("x", 4).alias("round_4"))


def fn_safe_ratio(spark, sf_dir):
    c = tt.read_table(spark, sf_dir, "customer")
    v = c.select("c_custkey", F.col("c_acctbal").alias("num"), (F.col("c_custkey") % 5 - 2).alias("den"))
    return v.select("c_custkey", "num", "den",
                    R.round_std(R.safe_ratio_pct("num", "den"), 2).alias("positive_guard_pct"),
                    R.round_std(R.nonzero_ratio_pct("num", "den"), 2).alias("nonzero_guard_pct"))


# --------------------------------------------------------------------------
# Data-quality keys
# --------------------------------------------------------------------------

def _dq(kinds):
    def run(spark, sf_dir):
        # Many check branches read the same models: cut lineage once.
        return quality.run_checks(models(Layers(spark, sf_dir, cut=Layers.FOR_CHECKS)), kinds=kinds)
    return run


def dq_row_counts(spark, sf_dir):
    # Each raw table is read once here: no lineage cut needed.
    lay = Layers(spark, sf_dir)
    return quality.row_count_results({t: getattr(lay, t) for t, _, _ in quality.ROW_COUNT_RULES})


def dq_countries(spark, sf_dir):
    return quality.country_results(Layers(spark, sf_dir).raw_macro)


def dq_not_all_null(spark, sf_dir):
    return quality.macro_presence(Layers(spark, sf_dir).raw_macro)


def dq_schema(spark, sf_dir):
    """Columns of every file of the source tables by their footers, and whether the derivations need them."""
    lay = Layers(spark, sf_dir)
    return footers.schema_results(spark, {t: lay.table(t) for t in tt.SOURCE_COLUMNS}, tt.SOURCE_COLUMNS)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {k: _layer(k) for k in LAYER_KEYS}
    q["vintage_unpivot"] = lambda spark, d: marts.vintage_unpivot(Layers(spark, d).stg_credit_default)
    for name, (fn, inputs) in SERVING.items():
        q[name] = _serving(fn, inputs)
    for fn in (raw_credit_rename, raw_credit_concat, raw_credit_glued, raw_marketing_rename, surrogate_id,
               macro_full_outer, raw_indicator_unpivot, raw_indicator_recent5,
               cohort_distinct_loans, raw_marketing_quarantine,
               fn_worst_delay, fn_dpd_bucket, fn_risk_grade, fn_ifrs9_stage, fn_age_band, fn_size_bucket,
               fn_status_flags, fn_decode, fn_yes_no, fn_round, fn_safe_ratio,
               dq_row_counts, dq_countries, dq_not_all_null, dq_schema):
        q[fn.__name__] = fn
    q["dq_not_null"] = _dq(("not_null",))
    q["dq_unique"] = _dq(("unique",))
    q["dq_accepted_values"] = _dq(("accepted_values",))
    q["dq_all"] = _dq(("not_null", "unique", "accepted_values"))
    return q
