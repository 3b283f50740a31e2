"""Lazy model graph over the test tables: each model is built once per request.

``Layers(spark, sf_dir)`` exposes every raw input, staging view,
intermediate table and mart as a lazy DataFrame. Nothing runs until an
action; Catalyst sees the whole chain, pushes filters and prunes columns
down to the parquet scans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators import intermediate, marts, reshape, serving, staging
from riskloom.session import size_shuffle_partitions
from riskloom.sources import testtables as tt
from riskloom.sources.schemas import BILL_AMT_COLS, PAY_STATUS_COLS


class Layers:
    """Model graph over one scale-factor folder.

    ``cut`` names models after which lineage is cut by writing them once as
    Parquet in the shared checkpoint folder, for jobs that read a
    model more than once: the check suite reads every layer (cut the loan
    and macro derivations), expected-loss inputs read the segments twice
    (PD pass + join; cut the segments), the vintage mart reads the staged
    loans twice (wide sums + distinct ids; cut staging). Each cut model is then computed once
    and scanned from the written table instead of re-aggregating line items.
    As a mapping, ``cut`` also names the columns to write (None: all). Written
    tables belong to the ``session.scratch`` block around the query, if there is one.
    """

    FOR_CHECKS = ("raw_credit", "macro_panel")
    FOR_ECL = ("int_portfolio_segments",)
    #: the marts behind the expected-loss inputs read these columns of the segments only
    FOR_ECL_MARTS = {"int_portfolio_segments": (
        "dpd_bucket", "is_default", "outstanding_balance", "credit_size_bucket", "education_level",
        "utilisation_rate_pct", "is_npl")}
    FOR_VINTAGE = {"stg_credit_default": (
        "id", "credit_limit", "is_default", *PAY_STATUS_COLS, *BILL_AMT_COLS)}

    def __init__(self, spark: SparkSession, sf_dir: str,
                 cut: Sequence[str] | Mapping[str, Sequence[str] | None] = ()):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cut = cut if isinstance(cut, Mapping) else dict.fromkeys(cut)
        size_shuffle_partitions(spark, [self.table(t) for t in ("lineitem", "orders", "customer")])

    def _cut(self, name: str, df: DataFrame) -> DataFrame:
        from riskloom.session import has_checkpoint_dir, materialize
        # Without a shared checkpoint folder the plan stays lazy (same result, more work).
        if name not in self.cut or not has_checkpoint_dir(self.spark):
            return df
        return materialize(df.select(*self.cut[name]) if self.cut[name] else df, name)

    def table(self, name: str) -> DataFrame:
        return tt.read_table(self.spark, self.sf_dir, name)

    # --- raw inputs ------------------------------------------------------
    @cached_property
    def raw_credit(self) -> DataFrame:
        return self._cut("raw_credit", tt.loans_from_tables(self.table("orders"), self.table("lineitem")))

    @cached_property
    def macro_panel(self) -> DataFrame:
        return self._cut("macro_panel", tt.macro_panel_from_tables(
            self.table("orders"), self.table("customer"), self.table("nation")))

    @cached_property
    def macro_long(self) -> DataFrame:
        return tt.macro_long(self.macro_panel)

    @cached_property
    def macro_series(self) -> DataFrame:
        """The series as their source has them: every year of the panel, empty values included."""
        return tt.macro_long(self.macro_panel, keep_empty=True)

    @cached_property
    def raw_indicator_recent(self) -> DataFrame:
        return reshape.recent_values(self.macro_series).filter("value IS NOT NULL")

    @cached_property
    def raw_macro(self) -> DataFrame:
        # Same rows as pivot_indicators(raw_indicator_recent) (tested), without the round trip.
        return reshape.recent_values_wide(self.macro_panel)

    @cached_property
    def raw_marketing(self) -> DataFrame:
        return tt.marketing_from_tables(self.table("customer"))

    # --- staging -----------------------------------------------------------
    @cached_property
    def stg_credit_default(self) -> DataFrame:
        return self._cut("stg_credit_default", staging.stg_credit_default(self.raw_credit))

    @cached_property
    def stg_bank_marketing(self) -> DataFrame:
        return staging.stg_bank_marketing(self.raw_marketing)

    @cached_property
    def stg_macro(self) -> DataFrame:
        return staging.stg_macro(self.raw_macro)

    # --- intermediate ------------------------------------------------------
    @cached_property
    def int_loan_delinquency(self) -> DataFrame:
        return intermediate.int_loan_delinquency(self.stg_credit_default)

    @cached_property
    def int_portfolio_segments(self) -> DataFrame:
        return self._cut("int_portfolio_segments",
                         intermediate.int_portfolio_segments(self.int_loan_delinquency))

    @cached_property
    def bucket_pd(self) -> DataFrame:
        return intermediate.bucket_pd(self.int_portfolio_segments)

    @cached_property
    def int_ecl_inputs(self) -> DataFrame:
        return intermediate.int_ecl_inputs(self.int_portfolio_segments)

    # --- marts -------------------------------------------------------------
    @cached_property
    def mart_portfolio_summary(self) -> DataFrame:
        return marts.mart_portfolio_summary(self.int_portfolio_segments)

    @cached_property
    def mart_npl_analysis(self) -> DataFrame:
        return marts.mart_npl_analysis(self.int_ecl_inputs)

    @cached_property
    def mart_ecl_estimates(self) -> DataFrame:
        return marts.mart_ecl_estimates(self.int_ecl_inputs)

    @cached_property
    def mart_vintage_curves(self) -> DataFrame:
        return marts.mart_vintage_curves(self.stg_credit_default)

    @cached_property
    def mart_regulatory_ratios(self) -> DataFrame:
        return marts.mart_regulatory_ratios(self.stg_macro)

    # --- pages: all roll-ups of a report page -----------------------------------
    @cached_property
    def page_portfolio(self) -> DataFrame:
        return serving.page_portfolio(self.mart_portfolio_summary)

    @cached_property
    def page_risk(self) -> DataFrame:
        return serving.page_risk(self.mart_npl_analysis, self.mart_ecl_estimates)
