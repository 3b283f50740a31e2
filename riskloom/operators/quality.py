"""Data-quality checks over every layer, as Spark aggregates.

Semantics follow the usual declarative test conventions: a check reports
its failing rows; ``not_null`` counts NULL rows, ``unique`` counts key
values that occur more than once, ``accepted_values`` counts distinct
values outside the list; NULL is ignored by ``unique`` and
``accepted_values``. All not-null and accepted-values checks of a table are
answered by one aggregate over one scan. Unique checks are a partial-aggregated group-by on the key, one scan
each (a hot key collapses map-side before the shuffle).

``WriteChecks`` answers the same questions without any scan: it observes the
rows of a table while they are written. Only a table that shows values
outside a list is read again, to count how many different ones.

The macro tables hold many countries here, so their year key is checked
at the (country_code, year) grain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.functions import rules as R

MACRO_KEY = ("country_code", "year")


@dataclass(frozen=True)
class Check:
    model: str
    column: str | tuple[str, ...]
    kind: str                       # not_null | unique | accepted_values
    values: tuple = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return self.column if isinstance(self.column, tuple) else (self.column,)

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


def _nn(model: str, *cols: str) -> list[Check]:
    return [Check(model, c, "not_null") for c in cols]


def _un(model: str, col) -> list[Check]:
    return [Check(model, col, "unique")]


def _av(model: str, col: str, values) -> list[Check]:
    return [Check(model, col, "accepted_values", tuple(values))]


# The declared checks: 23 raw/staging, 16 intermediate, 15 marts (54).
CHECKS: tuple[Check, ...] = tuple(
    # raw sources
    _nn("raw_macro", "year") + _un("raw_macro", MACRO_KEY) + _nn("raw_macro", "country_code")
    + _nn("raw_credit", "id") + _un("raw_credit", "id") + _nn("raw_credit", "credit_limit")
    + _nn("raw_credit", "is_default") + _av("raw_credit", "is_default", (0, 1))
    + _nn("raw_marketing", "id") + _un("raw_marketing", "id") + _nn("raw_marketing", "age")
    + _nn("raw_marketing", "subscribed_term_deposit")
    + _av("raw_marketing", "subscribed_term_deposit", ("yes", "no"))
    # staging
    + _nn("stg_macro", "year") + _un("stg_macro", MACRO_KEY) + _nn("stg_macro", "country_code")
    + _nn("stg_credit_default", "id") + _un("stg_credit_default", "id")
    + _nn("stg_credit_default", "credit_limit", "is_default")
    + _nn("stg_bank_marketing", "id") + _un("stg_bank_marketing", "id") + _nn("stg_bank_marketing", "age")
    # intermediate
    + _nn("int_loan_delinquency", "id") + _un("int_loan_delinquency", "id")
    + _nn("int_loan_delinquency", "dpd_bucket") + _av("int_loan_delinquency", "dpd_bucket", R.DPD_BUCKETS)
    + _nn("int_loan_delinquency", "risk_grade") + _av("int_loan_delinquency", "risk_grade", R.RISK_GRADES)
    + _nn("int_portfolio_segments", "id") + _un("int_portfolio_segments", "id")
    + _nn("int_portfolio_segments", "is_npl") + _av("int_portfolio_segments", "is_npl", (0, 1))
    + _nn("int_portfolio_segments", "utilisation_rate_pct")
    + _nn("int_ecl_inputs", "id") + _un("int_ecl_inputs", "id")
    + _nn("int_ecl_inputs", "ifrs9_stage") + _av("int_ecl_inputs", "ifrs9_stage", R.IFRS9_STAGES)
    + _nn("int_ecl_inputs", "ecl_amount")
    # marts
    + _nn("mart_portfolio_summary", "loan_count", "default_rate_pct", "npl_rate_pct")
    + _nn("mart_npl_analysis", "npl_rate_pct", "provision_coverage_pct")
    + _nn("mart_vintage_curves", "cohort", "month_num", "delinquency_rate_pct")
    + _nn("mart_regulatory_ratios", "year") + _un("mart_regulatory_ratios", MACRO_KEY)
    + _av("mart_regulatory_ratios", "npl_status", R.NPL_STATUSES)
    + _av("mart_regulatory_ratios", "capital_status", R.CAPITAL_STATUSES)
    + _nn("mart_ecl_estimates", "ifrs9_stage") + _av("mart_ecl_estimates", "ifrs9_stage", R.IFRS9_STAGES)
    + _nn("mart_ecl_estimates", "total_ecl")
)

RESULT_SCHEMA = "model string, column_name string, check_name string, failing_rows bigint"


def fails(check: Check) -> Column:
    """True where a row fails a not_null or accepted_values check."""
    c = F.col(check.column)
    return c.isNull() if check.kind == "not_null" else c.isNotNull() & ~c.isin(*check.values)


def _cell_results(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """All not_null and accepted_values checks of a table in one aggregate, unpivoted to rows.

    Bad values are counted as a distinct aggregate: all values inside the
    list are one NULL group, which collapses in every task.
    """
    found = [F.count(F.when(fails(c), F.lit(1))) if c.kind == "not_null" else F.count_distinct(F.when(fails(c), F.col(c.column)))
             for c in checks]
    counts = df.agg(*[x.alias(f"_n{i}") for i, x in enumerate(found)])
    rows = ", ".join(f"'{c.column}', '{c.kind}', `_n{i}`" for i, c in enumerate(checks))
    return counts.selectExpr(f"'{model}' AS model", f"stack({len(checks)}, {rows}) AS (column_name, check_name, failing_rows)")


def _unique_result(df: DataFrame, check: Check) -> DataFrame:
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in check.columns])
    dup = df.filter(present).groupBy(*check.columns).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return dup.agg(F.lit(check.model).alias("model"), F.lit(check.column_name).alias("column_name"),
                   F.lit(check.kind).alias("check_name"), F.count(F.lit(1)).alias("failing_rows"))


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS,
               kinds: Sequence[str] = ("not_null", "unique", "accepted_values")) -> DataFrame:
    """All requested checks as one frame (model, column_name, check_name, failing_rows)."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind == "unique" and c.kind in kinds:
            parts.append(_unique_result(models[c.model], c))
        elif c.kind in kinds:
            by_model.setdefault(c.model, []).append(c)
    parts += [_cell_results(models[m], m, cs) for m, cs in by_model.items()]
    return reduce(DataFrame.unionByName, parts)


class WriteChecks:
    """Cell checks and row counts observed while tables are written: no scan of what was written.

    ``watch(name, df)`` returns ``df`` with a metric on its rows; write that
    frame, then ask ``results``. Staging views are not written: their checks
    are watched on the raw table they filter (``views``: view -> (table, condition)).
    """

    def __init__(self, checks: Sequence[Check] = CHECKS, views: Mapping[str, tuple] | None = None):
        from riskloom.operators.staging import VIEWS
        self.views = VIEWS if views is None else views
        self.checks = [c for c in checks if c.kind != "unique"]
        self.watched: dict[str, Observation] = {}

    def table_of(self, model: str) -> str:
        return self.views[model][0] if model in self.views else model

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        metrics = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(self.checks):
            if self.table_of(c.model) == name:
                inside = self.views[c.model][1]() & fails(c) if c.model in self.views else fails(c)
                metrics.append(F.count(F.when(inside, F.lit(1))).alias(f"c{i}"))
        if "id" in df.columns:
            metrics += [F.min("id").alias("least_id"), F.max("id").alias("largest_id")]
        self.watched[name] = Observation()
        return df.observe(self.watched[name], *metrics)

    def rows(self, name: str) -> int:
        return self.watched[name].get["rows"]

    def dense_ids(self, name: str) -> bool:
        """Whether the table's ids fill at least half of their range (bitmaps of them are small then)."""
        seen = self.watched[name].get
        return bool(seen["rows"]) and seen["least_id"] is not None and \
            seen["largest_id"] - seen["least_id"] < 2 * seen["rows"]

    def results(self, models: Mapping[str, DataFrame]) -> list[tuple[str, str, str, int]]:
        """(model, column_name, check_name, failing_rows) of the watched cell checks; ``models`` only for bad values."""
        out = []
        for i, c in enumerate(self.checks):
            table = self.table_of(c.model)
            if table in self.watched:
                n = self.watched[table].get[f"c{i}"]
                if n and c.kind == "accepted_values":
                    n = models[c.model].filter(fails(c)).agg(F.count_distinct(c.column)).first()[0]
                out.append((c.model, c.column_name, c.kind, n))
        return out


# --------------------------------------------------------------------------
# Load-level checks
# --------------------------------------------------------------------------

# (table, comparison, bound) row-count rules of the loaded raw tables.
ROW_COUNT_RULES = (("raw_macro", ">", 10), ("raw_credit", "=", 30000), ("raw_marketing", ">=", 40000))


def row_count_results(models: Mapping[str, DataFrame], rules=ROW_COUNT_RULES) -> DataFrame:
    parts = []
    for table, op, bound in rules:
        n = F.count(F.lit(1))
        ok = {">": n > bound, "=": n == bound, ">=": n >= bound}[op]
        parts.append(models[table].agg(
            F.lit(table).alias("table_name"), n.alias("row_count"),
            F.lit(f"{op} {bound}").alias("rule"), ok.alias("passed")))
    return reduce(DataFrame.unionByName, parts)


def row_count_rows(counts: Mapping[str, int], rules=ROW_COUNT_RULES) -> list[tuple[str, int, str, bool]]:
    """The row-count rules over counts that are known already (from ``WriteChecks``)."""
    ok = {">": int.__gt__, "=": int.__eq__, ">=": int.__ge__}
    return [(t, counts[t], f"{op} {bound}", ok[op](counts[t], bound)) for t, op, bound in rules]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns absent from a table's schema (metadata only, no job)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


REQUIRED_COLUMNS = {
    "raw_credit": ("id", "credit_limit", "age", "is_default"),
    "raw_marketing": ("id", "age", "job", "subscribed_term_deposit"),
}


def country_results(raw_macro: DataFrame) -> DataFrame:
    """Distinct country codes of the macro table, with their row counts."""
    return raw_macro.groupBy("country_code").agg(F.count(F.lit(1)).alias("row_count"))


def macro_presence(raw_macro: DataFrame, column: str = "npl_ratio_pct", country: str = "KEN") -> DataFrame:
    """One row: non-NULL count of an indicator, and whether the expected country is present."""
    return raw_macro.agg(
        F.lit(column).alias("column_name"),
        F.count(F.col(column)).alias("non_null_rows"),
        (F.count(F.col(column)) > 0).alias("not_all_null"),
        F.lit(country).alias("expected_country"),
        F.coalesce(F.max(F.col("country_code") == country), F.lit(False)).alias("expected_country_present"),
    )
