"""Business rules of the credit-risk pipeline as Spark column expressions.

Every function here returns a ``Column`` built only from built-in
``pyspark.sql.functions``, so the rules stay inside whole-stage codegen and
Catalyst can fold, push down and prune around them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: labels, codes and thresholds that must equal the
# --- reference's for identical results (natural order).
DPD_BUCKETS = ("Current", "1-30 DPD", "31-60 DPD", "61-90 DPD", "90+ DPD")
RISK_GRADES = (1, 2, 3, 4)
SIZE_BUCKETS = ("Micro (<50K)", "Small (50K-150K)", "Medium (150K-300K)", "Large (>300K)")
SIZE_BOUNDS = (50000, 150000, 300000)
AGE_BANDS = ("18-29", "30-39", "40-49", "50-59", "60+")
AGE_BAND_BOUNDS = (30, 40, 50, 60)
IFRS9_STAGES = ("Stage 1", "Stage 2", "Stage 3")
EDUCATION_LABELS = {1: "Graduate School", 2: "University", 3: "High School"}
MARITAL_LABELS = {1: "Married", 2: "Single"}
OTHER_LABEL = "Other"
NO_CONSUMPTION_STATUS = -2          # pay status code used when a month is missing
DELINQUENT_STATUS = 3               # pay status from which a month counts as delinquent
LGD_UNSECURED = 0.45                # loss given default, unsecured consumer credit
NPL_BREACH_PCT = 15.0
NPL_WATCH_PCT = 10.0
MIN_CAPITAL_RATIO_PCT = 8.0
MIN_CORE_CAPITAL_PCT = 10.5
GDP_SLOW_PCT = 3.0
NPL_STATUSES = ("OK", "WATCH", "BREACH")
CAPITAL_STATUSES = ("OK", "BREACH")
GDP_STATUSES = ("OK", "SLOW", "RECESSION")
AGE_MIN, AGE_MAX = 18, 100
MACRO_YEAR_MIN, MACRO_YEAR_MAX = 2000, 2025
# Observation months of the six-month panel, oldest first (month_num 1..6).
PANEL_MONTHS = ("apr", "may", "jun", "jul", "aug", "sep")
PANEL_MONTH_LABELS = ("Apr 2005", "May 2005", "Jun 2005", "Jul 2005", "Aug 2005", "Sep 2005")
# Column order of the wide panel in the raw table (newest first).
PANEL_MONTHS_RAW_ORDER = ("sep", "aug", "jul", "jun", "may", "apr")


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Rounding and exact arithmetic
# --------------------------------------------------------------------------

def round_std(c: Column | str, digits: int) -> Column:
    """ROUND(double, n) with ties away from zero on the binary value.

    ``F.round`` on a double goes through its decimal text and rounds e.g.
    1.005 up; scaling first and rounding to an integer matches the
    scale-round-unscale rule of the SQL engines the results are compared with.
    """
    scale = float(10 ** digits)
    return F.round(col_(c).cast("double") * F.lit(scale), 0) / F.lit(scale)


def round_half_even(c: Column | str, digits: int) -> Column:
    """Report-side rounding: scale, round half to even, unscale (as NumPy/pandas ``round``).

    The report layer of the reference rounds its roll-ups in pandas, whose
    ties go to the even digit; SQL-side ``ROUND`` (``round_std``) sends them
    away from zero.
    """
    scale = float(10 ** digits)
    return F.bround(col_(c).cast("double") * F.lit(scale), 0) / F.lit(scale)


def scaled_long(c: Column | str, digits: int) -> Column:
    """A value with ``digits`` decimals as an exact integer count of units."""
    return F.round(col_(c).cast("double") * F.lit(float(10 ** digits)), 0).cast("long")


def exact_sum(c: Column | str, digits: int) -> Column:
    """Aggregate: order-independent sum of a column rounded to ``digits``.

    Double sums depend on the order rows arrive in; values carrying a fixed
    number of decimals are summed as integers and divided once.
    """
    return F.sum(scaled_long(c, digits)) / F.lit(float(10 ** digits))


def exact_avg(c: Column | str, digits: int) -> Column:
    """Aggregate: order-independent mean of a column rounded to ``digits``."""
    return F.sum(scaled_long(c, digits)) / F.count(col_(c)) / F.lit(float(10 ** digits))


def long_avg(c: Column | str) -> Column:
    """Aggregate: mean of an integer column from an exact integer sum."""
    return F.sum(col_(c)) / F.count(col_(c))


def safe_ratio_pct(num: Column | str, den: Column | str) -> Column:
    """``num / den * 100`` when ``den > 0``, else 0.0; division only inside the guard."""
    den_c = col_(den)
    return F.when(den_c > 0, col_(num) / den_c * F.lit(100.0)).otherwise(F.lit(0.0))


def nonzero_ratio_pct(num: Column | str, den: Column | str) -> Column:
    """``num / den * 100`` when ``den != 0``, else 0.0 (zero -> NaN -> 0 guard)."""
    den_c = col_(den)
    return F.when(den_c != 0, col_(num) / den_c * F.lit(100.0)).otherwise(F.lit(0.0))


# --------------------------------------------------------------------------
# Decoding and classification
# --------------------------------------------------------------------------

def decode(c: Column | str, labels: Mapping[int, str], other: str = OTHER_LABEL) -> Column:
    """Simple CASE: code -> label, anything else (NULL included) -> ``other``."""
    c = col_(c)
    expr = None
    for code, label in labels.items():
        expr = F.when(c == code, label) if expr is None else expr.when(c == code, label)
    return expr.otherwise(other)


def yes_no_flag(c: Column | str) -> Column:
    """'yes' -> 1, 'no' -> 0, anything else -> NULL."""
    c = col_(c)
    return F.when(c == "yes", F.lit(1)).when(c == "no", F.lit(0))


def worst_delay(statuses: Sequence[Column | str]) -> Column:
    """Worst pay status over the panel; missing months count as no consumption."""
    return F.greatest(*[F.coalesce(col_(s), F.lit(NO_CONSUMPTION_STATUS)) for s in statuses])


def dpd_bucket(delay: Column | str) -> Column:
    d = col_(delay)
    return (F.when(d <= 0, DPD_BUCKETS[0])
            .when(d == 1, DPD_BUCKETS[1])
            .when(d == 2, DPD_BUCKETS[2])
            .when(d == 3, DPD_BUCKETS[3])
            .otherwise(DPD_BUCKETS[4]))


def risk_grade(delay: Column | str) -> Column:
    d = col_(delay)
    return (F.when(d <= 0, F.lit(1))
            .when(d <= 2, F.lit(2))
            .when(d <= 3, F.lit(3))
            .otherwise(F.lit(4)))


def age_band(age: Column | str) -> Column:
    a = col_(age)
    expr = F.when(a < AGE_BAND_BOUNDS[0], AGE_BANDS[0])
    for bound, label in zip(AGE_BAND_BOUNDS[1:], AGE_BANDS[1:-1]):
        expr = expr.when(a < bound, label)
    return expr.otherwise(AGE_BANDS[-1])


def size_bucket(limit: Column | str) -> Column:
    lim = col_(limit)
    expr = F.when(lim <= SIZE_BOUNDS[0], SIZE_BUCKETS[0])
    for bound, label in zip(SIZE_BOUNDS[1:], SIZE_BUCKETS[1:-1]):
        expr = expr.when(lim <= bound, label)
    return expr.otherwise(SIZE_BUCKETS[-1])


def ifrs9_stage(bucket: Column | str) -> Column:
    b = col_(bucket)
    return (F.when(b == DPD_BUCKETS[0], IFRS9_STAGES[0])
            .when(b.isin(DPD_BUCKETS[1], DPD_BUCKETS[2]), IFRS9_STAGES[1])
            .otherwise(IFRS9_STAGES[2]))


def npl_flag(bucket: Column | str, is_default: Column | str) -> Column:
    """Non-performing: 90+ days past due or defaulted."""
    return F.when((col_(bucket) == DPD_BUCKETS[4]) | (col_(is_default) == 1), F.lit(1)).otherwise(F.lit(0))


def utilisation_pct(balance: Column | str, limit: Column | str) -> Column:
    lim = col_(limit)
    return F.when(lim > 0, round_std(col_(balance) / lim.cast("double") * F.lit(100.0), 2)).otherwise(F.lit(0.0))


def ecl_amount(pd_: Column | str, lgd: Column | str, ead: Column | str) -> Column:
    """PD x LGD x EAD, multiplied left to right, 2 decimals; no floor."""
    return round_std(col_(pd_) * col_(lgd) * col_(ead), 2)


def delinquent_flag(status: Column | str) -> Column:
    """1 when a month's pay status is at least the delinquency status; NULL -> 0."""
    return F.when(col_(status) >= DELINQUENT_STATUS, F.lit(1)).otherwise(F.lit(0))


def npl_status(npl_pct: Column | str) -> Column:
    x = col_(npl_pct)
    return F.when(x > NPL_BREACH_PCT, "BREACH").when(x > NPL_WATCH_PCT, "WATCH").otherwise("OK")


def capital_status(capital_pct: Column | str) -> Column:
    return F.when(col_(capital_pct) < MIN_CAPITAL_RATIO_PCT, "BREACH").otherwise("OK")


def gdp_status(growth_pct: Column | str) -> Column:
    x = col_(growth_pct)
    return F.when(x < 0, "RECESSION").when(x < GDP_SLOW_PCT, "SLOW").otherwise("OK")


def threshold_side(rate: Column | str, threshold: float = NPL_BREACH_PCT) -> Column:
    return F.when(col_(rate) > threshold, "Above").otherwise("Below")


def label_rank(c: Column | str, labels: Sequence[str]) -> Column:
    """Position (1-based) of a label in a fixed display order; unknown -> n+1."""
    c = col_(c)
    expr = None
    for i, label in enumerate(labels, start=1):
        expr = F.when(c == label, F.lit(i)) if expr is None else expr.when(c == label, F.lit(i))
    return expr.otherwise(F.lit(len(labels) + 1))
