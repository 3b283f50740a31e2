"""Independent SQL oracle for every registered query (DuckDB dialect).

Written by hand from the model semantics against the raw test tables; the
test-data derivations are the leading CTEs. Conventions that keep the two
engines bit-identical:

* ``SUM`` of integers is HUGEINT in DuckDB: cast to BIGINT.
* Every ``ROUND`` result gets ``+ 0.0`` so a rounded negative zero reads 0.0.
* Averages of fixed-decimal values are exact integer sums divided once.
* Double literals use the ``E0`` form (a bare ``100.0`` is DECIMAL).
"""

from __future__ import annotations

MONTHS = ("apr", "may", "jun", "jul", "aug", "sep")           # line number 1..6
RAW_ORDER = ("sep", "aug", "jul", "jun", "may", "apr")
LABELS = ("Apr 2005", "May 2005", "Jun 2005", "Jul 2005", "Aug 2005", "Sep 2005")
INDICATORS = ("npl_ratio_pct", "credit_private_sector_gdp_pct", "bank_capital_assets_ratio_pct",
              "gdp_growth_annual_pct", "inflation_cpi_annual_pct")


def _month_lines() -> str:
    out = []
    for i, m in enumerate(MONTHS, start=1):
        on = f"(l_linenumber - 1) % 6 + 1 = {i}"
        out.append(f"""
         MAX(CASE WHEN {on} THEN
               CASE WHEN l_quantity <= 20 THEN -2 WHEN l_quantity <= 34 THEN -1
                    WHEN l_quantity <= 44 THEN 0  WHEN l_quantity <= 46 THEN 1
                    WHEN l_quantity <= 48 THEN 2  WHEN l_quantity <= 49 THEN 3
                    ELSE CAST(4 + l_partkey % 6 AS INTEGER) END END) AS pay_status_{m},
         COALESCE(MAX(CASE WHEN {on} THEN
               CAST(FLOOR(l_extendedprice) AS BIGINT)
               * CASE WHEN l_tax = 0 THEN -1 ELSE 1 END END), 0) AS bill_amt_{m},
         MAX(CASE WHEN {on} THEN
               CAST(FLOOR(l_extendedprice / 10) AS BIGINT) END) AS pay_amt_{m}""")
    return ",".join(out)


def _cols(prefix: str) -> str:
    return ", ".join(f"{prefix}{m}" for m in RAW_ORDER)


PANEL = f"{_cols('pay_status_')}, {_cols('bill_amt_')}, {_cols('pay_amt_')}"

SIZE_CASE = """CASE WHEN {c} <= 50000  THEN 'Micro (<50K)'
            WHEN {c} <= 150000 THEN 'Small (50K-150K)'
            WHEN {c} <= 300000 THEN 'Medium (150K-300K)'
            ELSE 'Large (>300K)' END"""
DPD_CASE = """CASE WHEN {d} <= 0 THEN 'Current' WHEN {d} = 1 THEN '1-30 DPD'
            WHEN {d} = 2 THEN '31-60 DPD' WHEN {d} = 3 THEN '61-90 DPD' ELSE '90+ DPD' END"""
GRADE_CASE = "CASE WHEN {d} <= 0 THEN 1 WHEN {d} <= 2 THEN 2 WHEN {d} <= 3 THEN 3 ELSE 4 END"
AGE_CASE = """CASE WHEN {a} < 30 THEN '18-29' WHEN {a} < 40 THEN '30-39' WHEN {a} < 50 THEN '40-49'
            WHEN {a} < 60 THEN '50-59' ELSE '60+' END"""
STAGE_CASE = """CASE WHEN {b} = 'Current' THEN 'Stage 1'
            WHEN {b} IN ('1-30 DPD', '31-60 DPD') THEN 'Stage 2' ELSE 'Stage 3' END"""
NPL_STATUS = "CASE WHEN {x} > 15.0 THEN 'BREACH' WHEN {x} > 10.0 THEN 'WATCH' ELSE 'OK' END"
CAP_STATUS = "CASE WHEN {x} < 8.0 THEN 'BREACH' ELSE 'OK' END"
GDP_STATUS = "CASE WHEN {x} < 0 THEN 'RECESSION' WHEN {x} < 3.0 THEN 'SLOW' ELSE 'OK' END"


def xavg(c: str, scale: str) -> str:
    """Exact mean of a fixed-decimal double column (scale = '100' or '10000')."""
    return (f"(CAST(SUM(CAST(ROUND({c} * {scale}.0E0) AS BIGINT)) AS DOUBLE) / COUNT({c}) / {scale}.0E0)")


def xsum(c: str, scale: str) -> str:
    return f"(CAST(SUM(CAST(ROUND({c} * {scale}.0E0) AS BIGINT)) AS DOUBLE) / {scale}.0E0)"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


# ---------------------------------------------------------------- raw inputs
cte("loan_lines", (), f"""
  SELECT l_orderkey,
         SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r,{_month_lines()}
  FROM lineitem GROUP BY l_orderkey""")

cte("raw_credit", ("loan_lines",), f"""
  SELECT o_orderkey AS id,
         CAST(FLOOR(o_totalprice) AS BIGINT) - 5000 AS credit_limit,
         1 + o_custkey % 2 AS gender,
         CAST(substr(o_orderpriority, 1, 1) AS INT) AS education_level,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS marital_status,
         15 + o_custkey % 90 AS age,
         {_cols('pay_status_')},
         {", ".join(f"COALESCE(bill_amt_{m}, 0) AS bill_amt_{m}" for m in RAW_ORDER)},
         {_cols('pay_amt_')},
         CASE WHEN a.r >= 3 THEN 1 ELSE 0 END AS is_default
  FROM orders LEFT JOIN loan_lines a ON a.l_orderkey = o_orderkey""")

cte("macro_panel", (), """
  SELECT n_name AS country_code, CAST(year(o_orderdate) + 4 AS INT) AS year,
         CASE WHEN (n_nationkey + year(o_orderdate) + 4) % 7 = 0 THEN NULL
              ELSE 100.0E0 * SUM(CASE WHEN o_totalprice < 75000 THEN 1 ELSE 0 END) / COUNT(*) END AS npl_ratio_pct,
         100.0E0 * SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) / COUNT(*) AS credit_private_sector_gdp_pct,
         CASE WHEN (n_nationkey + year(o_orderdate) + 4) % 3 = 0 THEN NULL
              ELSE 50.0E0 * SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) / COUNT(*) END AS bank_capital_assets_ratio_pct,
         2.0E0 + 20.0E0 * SUM(CASE WHEN o_orderstatus = 'P' THEN 1 WHEN o_orderstatus = 'F' THEN -1 ELSE 0 END) / COUNT(*) AS gdp_growth_annual_pct,
         25.0E0 * SUM(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) / COUNT(*) AS inflation_cpi_annual_pct
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
  GROUP BY n_name, n_nationkey, year(o_orderdate)""")

cte("macro_long", ("macro_panel",), "\n  UNION ALL".join(
    f"""
  SELECT country_code, year, '{ind}' AS indicator, {ind} AS value FROM macro_panel WHERE {ind} IS NOT NULL"""
    for ind in INDICATORS))

# the most recent years of a series are counted with their empty values, which go afterwards
cte("macro_series", ("macro_panel",), "\n  UNION ALL".join(
    f"""
  SELECT country_code, year, '{ind}' AS indicator, {ind} AS value FROM macro_panel"""
    for ind in INDICATORS))

cte("macro_ranked", ("macro_series",), """
  SELECT *, ROW_NUMBER() OVER (PARTITION BY country_code, indicator ORDER BY year DESC) AS rn FROM macro_series""")

cte("macro_recent", ("macro_ranked",), """
  SELECT country_code, year, indicator, value FROM macro_ranked WHERE rn <= 25 AND value IS NOT NULL""")

cte("raw_macro", ("macro_recent",), "\n  SELECT year, country_code, " + ", ".join(
    f"MAX(CASE WHEN indicator = '{ind}' THEN value END) AS {ind}" for ind in INDICATORS)
    + "\n  FROM macro_recent GROUP BY country_code, year")

cte("raw_marketing", (), """
  SELECT c_custkey + 1 AS id, 15 + c_custkey % 90 AS age, lower(c_mktsegment) AS job,
         CASE c_custkey % 3 WHEN 0 THEN 'married' WHEN 1 THEN 'single' ELSE 'divorced' END AS marital,
         CASE c_custkey % 4 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary' WHEN 2 THEN 'tertiary' END AS education,
         CASE WHEN c_custkey % 13 = 0 THEN 'unknown' WHEN c_acctbal < 0 THEN 'yes' ELSE 'no' END AS has_credit_default,
         CAST(FLOOR(c_acctbal) AS BIGINT) AS avg_yearly_balance,
         CASE WHEN c_custkey % 3 = 0 THEN 'yes' ELSE 'no' END AS has_housing_loan,
         CASE WHEN c_custkey % 5 = 0 THEN 'yes' ELSE 'no' END AS has_personal_loan,
         CASE c_custkey % 3 WHEN 0 THEN 'cellular' WHEN 1 THEN 'telephone' END AS contact,
         1 + c_custkey % 31 AS contact_day_of_week,
         substr('janfebmaraprmayjunjulaugsepoctnovdec', CAST(1 + 3 * (c_custkey % 12) AS INT), 3) AS month,
         c_custkey * 37 % 3600 AS call_duration_sec,
         1 + c_custkey % 5 AS num_contacts_campaign,
         CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 400 ELSE -1 END AS days_since_prev_contact,
         c_custkey % 7 AS num_previous_contacts,
         CASE c_custkey % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'failure' WHEN 2 THEN 'other' END AS prev_campaign_outcome,
         CASE WHEN c_acctbal > 7000 THEN 'yes' ELSE 'no' END AS subscribed_term_deposit
  FROM customer""")

# ------------------------------------------------------------------- staging
cte("stg_credit", ("raw_credit",), f"""
  SELECT id, credit_limit, gender,
         CASE education_level WHEN 1 THEN 'Graduate School' WHEN 2 THEN 'University'
              WHEN 3 THEN 'High School' ELSE 'Other' END AS education_level,
         CASE marital_status WHEN 1 THEN 'Married' WHEN 2 THEN 'Single' ELSE 'Other' END AS marital_status,
         age, {PANEL}, CAST(is_default AS INTEGER) AS is_default
  FROM raw_credit
  WHERE credit_limit > 0 AND age BETWEEN 18 AND 100""")

cte("stg_marketing", ("raw_marketing",), """
  SELECT id, age, job, marital, education,
         CASE has_credit_default WHEN 'yes' THEN 1 WHEN 'no' THEN 0 ELSE NULL END AS has_credit_default,
         avg_yearly_balance,
         CASE has_housing_loan WHEN 'yes' THEN 1 WHEN 'no' THEN 0 ELSE NULL END AS has_housing_loan,
         CASE has_personal_loan WHEN 'yes' THEN 1 WHEN 'no' THEN 0 ELSE NULL END AS has_personal_loan,
         contact AS contact_type, month, contact_day_of_week AS day_of_week,
         call_duration_sec, num_contacts_campaign, days_since_prev_contact,
         num_previous_contacts, prev_campaign_outcome, subscribed_term_deposit
  FROM raw_marketing WHERE age BETWEEN 18 AND 100""")

cte("stg_macro", ("raw_macro",), "\n  SELECT CAST(year AS INTEGER) AS year, country_code, " + ", ".join(
    f"ROUND(CAST({ind} AS DOUBLE), 2) + 0.0 AS {ind}" for ind in INDICATORS)
    + "\n  FROM raw_macro WHERE year IS NOT NULL AND year BETWEEN 2000 AND 2025")

# -------------------------------------------------------------- intermediate
_greatest = ", ".join(f"COALESCE(pay_status_{m}, -2)" for m in RAW_ORDER)
cte("delinq", ("stg_credit",), f"""
  SELECT id, credit_limit, age, gender, education_level, marital_status, is_default,
         max_months_delayed,
         {DPD_CASE.format(d='max_months_delayed')} AS dpd_bucket,
         {GRADE_CASE.format(d='max_months_delayed')} AS risk_grade,
         bill_amt_sep AS outstanding_balance,
         pay_amt_sep + pay_amt_aug + pay_amt_jul + pay_amt_jun + pay_amt_may + pay_amt_apr AS total_payments_6m
  FROM (SELECT *, GREATEST({_greatest}) AS max_months_delayed FROM stg_credit) b""")

cte("seg", ("delinq",), f"""
  SELECT id, credit_limit, age, education_level, marital_status, dpd_bucket, risk_grade, is_default,
         outstanding_balance, total_payments_6m,
         {AGE_CASE.format(a='age')} AS age_band,
         {SIZE_CASE.format(c='credit_limit')} AS credit_size_bucket,
         CASE WHEN credit_limit > 0
              THEN ROUND(outstanding_balance / CAST(credit_limit AS DOUBLE) * 100, 2) + 0.0
              ELSE 0.0E0 END AS utilisation_rate_pct,
         CASE WHEN dpd_bucket = '90+ DPD' OR is_default = 1 THEN 1 ELSE 0 END AS is_npl
  FROM delinq""")

cte("bucket_pd", ("seg",), """
  SELECT dpd_bucket, ROUND(AVG(CAST(is_default AS DOUBLE)), 4) + 0.0 AS empirical_pd
  FROM seg GROUP BY dpd_bucket""")

cte("ecl", ("seg", "bucket_pd"), f"""
  SELECT s.*, bp.empirical_pd,
         {STAGE_CASE.format(b='s.dpd_bucket')} AS ifrs9_stage,
         0.45E0 AS lgd,
         s.outstanding_balance AS ead,
         ROUND(bp.empirical_pd * 0.45E0 * s.outstanding_balance, 2) + 0.0 AS ecl_amount
  FROM seg s LEFT JOIN bucket_pd bp ON s.dpd_bucket = bp.dpd_bucket""")

# --------------------------------------------------------------------- marts
cte("summary", ("seg",), f"""
  SELECT credit_size_bucket, age_band, education_level, dpd_bucket,
         COUNT(*) AS loan_count,
         CAST(SUM(credit_limit) AS BIGINT) AS total_credit_limit,
         ROUND(CAST(SUM(credit_limit) AS DOUBLE) / COUNT(credit_limit), 0) + 0.0 AS avg_credit_limit,
         CAST(SUM(outstanding_balance) AS BIGINT) AS total_outstanding,
         ROUND(CAST(SUM(outstanding_balance) AS DOUBLE) / COUNT(outstanding_balance), 0) + 0.0 AS avg_outstanding,
         ROUND({xavg('utilisation_rate_pct', '100')}, 2) + 0.0 AS avg_utilisation_pct,
         CAST(SUM(is_default) AS BIGINT) AS default_count,
         CAST(SUM(is_npl) AS BIGINT) AS npl_count,
         ROUND(CAST(SUM(is_default) AS DOUBLE) / COUNT(*) * 100, 2) + 0.0 AS default_rate_pct,
         ROUND(CAST(SUM(is_npl) AS DOUBLE) / COUNT(*) * 100, 2) + 0.0 AS npl_rate_pct
  FROM seg GROUP BY credit_size_bucket, age_band, education_level, dpd_bucket""")

_npl_ead = "SUM(CASE WHEN is_npl = 1 THEN ead ELSE 0 END)"
cte("npl", ("ecl",), f"""
  SELECT dpd_bucket, ifrs9_stage, credit_size_bucket, education_level,
         COUNT(*) AS loan_count,
         CAST(SUM(is_npl) AS BIGINT) AS npl_count,
         ROUND(CAST(SUM(is_npl) AS DOUBLE) / COUNT(*) * 100, 2) + 0.0 AS npl_rate_pct,
         CAST(SUM(ead) AS BIGINT) AS total_ead,
         CAST({_npl_ead} AS BIGINT) AS npl_outstanding,
         ROUND({xsum('ecl_amount', '100')}, 0) + 0.0 AS total_ecl_provision,
         ROUND(CASE WHEN {_npl_ead} > 0 THEN {xsum('ecl_amount', '100')} / {_npl_ead} * 100
                    ELSE 0.0E0 END, 2) + 0.0 AS provision_coverage_pct,
         ROUND({xavg('empirical_pd', '10000')} * 100, 2) + 0.0 AS avg_pd_pct,
         ROUND({xavg('utilisation_rate_pct', '100')}, 2) + 0.0 AS avg_utilisation_pct
  FROM ecl GROUP BY dpd_bucket, ifrs9_stage, credit_size_bucket, education_level""")

_npl_ecl = xsum("CASE WHEN is_npl = 1 THEN ecl_amount ELSE 0 END", "100")
cte("ecl_mart", ("ecl",), f"""
  SELECT ifrs9_stage, credit_size_bucket,
         COUNT(*) AS loan_count,
         CAST(SUM(ead) AS BIGINT) AS total_ead,
         ROUND({xsum('ecl_amount', '100')}, 0) + 0.0 AS total_ecl,
         ROUND({xavg('empirical_pd', '10000')} * 100, 2) + 0.0 AS avg_pd_pct,
         ROUND({xavg('lgd', '100')} * 100, 2) + 0.0 AS lgd_pct,
         ROUND(CASE WHEN SUM(ead) > 0 THEN {xsum('ecl_amount', '100')} / SUM(ead) * 100
                    ELSE 0.0E0 END, 2) + 0.0 AS ecl_rate_pct,
         CAST(SUM(is_npl) AS BIGINT) AS npl_count,
         ROUND(CASE WHEN {_npl_ead} > 0 THEN {_npl_ecl} / {_npl_ead} * 100
                    ELSE 0.0E0 END, 2) + 0.0 AS npl_provision_coverage_pct
  FROM ecl GROUP BY ifrs9_stage, credit_size_bucket""")

cte("monthly_status", ("stg_credit",), "\n  UNION ALL".join(
    f"""
  SELECT id, credit_limit, is_default, {i} AS month_num, '{lab}' AS obs_month,
         pay_status_{m} AS pay_status, bill_amt_{m} AS balance FROM stg_credit"""
    for i, (m, lab) in enumerate(zip(MONTHS, LABELS), start=1)))

cte("vintage", ("monthly_status",), f"""
  SELECT cohort, month_num, obs_month,
         COUNT(DISTINCT id) AS loan_count,
         CAST(SUM(CASE WHEN pay_status >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS delinquent_count,
         CAST(SUM(is_default) AS BIGINT) AS default_count,
         ROUND(CAST(SUM(CASE WHEN pay_status >= 3 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(DISTINCT id) * 100, 2) + 0.0
             AS delinquency_rate_pct,
         ROUND(CAST(SUM(is_default) AS DOUBLE) / COUNT(DISTINCT id) * 100, 2) + 0.0 AS default_rate_pct,
         ROUND(CAST(SUM(balance) AS DOUBLE) / COUNT(balance), 0) + 0.0 AS avg_balance
  FROM (SELECT *, {SIZE_CASE.format(c='credit_limit')} AS cohort FROM monthly_status) w
  GROUP BY cohort, month_num, obs_month""")

cte("reg", ("stg_macro",), f"""
  SELECT year, country_code, {", ".join(INDICATORS)},
         15.0E0 AS npl_warning_threshold_pct, 8.0E0 AS min_capital_ratio_pct, 10.5E0 AS cbk_min_core_capital_pct,
         {NPL_STATUS.format(x='npl_ratio_pct')} AS npl_status,
         {CAP_STATUS.format(x='bank_capital_assets_ratio_pct')} AS capital_status,
         {GDP_STATUS.format(x='gdp_growth_annual_pct')} AS gdp_status,
         ROUND(npl_ratio_pct - LAG(npl_ratio_pct) OVER (PARTITION BY country_code ORDER BY year), 2) + 0.0
             AS npl_yoy_change_pp
  FROM stg_macro
  WHERE npl_ratio_pct IS NOT NULL OR bank_capital_assets_ratio_pct IS NOT NULL""")


def with_ctes(final: str, *needs: str) -> str:
    """``WITH`` the dependency closure of ``needs`` (in definition order) + ``final``."""
    want: set[str] = set()

    def visit(n: str) -> None:
        if n in want:
            return
        want.add(n)
        for d in CTES[n][0]:
            visit(d)

    for n in needs:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in CTES if n in want)
    return f"WITH {body}\n{final}"


def queries() -> dict[str, str]:
    from oracle_sql_more import more_queries

    q = {
        "raw_credit": with_ctes("SELECT * FROM raw_credit", "raw_credit"),
        "raw_marketing": with_ctes("SELECT * FROM raw_marketing", "raw_marketing"),
        "raw_indicator_recent": with_ctes("SELECT * FROM macro_recent", "macro_recent"),
        "raw_macro": with_ctes("SELECT * FROM raw_macro", "raw_macro"),
        "stg_credit_default": with_ctes("SELECT * FROM stg_credit", "stg_credit"),
        "stg_bank_marketing": with_ctes("SELECT * FROM stg_marketing", "stg_marketing"),
        "stg_macro": with_ctes("SELECT * FROM stg_macro", "stg_macro"),
        "int_loan_delinquency": with_ctes("SELECT * FROM delinq", "delinq"),
        "int_portfolio_segments": with_ctes("SELECT * FROM seg", "seg"),
        "bucket_pd": with_ctes("SELECT * FROM bucket_pd", "bucket_pd"),
        "int_ecl_inputs": with_ctes("SELECT * FROM ecl", "ecl"),
        "mart_portfolio_summary": with_ctes("SELECT * FROM summary", "summary"),
        "mart_npl_analysis": with_ctes("SELECT * FROM npl", "npl"),
        "mart_ecl_estimates": with_ctes("SELECT * FROM ecl_mart", "ecl_mart"),
        "vintage_unpivot": with_ctes(
            f"SELECT id, credit_limit, is_default, month_num, obs_month, pay_status, balance, "
            f"{SIZE_CASE.format(c='credit_limit')} AS cohort FROM monthly_status", "monthly_status"),
        "mart_vintage_curves": with_ctes("SELECT * FROM vintage", "vintage"),
        "mart_regulatory_ratios": with_ctes("SELECT * FROM reg", "reg"),
    }
    q.update(more_queries())
    return q
