"""Oracle SQL for the source variants, scalar-function, serving and data-quality keys."""

from __future__ import annotations

from oracle_sql import (AGE_CASE, CAP_STATUS, DPD_CASE, GDP_STATUS, GRADE_CASE, INDICATORS, LABELS,
                        NPL_STATUS, RAW_ORDER, SIZE_CASE, STAGE_CASE, with_ctes, xavg)

DPD_RANK = ("CASE dpd_bucket WHEN 'Current' THEN 1 WHEN '1-30 DPD' THEN 2 WHEN '31-60 DPD' THEN 3 "
            "WHEN '61-90 DPD' THEN 4 WHEN '90+ DPD' THEN 5 ELSE 6 END")
SIZE_RANK = ("CASE {c} WHEN 'Micro (<50K)' THEN 1 WHEN 'Small (50K-150K)' THEN 2 "
             "WHEN 'Medium (150K-300K)' THEN 3 WHEN 'Large (>300K)' THEN 4 ELSE 5 END")
AGE_RANK = ("CASE age_band WHEN '18-29' THEN 1 WHEN '30-39' THEN 2 WHEN '40-49' THEN 3 "
            "WHEN '50-59' THEN 4 WHEN '60+' THEN 5 ELSE 6 END")

CREDIT_COLS = ("id, credit_limit, gender, education_level, marital_status, age, "
               + ", ".join(f"{p}{m}" for p in ("pay_status_", "bill_amt_", "pay_amt_") for m in RAW_ORDER)
               + ", is_default")


def _share(value: str) -> str:
    return (f"ROUND(CASE WHEN SUM({value}) OVER () <> 0 "
            f"THEN CAST({value} AS DOUBLE) / SUM({value}) OVER () * 100 ELSE 0.0E0 END, 2) + 0.0 AS share_pct")


def _sources() -> dict[str, str]:
    fo = "macro_recent"
    series = [f"(SELECT country_code, year, value AS {ind} FROM {fo} WHERE indicator = '{ind}') s{i}"
              for i, ind in enumerate(INDICATORS)]
    chain = series[0]
    key_c, key_y = "s0.country_code", "s0.year"
    for i in range(1, len(series)):
        chain += (f"\n    FULL OUTER JOIN {series[i]} ON {key_c} = s{i}.country_code AND {key_y} = s{i}.year")
        key_c = f"COALESCE({key_c}, s{i}.country_code)"
        key_y = f"COALESCE({key_y}, s{i}.year)"
    full_outer = (f"SELECT {key_y} AS year, {key_c} AS country_code, "
                  + ", ".join(f"s{i}.{ind}" for i, ind in enumerate(INDICATORS)) + f"\n  FROM {chain}")
    return {
        "raw_credit_rename": with_ctes("SELECT * FROM raw_credit", "raw_credit"),
        "raw_credit_concat": with_ctes(
            f"SELECT {CREDIT_COLS.replace(', is_default', '')}, t.is_default "
            "FROM (SELECT * EXCLUDE (is_default) FROM raw_credit) f FULL OUTER JOIN "
            "(SELECT l_orderkey AS id, CASE WHEN SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) >= 3 "
            "THEN 1 ELSE 0 END AS is_default FROM lineitem GROUP BY l_orderkey) t USING (id)", "raw_credit"),
        "raw_credit_glued": with_ctes(
            "SELECT ROW_NUMBER() OVER (ORDER BY id) AS id, " + CREDIT_COLS.replace("id, ", "", 1) + " FROM raw_credit",
            "raw_credit"),
        "raw_indicator_recent5": with_ctes(
            "SELECT country_code, year, indicator, value FROM macro_ranked WHERE rn <= 5 AND value IS NOT NULL", "macro_ranked"),
        "cohort_distinct_loans": with_ctes(
            f"SELECT {SIZE_CASE.format(c='credit_limit')} AS cohort, COUNT(DISTINCT id) AS loan_count FROM stg_credit GROUP BY 1",
            "stg_credit"),
        "raw_marketing_quarantine": with_ctes("""
  SELECT position, 'avg_yearly_balance' AS column_name, 'n/a' AS raw_value, 'does not fit bigint' AS reason
  FROM (SELECT id, ROW_NUMBER() OVER (ORDER BY id) - 1 AS position FROM raw_marketing) p WHERE id % 11 = 0
  UNION ALL
  SELECT position, 'age', age || ' years', 'does not fit bigint'
  FROM (SELECT id, age, ROW_NUMBER() OVER (ORDER BY id) - 1 AS position FROM raw_marketing) p WHERE id % 17 = 0""", "raw_marketing"),
        "raw_marketing_rename": with_ctes("SELECT * FROM raw_marketing", "raw_marketing"),
        "surrogate_id": with_ctes(
            "SELECT ROW_NUMBER() OVER (ORDER BY id) AS id, id AS source_id, "
            + CREDIT_COLS.replace("id, ", "", 1) + " FROM raw_credit", "raw_credit"),
        "macro_full_outer": with_ctes(full_outer, "macro_recent"),
        "raw_indicator_unpivot": with_ctes("""
  SELECT s.country_code, s.indicator, y.year, l.value
  FROM (SELECT DISTINCT country_code, indicator FROM macro_long) s
  CROSS JOIN (SELECT DISTINCT year FROM macro_long) y
  LEFT JOIN macro_long l
    ON l.country_code = s.country_code AND l.indicator = s.indicator AND l.year = y.year""", "macro_long"),
    }


def _functions() -> dict[str, str]:
    delay = "CASE WHEN l_quantity > 49 THEN NULL ELSE l_linenumber - 3 END"
    delay_groups = f"(SELECT {delay} AS delay, COUNT(*) AS n FROM lineitem GROUP BY 1) g"
    greatest = ", ".join(f"COALESCE(pay_status_{m}, -2)" for m in RAW_ORDER)
    return {
        "fn_worst_delay": with_ctes(f"SELECT id, GREATEST({greatest}) AS max_months_delayed FROM raw_credit",
                                    "raw_credit"),
        "fn_dpd_bucket": f"SELECT delay, {DPD_CASE.format(d='delay')} AS dpd_bucket, n FROM {delay_groups}",
        "fn_risk_grade": f"SELECT delay, {GRADE_CASE.format(d='delay')} AS risk_grade, n FROM {delay_groups}",
        "fn_ifrs9_stage": (f"SELECT delay, dpd_bucket, {STAGE_CASE.format(b='dpd_bucket')} AS ifrs9_stage, n "
                           f"FROM (SELECT delay, {DPD_CASE.format(d='delay')} AS dpd_bucket, n FROM {delay_groups}) b"),
        "fn_age_band": (f"SELECT age, {AGE_CASE.format(a='age')} AS age_band, n FROM "
                        f"(SELECT c_custkey % 90 + 10 AS age, COUNT(*) AS n FROM customer GROUP BY 1) a"),
        "fn_size_bucket": f"""
  SELECT credit_size_bucket, COUNT(*) AS n, MIN(credit_limit) AS min_limit, MAX(credit_limit) AS max_limit
  FROM (SELECT credit_limit, {SIZE_CASE.format(c='credit_limit')} AS credit_size_bucket
        FROM (SELECT CAST(FLOOR(o_totalprice) AS BIGINT) - 5000 AS credit_limit FROM orders) o) b
  GROUP BY credit_size_bucket""",
        "fn_status_flags": with_ctes(
            f"SELECT country_code, year, {NPL_STATUS.format(x='npl_ratio_pct')} AS npl_status, "
            f"{CAP_STATUS.format(x='bank_capital_assets_ratio_pct')} AS capital_status, "
            f"{GDP_STATUS.format(x='gdp_growth_annual_pct')} AS gdp_status FROM macro_panel", "macro_panel"),
        "fn_decode": """
  SELECT education_code,
         CASE education_code WHEN 1 THEN 'Graduate School' WHEN 2 THEN 'University'
              WHEN 3 THEN 'High School' ELSE 'Other' END AS education_level,
         marital_code,
         CASE marital_code WHEN 1 THEN 'Married' WHEN 2 THEN 'Single' ELSE 'Other' END AS marital_status,
         n
  FROM (SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS education_code,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS marital_code,
               COUNT(*) AS n
        FROM orders GROUP BY 1, 2) g""",
        "fn_yes_no": with_ctes("""
  SELECT has_credit_default,
         CASE has_credit_default WHEN 'yes' THEN 1 WHEN 'no' THEN 0 ELSE NULL END AS credit_default_flag,
         has_housing_loan,
         CASE has_housing_loan WHEN 'yes' THEN 1 WHEN 'no' THEN 0 ELSE NULL END AS housing_loan_flag,
         COUNT(*) AS n
  FROM raw_marketing GROUP BY has_credit_default, has_housing_loan""", "raw_marketing"),
        "fn_round": """
  SELECT l_orderkey, l_linenumber, x,
         ROUND(x, 0) + 0.0 AS round_0, ROUND(x, 2) + 0.0 AS round_2, ROUND(x, 4) + 0.0 AS round_4
  FROM (SELECT l_orderkey, l_linenumber, (l_extendedprice - 50000.0E0) / 7.0E0 AS x FROM lineitem) v""",
        "fn_safe_ratio": """
  SELECT c_custkey, num, den,
         ROUND(CASE WHEN den > 0 THEN num / den * 100 ELSE 0.0E0 END, 2) + 0.0 AS positive_guard_pct,
         ROUND(CASE WHEN den <> 0 THEN num / den * 100 ELSE 0.0E0 END, 2) + 0.0 AS nonzero_guard_pct
  FROM (SELECT c_custkey, c_acctbal AS num, c_custkey % 5 - 2 AS den FROM customer) v""",
    }


def reven(expr: str, digits: int) -> str:
    """Half-to-even rounding of a double: scale, round_even to an integer, unscale."""
    scale = f"{10 ** digits}.0E0"
    return f"(round_even(({expr}) * {scale}, 0) / {scale} + 0.0)"


def _serving() -> dict[str, str]:
    vint = "SELECT cohort, month_num, obs_month, {m}, " + SIZE_RANK.format(c="cohort") + " AS cohort_rank FROM vintage"
    heat_cols = ", ".join(
        f"MAX(CASE WHEN obs_month = '{lab}' THEN delinquency_rate_pct END) AS \"{lab}\"" for lab in LABELS)

    def latest(value, status, prefix):
        f = f"FILTER (WHERE {value} IS NOT NULL)"
        return (f"MAX(year) {f} AS {prefix}_year, max_by({value}, year) {f} AS {value}, "
                f"max_by({status}, year) {f} AS {status}")

    levels = " UNION ALL ".join(
        f"SELECT '{k}' AS level, {k} AS label, CAST(SUM(loan_count) AS BIGINT) AS loan_count, "
        "CAST(SUM(total_credit_limit) AS BIGINT) AS total_credit_limit, CAST(SUM(npl_count) AS BIGINT) AS npl_count, "
        f"{xavg('avg_utilisation_pct', '100')} AS mean_utilisation_pct FROM summary GROUP BY {k}"
        for k in ("dpd_bucket", "education_level", "credit_size_bucket", "age_band"))

    def risk(mart, level, table, group):
        own = {"npl": ("CAST(SUM(npl_count) AS BIGINT)", xavg("provision_coverage_pct", "100"), "NULL", "NULL"),
               "ecl": ("NULL", "NULL", "CAST(SUM(total_ead) AS BIGINT)", "SUM(total_ecl)")}[mart]
        label, by = (level, f" GROUP BY {level}") if group else ("NULL", "")
        return (f"SELECT '{mart}' AS mart, '{level if group else 'total'}' AS level, {label} AS label, "
                f"CAST(SUM(loan_count) AS BIGINT) AS loan_count, {own[0]} AS npl_count, {own[1]} AS mean_coverage_pct, "
                f"{own[2]} AS total_ead, {own[3]} AS total_ecl FROM {table}{by}")

    return {
        "page_portfolio": with_ctes(levels + f"""
  UNION ALL SELECT 'total', NULL, CAST(SUM(loan_count) AS BIGINT), CAST(SUM(total_credit_limit) AS BIGINT),
         CAST(SUM(npl_count) AS BIGINT), {xavg('avg_utilisation_pct', '100')} FROM summary""", "summary"),
        "page_risk": with_ctes(" UNION ALL ".join(
            risk(m, k, t, g) for m, k, t in (("npl", "dpd_bucket", "npl"), ("ecl", "ifrs9_stage", "ecl_mart")) for g in (True, False)),
            "npl", "ecl_mart"),
        "dash_portfolio_kpis": with_ctes(f"""
  SELECT CAST(SUM(loan_count) AS BIGINT) AS total_loans,
         CAST(SUM(total_credit_limit) AS BIGINT) AS total_exposure,
         {reven(xavg('avg_utilisation_pct', '100'), 1)} AS avg_utilisation_pct,
         CASE WHEN SUM(loan_count) > 0
              THEN {reven('CAST(SUM(npl_count) AS DOUBLE) / SUM(loan_count) * 100', 2)}
              ELSE 0.0E0 END AS portfolio_npl_rate_pct
  FROM summary""", "summary"),
        "dash_by_dpd": with_ctes(
            f"SELECT dpd_bucket, CAST(SUM(loan_count) AS BIGINT) AS loan_count, {DPD_RANK} AS bucket_rank "
            "FROM summary GROUP BY dpd_bucket", "summary"),
        "dash_by_education": with_ctes(
            f"SELECT education_level, loan_count, {_share('loan_count')} FROM "
            "(SELECT education_level, CAST(SUM(loan_count) AS BIGINT) AS loan_count FROM summary "
            "GROUP BY education_level) g", "summary"),
        "dash_exposure_by_size": with_ctes(
            "SELECT credit_size_bucket, CAST(SUM(total_credit_limit) AS BIGINT) AS total_credit_limit, "
            f"{SIZE_RANK.format(c='credit_size_bucket')} AS size_rank FROM summary GROUP BY credit_size_bucket",
            "summary"),
        "dash_by_age_band": with_ctes(
            f"SELECT age_band, CAST(SUM(loan_count) AS BIGINT) AS loan_count, {AGE_RANK} AS age_rank "
            "FROM summary GROUP BY age_band", "summary"),
        "dash_risk_kpis": with_ctes(f"""
  SELECT total_loans, npl_loans, total_ecl_provision, total_ead, portfolio_npl_rate_pct,
         15.0E0 AS npl_threshold_pct,
         CASE WHEN portfolio_npl_rate_pct > 15.0 THEN 'Above' ELSE 'Below' END AS npl_vs_threshold,
         portfolio_ecl_rate_pct
  FROM (
    SELECT a.total_loans, a.npl_loans, b.total_ecl_provision, b.total_ead,
           CASE WHEN a.total_loans > 0
                THEN {reven('CAST(a.npl_loans AS DOUBLE) / a.total_loans * 100', 2)}
                ELSE 0.0E0 END AS portfolio_npl_rate_pct,
           CASE WHEN b.total_ead > 0
                THEN {reven('b.total_ecl_provision / b.total_ead * 100', 2)}
                ELSE 0.0E0 END AS portfolio_ecl_rate_pct
    FROM (SELECT CAST(SUM(loan_count) AS BIGINT) AS total_loans,
                 CAST(SUM(npl_count) AS BIGINT) AS npl_loans FROM npl) a
    JOIN (SELECT SUM(total_ecl) AS total_ecl_provision,
                 CAST(SUM(total_ead) AS BIGINT) AS total_ead FROM ecl_mart) b ON TRUE) k""",
                                    "npl", "ecl_mart"),
        "dash_npl_by_dpd": with_ctes(f"""
  SELECT dpd_bucket, loan_count, npl_count,
         {reven('CAST(npl_count AS DOUBLE) / loan_count * 100', 2)} AS npl_rate,
         15.0E0 AS npl_threshold_pct, {DPD_RANK} AS bucket_rank
  FROM (SELECT dpd_bucket, CAST(SUM(loan_count) AS BIGINT) AS loan_count,
               CAST(SUM(npl_count) AS BIGINT) AS npl_count FROM npl GROUP BY dpd_bucket) g""", "npl"),
        "dash_ecl_by_stage": with_ctes(f"""
  SELECT ifrs9_stage, total_ead, total_ecl, loan_count,
         {reven('CASE WHEN total_ead <> 0 THEN total_ecl / total_ead * 100 ELSE 0.0E0 END', 2)} AS ecl_rate
  FROM (SELECT ifrs9_stage, CAST(SUM(total_ead) AS BIGINT) AS total_ead, SUM(total_ecl) AS total_ecl,
               CAST(SUM(loan_count) AS BIGINT) AS loan_count FROM ecl_mart GROUP BY ifrs9_stage) g""",
                                       "ecl_mart"),
        "dash_coverage_by_dpd": with_ctes(
            f"SELECT dpd_bucket, {xavg('provision_coverage_pct', '100')} AS provision_coverage_pct, "
            f"{DPD_RANK} AS bucket_rank FROM npl GROUP BY dpd_bucket", "npl"),
        "dash_ead_share": with_ctes(
            f"SELECT ifrs9_stage, total_ead, {_share('total_ead')} FROM "
            "(SELECT ifrs9_stage, CAST(SUM(total_ead) AS BIGINT) AS total_ead FROM ecl_mart "
            "GROUP BY ifrs9_stage) g", "ecl_mart"),
        "dash_vintage_delinquency": with_ctes(vint.format(m="delinquency_rate_pct"), "vintage"),
        "dash_vintage_default": with_ctes(vint.format(m="default_rate_pct"), "vintage"),
        "dash_vintage_balance": with_ctes(vint.format(m="avg_balance"), "vintage"),
        "dash_vintage_heatmap": with_ctes(
            f"SELECT cohort, {SIZE_RANK.format(c='cohort')} AS cohort_rank, {heat_cols} "
            "FROM vintage GROUP BY cohort", "vintage"),
        "dash_reg_latest": with_ctes(
            "SELECT country_code, "
            + latest("npl_ratio_pct", "npl_status", "data").replace("data_year", "data_year") + ", "
            + latest("bank_capital_assets_ratio_pct", "capital_status", "capital") + ", "
            + latest("gdp_growth_annual_pct", "gdp_status", "gdp")
            + " FROM reg GROUP BY country_code", "reg"),
        "dash_reg_npl_trend": with_ctes(
            "SELECT country_code, year, npl_ratio_pct, 15.0E0 AS warning_threshold_pct, "
            "10.0E0 AS watch_level_pct FROM reg WHERE npl_ratio_pct IS NOT NULL", "reg"),
        "dash_reg_capital_trend": with_ctes(
            "SELECT country_code, year, bank_capital_assets_ratio_pct, 8.0E0 AS min_capital_ratio_pct "
            "FROM reg WHERE bank_capital_assets_ratio_pct IS NOT NULL", "reg"),
        "dash_reg_credit_trend": with_ctes(
            "SELECT country_code, year, credit_private_sector_gdp_pct FROM reg "
            "WHERE credit_private_sector_gdp_pct IS NOT NULL", "reg"),
        "dash_reg_growth_inflation": with_ctes(
            "SELECT country_code, year, gdp_growth_annual_pct, inflation_cpi_annual_pct FROM reg "
            "WHERE gdp_growth_annual_pct IS NOT NULL AND inflation_cpi_annual_pct IS NOT NULL", "reg"),
        "dash_regulatory_history": with_ctes(
            "SELECT country_code, year, npl_ratio_pct, bank_capital_assets_ratio_pct, "
            "credit_private_sector_gdp_pct, gdp_growth_annual_pct, npl_status, capital_status, gdp_status "
            "FROM reg", "reg"),
    }


# Model name -> CTE holding it in the oracle.
MODEL_CTE = {
    "raw_macro": "raw_macro", "raw_credit": "raw_credit", "raw_marketing": "raw_marketing",
    "stg_macro": "stg_macro", "stg_credit_default": "stg_credit", "stg_bank_marketing": "stg_marketing",
    "int_loan_delinquency": "delinq", "int_portfolio_segments": "seg", "int_ecl_inputs": "ecl",
    "mart_portfolio_summary": "summary", "mart_npl_analysis": "npl", "mart_vintage_curves": "vintage",
    "mart_regulatory_ratios": "reg", "mart_ecl_estimates": "ecl_mart",
}


#: the 54 declared checks: table, column(s), check, accepted values
BUCKETS = "'Current', '1-30 DPD', '31-60 DPD', '61-90 DPD', '90+ DPD'"
STAGES = "'Stage 1', 'Stage 2', 'Stage 3'"
CHECKS = (
    ("raw_macro", "year", "not_null"),
    ("raw_macro", "country_code,year", "unique"),
    ("raw_macro", "country_code", "not_null"),
    ("raw_credit", "id", "not_null"),
    ("raw_credit", "id", "unique"),
    ("raw_credit", "credit_limit", "not_null"),
    ("raw_credit", "is_default", "not_null"),
    ("raw_credit", "is_default", "accepted_values", "0, 1"),
    ("raw_marketing", "id", "not_null"),
    ("raw_marketing", "id", "unique"),
    ("raw_marketing", "age", "not_null"),
    ("raw_marketing", "subscribed_term_deposit", "not_null"),
    ("raw_marketing", "subscribed_term_deposit", "accepted_values", "'yes', 'no'"),
    ("stg_macro", "year", "not_null"),
    ("stg_macro", "country_code,year", "unique"),
    ("stg_macro", "country_code", "not_null"),
    ("stg_credit_default", "id", "not_null"),
    ("stg_credit_default", "id", "unique"),
    ("stg_credit_default", "credit_limit", "not_null"),
    ("stg_credit_default", "is_default", "not_null"),
    ("stg_bank_marketing", "id", "not_null"),
    ("stg_bank_marketing", "id", "unique"),
    ("stg_bank_marketing", "age", "not_null"),
    ("int_loan_delinquency", "id", "not_null"),
    ("int_loan_delinquency", "id", "unique"),
    ("int_loan_delinquency", "dpd_bucket", "not_null"),
    ("int_loan_delinquency", "dpd_bucket", "accepted_values", BUCKETS),
    ("int_loan_delinquency", "risk_grade", "not_null"),
    ("int_loan_delinquency", "risk_grade", "accepted_values", "1, 2, 3, 4"),
    ("int_portfolio_segments", "id", "not_null"),
    ("int_portfolio_segments", "id", "unique"),
    ("int_portfolio_segments", "is_npl", "not_null"),
    ("int_portfolio_segments", "is_npl", "accepted_values", "0, 1"),
    ("int_portfolio_segments", "utilisation_rate_pct", "not_null"),
    ("int_ecl_inputs", "id", "not_null"),
    ("int_ecl_inputs", "id", "unique"),
    ("int_ecl_inputs", "ifrs9_stage", "not_null"),
    ("int_ecl_inputs", "ifrs9_stage", "accepted_values", STAGES),
    ("int_ecl_inputs", "ecl_amount", "not_null"),
    ("mart_portfolio_summary", "loan_count", "not_null"),
    ("mart_portfolio_summary", "default_rate_pct", "not_null"),
    ("mart_portfolio_summary", "npl_rate_pct", "not_null"),
    ("mart_npl_analysis", "npl_rate_pct", "not_null"),
    ("mart_npl_analysis", "provision_coverage_pct", "not_null"),
    ("mart_vintage_curves", "cohort", "not_null"),
    ("mart_vintage_curves", "month_num", "not_null"),
    ("mart_vintage_curves", "delinquency_rate_pct", "not_null"),
    ("mart_regulatory_ratios", "year", "not_null"),
    ("mart_regulatory_ratios", "country_code,year", "unique"),
    ("mart_regulatory_ratios", "npl_status", "accepted_values", "'OK', 'WATCH', 'BREACH'"),
    ("mart_regulatory_ratios", "capital_status", "accepted_values", "'OK', 'BREACH'"),
    ("mart_ecl_estimates", "ifrs9_stage", "not_null"),
    ("mart_ecl_estimates", "ifrs9_stage", "accepted_values", STAGES),
    ("mart_ecl_estimates", "total_ecl", "not_null"),
)
#: row-count rules of the loaded raw tables
ROW_COUNTS = (("raw_macro", ">", 10), ("raw_credit", "=", 30000), ("raw_marketing", ">=", 40000))


def _check_sql(model: str, columns: str, kind: str, values: str = "") -> str:
    t = MODEL_CTE[model]
    head = f"SELECT '{model}' AS model, '{columns}' AS column_name, '{kind}' AS check_name, "
    if kind == "not_null":
        return head + f"CAST(COUNT(*) AS BIGINT) AS failing_rows FROM {t} WHERE {columns} IS NULL"
    if kind == "unique":
        nn = " AND ".join(f"{k} IS NOT NULL" for k in columns.split(","))
        return (head + "CAST(COUNT(*) AS BIGINT) AS failing_rows FROM "
                f"(SELECT {columns} FROM {t} WHERE {nn} GROUP BY {columns} HAVING COUNT(*) > 1) d")
    return (head + "CAST(COUNT(*) AS BIGINT) AS failing_rows FROM "
            f"(SELECT {columns} FROM {t} GROUP BY {columns}) v WHERE {columns} NOT IN ({values})")


def _quality() -> dict[str, str]:
    def union(kinds):
        cs = [c for c in CHECKS if c[2] in kinds]
        return with_ctes("\nUNION ALL\n".join(_check_sql(*c) for c in cs), *sorted({MODEL_CTE[c[0]] for c in cs}))

    op_sql = {">": ">", "=": "=", ">=": ">="}
    counts = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, '{op} {b}' AS rule, "
        f"COUNT(*) {op_sql[op]} {b} AS passed FROM {MODEL_CTE[t]}" for t, op, b in ROW_COUNTS)
    return {
        "dq_not_null": union(("not_null",)),
        "dq_unique": union(("unique",)),
        "dq_accepted_values": union(("accepted_values",)),
        "dq_all": union(("not_null", "unique", "accepted_values")),
        "dq_row_counts": with_ctes(counts, *[MODEL_CTE[t] for t, _, _ in ROW_COUNTS]),
        "dq_countries": with_ctes(
            "SELECT country_code, COUNT(*) AS row_count FROM raw_macro GROUP BY country_code", "raw_macro"),
        "dq_not_all_null": with_ctes("""
  SELECT 'npl_ratio_pct' AS column_name, COUNT(npl_ratio_pct) AS non_null_rows,
         COUNT(npl_ratio_pct) > 0 AS not_all_null, 'KEN' AS expected_country,
         COALESCE(MAX(country_code = 'KEN'), FALSE) AS expected_country_present
  FROM raw_macro""", "raw_macro"),
    }


#: columns that the derivations of the loan, macro and marketing inputs read
SOURCE_COLUMNS = {
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag"),
    "customer": ("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "nation": ("n_nationkey", "n_name"),
}
#: the footers are read by path: the folder that the correctness run reads
FOOTER_DIR = "/root/testdata/sf0.01"


def schema_sql(folder: str = FOOTER_DIR) -> str:
    paths = ", ".join(f"'{folder}/{t}.parquet'" for t in SOURCE_COLUMNS)
    needed = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name" for t, cols in SOURCE_COLUMNS.items() for c in cols)
    return f"""
  WITH found AS (SELECT regexp_extract(file_name, '([a-z]+)[.]parquet$', 1) AS table_name,
                        regexp_extract(file_name, '[^/]+$') AS file_name, name AS column_name, type AS physical_type
                 FROM parquet_schema([{paths}]) WHERE type IS NOT NULL),
  needed AS ({needed}),
  files AS (SELECT DISTINCT table_name, file_name FROM found)
  SELECT COALESCE(f.table_name, n.table_name) AS table_name, COALESCE(f.file_name, n.file_name) AS file_name,
         COALESCE(f.column_name, n.column_name) AS column_name, physical_type,
         n.column_name IS NOT NULL AS required, f.column_name IS NOT NULL AS present
  FROM found f FULL OUTER JOIN (SELECT * FROM needed JOIN files USING (table_name)) n
    ON f.table_name = n.table_name AND f.file_name = n.file_name AND f.column_name = n.column_name"""


def more_queries() -> dict[str, str]:
    q = {"dq_schema": schema_sql()}
    q.update(_sources())
    q.update(_functions())
    q.update(_serving())
    q.update(_quality())
    return q
