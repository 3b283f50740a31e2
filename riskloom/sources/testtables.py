"""Loan, macro and marketing frames derived from the driver's test tables.

The test tables hold no loan data, so each raw input of the pipeline is
derived from them by a fixed rule (loans from orders and their line items,
a macro panel from orders by nation and year, marketing contacts from
customers). All derivations are plain DataFrame plans over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.rules import PANEL_MONTHS
from riskloom.session import broadcast_if_small, table_path
from riskloom.sources.schemas import (BILL_AMT_COLS, CREDIT_POSITIONAL_NAMES, INDICATOR_COLUMNS,
                                      RAW_CREDIT_COLUMNS, RAW_MARKETING_COLUMNS)

# Dimension tables are broadcast only while their estimated size stays under this.
DIMENSION_MAX_BYTES = 64 << 20

# --- Fixed values of the derivation rules (test-data mapping).
QUANTITY_STATUS_BOUNDS = ((20, -2), (34, -1), (44, 0), (46, 1), (48, 2), (49, 3))
QUANTITY_STATUS_ELSE = 4            # plus l_partkey modulo 6: codes 4..9
QUANTITY_STATUS_SPREAD = 6
DEFAULT_MIN_RETURNS = 3
CREDIT_LIMIT_OFFSET = 5000
LOW_PRICE_BOUND = 75000
MONTH_ABBREVIATIONS = ("jan", "feb", "mar", "apr", "may", "jun",
                       "jul", "aug", "sep", "oct", "nov", "dec")
YEAR_SHIFT = 4


#: columns that the loan, macro and marketing derivations read
SOURCE_COLUMNS = {
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag"),
    "customer": ("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "nation": ("n_nationkey", "n_name"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _quantity_status(q):
    expr = None
    for bound, status in QUANTITY_STATUS_BOUNDS:
        expr = F.when(q <= bound, F.lit(status)) if expr is None else expr.when(q <= bound, F.lit(status))
    return expr.otherwise((F.lit(QUANTITY_STATUS_ELSE) + F.col("l_partkey") % QUANTITY_STATUS_SPREAD).cast("int"))


def loan_lines(lineitem: DataFrame) -> DataFrame:
    """One row per order: returns count and the six monthly status/bill/payment values.

    Line number i is observation month 1 + (i - 1) modulo 6 (apr..sep), so
    every line counts. (order, line) is not unique in the test data, hence
    MAX per month; a month without a line has no status and no payment
    (NULL) and a bill of 0. The aggregate is algebraic, so map-side partial
    aggregation collapses hot orders before the shuffle.
    """
    q = F.col("l_quantity")
    status = _quantity_status(q)
    bill = F.floor("l_extendedprice") * F.when(F.col("l_tax") == 0, F.lit(-1)).otherwise(F.lit(1))
    pay = F.floor(F.col("l_extendedprice") / 10)
    aggs = [F.sum(F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0))).alias("returns")]
    for i, m in enumerate(PANEL_MONTHS, start=1):
        on = (F.col("l_linenumber") - 1) % len(PANEL_MONTHS) + 1 == i
        aggs += [
            F.max(F.when(on, status)).alias(f"pay_status_{m}"),
            F.coalesce(F.max(F.when(on, bill)), F.lit(0).cast("long")).alias(f"bill_amt_{m}"),
            F.max(F.when(on, pay)).alias(f"pay_amt_{m}"),
        ]
    return lineitem.groupBy("l_orderkey").agg(*aggs)


def loans_from_tables(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Raw credit-default frame: one client per order; an order without line items has no statuses and bills of 0."""
    lines = loan_lines(lineitem)
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    cust = F.col("o_custkey")
    return j.select(
        F.col("o_orderkey").alias("id"),
        (F.floor("o_totalprice") - CREDIT_LIMIT_OFFSET).alias("credit_limit"),
        (F.lit(1) + cust % 2).alias("gender"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("education_level"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1))
         .when(F.col("o_orderstatus") == "O", F.lit(2)).otherwise(F.lit(3)).alias("marital_status"),
        (F.lit(15) + cust % 90).alias("age"),
        *[F.coalesce(c, F.lit(0)).alias(c) if c in BILL_AMT_COLS else c for c in RAW_CREDIT_COLUMNS[6:-1]],
        F.when(F.col("returns") >= DEFAULT_MIN_RETURNS, F.lit(1)).otherwise(F.lit(0)).alias("is_default"),
    )


def credit_positional(loans: DataFrame) -> DataFrame:
    """The same frame under its positional source names X1..X23, Y (id kept)."""
    back = {v: k for k, v in CREDIT_POSITIONAL_NAMES.items()}
    return loans.select("id", *[F.col(c).alias(back[c]) for c in RAW_CREDIT_COLUMNS[1:]])


def credit_targets(lineitem: DataFrame) -> DataFrame:
    """(id, Y) of the orders that have line items: the target side of the split credit files."""
    returns = F.sum(F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0)))
    return lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.when(returns >= DEFAULT_MIN_RETURNS, F.lit(1)).otherwise(F.lit(0)).alias("Y"))


def land_apart(loans: DataFrame, folder: str, files: int) -> tuple[str, str]:
    """Features and target as two landed folders without ids, rows in id order, split into unlike files."""
    ordered = credit_positional(loans)
    features, target = f"{folder}/features", f"{folder}/target"
    for path, side, n in ((features, ordered.drop("Y"), files), (target, ordered.select("id", "Y"), files + 2)):
        side.repartitionByRange(n, "id").sortWithinPartitions("id").drop("id").write.parquet(path)
    return features, target


def macro_panel_from_tables(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Wide macro panel: one row per (nation, year) with five indicator ratios.

    orders x customer is a shuffle join on the customer key (AQE splits a
    hot customer); the nation dimension is broadcast behind a size check.
    The (nation, year) aggregate collapses map-side to a few hundred rows.
    """
    o = orders.select("o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
                      F.year("o_orderdate").alias("order_year"))
    c = customer.select("c_custkey", "c_nationkey")
    n = broadcast_if_small(nation.select("n_nationkey", "n_name"), DIMENSION_MAX_BYTES)
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))

    def share(pred):
        return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0)))

    g = j.groupBy("n_name", "n_nationkey", "order_year").agg(
        F.count(F.lit(1)).alias("n"),
        share(F.col("o_totalprice") < LOW_PRICE_BOUND).alias("low_price"),
        share(F.col("o_orderstatus") == "O").alias("open_orders"),
        share(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.sum(F.when(F.col("o_orderstatus") == "P", F.lit(1))
               .when(F.col("o_orderstatus") == "F", F.lit(-1)).otherwise(F.lit(0))).alias("status_score"),
        share(F.col("o_orderpriority") == "5-LOW").alias("low_priority"),
    )
    key = F.col("n_nationkey") + F.col("order_year") + YEAR_SHIFT
    n_rows = F.col("n")
    panel = g.select(
        F.col("n_name").alias("country_code"),
        (F.col("order_year") + YEAR_SHIFT).cast("int").alias("year"),
        F.when(key % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(100.0) * F.col("low_price") / n_rows).alias("npl_ratio_pct"),
        (F.lit(100.0) * F.col("open_orders") / n_rows).alias("credit_private_sector_gdp_pct"),
        F.when(key % 3 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(50.0) * F.col("urgent") / n_rows).alias("bank_capital_assets_ratio_pct"),
        (F.lit(2.0) + F.lit(20.0) * F.col("status_score") / n_rows).alias("gdp_growth_annual_pct"),
        (F.lit(25.0) * F.col("low_priority") / n_rows).alias("inflation_cpi_annual_pct"),
    )
    # The panel is bounded (countries x years). Hash it by country once: every
    # later step (per-series window, pivot per country-year, per-country LAG)
    # clusters on a superset of country_code and reuses this partitioning.
    return panel.repartition("country_code")


def macro_long(panel: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Long form (country_code, year, indicator, value); NULL values left out unless ``keep_empty``."""
    long = panel.unpivot(["country_code", "year"], list(INDICATOR_COLUMNS), "indicator", "value")
    return long if keep_empty else long.filter(F.col("value").isNotNull())


def macro_wide_by_year(long: DataFrame, years: list[int] | None = None) -> DataFrame:
    """One row per (country, indicator), one column per year (the raw series shape).

    Without ``years`` Spark finds the distinct years itself (one small job
    over a bounded column: years are calendar values).
    """
    g = long.groupBy("country_code", "indicator")
    return (g.pivot("year", years) if years is not None else g.pivot("year")).agg(F.max("value"))


def marketing_from_tables(customer: DataFrame) -> DataFrame:
    """Raw bank-marketing frame: one contact per customer, raw column order."""
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")
    months = F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS])
    cols = {
        "id": k + 1,
        "age": F.lit(15) + k % 90,
        "job": F.lower("c_mktsegment"),
        "marital": F.when(k % 3 == 0, "married").when(k % 3 == 1, "single").otherwise("divorced"),
        "education": F.when(k % 4 == 0, "primary").when(k % 4 == 1, "secondary").when(k % 4 == 2, "tertiary"),
        "has_credit_default": F.when(k % 13 == 0, "unknown").when(bal < 0, "yes").otherwise("no"),
        "avg_yearly_balance": F.floor(bal),
        "has_housing_loan": F.when(k % 3 == 0, "yes").otherwise("no"),
        "has_personal_loan": F.when(k % 5 == 0, "yes").otherwise("no"),
        "contact": F.when(k % 3 == 0, "cellular").when(k % 3 == 1, "telephone"),
        "contact_day_of_week": F.lit(1) + k % 31,
        "month": F.element_at(months, (k % 12 + 1).cast("int")),
        "call_duration_sec": k * 37 % 3600,
        "num_contacts_campaign": F.lit(1) + k % 5,
        "days_since_prev_contact": F.when(k % 4 == 0, k % 400).otherwise(F.lit(-1).cast("long")),
        "num_previous_contacts": k % 7,
        "prev_campaign_outcome": (F.when(k % 4 == 0, "success").when(k % 4 == 1, "failure")
                                  .when(k % 4 == 2, "other")),
        "subscribed_term_deposit": F.when(bal > 7000, "yes").otherwise("no"),
    }
    return customer.select(*[cols[c].alias(c) for c in RAW_MARKETING_COLUMNS])


# --- Fixed values: source-style names of the marketing columns before
# --- normalisation (mixed case, spaces and dots), in raw column order.
MARKETING_SOURCE_NAMES = {
    "age": "Age",
    "job": "Job",
    "marital": "Marital",
    "education": "Education",
    "has_credit_default": "Default",
    "avg_yearly_balance": "Balance",
    "has_housing_loan": "Housing",
    "has_personal_loan": "Loan",
    "contact": "Contact",
    "contact_day_of_week": "Day Of.Week",
    "month": "Month",
    "call_duration_sec": "Duration",
    "num_contacts_campaign": "Campaign",
    "days_since_prev_contact": "pdays",
    "num_previous_contacts": "previous",
    "prev_campaign_outcome": "poutcome",
    "subscribed_term_deposit": "y",
}


def marketing_source_named(marketing: DataFrame) -> DataFrame:
    """Marketing frame under source-style names (id dropped, as fetched)."""
    return marketing.select(*[F.col(c).alias(n) for c, n in MARKETING_SOURCE_NAMES.items()],
                            F.col("id").alias("row_key"))


def land_contacts(customer: DataFrame, path: str, files: int) -> str:
    """Contacts landed as CSV in id order; balances that the source does not know read 'n/a' and some ages carry a unit."""
    src = marketing_source_named(marketing_from_tables(customer))
    text = src.withColumn("Balance", F.when(F.col("row_key") % 11 == 0, F.lit("n/a")).otherwise(F.col("Balance").cast("string")))
    text = text.withColumn("Age", F.when(F.col("row_key") % 17 == 0, F.concat("Age", F.lit(" years"))).otherwise(F.col("Age").cast("string")))
    (text.repartitionByRange(files, "row_key").sortWithinPartitions("row_key").drop("row_key")
     .write.option("header", "true").csv(path))
    return path
