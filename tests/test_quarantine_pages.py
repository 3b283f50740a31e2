"""Rejected cells beside the good rows, recent years, page roll-ups in one pass, bitmaps of ids."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from compare import canon
from conftest import SF_MID, SF_SMALL
from riskloom.operators import marts, reshape, serving
from riskloom.plans.layers import Layers
from riskloom.sources import landed, testtables as tt
from riskloom.sources.schemas import RAW_MARKETING_COLUMNS, RAW_MARKETING_SCHEMA


def fresh(scratch, name):
    return os.path.join(scratch, f"{name}-{uuid.uuid4().hex}")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def contacts(spark):
    src = tt.marketing_source_named(Layers(spark, SF_SMALL).raw_marketing)
    return src.select([F.col(f"`{c}`").cast("string").alias(c) for c in src.columns]).orderBy(F.col("row_key").cast("long")).drop("row_key")


def test_good_and_rejected_rows_are_all_rows(spark, scratch):
    p = fresh(scratch, "contacts")
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    tt.land_contacts(customer, p, 3)
    good, bad = landed.read_marketing_quarantined(spark, p, fresh(scratch, "split"))
    n = customer.count()
    rejected = {r.position for r in bad.collect()}
    assert good.count() + len(rejected) == n
    assert {r.id - 1 for r in good.select("id").collect()} | rejected == set(range(n))
    both = [r for r in bad.collect() if r.position + 1 in (187, 374)]     # multiples of 11 and of 17: two bad cells a row
    if n >= 187:
        assert sorted(r.column_name for r in both if r.position == 186) == ["age", "avg_yearly_balance"]
    # good rows equal the clean table's, under the same ids
    clean = Layers(spark, SF_SMALL).raw_marketing
    ids = good.select("id")
    assert canon(good.toPandas()) == canon(clean.join(ids, "id", "left_semi").select(*RAW_MARKETING_COLUMNS).toPandas())
    # each rejected cell names the file and the row that holds it
    r = bad.filter("column_name = 'age'").first()
    assert r.raw_value.endswith(" years") and r.reason == "does not fit bigint" and "part-" in r.file


def test_malformed_lines_are_quarantined_whole(spark, scratch):
    p = fresh(scratch, "lines")
    os.makedirs(p)
    names = list(tt.MARKETING_SOURCE_NAMES.values())
    row = [str(40 + i) if RAW_MARKETING_SCHEMA[c].dataType.typeName() == "long" else "no" for i, c in enumerate(tt.MARKETING_SOURCE_NAMES)]
    with open(f"{p}/a.csv", "w") as f:
        f.write("\n".join([",".join(names), ",".join(row), ",".join(row[:5]), ",".join(row + ["more"]), ",".join(row)]) + "\n")
    good, bad = landed.read_marketing_quarantined(spark, p, fresh(scratch, "split"))
    assert sorted(r.id for r in good.collect()) == [1, 4]
    got = sorted((r.position, r.column_name, r.reason, r.raw_value) for r in bad.collect())
    assert got == [(1, None, "malformed line", ",".join(row[:5])), (2, None, "malformed line", ",".join(row + ["more"]))]


def test_parquet_rows_and_empty_files(spark, scratch):
    rows = spark.createDataFrame([("12", "a"), ("x", "b"), (None, "c"), ("13.0", "d"), ("13.5", "e")], "n string, s string").coalesce(1)
    p = fresh(scratch, "p")
    rows.write.parquet(p)
    df = spark.read.parquet(p)
    cols = [("n", F.col("n"), landed.typed(F.col("n"), df.schema["n"].dataType, landed.IntegerType()).alias("n")), ("s", F.col("s"), F.col("s"))]
    good, bad = landed.split_rejected(df, cols, "parquet", fresh(scratch, "split"))
    assert sorted((r.position, r.n, r.s) for r in good.collect()) == [(0, 12, "a"), (2, None, "c"), (3, 13, "d")]
    assert sorted((r.position, r.raw_value, r.reason) for r in bad.collect()) == [(1, "x", "does not fit int"), (4, "13.5", "does not fit int")]
    q = fresh(scratch, "q")
    rows.filter("false").write.parquet(q)
    good, bad = landed.split_rejected(spark.read.parquet(q), cols, "parquet", fresh(scratch, "split"))
    assert good.count() == 0 and bad.count() == 0


def test_recent_years_count_empty_ones_and_cut_before_the_shuffle(spark, scratch):
    rows = [("A", "x", y, None if y % 2 else float(y)) for y in range(2000, 2010)] + [("B", "x", 1990, 1.0)]
    long = spark.createDataFrame(rows, "country_code string, indicator string, year int, value double").repartition(3)
    kept = reshape.recent_values(long, 4)
    assert sorted((r.country_code, r.year) for r in kept.collect()) == [("A", y) for y in range(2006, 2010)] + [("B", 1990)]
    lines = plan_of(kept).splitlines()
    shuffle = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x)
    assert any("WindowGroupLimit" in x and "Partial" in x for x in lines[shuffle:])      # below the exchange
    # the landed reader has the same rule
    p = fresh(scratch, "series")
    long.filter("country_code = 'A'").select("country_code", "year", "value").write.parquet(p)
    got = landed.read_indicator_series(spark, {"x": p}, recent=4)
    assert sorted(r.year for r in got.collect()) == [2006, 2008]


def test_recent_five_cut_something(spark):
    import __spark_entry__ as E
    lay = Layers(spark, SF_SMALL)
    assert 0 < E.queries()["raw_indicator_recent5"](spark, SF_SMALL).count() < lay.raw_indicator_recent.count()


def test_a_page_reads_the_raw_tables_once(spark):
    plan = plan_of(Layers(spark, SF_SMALL).page_portfolio)
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1
    assert "Expand" in plan


def test_page_levels_equal_separate_roll_ups(spark):
    lay = Layers(spark, SF_MID)
    mart = lay.mart_portfolio_summary
    page = lay.page_portfolio
    for key in serving.PORTFOLIO_LEVELS:
        one = mart.groupBy(key).agg(F.sum("loan_count").alias("a"), F.sum("npl_count").alias("b")).select(F.col(key).alias("k"), "a", "b")
        assert canon(page.filter(F.col("level") == key).select(F.col("label").alias("k"), F.col("loan_count").alias("a"),
                                                               F.col("npl_count").alias("b")).toPandas()) == canon(one.toPandas())
    empty = serving.dash_portfolio_kpis(serving.page_portfolio(mart.filter("false"))).first()
    assert (empty.total_loans, empty.total_exposure, empty.portfolio_npl_rate_pct) == (0, 0, 0.0)


def test_null_labels_are_a_level_row_of_their_own(spark):
    mart = Layers(spark, SF_SMALL).mart_portfolio_summary.withColumn("age_band", F.lit(None).cast("string"))
    page = serving.page_portfolio(mart)
    assert page.filter("level = 'age_band' AND label IS NULL").count() == 1
    assert page.filter("level = 'total'").count() == 1


@pytest.mark.parametrize("step", [1, 7, 40_000])
def test_bitmaps_count_like_count_distinct(spark, step):
    ids = spark.range(-500, 20_000).select((F.col("id") * step).alias("id"), (F.col("id") % 3).alias("g"))
    df = ids.unionByName(ids.filter("id % 2 = 0")).unionByName(spark.createDataFrame([(None, 1), (None, 9)], "id bigint, g bigint"))
    got = marts.distinct_by_bitmap(df, ["g"], "id", "n")
    assert canon(got.toPandas()) == canon(df.groupBy("g").agg(F.count_distinct("id").alias("n")).toPandas())


def test_bitmaps_shuffle_less_than_pairs(spark):
    df = spark.range(0, 300_000, 1, 4).select("id", (F.col("id") % 2).alias("g"))
    maps = df.groupBy("g", F.bitmap_bucket_number("id")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("m"))
    # what moves: one 4 KB bitmap per group, bucket and task at most, against 16 bytes an id
    n = maps.count()
    assert n == 21 and n * 4096 * 4 < 300_000 * 16        # id 0 is in a bucket of its own
    plan = plan_of(marts.distinct_by_bitmap(df, ["g"], "id", "n"))
    assert "partial_bitmap_construct_agg" in plan


def test_vintage_forms_agree(spark):
    stg = Layers(spark, SF_MID).stg_credit_default
    assert canon(marts.mart_vintage_curves(stg, dense_ids=True).toPandas()) == canon(marts.mart_vintage_curves(stg).toPandas())
