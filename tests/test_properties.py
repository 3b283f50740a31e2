"""Property tests: rounding parity with the SQL engine, rules vs plain models, exact sums."""

import random
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from riskloom.functions import rules as R


@pytest.fixture(scope="module")
def values():
    rng = random.Random(7)
    vals = [rng.uniform(-1e6, 1e6) for _ in range(3000)]
    vals += [k / 1000 for k in range(-3000, 3000, 7)]           # near-ties at every precision
    vals += [k / 200 for k in range(-500, 500)] + [k + 0.5 for k in range(-50, 50)]  # exact ties
    vals += [0.0, -0.0, 1e-12, -1e-12]
    return vals


@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_round_matches_sql_engine(spark, values, digits):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x double")
    got = {r.i: r.y for r in df.select("i", R.round_std("x", digits).alias("y")).collect()}
    con = duckdb.connect()
    con.register("t", __import__("pandas").DataFrame({"i": range(len(values)), "x": values}))
    want = dict(con.execute(f"SELECT i, ROUND(x, {digits}) + 0.0 FROM t").fetchall())
    bad = [(values[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not bad, bad[:5]


def test_rules_equal_plain_models_over_whole_ranges(spark):
    def bucket(d):
        return "Current" if d <= 0 else {1: "1-30 DPD", 2: "31-60 DPD", 3: "61-90 DPD"}.get(d, "90+ DPD")

    def grade(d):
        return 1 if d <= 0 else 2 if d <= 2 else 3 if d <= 3 else 4

    def band(a):
        return "18-29" if a < 30 else "30-39" if a < 40 else "40-49" if a < 50 else "50-59" if a < 60 else "60+"

    def size(v):
        return ("Micro (<50K)" if v <= 50000 else "Small (50K-150K)" if v <= 150000
                else "Medium (150K-300K)" if v <= 300000 else "Large (>300K)")

    d = spark.range(-5, 15).select(F.col("id").cast("int").alias("d"))
    assert all(r[1] == bucket(r[0]) and r[2] == grade(r[0])
               for r in d.select("d", R.dpd_bucket("d"), R.risk_grade("d")).collect())
    a = spark.range(0, 130).select(F.col("id").alias("a"))
    assert all(r[1] == band(r[0]) for r in a.select("a", R.age_band("a")).collect())
    v = spark.range(-10, 400_000, 997).union(spark.createDataFrame(
        [(x,) for x in (50000, 50001, 150000, 150001, 300000, 300001)], "id long"))
    assert all(r[1] == size(r[0]) for r in v.select("id", R.size_bucket("id")).collect())


def test_exact_sum_and_avg_equal_decimal_arithmetic(spark):
    rng = random.Random(11)
    rows = [(rng.randrange(7), round(rng.uniform(-5000, 5000), 2)) for _ in range(20000)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(13)
    got = {r.g: (r.s, r.a) for r in df.groupBy("g").agg(
        R.round_std(R.exact_sum("v", 2), 2).alias("s"), R.round_std(R.exact_avg("v", 2), 2).alias("a")).collect()}
    for g in got:
        vals = [Decimal(str(v)) for k, v in rows if k == g]
        s = sum(vals)
        a = (s / len(vals)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert got[g][0] == float(s)
        assert abs(got[g][1] - float(a)) < 1e-9


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_report_rounding_matches_numpy_and_sql_round_even(spark, values, digits):
    import numpy as np
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x double")
    got = {r.i: r.y for r in df.select("i", R.round_half_even("x", digits).alias("y")).collect()}
    want = {i: float(np.round(v, digits)) for i, v in enumerate(values)}
    bad = [(values[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not bad, bad[:5]
    con = duckdb.connect()
    con.register("t", __import__("pandas").DataFrame({"i": range(len(values)), "x": values}))
    scale = f"{10 ** digits}.0E0"
    sql = dict(con.execute(f"SELECT i, round_even(x * {scale}, 0) / {scale} + 0.0 FROM t").fetchall())
    assert all(sql[i] == got[i] for i in got)
