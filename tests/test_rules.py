"""Business rules through the real column functions, with every bucket edge."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions import rules as R


def one(spark, col, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col.alias("v")).collect()]


def test_all_paid_duly_is_current(spark):
    cols = [f"s{i}" for i in range(6)]
    df = spark.createDataFrame([tuple([-1] * 6)], ", ".join(f"{c} int" for c in cols))
    r = df.select(R.dpd_bucket(R.worst_delay(cols)).alias("b")).first()
    assert r.b == "Current"


def test_all_four_months_late_is_90_plus(spark):
    cols = [f"s{i}" for i in range(6)]
    df = spark.createDataFrame([tuple([4] * 6)], ", ".join(f"{c} int" for c in cols))
    assert df.select(R.dpd_bucket(R.worst_delay(cols))).first()[0] == "90+ DPD"


def test_worst_delay_skips_nulls_and_all_null_is_no_consumption(spark):
    cols = [f"s{i}" for i in range(6)]
    df = spark.createDataFrame([(None, 2, None, -1, None, None), (None,) * 6],
                               ", ".join(f"{c} int" for c in cols))
    assert [r[0] for r in df.select(R.worst_delay(cols)).collect()] == [2, -2]


def test_ecl_amount(spark):
    df = spark.createDataFrame([(0.22, 100000)], "pd double, ead long")
    assert df.select(R.ecl_amount("pd", F.lit(0.45), "ead")).first()[0] == pytest.approx(9900.0)


def test_ecl_negative_balance_gives_negative_loss(spark):
    df = spark.createDataFrame([(0.5, -1000)], "pd double, ead long")
    assert df.select(R.ecl_amount("pd", F.lit(0.45), "ead")).first()[0] == -225.0


def test_utilisation(spark):
    df = spark.createDataFrame([(75000, 150000), (5, 0), (5, -3)], "bal long, lim long")
    assert one(spark, R.utilisation_pct("bal", "lim"), df.collect(), df.schema) == [50.0, 0.0, 0.0]


def test_npl_flag_sum(spark):
    df = spark.createDataFrame([("Current", 0), ("1-30 DPD", 0), ("90+ DPD", 0), ("90+ DPD", 1), ("Current", 1)],
                               "b string, d int")
    assert df.select(F.sum(R.npl_flag("b", "d"))).first()[0] == 3


def test_stage_map_all_buckets(spark):
    df = spark.createDataFrame([(b,) for b in R.DPD_BUCKETS] + [(None,)], "b string")
    got = dict((r[0], r[1]) for r in df.select("b", R.ifrs9_stage("b")).collect())
    assert got == {"Current": "Stage 1", "1-30 DPD": "Stage 2", "31-60 DPD": "Stage 2",
                   "61-90 DPD": "Stage 3", "90+ DPD": "Stage 3", None: "Stage 3"}


def test_coverage_ratio(spark):
    df = spark.createDataFrame([(45000.0, 100000)], "ecl double, npl_ead long")
    assert df.select(R.round_std(R.safe_ratio_pct("ecl", "npl_ead"), 2)).first()[0] == 45.0


def test_bucket_and_grade_edges(spark):
    df = spark.createDataFrame([(d,) for d in (-2, -1, 0, 1, 2, 3, 4, 8)] + [(None,)], "d int")
    rows = df.select("d", R.dpd_bucket("d"), R.risk_grade("d")).collect()
    got = {r[0]: (r[1], r[2]) for r in rows}
    assert got[0] == ("Current", 1) and got[-2] == ("Current", 1)
    assert got[1] == ("1-30 DPD", 2) and got[2] == ("31-60 DPD", 2)
    assert got[3] == ("61-90 DPD", 3) and got[4] == ("90+ DPD", 4) and got[8] == ("90+ DPD", 4)
    assert got[None] == ("90+ DPD", 4)  # NULL falls through to the last branch


def test_age_band_edges(spark):
    df = spark.createDataFrame([(a,) for a in (18, 29, 30, 39, 40, 49, 50, 59, 60, 100)], "a long")
    got = [r[0] for r in df.select(R.age_band("a")).collect()]
    assert got == ["18-29", "18-29", "30-39", "30-39", "40-49", "40-49", "50-59", "50-59", "60+", "60+"]


def test_size_bucket_edges(spark):
    df = spark.createDataFrame([(v,) for v in (50000, 50001, 150000, 150001, 300000, 300001)], "v long")
    got = [r[0] for r in df.select(R.size_bucket("v")).collect()]
    assert got == ["Micro (<50K)", "Small (50K-150K)", "Small (50K-150K)", "Medium (150K-300K)",
                   "Medium (150K-300K)", "Large (>300K)"]


def test_status_flags_edges_and_null(spark):
    df = spark.createDataFrame([(15.0, 8.0, 0.0), (15.01, 7.99, -0.01), (10.0, None, 3.0),
                                (10.01, 8.0, 2.99), (None, None, None)], "n double, c double, g double")
    got = [tuple(r) for r in df.select(R.npl_status("n"), R.capital_status("c"), R.gdp_status("g")).collect()]
    assert got == [("WATCH", "OK", "SLOW"), ("BREACH", "BREACH", "RECESSION"), ("OK", "OK", "OK"),
                   ("WATCH", "OK", "SLOW"), ("OK", "OK", "OK")]


def test_decode_and_yes_no(spark):
    df = spark.createDataFrame([(1, "yes"), (2, "no"), (3, "unknown"), (4, None), (None, "YES")], "e int, f string")
    got = [tuple(r) for r in df.select(R.decode("e", R.EDUCATION_LABELS), R.yes_no_flag("f")).collect()]
    assert got == [("Graduate School", 1), ("University", 0), ("High School", None), ("Other", None),
                   ("Other", None)]


def test_round_half_away_from_zero_on_binary_value(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (1.005,), (2.675,), (-0.004,)], "x double")
    got = [tuple(r) for r in df.select(R.round_std("x", 0), R.round_std("x", 2)).collect()]
    # 1.005 is stored just below 1.005, so it rounds down; ties away from zero.
    assert got == [(3.0, 2.5), (-3.0, -2.5), (1.0, 1.0), (3.0, 2.68), (0.0, 0.0)]


def test_label_rank(spark):
    df = spark.createDataFrame([(b,) for b in ("90+ DPD", "Current", "zzz")], "b string")
    assert [r[0] for r in df.select(R.label_rank("b", R.DPD_BUCKETS)).collect()] == [5, 1, 6]
