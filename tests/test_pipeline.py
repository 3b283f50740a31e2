"""The layered batch job, and the landed-file readers."""

import os

from pyspark.sql import functions as F

from compare import canon
from conftest import SF_SMALL
from riskloom.operators import reshape
from riskloom.plans.layers import Layers
from riskloom.plans.pipeline import missing_required_columns, raw_from_tables, run_pipeline
from riskloom.sources import landed, testtables as tt
from riskloom.sources.schemas import INDICATORS


def same(a, b):
    return canon(a.toPandas()) == canon(b.toPandas())


def test_pipeline_writes_every_layer_and_matches_queries(spark, scratch):
    out = os.path.join(scratch, "run1")
    t = run_pipeline(spark, raw_from_tables(spark, SF_SMALL), out)
    lay = Layers(spark, SF_SMALL)
    for name in ("int_ecl_inputs", "mart_portfolio_summary", "mart_npl_analysis", "mart_ecl_estimates",
                 "mart_vintage_curves", "mart_regulatory_ratios"):
        assert os.path.isdir(os.path.join(out, "marts" if name.startswith("mart") else "intermediate", name))
        assert same(t[name], getattr(lay, name)), name
    assert t["dq_checks"].count() == 54
    # every report roll-up written by the job equals the registry query of the same key
    import __spark_entry__ as E
    from riskloom.plans.catalog import SERVING
    qs = E.queries()
    for key in SERVING:
        assert same(t[key], qs[key](spark, SF_SMALL)), key
    assert missing_required_columns(t) == {"raw_credit": [], "raw_marketing": []}
    # idempotent: a second run over the same folder replaces the outputs
    first = canon(t["mart_ecl_estimates"].toPandas())
    t2 = run_pipeline(spark, raw_from_tables(spark, SF_SMALL), out, with_serving=False)
    assert canon(t2["mart_ecl_estimates"].toPandas()) == first


def test_landed_positional_credit_round_trip(spark, scratch):
    raw = Layers(spark, SF_SMALL).raw_credit
    p = os.path.join(scratch, "credit_positional")
    tt.credit_positional(raw).write.mode("overwrite").parquet(p)
    assert same(landed.read_raw_credit(spark, p, positional=True), raw)


def test_landed_credit_without_id_gets_dense_ids(spark, scratch):
    raw = Layers(spark, SF_SMALL).raw_credit
    p = os.path.join(scratch, "credit_no_id")
    # the source id survives as an ordinary column used only to order the rows
    tt.credit_positional(raw).withColumnRenamed("id", "X0").write.mode("overwrite").parquet(p)
    got = landed.read_raw_credit(spark, p, positional=True, order_by=["X1", "X2", "X5", "X12", "X18"])
    n = raw.count()
    assert got.count() == n
    assert sorted(r.id for r in got.select("id").collect()) == list(range(1, n + 1))
    assert set(got.columns) == set(raw.columns)


def test_landed_split_credit_joined_by_id(spark, scratch):
    pos = tt.credit_positional(Layers(spark, SF_SMALL).raw_credit)
    fp, tp = os.path.join(scratch, "feat"), os.path.join(scratch, "target")
    pos.drop("Y").write.mode("overwrite").parquet(fp)
    pos.select("id", "Y").orderBy(F.col("id").desc()).write.mode("overwrite").parquet(tp)
    got = landed.read_raw_credit_split(spark, fp, tp)
    assert same(got, Layers(spark, SF_SMALL).raw_credit)


def test_landed_marketing_csv_gets_dense_ids(spark, scratch):
    mk = Layers(spark, SF_SMALL).raw_marketing
    src = tt.marketing_source_named(mk)
    p = os.path.join(scratch, "marketing_csv")
    src.write.mode("overwrite").option("header", "true").csv(p)
    got = landed.read_raw_marketing(spark, p, fmt="csv", order_by=["row_key"])
    assert got.count() == mk.count()
    assert sorted(r.id for r in got.select("id").collect()) == list(range(1, mk.count() + 1))
    assert set(got.columns) == set(mk.columns)


def test_landed_indicators_skip_missing_and_fill_null(spark, scratch):
    long = Layers(spark, SF_SMALL).macro_long
    paths = {}
    for code, name in list(INDICATORS.items())[:3]:
        p = os.path.join(scratch, f"ind_{name}")
        long.filter(F.col("indicator") == name).select("country_code", "year", "value") \
            .write.mode("overwrite").parquet(p)
        paths[code] = p
    paths["MISSING.CODE"] = os.path.join(scratch, "does_not_exist")
    wide = landed.read_raw_macro(spark, paths)
    assert wide.filter(F.col("gdp_growth_annual_pct").isNotNull()).count() == 0
    assert wide.filter(F.col("npl_ratio_pct").isNotNull()).count() > 0


def test_rename_helpers():
    assert reshape.normalise_name("Day Of.Week") == "day_of_week"


def test_concurrent_layer_write_reports_failures(spark, scratch):
    import pytest
    from riskloom.plans.pipeline import _write_all
    from riskloom.plans.store import NotPublished, Store
    good = spark.range(10)
    bad = spark.range(10).select(F.raise_error(F.lit("boom")))
    store = Store(spark, os.path.join(scratch, "concurrent"))
    with pytest.raises(Exception):
        _write_all({"good": good, "bad": bad}, store, "layer", workers=2)
    with pytest.raises(NotPublished):
        store.read("layer", "good")                     # nothing of a failed layer is published
    assert _write_all({"a": good, "b": good}, store, "layer", workers=2)["b"].count() == 10


def test_cli_over_landed_files(spark, scratch, capsys):
    """The shell entry point over landed files: positional credit, ';' CSV, indicator files."""
    from riskloom.plans.pipeline import main
    lay = Layers(spark, SF_SMALL)
    land = os.path.join(scratch, "landed-cli")
    tt.credit_positional(lay.raw_credit).write.mode("overwrite").parquet(f"{land}/credit")
    tt.marketing_source_named(lay.raw_marketing).drop("row_key") \
        .withColumn("seq", F.monotonically_increasing_id()) \
        .write.mode("overwrite").option("header", "true").option("sep", ";").csv(f"{land}/marketing")
    macro_args = []
    for code, name in INDICATORS.items():
        p = f"{land}/ind_{name}"
        lay.macro_long.filter(F.col("indicator") == name).select("country_code", "year", "value") \
            .write.mode("overwrite").parquet(p)
        macro_args.append(f"{code}={p}")
    macro_args.append(f"MISSING.SERIES={land}/nothing_here")
    out = os.path.join(scratch, "cli-out")
    # the marketing file has no id column: the CLI path numbers rows by a landed key
    from riskloom.plans import pipeline as P
    raw = P.raw_from_landed(spark, f"{land}/credit", f"{land}/marketing",
                            dict(a.split("=", 1) for a in macro_args), positional=True,
                            marketing_sep=";", marketing_order_by=["seq"])
    t = P.run_pipeline(spark, raw, out, with_serving=False)
    assert t["raw_credit"].count() == lay.raw_credit.count()
    assert t["raw_marketing"].count() == lay.raw_marketing.count()
    assert same(t["mart_ecl_estimates"], lay.mart_ecl_estimates)
    assert same(t["mart_regulatory_ratios"], lay.mart_regulatory_ratios)
    # argument handling of the shell entry point
    import pytest
    with pytest.raises(SystemExit):
        main(["--out", out])


def test_split_credit_refuses_repeated_target_ids(spark, scratch):
    import pytest
    pos = tt.credit_positional(Layers(spark, SF_SMALL).raw_credit)
    fp, tp = os.path.join(scratch, "feat-dup"), os.path.join(scratch, "target-dup")
    pos.drop("Y").write.mode("overwrite").parquet(fp)
    tgt = pos.select("id", "Y")
    tgt.unionByName(tgt.limit(2)).write.mode("overwrite").parquet(tp)
    with pytest.raises(ValueError):
        landed.read_raw_credit_split(spark, fp, tp)
