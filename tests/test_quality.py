"""Data-quality checks: clean layers pass where the data allows; broken data is caught."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskloom.operators import quality
from riskloom.plans.catalog import models
from riskloom.plans.layers import Layers


def failing(df):
    return {(r.model, r.column_name, r.check_name): r.failing_rows for r in df.collect()}


def test_fifty_four_checks_on_clean_layers(spark):
    res = failing(quality.run_checks(models(Layers(spark, SF_SMALL))))
    assert len(res) == 54
    # The derived layers are clean for every declared check.
    assert {k: v for k, v in res.items() if v} == {}


def test_each_check_kind_catches_broken_data(spark):
    seg = Layers(spark, SF_SMALL).int_portfolio_segments
    dup = seg.unionByName(seg.limit(3))                                   # 3 duplicated ids
    nul = seg.withColumn("is_npl", F.when(F.col("id") % 2 == 0, None).otherwise(F.col("is_npl")))
    bad = seg.withColumn("is_npl", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, 9)
                         .otherwise(F.col("is_npl")))
    checks = [c for c in quality.CHECKS if c.model == "int_portfolio_segments"]
    r_dup = failing(quality.run_checks({"int_portfolio_segments": dup}, checks))
    r_nul = failing(quality.run_checks({"int_portfolio_segments": nul}, checks))
    r_bad = failing(quality.run_checks({"int_portfolio_segments": bad}, checks))
    assert r_dup[("int_portfolio_segments", "id", "unique")] == 3
    assert r_nul[("int_portfolio_segments", "is_npl", "not_null")] == \
        seg.filter(F.col("id") % 2 == 0).count()
    assert r_nul[("int_portfolio_segments", "is_npl", "accepted_values")] == 0   # NULL ignored
    assert r_bad[("int_portfolio_segments", "is_npl", "accepted_values")] == 2   # distinct bad values


def test_row_count_rules(spark):
    rc = {r.table_name: r for r in quality.row_count_results(models(Layers(spark, SF_SMALL))).collect()}
    assert rc["raw_macro"].passed is True
    assert rc["raw_credit"].passed == (rc["raw_credit"].row_count == 30000)


def test_required_columns(spark):
    lay = Layers(spark, SF_SMALL)
    assert quality.missing_columns(lay.raw_credit, quality.REQUIRED_COLUMNS["raw_credit"]) == []
    assert quality.missing_columns(lay.raw_credit.drop("age"), ["id", "age"]) == ["age"]


def test_unique_check_with_a_hot_key(spark):
    """A third of the rows share one id: counted once as a duplicated value, exactly."""
    seg = Layers(spark, SF_SMALL).int_portfolio_segments
    hot = seg.agg(F.min("id")).first()[0]
    skewed = seg.withColumn("id", F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id")))
    checks = [c for c in quality.CHECKS if c.model == "int_portfolio_segments" and c.kind == "unique"]
    res = failing(quality.run_checks({"int_portfolio_segments": skewed}, checks, kinds=("unique",)))
    expect = skewed.groupBy("id").count().filter("count > 1").count()
    assert res[("int_portfolio_segments", "id", "unique")] == expect >= 1


@pytest.fixture(scope="module")
def small_models(spark):
    return models(Layers(spark, SF_SMALL, cut=Layers.FOR_CHECKS))


def _break(df, check):
    if check.kind == "not_null":
        dtype = df.schema[check.column].dataType
        return df.withColumn(check.column, F.lit(None).cast(dtype))
    if check.kind == "unique":
        return df.unionByName(df.limit(1))
    dtype = df.schema[check.column].dataType
    bad = F.lit("__not_listed__") if dtype.typeName() == "string" else F.lit(987654)
    return df.withColumn(check.column, bad.cast(dtype))


@pytest.mark.parametrize("check", quality.CHECKS, ids=lambda c: f"{c.model}.{c.column_name}.{c.kind}")
def test_every_declared_check_catches_its_breakage(spark, small_models, check):
    broken = {check.model: _break(small_models[check.model], check)}
    res = failing(quality.run_checks(broken, [check], kinds=(check.kind,)))
    assert res[(check.model, check.column_name, check.kind)] >= 1
