"""Versioned tables, checks on the write path, and the gate of the job."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from compare import canon
from conftest import SF_SMALL
from riskloom.operators import marts, quality
from riskloom.plans import pipeline as P
from riskloom.plans.layers import Layers
from riskloom.plans.store import NotPublished, Store
from riskloom.sources import testtables as tt
from riskloom.sources.schemas import INDICATORS


def fresh(scratch, name):
    return os.path.join(scratch, f"{name}-{uuid.uuid4().hex}")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def run(spark, scratch):
    return P.run_pipeline(spark, P.raw_from_tables(spark, SF_SMALL), fresh(scratch, "run"), with_serving=False, buckets=4)


def test_a_job_that_dies_leaves_the_old_table(spark, scratch):
    store = Store(spark, fresh(scratch, "store"))
    with pytest.raises(NotPublished):
        store.read("marts", "t")
    store.replace(spark.range(5), "marts", "t")
    # killed between the write and the pointer
    new = store.write(spark.range(7), "marts", "t")
    assert store.read("marts", "t").count() == 5
    # killed while it writes
    with pytest.raises(Exception):
        store.write(spark.range(9, numPartitions=3).select(F.when(F.col("id") > 7, F.raise_error(F.lit("dead"))).otherwise(F.col("id")).alias("id")), "marts", "t")
    assert Store(spark, store.base).read("marts", "t").count() == 5
    store.publish("marts", "t", new)
    assert store.read("marts", "t").count() == 7


def test_a_reader_keeps_its_version_and_old_ones_go(spark, scratch):
    store = Store(spark, fresh(scratch, "store"))
    held = store.replace(spark.range(1), "l", "t")
    store.replace(spark.range(2), "l", "t")
    assert held.count() == 1                                   # one version back is still there
    for n in (3, 4, 5):
        store.replace(spark.range(n), "l", "t")
    assert store.read("l", "t").count() == 5
    left = [x for x in os.listdir(store.folder("l", "t")) if x.startswith("v-")]
    assert len(left) == 2
    with pytest.raises(Exception):
        held.count()


def test_bucketed_table_read_by_another_session(spark, scratch):
    store = Store(spark, fresh(scratch, "store"))
    store.replace(spark.range(100).withColumn("x", F.col("id") % 3), "l", "t", buckets=4)
    for (table,) in spark.sql("SHOW TABLES LIKE 'riskloom_l_t_*'").select("tableName").collect():
        spark.sql(f"DROP TABLE {table}")                       # a session that never wrote it
    again = Store(spark, store.base).read("l", "t")
    assert sorted(r.id for r in again.collect()) == list(range(100))
    assert "Exchange" not in plan_of(again.groupBy("id").count())


def test_unique_checks_and_distinct_counts_need_no_exchange_on_id(spark, run):
    for model in ("raw_credit", "stg_credit_default", "int_loan_delinquency", "int_portfolio_segments", "int_ecl_inputs"):
        per_id = run[model].filter("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        assert "Exchange" not in plan_of(per_id), model
    unique = plan_of(quality.run_checks(run, kinds=("unique",)))
    assert "hashpartitioning(id" not in unique
    vintage = plan_of(marts.mart_vintage_curves(run["stg_credit_default"]))
    assert "hashpartitioning(cohort" in vintage and not any("hashpartitioning" in x and "id#" in x for x in vintage.splitlines())


def test_observed_checks_equal_the_scanned_ones(spark, run):
    scanned = quality.run_checks(P_models(run))
    assert canon(run["dq_checks"].toPandas()) == canon(scanned.toPandas())
    counts = quality.row_count_results(run)
    assert canon(run["dq_row_counts"].toPandas()) == canon(counts.toPandas())
    assert P.failures(run) == []
    assert all("raw_" in x for x in P.failures(run, row_counts=True))


def P_models(run):
    return {m: run[m] for m in {c.model for c in quality.CHECKS}}


def test_observed_checks_scan_nothing(spark, scratch):
    """Clean tables: the answers come without any frame to read. Broken ones: counted exactly."""
    rows = spark.createDataFrame([(1, 20, "yes"), (2, 17, "no"), (None, 40, "no"), (None, 12, None)],
                                 "id bigint, age bigint, subscribed_term_deposit string")
    store, watch = Store(spark, fresh(scratch, "store")), quality.WriteChecks()
    P._write_all({"raw_marketing": rows}, store, "raw", 1, watch)
    got = {(m, c, k): n for m, c, k, n in watch.results({})}
    assert watch.rows("raw_marketing") == 4
    assert got["raw_marketing", "id", "not_null"] == 2
    assert got["stg_bank_marketing", "id", "not_null"] == 1          # the view drops the row aged 12
    assert got["raw_marketing", "subscribed_term_deposit", "not_null"] == 1
    assert got["raw_marketing", "subscribed_term_deposit", "accepted_values"] == 0
    bad = rows.withColumn("subscribed_term_deposit", F.concat(F.lit("v"), F.col("age") % 2))
    watch = quality.WriteChecks()
    t = P._write_all({"raw_marketing": bad}, store, "raw", 1, watch)
    got = {(m, c, k): n for m, c, k, n in watch.results(t)}
    assert got["raw_marketing", "subscribed_term_deposit", "accepted_values"] == 2


def test_one_scan_per_table_and_unique_key(spark, run):
    models = P_models(run)
    cells = [c for c in quality.CHECKS if c.kind != "unique"]
    assert plan_of(quality.run_checks(models, cells)).count("FileScan") == len({c.model for c in cells})
    unique = [c for c in quality.CHECKS if c.kind == "unique"]
    assert plan_of(quality.run_checks(models)).count("FileScan") == len({c.model for c in cells}) + len(unique)


def test_bad_values_of_two_columns_in_one_scan(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 9), ("b", 9), ("c", None), (None, 8)], "dpd_bucket string, risk_grade int")
    checks = [c for c in quality.CHECKS if c.model == "int_loan_delinquency" and c.column in ("dpd_bucket", "risk_grade")]
    got = {(r.column_name, r.check_name): r.failing_rows for r in quality.run_checks({"int_loan_delinquency": rows}, checks).collect()}
    assert got == {("dpd_bucket", "not_null"): 1, ("dpd_bucket", "accepted_values"): 3,
                   ("risk_grade", "not_null"): 1, ("risk_grade", "accepted_values"): 2}


def landed(spark, folder, credit):
    lay = Layers(spark, SF_SMALL)
    credit(tt.credit_positional(lay.raw_credit)).write.parquet(f"{folder}/credit")
    tt.marketing_source_named(lay.raw_marketing).drop("row_key").write.option("header", "true").csv(f"{folder}/marketing")
    series = []
    for code, name in INDICATORS.items():
        lay.macro_long.filter(F.col("indicator") == name).select("country_code", "year", "value").write.parquet(f"{folder}/{name}")
        series.append(f"{code}={folder}/{name}")
    return ["--out", f"{folder}/out", "--credit", f"{folder}/credit", "--positional", "--marketing", f"{folder}/marketing",
            "--no-serving", "--macro", *series]


def test_the_job_fails_on_a_failing_check(spark, scratch, capsys):
    bad = lambda df: df.withColumn("Y", F.when(F.col("id") % 5 == 0, F.lit(7)).otherwise(F.col("Y")))
    assert P.main(landed(spark, fresh(scratch, "bad"), bad)) == 1
    said = capsys.readouterr().out
    assert "check failed: raw_credit.is_default accepted_values: 1" in said


def test_the_job_passes_clean_files_and_names_a_file_without_a_column(spark, scratch, capsys):
    args = landed(spark, fresh(scratch, "clean"), lambda df: df)
    assert P.main([*args, "--bucketed"]) == 0
    folder = args[3]
    spark.read.parquet(folder).limit(3).withColumn("id", F.col("id") + 10**9).drop("X23").coalesce(1).write.mode("append").parquet(folder)
    assert P.main(args) == 1
    assert "column missing: landed_credit.X23 in part-" in capsys.readouterr().out


def test_the_job_lists_rejected_cells(spark, scratch, capsys):
    folder = fresh(scratch, "dirty")
    args = landed(spark, folder, lambda df: df)
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    args[args.index("--marketing") + 1] = tt.land_contacts(customer, f"{folder}/contacts", 2)
    assert P.main([*args, "--quarantine"]) == 0
    store = Store(spark, f"{folder}/out")
    rejected = store.read("quarantine", "quarantine_raw_marketing").select("position").distinct().count()
    assert rejected > 0 and store.read("raw", "raw_marketing").count() + rejected == customer.count()
    assert f"raw_marketing: {rejected} rows in quarantine" in capsys.readouterr().out


def tables_in(spark):
    from riskloom.session import checkpoint_dir
    base = checkpoint_dir(spark).removeprefix("file:")
    folder = os.path.join(base, "riskloom-tables")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_scratch_tables_belong_to_their_block(spark):
    import __spark_entry__ as E
    from riskloom.session import scratch as owned
    before = tables_in(spark)
    with owned(spark) as written:
        for key in ("dq_all", "mart_ecl_estimates", "mart_vintage_curves", "surrogate_id", "page_risk"):
            E.queries()[key](spark, SF_SMALL).collect()
        assert len(written) >= 6 and len(tables_in(spark)) >= len(before) + 6
    assert tables_in(spark) == before
    with pytest.raises(ZeroDivisionError), owned(spark):
        E.queries()["mart_ecl_estimates"](spark, SF_SMALL).collect()
        1 / 0
    assert tables_in(spark) == before


def test_scratch_holds_only_the_columns_that_are_read(spark):
    lay = Layers(spark, SF_SMALL, cut=Layers.FOR_ECL_MARTS)
    assert len(lay.int_portfolio_segments.columns) == 7
    whole = Layers(spark, SF_SMALL)
    assert canon(lay.mart_npl_analysis.toPandas()) == canon(whole.mart_npl_analysis.toPandas())
    assert canon(lay.mart_ecl_estimates.toPandas()) == canon(whole.mart_ecl_estimates.toPandas())
