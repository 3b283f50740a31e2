"""Landed files: footers of every file, row positions, sides glued row by row."""

import os

import pytest
from pyspark.sql import functions as F

from compare import canon
from conftest import SF_SMALL
from riskloom.plans.layers import Layers
from riskloom.sources import footers, landed, positions, testtables as tt


def same(a, b):
    return canon(a.toPandas()) == canon(b.toPandas())


def fresh(scratch, name):
    import uuid
    return os.path.join(scratch, f"{name}-{uuid.uuid4().hex}")


@pytest.fixture(scope="module")
def mixed(spark, scratch):
    """A folder whose second file lacks a column and whose third one is empty."""
    p = fresh(scratch, "mixed")
    rows = spark.range(30).select("id", (F.col("id") * 2).alias("age"), F.lit("x").alias("job"))
    for i, df in enumerate((rows.coalesce(1), rows.drop("age").coalesce(1), rows.filter("id < 0").coalesce(1))):
        df.write.mode("append").parquet(p)
    return p


def test_a_file_that_lacks_a_column_is_named(spark, mixed):
    t = {"contacts": spark.read.option("mergeSchema", "true").parquet(mixed)}
    res = footers.schema_results(spark, t, {"contacts": ("id", "age", "nothing")})
    gone = sorted((r.column_name, r.file_name) for r in footers.missing(res).collect())
    files = {r.file: r.rows for r in footers.footers(spark, t).groupBy("file").agg(F.max("file_rows").alias("rows")).collect()}
    assert sorted(files.values()) == [0, 30, 30]                      # the empty file is read, too
    without_age = [f.rpartition("/")[2] for f in t["contacts"].inputFiles()
                   if "age" not in spark.read.parquet(f).columns]
    assert len(without_age) == 1
    assert [f for c, f in gone if c == "age"] == without_age
    assert len([f for c, f in gone if c == "nothing"]) == 3
    kinds = {(r.column_name, r.physical_type, r.required) for r in res.filter("present").collect()}
    assert kinds == {("id", "INT64", True), ("age", "INT64", True), ("job", "BYTE_ARRAY", False)}


def test_footers_of_a_store_that_only_spark_opens(spark, mixed):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.landed.link./in", f"file://{mixed}")
    t = lambda p: {"contacts": spark.read.parquet(p)}
    drop = lambda df: df.withColumn("file", F.element_at(F.split("file", "/"), -1))
    assert same(drop(footers.footers(spark, t("viewfs://landed/in"))), drop(footers.footers(spark, t(mixed))))


def test_no_files_no_rows(spark):
    assert footers.footers(spark, {}).count() == 0
    assert footers.schema_results(spark, {}, {"a": ("x",)}).count() == 0


def test_natural_order_of_files():
    names = ["part-10", "part-9", "part-100000", "part-99999", "a", "part-9-b"]
    assert sorted(names, key=positions.natural) == ["a", "part-9", "part-9-b", "part-10", "part-99999", "part-100000"]


def ordered(spark, n, files, name, factor, scratch, fmt="parquet", **options):
    p = fresh(scratch, name)
    w = spark.range(0, n, 1, files).select((F.col("id") * factor).alias(name)).write
    for k, v in options.items():
        w = w.option(k.replace("_", "."), v)
    w.format(fmt).save(p)
    return spark.read.format(fmt).option("header", "true").load(p)


def test_glue_of_unlike_files_and_row_groups(spark, scratch):
    a = ordered(spark, 20_000, 3, "a", 2, scratch)
    b = ordered(spark, 20_000, 13, "b", 3, scratch, parquet_block_size="4096")
    g = positions.glue(a, b)
    assert g.count() == 20_000
    assert g.filter("a * 3 <> b * 2 OR a <> position * 2").count() == 0
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "rangepartitioning" not in plan


def test_positions_of_one_large_file_read_by_many_tasks(spark, scratch):
    a = ordered(spark, 50_000, 1, "a", 1, scratch, parquet_block_size="16384")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert a.rdd.getNumPartitions() > 5
        placed, n = positions.parquet_positions(a)
        assert n == 50_000 and placed.filter("a <> position").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_glue_with_a_split_csv(spark, scratch):
    a = ordered(spark, 5_000, 2, "a", 2, scratch)
    c = ordered(spark, 5_000, 3, "c", 5, scratch, fmt="csv", header="true")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        assert c.rdd.getNumPartitions() > 5
        g = positions.glue(a, c, right_fmt="csv")
        assert g.count() == 5_000 and g.filter("a * 5 <> cast(c as int) * 2").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_unequal_counts_raise(spark, scratch):
    a, b = ordered(spark, 100, 2, "a", 1, scratch), ordered(spark, 101, 3, "b", 1, scratch)
    with pytest.raises(positions.UnequalRows) as e:
        positions.glue(a, b)
    assert (e.value.left, e.value.right) == (100, 101)


def test_glue_of_empty_sides(spark, scratch):
    a, b = ordered(spark, 0, 1, "a", 1, scratch), ordered(spark, 0, 1, "b", 1, scratch)
    assert positions.glue(a, b).collect() == []


def test_credit_files_glued_keep_their_order(spark, scratch):
    raw = Layers(spark, SF_SMALL).raw_credit
    features, target = tt.land_apart(raw, fresh(scratch, "apart"), 4)
    got = landed.read_raw_credit_glued(spark, features, target)
    by_id = {r.id: r for r in raw.collect()}
    rows = got.orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, len(by_id) + 1))
    for r, i in zip(rows, sorted(by_id)):
        assert r[1:] == by_id[i][1:]


def test_files_without_ids_are_numbered_in_file_order(spark, scratch):
    lay = Layers(spark, SF_SMALL)
    p = fresh(scratch, "credit")
    raw = lay.raw_credit.repartitionByRange(5, "id").sortWithinPartitions("id")
    tt.credit_positional(raw).drop("id").write.parquet(p)
    got = landed.read_raw_credit(spark, p, positional=True)
    expect = [r[1:] for r in lay.raw_credit.orderBy("id").collect()]
    assert [r[1:] for r in got.orderBy("id").collect()] == expect
    q = fresh(scratch, "contacts")
    src = tt.marketing_source_named(lay.raw_marketing)
    src.repartitionByRange(3, "row_key").sortWithinPartitions("row_key").drop("row_key").write.option("header", "true").csv(q)
    got = landed.read_raw_marketing(spark, q)
    assert [r[1:] for r in got.orderBy("id").collect()] == [r[1:] for r in lay.raw_marketing.orderBy("id").collect()]


def test_concat_keeps_rows_without_a_partner(spark):
    import __spark_entry__ as E
    got = E.queries()["raw_credit_concat"](spark, SF_SMALL)
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    alone = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left_anti").count()
    assert alone > 0 and got.filter("is_default IS NULL").count() == alone
    assert got.count() == orders.count()
