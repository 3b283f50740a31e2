"""Schemas of Parquet files as their own footers state them, read in parallel.

A table's schema in Spark comes from one footer or a merge; a file that
lacks a column then reads as NULL and nobody is told. Here Spark lists the
files of every table and deals them to tasks, and each task reads the footers
of its files (a few KB each, no data pages), so every file is named with
every column it has, and with every required one that it lacks.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: schemes that Arrow's own file systems open; files elsewhere are handed over by Spark's binary reader
ARROW_SCHEMES = ("", "file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")
FILES_PER_TASK = 64
MAX_TASKS = 10_000
FOOTER_COLUMNS = "table_name string, file string, column_name string, physical_type string, file_rows bigint"


def _rows(table: str, file: str, source) -> list[tuple]:
    import pyarrow.parquet as pq
    meta = pq.read_metadata(source)
    leaves = [meta.schema.column(i) for i in range(meta.num_columns)]
    return [(table, file, c.path, c.physical_type, meta.num_rows) for c in leaves]


def _open(uri: str):
    from pyarrow import fs
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(parsed.path))
    files, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return files.open_input_file(path)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 4 + [pa.int64()]
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                      ["table_name", "file", "column_name", "physical_type", "file_rows"])


def files_of(tables: Mapping[str, DataFrame]) -> list[tuple[str, str]]:
    """(table, file) of every file that Spark would read, empty files included."""
    return [(name, f) for name, df in tables.items() for f in sorted(set(df.inputFiles()))]


def footers(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, file, column_name, physical_type, file_rows): one row per file and leaf column."""
    files = files_of(tables)
    if not files:
        return spark.createDataFrame([], FOOTER_COLUMNS)
    tasks = max(1, min(MAX_TASKS, -(-len(files) // FILES_PER_TASK), len(files)))
    listed = spark.createDataFrame(files, "table_name string, file string")
    elsewhere = [f for _, f in files if urlparse(f).scheme not in ARROW_SCHEMES]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for table, file in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with _open(file) as source:
                    yield _batch(_rows(table, file, source))

    def read_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield _batch(_rows(b.column(0)[i].as_py(), b.column(1)[i].as_py(), io.BytesIO(b.column(2)[i].as_py())))
    if not elsewhere:
        # at least as many tasks as slots for few files, 64 files a task for many
        tasks = max(tasks, min(len(files), spark.sparkContext.defaultParallelism))
        return listed.repartition(tasks, "file").mapInArrow(read, FOOTER_COLUMNS)
    # only Spark opens this store: whole files go through its binary reader
    content = spark.read.format("binaryFile").load(elsewhere).select(F.col("path").alias("file"), "content")
    return listed.join(content, "file").select("table_name", "file", "content").mapInArrow(read_content, FOOTER_COLUMNS)


def schema_results(spark: SparkSession, tables: Mapping[str, DataFrame],
                   required: Mapping[str, Sequence[str]]) -> DataFrame:
    """(table_name, file_name, column_name, physical_type, required, present).

    Every column of every file, and every required column that a file lacks
    (``present`` false, no type). Column names are compared exactly.
    """
    found = footers(spark, tables)
    wanted = spark.createDataFrame([(t, c) for t, cols in required.items() for c in cols] or [(None, None)],
                                   "table_name string, column_name string").filter("table_name IS NOT NULL")
    listed = spark.createDataFrame(files_of(tables) or [(None, None)], "table_name string, file string").filter("file IS NOT NULL")
    # files x required columns of their table: a join on the table's name, metadata only
    needed = listed.join(F.broadcast(wanted), "table_name").withColumn("required", F.lit(True))
    both = found.join(needed, ["table_name", "file", "column_name"], "full_outer")
    return both.select("table_name", F.element_at(F.split("file", "/"), -1).alias("file_name"), "column_name", "physical_type",
                       F.coalesce("required", F.lit(False)).alias("required"),
                       F.col("physical_type").isNotNull().alias("present"))


def missing(results: DataFrame) -> DataFrame:
    """The required columns that a file lacks."""
    return results.filter("required AND NOT present").select("table_name", "file_name", "column_name")
