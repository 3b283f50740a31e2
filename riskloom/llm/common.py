"""Helpers shared by the text operators: Arrow row mapping, word splitting, the held-out rule."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import materialize, table_path

#: text of one Arrow batch under ``small_batches``
BATCH_BYTES = 4 << 20

#: bytes that end a word under ``[^\x20\x09-\x0D]+``; ``bytes.split()`` splits on exactly these
ASCII_SPACE = b" \t\n\r\x0b\x0c"

#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z, as one byte table:
#: every byte of a non-ASCII code point is >= 0x80 and so stays a word byte
ALNUM_TABLE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256))

#: A-Z to a-z, other bytes unchanged
LOWER_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def held_out(doc_id: Column) -> Column:
    """True for documents whose crc32(doc_id as text) mod 3 is 1 (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def map_text(df: DataFrame, keep: Sequence[str], make: Callable[[], Callable], fields: str,
             text: str = "text", extra: Sequence[str] = ()) -> DataFrame:
    """Per-document Arrow map: ``keep`` columns unchanged, plus the ``fields`` computed from the text.

    ``make()`` runs once per task and returns ``f(texts, *extra_columns)``; it
    gets lists (texts as UTF-8 bytes or None) and returns one list per field.
    Columns travel under positional names, so a column of any name may be
    kept. Row order, row count and repeated rows are unchanged; an empty
    table gives an empty table with the full schema.
    """
    n, m = len(keep), len(extra)
    inner = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                      *[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(extra)],
                      F.col(f"`{text}`").cast("string").cast("binary").alias("t"))
    kept = ", ".join(f"k{i} {inner.schema[i].dataType.simpleString()}" for i in range(n))
    schema = ", ".join(x for x in (kept, fields) if x)
    # types of the new fields, resolved once on the driver
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType
    new = [(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            outs = f(b.column(n + m).to_pylist(), *[b.column(n + i).to_pylist() for i in range(m)])
            arrays = [b.column(i) for i in range(n)] + [pa.array(o, type=t) for o, (_, t) in zip(outs, new)]
            yield pa.RecordBatch.from_arrays(arrays, [f"k{i}" for i in range(n)] + [c for c, _ in new])

    out = inner.mapInArrow(run, schema)
    return out.toDF(*keep, *[c for c, _ in new])


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared checkpoint folder and read back (see ``materialize``).

    The shuffle files behind the written table are of no further use; the
    collection hint lets Spark's cleaner remove them now rather than when the
    driver next runs short of heap.
    """
    out = materialize(df, label)
    cleaned(df.sparkSession)
    return out


def cleaned(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of tables that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*frames: DataFrame) -> None:
    """Delete tables written by ``cut`` that nothing reads any more."""
    for df in frames:
        folders = {f.rpartition("/")[0] for f in df.inputFiles()}
        for folder in folders:
            if "/riskloom-tables/" in folder:
                sc = df.sparkSession.sparkContext
                path = sc._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of the session end at ``BATCH_BYTES`` or less, also in plans that run later.

    Spark ends them at 10,000 rows or 64 MB, and every task holds a few copies, in the JVM and in its Python worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def bounded_broadcast(df: DataFrame, rows: int, most: int = 200_000) -> DataFrame:
    """Broadcast hint for a side whose exact row count is known and under ``most``; else a shuffle join."""
    return F.broadcast(df) if rows <= most else df
